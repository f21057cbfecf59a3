"""Helpers shared by the corpus operators: shared scratch tables, words and hashes in Arrow
batches, and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of UTF-8 text that one numpy step works on; a longer single text is a step of its own.
STEP_BYTES = 6 << 20
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
BASE = np.uint64(_BASE)
BASE_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; only where that is unset and Spark runs on this
    machine alone, as in tests, a temporary one is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as a table in the shared folder and read again: lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released() -> None:
    """Give memory that a step has freed back to the system: Python workers outlive their stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of about ``step`` bytes of one text column, by whole rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, before + step, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts in one array, and the offsets of each text's
    words in it (null: no words)."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(full, dtype=np.int64)))
    return flat.filter(pa.array(full)), before[offsets]


def _letter_bytes() -> np.ndarray:
    """ASCII letters in lower case and all bytes of other characters; the rest is a blank."""
    table = np.full(256, 32, np.uint8)
    table[128:] = np.arange(128, 256)
    table[ord("a") : ord("z") + 1] = table[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return table


def terms(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All runs of ASCII letters, in lower case, and other than ASCII characters of the texts in
    one array, and the text that each is from (null: none)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    clean = pa.py_buffer(_letter_bytes()[raw])
    split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, clean], offset=texts.offset))
    flat = split.flatten()
    row = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy())
    full = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(full).dictionary_encode(), row[full.to_numpy(zero_copy_only=False)]


def hash_words(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash for each word; each distinct word is hashed once."""
    if not len(flat):
        return np.zeros(0, np.uint64)
    coded = flat.dictionary_encode()
    values = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, values), np.uint64, len(values))
    return hashes[coded.indices.to_numpy()]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of word sequences that start at any position of an array of word hashes."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        powers = np.full(n + 1, BASE, np.uint64)
        inverse = np.full(n + 1, BASE_INVERSE, np.uint64)
        powers[0] = inverse[0] = 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * np.cumprod(powers, dtype=np.uint64)[:n], dtype=np.uint64, out=self.sums[1:])

    def of(self, starts: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[starts + length] - self.sums[starts]) * self.inverse[starts])

    def all(self, length: int) -> np.ndarray:
        """At every position from which ``length`` words follow in the array."""
        n = max(0, len(self.sums) - length)
        return mix((self.sums[length : length + n] - self.sums[:n]) * self.inverse[:n])


def documents(docs: DataFrame) -> DataFrame:
    """doc_id as long and text as string, whatever other columns there are."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in the links (a, b); component is the smallest id reachable.

    Each round points every node at its smallest neighbour, follows one more pointer and
    contracts the graph, so that paths shrink by a factor and stars go in one round. Minima
    combine before the shuffle; the contracted edges are a table in the shared folder.
    """
    edges = stored(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("to")).union(edges.select("b", "a"))
        nearest = both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("to"))
        nearest = stored(nearest, "nearest")
        level = stored(_follow(nearest, nearest), "level")
        levels.append(level)
        for end in ("a", "b"):
            renamed = level.select(F.col("id").alias(end), F.col("to").alias("_to"))
            edges = edges.join(renamed, end).drop(end).withColumnRenamed("_to", end)
        edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = stored(edges.distinct(), "edges")
    if not levels:
        return links.select(F.col("a").alias("id"), F.col("a").alias("component")).limit(0)
    found = levels[0]
    for level in levels[1:]:
        found = _follow(found, level)
    return found.select("id", F.col("to").alias("component"))


def _follow(pointers: DataFrame, then: DataFrame) -> DataFrame:
    """Point each id at what ``then`` has for the id it points at now."""
    then = then.select(F.col("id").alias("to"), F.col("to").alias("next"))
    return pointers.join(then, "to", "left").select("id", F.coalesce("next", "to").alias("to"))
