"""Hierarchical packing of tokenised documents into windows of several lengths.

Each document is its token ids and an end id.  It goes to the shortest tier that holds it (the
longest tier for longer ones).  Each task packs each tier as one stream, cut at the tier's
length, so windows have no gaps.  What is left in the tiers at the end of a task goes, long
tiers first, into windows of the longest tier: gaps there are filled from the shorter ones.  The
rest of these, less than one window, becomes windows of powers of two, so nothing is padded.
Step groups are numbered after packing, over all tasks: windows of one length are counted by task,
the counts are summed up in the order of tasks, and each STEP_TOKENS ids of windows are a group.
So all steps have the same number of ids and one shape; only the last group of each length of
window may be short.

A task needs the ids of one slice of texts and one open window for each tier.  Words are
tokenised once for each slice or taken from a bounded cache; white space always separates
tokens of this vocabulary, so the ids are those of the whole text.  No shuffle.

Defined results: null and empty texts are the end id alone.  Rows without doc_id and rows that
repeat one are packed as any other.  Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posofold.llm.common import documents, released, slices, stored, words

TIERS = (512, 1024, 2048, 4096)
END, STEP_TOKENS = 2, 32768
#: Words and pieces whose ids a worker keeps, and bytes of text in a step: more is faster.
CACHE, STEP_BYTES = 500_000, 12 << 20
_tokenizers: dict = {}


#: Words of these characters are lower-cased and cut into these pieces as the tokenizer would.
_SIMPLE = re.compile(r"[!-&(-~À-ÖØ-öø-ÿß]+")
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")


class _Vocabulary:
    """Ids of words.  Simple words are tokenised by pieces, which need no normalisation and of
    which there are fewer; bounded caches of words and of pieces keep what is used."""

    def __init__(self, path: str, cache: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content.lower() for t in self.whole.get_added_tokens_decoder().values()]
        with open(path) as file:
            parts = json.load(file)
        parts |= {"normalizer": None, "added_tokens": []}
        parts["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.lean = Tokenizer.from_str(json.dumps(parts))
        self.words, self.pieces = _Cache(self._words, cache), _Cache(lambda new: self._encode(self.lean, new), cache)

    @staticmethod
    def _encode(tokenizer, keys: list[str]) -> list[bytes]:
        found = []
        for start in range(0, len(keys), 5000):
            got = tokenizer.encode_batch(keys[start : start + 5000], add_special_tokens=False)
            found += [array("I", x.ids).tobytes() for x in got]
        return found

    def _words(self, new: list[str]) -> list[bytes]:
        simple, find = _SIMPLE.fullmatch, _PIECE.findall
        cut = [find(w.lower()) if simple(w) and not ("<" in w and any(x in w.lower() for x in self.special)) else None for w in new]
        whole = iter(self._encode(self.whole, [w for w, c in zip(new, cut) if c is None]))
        distinct = list({p for c in cut if c for p in c})
        ids = dict(zip(distinct, self.pieces.get(distinct)))
        return [next(whole) if c is None else ids[c[0]] if len(c) == 1 else b"".join([ids[p] for p in c]) for c in cut]

    def ids(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct words one after another, and the number for each word."""
        found = self.words.get(values)
        return np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) // 4


class _Cache:
    """What was made for keys: a younger and an older part of bounded size."""

    def __init__(self, make, size: int):
        self.make, self.size, self.young, self.old = make, size, {}, {}

    def get(self, keys: list[str]) -> list[bytes]:
        """For distinct keys."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = [k for k in keys if k not in young]
        new = []
        for k in missing:
            if k in old:
                young[k] = old[k]
            else:
                new.append(k)
        young.update(zip(new, self.make(new)))
        return [young[k] for k in keys]


def _gather(values: np.ndarray, count: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of values (count long each) named by which, one after another, and their bounds."""
    first = np.cumsum(count) - count
    n = count[which]
    ends = np.concatenate(([0], np.cumsum(n)))
    return values[np.repeat(first[which] - ends[:-1], n) + np.arange(ends[-1])], ends


def _vocabulary(path: str, cache: int) -> _Vocabulary:
    """One for all tasks of a worker."""
    if (path, cache) not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[path, cache] = _Vocabulary(path, cache)
        released()  # what the file was parsed to
    return _tokenizers[path, cache]


def token_ids(texts: pa.Array, path: str, end: int | None = END, cache: int = CACHE) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and the number for each text."""
    flat, offsets = words(texts)
    coded = flat.dictionary_encode()
    ids, count = _vocabulary(path, cache).ids(coded.dictionary.to_pylist())
    which = coded.indices.to_numpy().astype(np.int64)
    if end is not None:
        ids, count = np.append(ids, np.uint32(end)), np.append(count, 1)
        which = np.insert(which, offsets[1:], len(count) - 1)
        offsets = offsets + np.arange(len(offsets))
    out, ends = _gather(ids, count, which)
    return out, np.diff(ends[offsets])


class _Tier:
    """The stream of one tier: pieces wait until their window is full."""

    def __init__(self, length: int):
        self.length, self.done = length, 0
        self.ids = np.zeros(0, np.uint32)
        self.pieces = [np.zeros(0, np.int64)] * 4  # row of the id, start, length, tokens of the document
        self.docs: list = []

    def add(self, docs: list, ids: np.ndarray, start: np.ndarray, length: np.ndarray, total: np.ndarray) -> None:
        row = np.arange(len(docs)) + len(self.docs)
        self.docs = self.docs + docs
        self.pieces = [np.concatenate(x) for x in zip(self.pieces, (row, start, length, total))]
        self.ids = np.concatenate((self.ids, ids))

    def full(self, window: int | None = None):
        """Cut off all full windows: pieces as (docs, start, length, total, window, offset, crc, ids)."""
        size = window or self.length
        row, start, length, total = self.pieces
        end = np.cumsum(length)
        begin = end - length
        count = np.where(length > 0, (end - 1) // size - begin // size + 1, 0)
        piece = np.repeat(np.arange(len(row)), count)
        k = begin[piece] // size + np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
        a, b = np.maximum(begin[piece], k * size), np.minimum(end[piece], (k + 1) * size)
        limit = len(self.ids) // size * size
        out = a < limit
        cut = [row[piece], start[piece] + a - begin[piece], b - a, total[piece]]
        data = memoryview(self.ids.astype("<u4", copy=False)).cast("B")
        crc = [zlib.crc32(data[4 * x : 4 * y]) for x, y in zip(a[out].tolist(), b[out].tolist())]
        docs = [self.docs[i] for i in cut[0][out].tolist()]
        found = (docs, *(c[out] for c in cut[1:]), k[out] + self.done, a[out] % size, crc, self.ids, a[out], b[out])
        self.done += limit // size
        left = [c[~out] for c in cut]
        self.docs = [self.docs[i] for i in left[0].tolist()]
        left[0] = np.arange(len(self.docs))
        self.pieces, self.ids = left, self.ids[limit:]
        return found


_COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long"
_KINDS = 5  # bits of a sequence_id that tell tiers and tails apart; the task begins at bit 40


def _packer(path: str, tiers: tuple[int, ...], with_ids: bool, cache: int, step: int):
    def rows(found, number: int, size: int) -> pa.RecordBatch:
        docs, start, length, total, window, offset, crc, ids, a, b = found
        base = TaskContext.get().partitionId() << 40
        sequence = base + (window << _KINDS) + number
        columns = [pa.array(docs, pa.int64()), *map(pa.array, (start, length)), pa.array(crc, pa.int64())]
        columns += [*map(pa.array, (total, sequence, offset, np.full(len(docs), size)))]
        names = [x.split()[0] for x in _COLUMNS.split(", ")]
        if with_ids:
            ends = np.concatenate(([0], np.cumsum(b - a))).astype(np.int32)
            taken = ids[np.repeat(a - ends[:-1], b - a) + np.arange(ends[-1])].astype(np.int64)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(taken)))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams = [_Tier(t) for t in tiers]
        for batch in slices(batches, step=step):
            ids, count = token_ids(batch.column("text"), path, cache=cache)
            first = np.cumsum(count) - count
            doc = np.array(batch.column("doc_id").to_pylist(), dtype=object)
            route = np.minimum(np.searchsorted(tiers, count), len(tiers) - 1)
            token_route = np.repeat(route, count)
            for number, stream in enumerate(streams):
                mine = np.flatnonzero(route == number)
                if len(mine):
                    n = count[mine]
                    stream.add(doc[mine].tolist(), ids[token_route == number], np.zeros(len(mine), np.int64), n, n)
                    yield rows(stream.full(), number, stream.length)
        rest = _Tier(tiers[-1])
        for stream in reversed(streams):
            rest.add(stream.docs, stream.ids, *stream.pieces[1:])
        size, number = tiers[-1], len(tiers)
        while size and len(rest.ids):
            rest.done = 0
            yield rows(rest.full(size), number, size)
            size, number = size // 2, number + 1
        released()

    return pack


def _grouped(pieces: DataFrame) -> DataFrame:
    """Pieces with the step group of their window."""
    at = F.col("sequence_id")
    pieces = pieces.withColumns({
        "_task": F.shiftright(at, 40), "_kind": at.bitwiseAND((1 << _KINDS) - 1),
        "_window": F.shiftright(at.bitwiseAND((1 << 40) - 1), _KINDS),
    })
    counts = pieces.groupBy("_task", "_kind").agg((F.max("_window") + 1).alias("_n"))  # a row for each task and length
    earlier = Window.partitionBy("_kind").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_task", "_kind", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    group = F.floor((F.col("_before") + F.col("_window")) * F.col("tier") / STEP_TOKENS) * (1 << _KINDS) + F.col("_kind")
    grouped = pieces.join(counts, ["_task", "_kind"]).withColumn("step_group", group.cast("long"))
    return grouped.drop("_task", "_kind", "_window", "_before")


def pack(
    docs: DataFrame, path: str, tiers: tuple[int, ...] = TIERS, with_ids: bool = False, cache: int = CACHE, step: int = STEP_BYTES
) -> DataFrame:
    """Pieces of documents in windows; with_ids adds the ids of each piece."""
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)) or STEP_TOKENS % tiers[-1]:
        raise ValueError("tiers are rising powers of two that divide a step")
    packed = documents(docs).mapInArrow(_packer(path, tiers, with_ids, cache, step), _COLUMNS + ", ids array<long>" * with_ids)
    return _grouped(stored(packed, "pieces"))
