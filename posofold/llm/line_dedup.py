"""Fuzzy line dedup: SimHash, pigeonhole blocks, edit similarity, one occurrence for each group.

Lines (between newlines) are normalised by words: lower case, without punctuation at the ends,
digits as 0.  Equal normalised lines are one class.  The 64-bit SimHash of a line's distinct
words (a word that fills a line must not decide it alone) is cut
into BLOCKS blocks; hashes that differ in at most DISTANCE bits agree on BLOCKS - DISTANCE whole
blocks, so classes meet on each choice of that many.  Two classes link when their hashes differ
in at most DISTANCE bits and the edit similarity of the normalised lines, 1 - edits / longer
length, is at least SIMILARITY.  Of all occurrences connected by links, the one with the
smallest (doc_id, line number) stays and the others are removed.

Within a block a class is first checked with the block's first one; what is connected by then is
not compared again, so near copies of one line cost a check each and not one for each pair.
A task settles repeats of a class within a slice by itself: a line in a third of all documents
is a row for each slice.

Defined results: lines without a word (blank ones, or punctuation alone) are kept and match
nothing; all others count, however short.  Null and empty texts have no lines to remove.  Rows without doc_id keep all lines.
Rows that repeat a doc_id and text exactly get the same result each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posofold.llm.common import Rolling, components, documents, slices, stored, words
from posofold.llm.substring import _first_of, _unpacked, packed

BLOCKS, DISTANCE, SIMILARITY, MIN_WORDS = 5, 3, 0.85, 1
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_ENDS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’…–—¿¡"
_BITS = [(64 * i // BLOCKS, 64 * (i + 1) // BLOCKS) for i in range(BLOCKS)]
LANE = 255
_CHOICES = list(combinations(range(BLOCKS), BLOCKS - DISTANCE))


def _normal(words: list[str]) -> list[str]:
    """The words (without newlines) in lower case, digits as 0, without punctuation at the ends."""
    joined = "\n".join(words).lower().encode().translate(_DIGITS).decode()
    return [w.strip(_ENDS) for w in joined.split("\n")] if words else []


def normalised(line: str) -> str:
    return " ".join([w for w in _normal(line.split()) if w])


class _Lines:
    """Keys and word counts of the lines of a batch, one after another, and SimHashes of chosen ones."""

    def __init__(self, texts: pa.Array):
        split = pc.split_pattern(texts, "\n")
        split = pc.if_else(pc.is_null(split), pa.scalar([], split.type), split)
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        self.text = split.flatten()
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.start = np.cumsum(counts) - counts
        self.number = np.arange(len(self.row)) - self.start[self.row]
        self.counts = counts
        flat, offsets = words(self.text)
        coded = flat.dictionary_encode()
        normal = _normal(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) if w else 0 for w in normal), np.uint64, len(normal))
        self.hashes, same = np.unique(hashes, return_inverse=True)
        code = same[coded.indices.to_numpy()]
        each = hashes[coded.indices.to_numpy()]
        full = each != 0
        self.code, self.offsets = code[full], np.concatenate(([0], np.cumsum(full)))[offsets]
        self.words = np.diff(self.offsets)
        self.key = Rolling(each[full]).of(self.offsets[:-1], self.words)

    def sims(self, lines: np.ndarray) -> np.ndarray:
        """SimHashes of the lines with these indexes; each has a word."""
        parts = np.array_split(lines, max(1, int(self.words[lines].sum()) // 400_000))
        return np.concatenate([self._sims(part) for part in parts])

    def _sims(self, lines: np.ndarray) -> np.ndarray:
        n = self.words[lines]
        if not len(n):
            return np.zeros(0, np.uint64)
        first = np.cumsum(n) - n
        at = np.repeat(self.offsets[:-1][lines] - first, n) + np.arange(n.sum())
        # distinct words of each line: one integer for line and word, sorted
        pair = np.sort(np.repeat(np.arange(len(n)), n) * len(self.hashes) + self.code[at])
        pair = pair[np.concatenate(([True], pair[1:] != pair[:-1]))]
        line, code = np.divmod(pair, len(self.hashes))
        n = np.bincount(line, minlength=len(n))
        start = np.cumsum(n) - n
        # 64 counters of a byte each hold the sums of up to LANE words, longer lines are cut
        within = np.arange(len(line)) - start[line]
        heads = np.flatnonzero(within % LANE == 0)
        bits = np.unpackbits(self.hashes[code].view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
        sums = np.add.reduceat(bits, heads, axis=0).view(np.uint8)
        pieces = -(-n // LANE)
        if pieces.max() > 1:
            sums = np.add.reduceat(sums, np.cumsum(pieces) - pieces, axis=0, dtype=np.int64)
        return np.packbits(sums > (n // 2)[:, None], axis=1).view(np.uint64).ravel()


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first occurrence of each class in a slice, and lines known to repeat one."""
    names = ["line_key", "sim", "doc_id", "line", "known"]
    for batch in slices(batches):
        x = _Lines(batch.column("text"))
        at = np.flatnonzero(x.words >= MIN_WORDS)
        doc = batch.column("doc_id").to_numpy()[x.row[at]]
        line = x.number[at]
        first = _first_of(x.key[at], x.key[at], doc, line)
        k = at[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.key[k].view(np.int64)), pa.array(x.sims(k).view(np.int64)), pa.array(doc[first]),
             pa.array(line[first].astype(np.int32)), pa.nulls(len(k), pa.list_(pa.int32()))], names,
        )
        later = np.flatnonzero(~first)
        if len(later):
            later = later[np.lexsort((line[later], doc[later]))]
            heads = np.flatnonzero(np.concatenate(([True], doc[later][1:] != doc[later][:-1])))
            lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(later)).astype(np.int32)), pa.array(line[later].astype(np.int32)))
            none = pa.nulls(len(heads), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(doc[later][heads]), pa.nulls(len(heads), pa.int32()), lists], names)


def _texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Normalised texts of chosen lines."""
    for batch in slices(_unpacked(batches)):
        keys, texts = [], []
        for text, chosen in zip(batch.column("text").to_pylist(), batch.column("chosen").to_pylist()):
            lines = (text or "").split("\n")
            for c in chosen:
                if c["line"] < len(lines):
                    keys.append(c["line_key"])
                    texts.append(normalised(lines[c["line"]]))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.string())], ["line_key", "normal"])


def _middles(a: str, b: str) -> tuple[str, str]:
    """What is left of both without their common start and end."""
    start = _shared(a, b, False)
    a, b = a[start:], b[start:]
    end = _shared(a, b, True)
    return a[: len(a) - end], b[: len(b) - end]


def _shared(a: str, b: str, from_end: bool) -> int:
    """Length of the common start or end, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        n = (low + high + 1) // 2
        same = a[len(a) - n :] == b[len(b) - n :] if from_end else a[:n] == b[:n]
        low, high = (n, high) if same else (low, n - 1)
    return low


def edits(a: str, b: str) -> int:
    """Levenshtein distance, by bit-parallel columns."""
    a, b = _middles(a, b)
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, distance = full, 0, len(a)
    for c in b:
        same = where.get(c, 0)
        x = ((((same & plus) + plus) ^ plus) | same | minus) & full
        up, down = minus | ~(x | plus) & full, plus & x
        distance += bool(up & last) - bool(down & last)
        up, down = (up << 1 | 1) & full, down << 1 & full
        plus, minus = down | ~(x | up) & full, up & x
    return distance


def similar(a: str, b: str) -> bool:
    """Whether the edit similarity is at least SIMILARITY."""
    longer = max(len(a), len(b))
    if min(len(a), len(b)) < SIMILARITY * longer:
        return False
    a, b = _middles(a, b)
    # no more edits than the longer middle has characters
    return longer - max(len(a), len(b)) >= SIMILARITY * longer or longer - edits(a, b) >= SIMILARITY * longer


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = list(map(similar, batch.column("normal_a").to_pylist(), batch.column("normal_b").to_pylist()))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _links(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Verified links (a, b) of classes (line_key, sim, first)."""
    parts = [F.shiftrightunsigned("sim", low).bitwiseAND(F.lit((1 << (high - low)) - 1)) for low, high in _BITS]
    blocks = []
    for number, choice in enumerate(_CHOICES):
        value = F.lit(number).cast("long")
        for k in choice:
            value = F.shiftleft(value, _BITS[k][1] - _BITS[k][0]).bitwiseOR(parts[k])
        blocks.append(value)
    rows = classes.select("line_key", "sim", F.explode(F.array(*blocks)).alias("block"))
    alike = Window.partitionBy("block")
    rows = rows.withColumns({"low": F.min("line_key").over(alike), "high": F.max("line_key").over(alike)})
    rows = stored(rows.where("low < high").select("block", "line_key", "sim"), "blocks")
    mates = rows.select("block", F.col("line_key").alias("mate"), F.col("sim").alias("mate_sim"))
    near = (rows["block"] == mates["block"]) & (F.col("line_key") != F.col("mate")) & _near("sim", "mate_sim")
    rows = stored(rows.join(mates, near, "left_semi"), "near")

    chosen = rows.select("line_key").distinct().join(classes, "line_key")
    chosen = chosen.groupBy(F.col("first.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct(F.col("first.line").alias("line"), "line_key")).alias("chosen")
    )
    texts = chosen.join(packed(docs), "doc_id").mapInArrow(_texts_of, "line_key long, normal string")
    texts = stored(texts.groupBy("line_key").agg(F.min("normal").alias("normal")), "lines")

    def checked(pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(texts.select(F.col("line_key").alias(end), F.col("normal").alias(f"normal_{end}")), end)
        return stored(pairs.mapInArrow(_verify, "a long, b long"), "links")

    leader = F.min(F.struct("line_key", "sim")).over(alike).alias("lead")
    star = rows.select("line_key", "sim", leader).where("lead.line_key < line_key").where(_near("sim", "lead.sim"))
    links = checked(star.select(F.col("lead.line_key").alias("a"), F.col("line_key").alias("b")).distinct())

    named = rows.join(components(links).withColumnRenamed("id", "line_key"), "line_key", "left")
    named = named.withColumn("component", F.coalesce("component", "line_key"))
    mixed = named.withColumns({"low": F.min("component").over(alike), "high": F.max("component").over(alike)})
    mixed = stored(mixed.where("low < high").select("block", "line_key", "sim", "component"), "mixed")
    other = mixed.select("block", *(F.col(c).alias(f"{c}_b") for c in ("line_key", "sim", "component")))
    apart = mixed.join(other, "block").where("line_key < line_key_b and component <> component_b").where(_near("sim", "sim_b"))
    return links.union(checked(apart.select(F.col("line_key").alias("a"), F.col("line_key_b").alias("b")).distinct()))


def _cut(with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(_unpacked(batches)):
            rows = []
            for doc_id, text, gone in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "gone"))):
                lines = [] if text is None else text.split("\n")
                drop = {x for x in gone or () if x < len(lines)}
                kept = "\n".join([x for i, x in enumerate(lines) if i not in drop]) if drop else text or ""
                row = (doc_id, len(lines), len(drop), hashlib.sha256(kept.encode()).hexdigest())
                rows.append((*row, kept) if with_text else row)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["doc_id", "n_lines", "n_removed", "kept_sha256", "kept_text"]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return cut


def without_repeated_lines(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """For each row of docs: doc_id, n_lines, n_removed, kept_sha256 and, if asked for, kept_text."""
    found = documents(docs).where("doc_id is not null").mapInArrow(
        _occurrences, "line_key long, sim long, doc_id long, line int, known array<int>"
    )
    found = stored(found, "occurrences")
    seen = found.where("known is null")
    classes = stored(
        seen.groupBy("line_key").agg(
            F.min(F.struct("doc_id", "line")).alias("first"), F.max("sim").alias("sim"), F.count("*").alias("n")
        ),
        "classes",
    )
    joined = components(_links(classes, docs)).withColumnRenamed("id", "line_key")
    groups = classes.join(joined, "line_key", "left").where("component is not null or n > 1")
    groups = stored(groups.select("line_key", "first", F.coalesce("component", "line_key").alias("component")), "groups")
    keepers = groups.groupBy("component").agg(F.min("first").alias("keep"))
    keepers = groups.join(keepers, "component").select("line_key", "keep")
    later = seen.join(keepers, "line_key").where("doc_id <> keep.doc_id or line <> keep.line")
    gone = later.select("doc_id", F.array("line").alias("gone")).union(found.where("known is not null").select("doc_id", "known"))
    gone = gone.groupBy("doc_id").agg(F.flatten(F.collect_list("gone")).alias("gone"))
    rows = packed(docs).join(gone, "doc_id", "left").select("doc_id", "packed", "gone")
    kind = "doc_id long, n_lines long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return rows.mapInArrow(_cut(with_text), kind)
