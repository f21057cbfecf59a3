"""Hard negatives for embeddings, by full exact scores from subset-sum tables (Four Russians).

Components become integers floor(256 x).  A candidate is packed once into bit planes: for each
bit of the two's complement, one byte for every eight dimensions.  An anchor has, for the same
eight dimensions, a table of the 256 sums of subsets of its components.  A score is then looked
up and not multiplied: for each plane, from the top one (which counts negative) down, double the
sum so far and add the table entries that the plane's bytes point at.  All is integer and exact.

Anchors are dealt into blocks of about ``ANCHORS`` and candidates into chunks of about ``CHUNK``,
by hash, so no task grows with the data or with a label.  Each (block, chunk) is a task, which
keeps the first few rows of each anchor; the first few of all chunks follow.  A first round finds
the positives, a second one the negatives between the two shares of each positive's score.

Defined results: rows with null vec_id, label or vector, with a null or non-finite component, or
with one of 2^17 or more (scores might leave the range of a long) take no part.  Vectors of
different lengths aren't compared; empty ones score 0 with each other.  Rows that repeat a
vec_id are rows of their own, anchors too.  An anchor without positives, or a positive without
negatives, gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posofold.llm.common import stored

ANCHORS, CHUNK = 1024, 16384
SCALE, LIMIT = 256, 1 << 25  # components are below LIMIT once scaled
LABELS, MISLABELLED, ANCHOR_EVERY = 10, 7, 100
_STEP = 64  # anchors scored at a time
MAX_PARTITIONS = 20_000  # more (block, chunk) pairs share partitions
_FOUND = "anchor long, anchor_id long, positive long, positive_id long, positive_score long, score long, row long, vec_id long"


def _rows(vectors: DataFrame) -> DataFrame:
    values = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), values.alias("v"))
    within = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(LIMIT / SCALE)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(within)
    moved = F.when(F.col("vec_id") % MISLABELLED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        "vec_id",
        moved.alias("label"),
        F.transform("v", lambda x: F.floor(x * SCALE).cast("int")).alias("v"),
        F.size("v").alias("dim"),
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Integer vectors, with zeros up to a multiple of eight dimensions."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
    return np.pad(flat, ((0, 0), (0, -dim % 8))).astype(np.int64)


def _packer(bits: int):
    """Vectors as bit planes: for each bit, the lowest first, a byte for every eight dimensions."""

    def pack(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                v = _matrix(part.column("v"), dim)
                planes = [np.packbits(((v >> k) & 1).astype(np.uint8), axis=1, bitorder="little") for k in range(bits)]
                size = bits * ((dim + 7) // 8)
                flat = pa.py_buffer(np.ascontiguousarray(np.concatenate(planes, axis=1)))
                offsets = pa.py_buffer(np.arange(len(v) + 1, dtype=np.int32) * size)
                packed = pa.Array.from_buffers(pa.binary(), len(v), [None, offsets, flat])
                yield pa.RecordBatch.from_arrays([*part.select(["row", "vec_id", "label", "dim"]).columns, packed], ["row", "vec_id", "label", "dim", "planes"])

    return pack


def _scores(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Scores (anchor, candidate) from planes (plane, group, candidate) of table positions."""
    bits, groups, n = planes.shape
    most = int(np.abs(anchors).sum(axis=1).max(initial=0)) << bits
    kind = np.int32 if most < 1 << 31 else np.int64
    tables = np.zeros((groups, 256, len(anchors)), kind)
    for d in range(groups * 8):
        table, one = tables[d // 8], 1 << d % 8
        table[one : 2 * one] = table[:one] + anchors[:, d].astype(kind)
    total, found = np.zeros((n, len(anchors)), kind), np.empty((n, len(anchors)), kind)
    for k in reversed(range(bits)):
        total <<= 1
        for g in range(groups):
            np.take(tables[g], planes[k, g], axis=0, out=found, mode="clip")
            (np.subtract if k == bits - 1 else np.add)(total, found, out=total)
    return np.ascontiguousarray(total.T)


def _first(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores among those given, which are in the order of ties."""
    s = scores[among]
    if len(s) > k:
        near = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
        among, s = among[near], s[near]
    return among[np.argsort(-s, kind="stable")[:k]]


def _searcher(bits: int, pick, k: int):
    """For each anchor of a block and each of its goals, the first k of one chunk of candidates."""

    def search(table: pa.Table) -> pa.Table:
        is_anchor = table.column("is_anchor").to_numpy(zero_copy_only=False).astype(bool)
        dim = table.column("dim")[0].as_py()
        a, c = table.filter(pa.array(is_anchor)), table.filter(pa.array(~is_anchor)).sort_by([("vec_id", "ascending"), ("row", "ascending")])
        out: list[tuple] = []
        if a.num_rows and c.num_rows:
            groups = (dim + 7) // 8
            packed = np.frombuffer(b"".join(c.column("planes").to_pylist()), np.uint8).reshape(c.num_rows, bits, groups)
            planes = packed.transpose(1, 2, 0).astype(np.intp)
            v = _matrix(a.column("v").combine_chunks(), dim)
            labels, rows, ids = (c.column(x).to_numpy() for x in ("label", "row", "vec_id"))
            own = list(zip(*(a.column(x).to_pylist() for x in ("row", "vec_id", "label", "goals"))))
            for start in range(0, len(own), _STEP):
                scores = _scores(v[start : start + _STEP], planes)
                for s, (row, vec_id, label, goals) in zip(scores.astype(np.int64), own[start : start + _STEP]):
                    for goal, among in pick(s, labels == label, rows != row, goals):
                        for i in _first(s, among, k).tolist():
                            out.append((row, vec_id, *goal, int(s[i]), int(rows[i]), int(ids[i])))
        names = [x.split()[0] for x in _FOUND.split(", ")]
        columns = zip(*out) if out else [[]] * len(names)
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(names, columns)})

    return search


def _same_label(s, same, other, goals):
    yield (None, None, None), np.flatnonzero(same & other)


def _between(low: int, high: int):
    def pick(s, same, other, goals):
        for goal in goals:
            p = goal["positive_score"]
            fits = ~same & (100 * s >= low * p) & (100 * s <= high * p)
            yield (goal["positive"], goal["positive_id"], p), np.flatnonzero(fits)

    return pick


def _first_rows(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for (vec_id, embedding, label).

    ``low`` and ``high`` are the shares, in hundredths, of a positive's score between which the
    score of its negatives lies.  ``is_anchor`` is a condition on vec_id.
    """
    is_anchor = F.col("vec_id") % ANCHOR_EVERY == 0 if is_anchor is None else is_anchor
    rows = stored(_rows(vectors), "integers")
    size = F.greatest(F.lit(0), F.array_max("v"), -1 - F.array_min("v"))
    bits = 1 + int(rows.agg(F.max(size)).first()[0] or 0).bit_length()
    anchors = rows.where(is_anchor)
    counts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.sum(is_anchor.cast("long")).alias("anchors"))
    parts = counts.where("anchors > 0").select(
        "dim", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"), F.ceil(F.col("anchors") / ANCHORS).cast("int").alias("blocks")
    )
    cells = int(parts.agg(F.sum(F.col("chunks").cast("long") * F.col("blocks"))).first()[0] or 1)
    lot = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    packed = stored(
        rows.join(parts, "dim", "left_semi").mapInArrow(_packer(bits), "row long, vec_id long, label long, dim int, planes binary"), "planes"
    )
    candidates = packed.join(parts, "dim").withColumns({"chunk": lot("chunks"), "is_anchor": F.lit(False)}).withColumn("block", each("blocks"))
    goal = "array<struct<positive:long,positive_id:long,positive_score:long>>"
    keys = ["dim", "block", "chunk"]
    columns = [*keys, "is_anchor", "row", "vec_id", "label", "v", "planes", "goals"]
    candidates = candidates.withColumns({"v": F.lit(None).cast("array<int>"), "goals": F.lit(None).cast(goal)})

    def search(goals: DataFrame, pick, k: int) -> DataFrame:
        side = goals.join(parts, "dim").withColumns({"block": lot("blocks"), "is_anchor": F.lit(True)}).withColumn("chunk", each("chunks"))
        side = side.withColumn("planes", F.lit(None).cast("binary"))
        work = side.select(*columns).union(candidates.select(*columns))
        work = work.repartition(min(cells, MAX_PARTITIONS), *keys)  # few bytes are much work: AQE would unite them
        return work.groupBy(*keys).applyInArrow(_searcher(bits, pick, k), _FOUND)

    near = search(anchors.withColumn("goals", F.lit(None).cast(goal)), _same_label, positives)
    near = _first_rows(near, ["anchor"], positives)
    met = F.struct(F.col("row").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    goals = stored(near.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(met).alias("goals")), "positives")
    far = search(anchors.join(goals, "row"), _between(low, high), negatives)
    return _first_rows(far, ["anchor", "positive"], negatives).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
