"""Near-duplicate embeddings: an exact metric range join over pivot cells.

Cosine >= t between unit vectors is Euclidean distance <= r with r^2 = 2 - 2t, a metric.  A
bounded sample of vectors serves as pivots; each vector lives in the cell of its nearest pivot.
If y lives in cell q and d(x, y) <= r, the triangle inequality gives d(x, q) <= d(x, h) + 2r
for the pivot h nearest to x, and the plane between h and q gives the sharper
(d(x, q)^2 - d(x, h)^2) / (2 d(h, q)) <= r; x is copied to every cell that passes both.  Each
(label, cell) then joins its own vectors with its visitors and no other cell is needed: every
y has one home, so each link of x is counted in exactly one cell.

A label has one pivot for about ``CELL`` vectors, so a small one is a single cell.  A large cell
is cut into blocks of residents and chunks of visitors, joined block by chunk, so a task holds a
bounded part however hot a label or cell is.  A block emits, for each
vector, its number of links and one edge to the smallest vector linked with it in that block,
plus edges that keep the block's linked vectors together: no pairs are listed.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows with null
label or vec_id, link with nothing.  Rows that repeat a vec_id are vectors of their own: each is
compared with all others, and counts its own links.  Vectors of different lengths never link.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posofold.llm.common import components, stored

#: The pivots of all labels are at most about this many vectors; only they are broadcast.
MAX_PIVOTS = 4096
CELL, BLOCK, CHUNK = 4096, 4096, 16384
_STEP = 1024  # rows in one matrix product
_SLACK = 1e-6  # rounding in the distances to pivots; only candidates depend on it


def _numbered(vectors: DataFrame) -> DataFrame:
    """All rows with a number that stays as it is."""
    values = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("named"), F.col("label"), values.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    known = F.col("named").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
    usable = F.coalesce(known & F.exists("v", lambda x: x != 0) & finite, F.lit(False))
    return rows.select(
        F.monotonically_increasing_id().alias("vec_id"), "named", F.when(usable, F.col("label")).alias("label"),
        F.when(usable, F.col("v")).alias("v"), F.size("v").alias("dim"), usable.alias("usable"),
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _placer(pivots: dict[tuple, np.ndarray], radius: float):
    """For each vector its home cell, and the cells that it visits."""

    def cells(x: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        squared = np.maximum(0, 2 - 2 * (x @ p.T))
        home = squared.argmin(axis=1)
        between = np.sqrt(np.maximum(0, 2 - 2 * (p @ p.T)))[home]
        own = squared[np.arange(len(x)), home][:, None]
        near = np.sqrt(squared) <= np.sqrt(own) + 2 * radius + _SLACK
        near &= squared - own <= 2 * between * radius + _SLACK
        near[np.arange(len(x)), home] = True
        row, cell = np.nonzero(near)
        return row, cell, home[row] == cell

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _STEP):
                batch = whole.slice(start, _STEP)
                keys = list(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist()))
                for key in set(keys):
                    part = batch.filter(pa.array([k == key for k in keys]))
                    x = _unit(_matrix(part.column("v"), key[1]))
                    alone = np.arange(len(x)), np.zeros(len(x), int), np.ones(len(x), bool)
                    row, cell, resident = cells(x, pivots[key]) if key in pivots else alone
                    for at in range(0, len(row), 4 * _STEP):
                        yield piece(part, x, key[1], *(v[at : at + 4 * _STEP] for v in (row, cell, resident)))

    def piece(part, x, dim, row, cell, resident) -> pa.RecordBatch:
        taken = part.select(["vec_id", "label"]).take(pa.array(row))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32) * dim), pa.array(x[row].ravel()))
        columns = [*taken.columns, pa.array(cell.astype(np.int32)), pa.array(resident), lists]
        columns.append(pa.array(np.full(len(row), dim, np.int32)))
        return pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "cell", "resident", "v", "dim"])

    return place


def _joiner(threshold: float):
    """Links between the residents of a block and everything in one chunk of its cell."""

    def join(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy(zero_copy_only=False).astype(bool)
        ids, dim = table.column("vec_id").to_numpy(), table.column("dim")[0].as_py()
        x = _matrix(table.column("v").combine_chunks(), dim)
        residents, all_of = np.flatnonzero(side), np.flatnonzero(~side)
        counts = np.zeros(len(all_of), np.int64)
        first = ids[all_of].copy()  # the smallest resident linked with each
        edges = []
        order = np.argsort(ids[residents])
        residents = residents[order]
        for start in range(0, len(all_of), _STEP):
            part = all_of[start : start + _STEP]
            linked = x[part] @ x[residents].T >= threshold
            linked &= ids[part][:, None] != ids[residents][None, :]
            counts[start : start + _STEP] = linked.sum(axis=1)
            some = np.flatnonzero(linked.any(axis=1))
            first[start + some] = ids[residents][linked[some].argmax(axis=1)]
            # One edge for each resident joins it to the smallest of the part linked with it: with
            # the edges to `first`, all that is linked within the block stays connected.
            by_id = np.argsort(ids[part])
            turned = linked[by_id]
            hit = np.flatnonzero(turned.any(axis=0))
            edges.append((ids[residents][hit], ids[part][by_id][turned[:, hit].argmax(axis=0)]))
            # Further links that these two edges leave unconnected are added one by one.
            edges += _missing(linked, ids[part], ids[residents], first[start : start + len(part)], edges[-1])
        a = np.concatenate([ids[all_of], *(e[0] for e in edges)])
        b = np.concatenate([first, *(e[1] for e in edges)])
        n = np.concatenate([counts, *(np.zeros(len(e[0]), np.int64) for e in edges)])
        used = (n > 0) | (a != b)
        return pa.table({"a": a[used], "b": b[used], "n": n[used]})

    return join


def _missing(linked, rows, columns, first, edge) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links whose two ends are not yet in one component of the block."""
    ids, place = np.unique(np.concatenate([rows, columns, first, edge[0], edge[1]]), return_inverse=True)
    n, m = len(rows), len(columns)
    row, column = place[:n], place[n : n + m]
    parent = np.arange(len(ids))

    def unite(a: np.ndarray, b: np.ndarray) -> None:
        while True:
            pa_, pb = parent[a], parent[b]
            if (pa_ == pb).all():
                return
            np.minimum.at(parent, np.maximum(pa_, pb), np.minimum(pa_, pb))
            while (parent[parent] != parent).any():
                parent[:] = parent[parent]

    at = n + m
    unite(row, place[at : at + n])
    unite(place[at + n : at + n + len(edge[0])], place[at + n + len(edge[0]) :])
    extra = []
    while True:
        i, j = np.nonzero(linked & (parent[row][:, None] != parent[column][None, :]))
        if not len(i):
            return extra
        _, once = np.unique(np.stack([parent[row[i]], parent[column[j]]]), axis=1, return_index=True)
        extra.append((rows[i[once]], columns[j[once]]))
        unite(row[i[once]], column[j[once]])


def near_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors (vec_id, embedding, label)."""
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    every = stored(_numbered(vectors), "vectors")
    rows = every.where("usable").select("vec_id", "label", "v", "dim")
    counts = rows.groupBy("label", "dim").count().where(F.col("count") > CELL)
    total = counts.agg(F.sum("count")).first()[0] or 0
    share = min(1 / CELL, MAX_PIVOTS / max(1, total))
    lot = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 40)) < int(share * (1 << 40))
    chosen = rows.join(counts, ["label", "dim"], "left_semi").where(lot)
    pivots: dict[tuple, list] = {}
    for r in chosen.select("label", "dim", "v").collect():  # MAX_PIVOTS is what is expected at most
        pivots.setdefault((r["label"], r["dim"]), []).append(r["v"])
    pivots = {key: _unit(np.array(v, dtype=np.float64)) for key, v in pivots.items()}
    kind = dict(rows.dtypes)["label"]
    placed = stored(
        rows.mapInArrow(_placer(pivots, radius), f"vec_id long, label {kind}, cell int, resident boolean, v array<double>, dim int"),
        "cells",
    )
    sizes = placed.groupBy("label", "dim", "cell").agg(
        F.ceil(F.sum(F.col("resident").cast("int")) / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"),
    )
    sized = placed.join(sizes.where("blocks > 0"), ["label", "dim", "cell"])
    cut = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["label", "dim", "cell", "block", "chunk", "side", "vec_id", "v"]
    residents = sized.where("resident").withColumns({"block": cut("blocks", 1), "side": F.lit(True)}).withColumn("chunk", each("chunks"))
    visitors = sized.withColumns({"chunk": cut("chunks", 2), "side": F.lit(False)}).withColumn("block", each("blocks"))
    work = residents.select(*columns).union(visitors.select(*columns))
    out = stored(
        work.groupBy("label", "dim", "cell", "block", "chunk").applyInArrow(_joiner(threshold), "a long, b long, n long"),
        "links",
    )
    counts = out.where("n > 0").groupBy(F.col("a").alias("vec_id")).agg(F.sum("n").alias("n_links"))
    classes = components(out.select("a", "b")).select(F.col("id").alias("vec_id"), "component")
    joined = every.select("vec_id", "named").join(counts, "vec_id", "left").join(classes, "vec_id", "left")
    joined = stored(joined.withColumn("component", F.coalesce("component", "vec_id")), "classes")
    # rows are named by their vec_id again; rows of one vec_id are one place on a path of links
    ways = joined.where("named is not null").groupBy("component").agg(F.min("named").alias("least"))
    met = joined.where("named is not null").select("named", "component").join(ways, "component")
    shared = met.where("named <> least").select(F.col("named").alias("a"), F.col("least").alias("b"))
    names = components(shared).select(F.col("id").alias("named"), F.col("component").alias("smallest"))
    return joined.join(names, "named", "left").select(
        F.col("named").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("smallest", "named").alias("component_id"),
        F.col("named").eqNullSafe(F.coalesce("smallest", "named")).alias("kept"),
    )
