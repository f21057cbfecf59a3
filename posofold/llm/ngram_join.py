"""N-gram Jaccard join over an R-tree of count vectors.

A document's set holds its distinct ``K``-word shingles, as 64-bit hashes; documents link when
100 |A and B| >= 75 |A or B|.  Equal sets are one class.

1. Blocks.  Linked sets share at least three quarters of the larger one, m, so among the half of
   each set with the smallest hashes they share m/4.  Shingles of that half which no other set
   has are useless; a set that is left with fewer than n/4 links with nothing, and of u left the
   u - n/4 + 1 rarest suffice: linked sets meet on one of them.  Every block is a shingle.
2. Each set of a block is checked with the block's most central one, whose shingles are the most
   common: of copies with edits, the least edited.  Blocks whose sets are all connected by then
   have nothing more to say; blocks with the same members are one.
3. Other blocks: shingles are hashed into ``GROUPS`` groups, and the counts by group are a point.
   An R-tree holds the points; the sum of coordinate minima of a point and a node's upper corner
   bounds the overlap with all sets below, so most are never looked at.  Pairs of sets in
   different components that survive are checked.  Blocks over ``TILE`` sets are joined tile by
   tile: bounded memory, and no pair is left out.
4. Surviving pairs are verified on the whole sets.

``links`` are verified pairs of classes that connect all that is linked; pairs within an
already connected component are not listed again.

Defined results: null and empty texts have an empty set, linked with nothing; fewer than K words
are one shingle.  Rows without doc_id link with nothing.  Rows that repeat a doc_id are compared
by each of their texts and share that id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posofold.llm.common import Rolling, components, documents, hash_words, mix, released, slices, stored, words
from posofold.llm.substring import _unpacked, packed

K, GROUPS, TILE, LEAF = 5, 256, 1024, 16
STEP_BYTES = 1 << 20  # of text whose shingles are in memory at once: some forty times as much
KNOWN = 1 << 14  # sets that a task remembers to have sent


class _Sets:
    """Sorted distinct shingle hashes of each text of a batch, one after another."""

    def __init__(self, texts: pa.Array):
        flat, offsets = words(pc.ascii_lower(texts))
        rolling = Rolling(hash_words(flat))
        n = np.diff(offsets)
        count = np.where(n >= K, n - K + 1, np.minimum(n, 1))
        row = np.repeat(np.arange(len(n)), count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + offsets[:-1][row]
        hashes = rolling.of(start, np.minimum(n, K)[row])
        order = np.lexsort((hashes, row))
        row, hashes = row[order], hashes[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
        self.row, self.hashes = row[new], hashes[new]
        self.size = np.bincount(self.row, minlength=len(n))
        self.start = np.cumsum(self.size) - self.size
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.hashes + np.uint64(12345)), dtype=np.uint64)))
        total = sums[self.start + self.size] - sums[self.start]
        self.id = mix(total + mix(self.size.astype(np.uint64))).view(np.int64)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, step=STEP_BYTES):
        s = _Sets(batch.column("text"))
        ids = pa.array(s.id, mask=s.size == 0)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s.size), ids], ["doc_id", "n_shingles", "set_id"])
    released()


def _low_half(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The half of each distinct set with the smallest hashes (again if it comes back after ``KNOWN`` others)."""
    known = np.zeros(0, np.int64)
    for batch in slices(batches, step=STEP_BYTES):
        s = _Sets(batch.column("text"))
        _, first = np.unique(s.id, return_index=True)
        once = np.zeros(len(s.id), bool)
        once[first] = ~np.isin(s.id[first], known)
        known = np.concatenate((known, s.id[once]))[-KNOWN:]
        taken = once[s.row] & (np.arange(len(s.row)) - s.start[s.row] < (s.size[s.row] + 1) // 2)
        row = s.row[taken]
        yield pa.RecordBatch.from_arrays(
            [pa.array(s.hashes[taken].view(np.int64)), pa.array(s.id[row]), pa.array(s.size[row].astype(np.int32))],
            ["shingle", "set_id", "n"],
        )
    released()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sets and their counts by group."""
    for batch in slices(_unpacked(batches), step=STEP_BYTES):
        s = _Sets(batch.column("text"))
        group = (s.hashes >> np.uint64(40)).astype(np.int64) % GROUPS
        counts = np.bincount(s.row * GROUPS + group, minlength=len(s.size) * GROUPS).astype(np.int32)
        ends = (s.start + s.size).tolist()
        sets = [s.hashes[a:b].tobytes() for a, b in zip(s.start.tolist(), ends)]
        points = [x.tobytes() for x in counts.reshape(-1, GROUPS)]
        columns = [batch.column("set_id"), pa.array(sets, pa.binary()), pa.array(points, pa.binary())]
        found = pa.RecordBatch.from_arrays(columns, ["set_id", "shingles", "point"])
        # Rows that repeat a doc_id with another text have another set.
        yield found.filter(pc.equal(found.column("set_id"), pa.array(s.id)))
    released()


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        sets = zip(*(batch.column(c).to_pylist() for c in ("shingles_a", "shingles_b", "point_a", "point_b")))
        for x, y, p, q in sets:
            n = (len(x) + len(y)) // 8
            # 100 i >= 75 (n - i) is 7 i >= 3 n, and i is at most the sum of minima.
            if 7 * int(np.minimum(np.frombuffer(p, np.int32), np.frombuffer(q, np.int32)).sum()) < 3 * n:
                keep.append(False)
                continue
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.searchsorted(x, y)
            at[at == len(x)] = 0
            keep.append(7 * int((x[at] == y).sum()) >= 3 * n)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    released()


class RTree:
    """Points packed by splitting on the widest coordinate; each node keeps upper corner and sizes."""

    def __init__(self, points: np.ndarray):
        self.points, self.sizes = points, points.sum(axis=1)
        leaves, todo = [], [np.arange(len(points))]
        while todo:
            part = todo.pop()
            if len(part) <= LEAF:
                leaves.append(part)
                continue
            values = np.column_stack((points[part], self.sizes[part]))
            order = np.argsort(values[:, values.std(axis=0).argmax()], kind="stable")
            todo += [part[order[len(part) // 2 :]], part[order[: len(part) // 2]]]
        self.leaves = leaves
        level = [(points[x].max(axis=0), self.sizes[x].min(), self.sizes[x].max()) for x in leaves]
        self.levels = [level]
        while len(level) > 1:
            groups = [level[i : i + 4] for i in range(0, len(level), 4)]
            level = [(np.max([g[0] for g in x], axis=0), min(g[1] for g in x), max(g[2] for g in x)) for x in groups]
            self.levels.append(level)
        self.levels = [tuple(np.array(x) for x in zip(*level)) for level in self.levels]

    def candidates(self, point: np.ndarray) -> np.ndarray:
        """Indices of all points whose overlap with this one can reach the threshold."""
        size, nodes = point.sum(), np.zeros(1, int)
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, low, high = (x[nodes] for x in self.levels[depth])
            possible = (4 * high >= 3 * size) & (3 * low <= 4 * size)
            possible &= 7 * np.minimum(corner, point).sum(axis=1) >= 3 * (size + low)
            nodes = nodes[possible]
            if depth:
                nodes = (nodes[:, None] * 4 + np.arange(4)).ravel()
                nodes = nodes[nodes < len(self.levels[depth - 1][0])]
        if not len(nodes):
            return nodes
        found = np.concatenate([self.leaves[i] for i in nodes])
        return found[7 * np.minimum(self.points[found], point).sum(axis=1) >= 3 * (size + self.sizes[found])]


def _search(table: pa.Table) -> pa.Table:
    ids, comp = table.column("set_id").to_numpy(), table.column("component").to_numpy()
    tile = table.column("tile").to_numpy()
    points = np.frombuffer(b"".join(table.column("point").to_pylist()), np.int32).reshape(len(ids), GROUPS)
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    indexed, asking = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    if len(indexed) <= 2 * LEAF:  # a tree of two leaves prunes nothing
        size = points.sum(axis=1)
        overlap = np.minimum(points[asking][:, None], points[indexed][None]).sum(axis=2)
        row, column = np.nonzero(7 * overlap >= 3 * (size[asking][:, None] + size[indexed][None]))
    else:
        tree = RTree(points[indexed])
        found = [tree.candidates(points[k]) for k in asking]
        row = np.repeat(np.arange(len(asking)), [len(x) for x in found])
        column = np.concatenate(found) if found else row
    a, b = indexed[column], asking[row]
    taken = comp[a] != comp[b]
    if i == j:
        taken &= ids[a] < ids[b]
    a, b = ids[a[taken]], ids[b[taken]]
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(*(F.col(c).alias(f"{c}_{end}" if c != "set_id" else end) for c in sets.columns)), end)
    return pairs.mapInArrow(_verify, "a long, b long")


def _blocks(docs: DataFrame) -> DataFrame:
    """(shingle, set_id, n, central): blocks in which all linked sets meet."""
    halves = docs.where("doc_id is not null").mapInArrow(_low_half, "shingle long, set_id long, n int")
    alike = Window.partitionBy("shingle")
    shared = halves.withColumns({
        "low": F.min("set_id").over(alike), "high": F.max("set_id").over(alike), "df": F.count("*").over(alike)
    }).where("low < high")
    one = Window.partitionBy("set_id")
    ranked = shared.withColumn("rank", F.dense_rank().over(one.orderBy("df", "shingle")))
    ranked = ranked.withColumns({"left": F.max("rank").over(one), "central": F.sum("df").over(one) / F.col("n")})
    ranked = ranked.withColumn("least", F.ceil(F.col("n") / 4)).where("left >= least and rank <= left - least + 1")
    return ranked.select("shingle", "set_id", "n", "central")


def _residual(blocks: DataFrame, connected: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs of sets in different components, from the R-trees of blocks."""
    named = blocks.select("shingle", "set_id").join(connected.withColumnRenamed("id", "set_id"), "set_id", "left")
    named = named.withColumn("component", F.coalesce("component", "set_id"))
    alike = Window.partitionBy("shingle")
    mixed = named.withColumns({
        "low": F.min("component").over(alike), "high": F.max("component").over(alike),
        "block": F.sum(F.shiftright(F.xxhash64("set_id"), 20)).over(alike),
    }).where("low < high")
    members = mixed.select("block", "set_id", "component").distinct()
    # Blocks of equal sums have equal members; should sums meet by chance, the block is their union.
    tiles = F.ceil(F.count("*").over(Window.partitionBy("block")) / TILE).cast("int")
    members = members.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("set_id"), "tiles").cast("int"))
    members = members.join(sets.select("set_id", "point"), "set_id")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    members = members.withColumn("other", other)
    members = members.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})
    return members.groupBy("block", "i", "j").applyInArrow(_search, "a long, b long").distinct()


def jaccard_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with their class (doc_id, n_shingles, set_id), and verified links (a, b) of classes."""
    docs = documents(docs)
    sizes = stored(docs.mapInArrow(_sizes, "doc_id long, n_shingles long, set_id long"), "sizes")
    blocks = stored(_blocks(docs), "blocks")
    active = blocks.select("set_id").distinct()
    spoken = sizes.where("doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    texts = active.join(spoken, "set_id").join(packed(docs), "doc_id").select("set_id", "packed")
    sets = stored(texts.mapInArrow(_whole, "set_id long, shingles binary, point binary"), "sets")
    leader = F.max(F.struct("central", "set_id", "n")).over(Window.partitionBy("shingle")).alias("first")
    first = blocks.select("set_id", "n", leader).where("first.set_id <> set_id and 4 * n >= 3 * first.n and 3 * n <= 4 * first.n")
    pairs = first.select(
        F.least("first.set_id", "set_id").alias("a"), F.greatest("first.set_id", "set_id").alias("b")
    ).distinct()
    near = stored(_checked(pairs, sets), "links")
    more = stored(_checked(_residual(blocks, components(near), sets), sets), "links")
    return sizes, near.union(more)


def near_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable) of every row of docs."""
    sizes, links = jaccard_links(docs)
    classes = sizes.where("set_id is not null and doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    joined = classes.join(components(links).withColumnRenamed("id", "set_id"), "set_id", "left")
    joined = stored(joined.withColumn("component", F.coalesce("component", "set_id")), "classes")
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(smallest, "component").select("set_id", "component_id")
    return sizes.join(named, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    )
