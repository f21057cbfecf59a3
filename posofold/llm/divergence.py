"""Divergence of sources: how far the term shares of each source are from those of its peers.

The groups are the (lang, source) pairs.  Each lang keeps the terms of at least ``MIN_DOCS`` of
its documents; a group or lang gives a kept term the smoothed share p = 1 + floor(10^9 (n + 1) /
(N + V)), and f(p, q) = floor((p - q)^2 / q) is what the term adds to the divergence of p from q.

Sums over pairs of groups go by rows, as in Gustavson's sparse matrix product.  Most shares are
those of terms that a group hasn't got (n = 0), so each sum is first taken as if no term were
common, from the group's histogram of counts, and then put right for the common terms alone:

    sum f(p, q) = sum f(p, q0) + sum f(p0, q) - V f(p0, q0)
                  + sum over common terms of (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))

For the last line, a task holds a slice of the terms with their postings, term-major, for a block
of groups and a block of their peers.  Each group scatters its terms through that index into one
dense accumulator by peer; no pair of postings is emitted.  Slices are dealt by a hash of the
term and blocks by a hash of the source, so neither a frequent term nor a large source makes a
large task.  Counts combine within tasks before they are shuffled.

Defined results: null text, lang and source are ''.  A lang without kept terms has value 0 for
each pair of its groups.  Repeated rows count as documents of their own.  Other columns, doc_id
too, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posofold.llm.common import slices, stored, terms

MIN_DOCS, UNIT, TERM_RANKS = 3, 1_000_000_000, 200
#: Groups in a block, postings in a slice, pairs that one numpy step adds.
BLOCK, SLICE, STEP_PAIRS = 256, 200_000, 1 << 20
_STEP_BYTES = 4 << 20


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, its number of occurrences and of documents, for each step of a task."""
    names = ["lang", "source", "term", "n", "docs"]
    for batch in slices(batches, step=_STEP_BYTES):
        found, row = terms(batch.column("text"))
        if not len(row):
            continue
        lang, source = (batch.column(x).dictionary_encode() for x in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        width = len(found.dictionary)
        code = found.indices.to_numpy().astype(np.int64)
        by_doc, n = np.unique(row * width + code, return_counts=True)
        key, place = np.unique(group[by_doc // width] * width + by_doc % width, return_inverse=True)
        occurrences = np.bincount(place, weights=n, minlength=len(key)).astype(np.int64)  # below 2^53
        at = key // width
        columns = [
            lang.dictionary.take(pa.array(at // len(source.dictionary))),
            source.dictionary.take(pa.array(at % len(source.dictionary))),
            found.dictionary.take(pa.array(key % width)).cast(pa.string()),
            pa.array(occurrences),
            pa.array(np.bincount(place, minlength=len(key)).astype(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names)


def _share(n: Column | str, total: str, kept: str) -> Column:
    """1 + floor(UNIT (n + 1) / (total + kept)); the product may leave the range of a long."""
    big = lambda c: F.expr(c) if isinstance(c, str) else c
    over = (F.lit(UNIT).cast("decimal(10,0)") * (big(n) + 1).cast("decimal(20,0)")).cast("decimal(38,0)")
    whole = F.call_function("div", over, (F.col(total) + F.col(kept)).cast("decimal(38,0)"))
    return F.lit(1).cast("long") + whole.cast("long")


def _added(p, q):
    """What a term of share p adds to the divergence from share q; for columns of numbers or arrays."""
    return (p - q) * (p - q) // q


def _pairs(out: np.ndarray, langs, names: list[str]) -> pa.Table:
    a, b = np.nonzero(~np.eye(len(names), dtype=bool) & (out != 0))
    known = pa.array(names, pa.string())
    return pa.table({"lang": pa.array([langs] * len(a), pa.string()), "source": known.take(pa.array(a)), "item": known.take(pa.array(b)), "value": pa.array(out[a, b])})


def _sides(table: pa.Table) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Numbers and names of the sources of a cell, and which of them are rows or peers of it."""
    coded = table.column("source").combine_chunks().dictionary_encode()
    code, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    block = np.zeros(len(names), np.int64)
    block[code] = table.column("block").to_numpy()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    return code, names, block == i, block == j


def _common(table: pa.Table) -> pa.Table:
    """For each row and peer of a cell, what the common terms of its slice put right."""
    code, names, is_row, is_peer = _sides(table)
    term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.lexsort((code, term))  # the index: term-major postings
    term, code = term[order], code[order]
    p, zero = (table.column(x).to_numpy()[order] for x in ("p", "p0"))
    first = np.searchsorted(term, np.arange(term[-1] + 2))
    by_source = np.argsort(code, kind="stable")
    edges = np.searchsorted(code[by_source], np.arange(len(names) + 1))
    out = np.zeros((len(names), len(names)), np.int64)
    for s in range(len(names)):
        mine = by_source[edges[s] : edges[s + 1]]
        length = first[term[mine] + 1] - first[term[mine]]
        done = np.cumsum(length)
        start = 0
        while start < len(mine):  # as many terms as make one step
            stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + STEP_PAIRS, side="right")))
            at, n = mine[start:stop], length[start:stop]
            own = np.repeat(at, n)
            peer = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[term[at]], n)
            more = _added(p[own], p[peer]) - _added(p[own], zero[peer]) - _added(zero[own], p[peer]) + _added(zero[own], zero[peer])
            np.add.at(out[s], code[peer], more)
            start = stop
    return _pairs(_kept_sides(out, is_row, is_peer), table.column("lang")[0].as_py(), names)


def _kept_sides(out: np.ndarray, is_row: np.ndarray, is_peer: np.ndarray) -> np.ndarray:
    """A cell of two blocks answers for pairs between them, both ways; of one block, for all its pairs."""
    across = is_row[:, None] & is_peer[None, :]
    return np.where(across | across.T, out, 0)


def _baseline(table: pa.Table) -> pa.Table:
    """For each row and peer of a cell, the sum as if no term were common, from histograms (p, weight)."""
    code, names, is_row, is_peer = _sides(table)
    p, weight = table.column("p").to_numpy(), table.column("weight").to_numpy()
    zero, kept = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    zero[code], kept[code] = table.column("p0").to_numpy(), table.column("kept").to_numpy()
    out = -kept[:, None] * _added(zero[:, None], zero[None, :])
    step = max(1, STEP_PAIRS // len(names))
    for start in range(0, len(p), step):
        at = slice(start, start + step)
        from_zero = weight[at, None] * _added(p[at, None], zero[None, :])  # each value against the peers' zero
        to_zero = weight[at, None] * _added(zero[None, :], p[at, None])
        np.add.at(out, code[at], from_zero)
        np.add.at(out.T, code[at], to_zero)
    return _pairs(_kept_sides(out, is_row, is_peer), table.column("lang")[0].as_py(), names)


def _cells(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each row once for every cell (i <= j) of two blocks of sources that its own block is in."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.join(blocks, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    return dealt.withColumn("_other", other).withColumns({"i": F.least("block", "_other"), "j": F.greatest("block", "_other")})


def divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank for documents (text, lang, source)."""
    rows = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    counted = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = stored(counted, "counts")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= MIN_DOCS)
    kept = stored(kept.drop("docs"), "terms")
    entries = stored(counted.select("lang", "term", "source", "n").join(kept, ["lang", "term"]), "entries")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "own", "kept", "lang_total"])
    groups = stored(groups.withColumn("p0", F.when(F.col("kept") > 0, _share(F.lit(0).cast("long"), "total", "kept")).otherwise(1)), "groups")
    shares = entries.join(groups, ["lang", "source"]).withColumns({"p": _share("n", "total", "kept"), "q": _share("lang_n", "lang_total", "kept")})
    return _term_part(shares).union(_pair_part(shares, entries, groups))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _part(rows: DataFrame, part: str) -> DataFrame:
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))


def _term_part(shares: DataFrame) -> DataFrame:
    value = F.expr("((p - q) * (p - q)) div q")
    over = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), value.alias("value"))
    return _part(_ranked(over).where(F.col("rank") <= TERM_RANKS), "term")


def _pair_part(shares: DataFrame, entries: DataFrame, groups: DataFrame) -> DataFrame:
    blocks = stored(groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "blocks")
    found = "lang string, source string, item string, value long"
    n_slices = max(1, -(-entries.count() // SLICE))
    postings = _cells(shares.select("lang", "source", "term", "p", "p0"), blocks)
    postings = postings.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(n_slices)))
    common = postings.groupBy("lang", "i", "j", "slice").applyInArrow(_common, found)
    histogram = shares.groupBy("lang", "source", "p0", "kept", "p").agg(F.count("*").alias("weight"))
    absent = groups.select("lang", "source", "p0", "kept", F.col("p0").alias("p"), (F.col("kept") - F.col("own")).alias("weight"))
    base = _cells(histogram.union(absent), blocks).groupBy("lang", "i", "j").applyInArrow(_baseline, found)
    wide = F.sum(F.col("value").cast("decimal(38,0)")).cast("long")  # parts may leave the range of a long, sums don't
    sums = common.union(base).groupBy("lang", "source", "item").agg(wide.alias("value"))
    peers = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = peers.join(sums, ["lang", "source", "item"], "left").na.fill(0, ["value"])
    return _part(_ranked(pairs), "pair")
