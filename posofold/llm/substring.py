"""Repeated passages: seed and extend.

Seeds: each window of ``LENGTH`` words names one anchor, the smallest hash among its runs of
``SEED`` words (rightmost if tied).  Two equal windows name the same anchor, so every repeat of
LENGTH words is seeded, with one seed for about seven words.  Documents meet on equal anchors.

Extension: an anchor stands for the consecutive windows that name it, up to LENGTH - SEED + 1 of
them; together they reach as far to the left and right as a repeat could need before the next
anchor takes over.  Occurrences whose whole extension is equal form a class: all but the first
are repeats.  Where one anchor has several classes, the first occurrence of each is extended
window by window and the windows meet in turn.  Occurrences are compared with the first of their
kind, never with each other, so a passage in a third of all documents costs a row for each.
Within a batch a task keeps the first occurrence alone and settles the others by itself.

Repeats that touch or overlap are joined to maximal ones.  ``repeats`` gives these spans and
``without_repeats`` the kept text.  Windows are judged on the input.

Defined results: null and empty texts have no words.  Rows without doc_id take no part and keep
all words.  Rows that repeat a doc_id and text exactly get the same result each.  Words are
compared by 64-bit hashes of words, seeds and extensions (a seed and an extension must agree).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posofold.llm.common import Rolling, documents, hash_words, mix, slices, stored, words

LENGTH, SEED = 20, 8
REACH = LENGTH - SEED + 1
_SEED_ROW = "anchor long, extension long, doc_id long, start int, windows int, known array<struct<start:int,windows:int>>"
_WINDOW_ROW = "anchor long, extension long, doc_id long, start int, known array<struct<start:int,windows:int>>"
_SPAN = pa.struct([("start", pa.int32()), ("windows", pa.int32())])


def _first_of(anchor, extension, doc, start) -> np.ndarray:
    """Whether each row is the first (by doc, start) with its anchor and extension."""
    order = np.lexsort((start, doc, extension, anchor))
    a, e = anchor[order], extension[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (e[1:] != e[:-1])
    # Rows that repeat the same place of the same document are as early as the first.
    d, s = doc[order], start[order]
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    tied = (d == d[head]) & (s == s[head])
    first = np.zeros(len(order), bool)
    first[order] = new | tied
    return first


def _known(doc, start, windows) -> tuple[np.ndarray, pa.Array]:
    """Documents and the spans found in each."""
    order = np.lexsort((start, doc))
    doc, start, windows = doc[order], start[order], windows[order]
    heads = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else np.zeros(0, int)
    spans = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32))], fields=list(_SPAN))
    lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(doc)).astype(np.int32)), spans)
    return doc[heads], lists


def _no_spans(n: int) -> pa.Array:
    return pa.nulls(n, pa.list_(_SPAN))


class _Text:
    """Word hashes of the texts of a batch, the windows in them and the anchors they name."""

    def __init__(self, texts: pa.Array):
        flat, self.offsets = words(texts)
        self.rolling = Rolling(hash_words(flat))
        n = len(flat)
        lengths = np.diff(self.offsets)
        self.row = np.repeat(np.arange(len(lengths)), lengths)
        self.left = self.offsets[1:][self.row] - np.arange(n)  # words from here to the end of the text
        seeds = self.rolling.all(SEED)
        low = seeds
        for step in (1, 2, 4, REACH - 8):  # minimum over 2, 4, 8 and REACH seeds
            low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        self.windows = np.flatnonzero(self.left[: len(low)] >= LENGTH)
        at = np.zeros(len(self.windows), np.int64)
        least = low[self.windows]
        for j in range(REACH):
            at = np.where(seeds[self.windows + j] == least, self.windows + j, at)
        self.anchor_at, self.anchor = at, least


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        t = _Text(batch.column("text"))
        ids = batch.column("doc_id").to_numpy()
        w = t.windows
        if not len(w):
            continue
        new = np.ones(len(w), bool)
        new[1:] = (t.anchor_at[1:] != t.anchor_at[:-1]) | (w[1:] != w[:-1] + 1)
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(w)))
        start, anchor = w[head], t.anchor[head]
        extension = t.rolling.of(start, count + LENGTH - 1)
        extension = mix(extension + mix((count * 64 + t.anchor_at[head] - start).astype(np.uint64)))
        doc, place = ids[t.row[start]], start - t.offsets[t.row[start]]
        first = _first_of(anchor, extension, doc, place)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor[first].view(np.int64)), pa.array(extension[first].view(np.int64)), pa.array(doc[first]),
             pa.array(place[first].astype(np.int32)), pa.array(count[first].astype(np.int32)), _no_spans(int(first.sum()))],
            ["anchor", "extension", "doc_id", "start", "windows", "known"],
        )
        later = ~first
        if later.any():
            found, spans = _known(doc[later], place[later], count[later])
            n, none = len(found), np.zeros(len(found), np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(found), pa.array(none), pa.array(none), spans],
                ["anchor", "extension", "doc_id", "start", "windows", "known"],
            )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the extensions that are still open."""
    for batch in slices(_unpacked(batches)):
        t = _Text(batch.column("text"))
        ids = batch.column("doc_id").to_numpy()
        lists = batch.column("open")
        spans = lists.flatten()
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        n = spans.field("windows").to_numpy().astype(np.int64)
        base = np.repeat(t.offsets[:-1], counts) + spans.field("start").to_numpy()
        at = np.repeat(base - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        at = np.unique(at)  # repeated rows of a document
        where = np.searchsorted(t.windows, at)
        good = where < len(t.windows)
        good[good] = t.windows[where[good]] == at[good]
        at, anchor = at[good], t.anchor[where[good]]
        extension = mix(t.rolling.of(at, LENGTH) + (t.anchor_at[where[good]] - at).astype(np.uint64))
        doc, place = ids[t.row[at]], at - t.offsets[t.row[at]]
        first = _first_of(anchor, extension, doc, place)
        columns = ["anchor", "extension", "doc_id", "start", "known"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor[first].view(np.int64)), pa.array(extension[first].view(np.int64)), pa.array(doc[first]),
             pa.array(place[first].astype(np.int32)), _no_spans(int(first.sum()))], columns,
        )
        later = ~first
        if later.any():
            found, spans = _known(doc[later], place[later], np.ones(int(later.sum()), int))
            m = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(found), pa.array(np.zeros(m, np.int32)), spans],
                columns,
            )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches):
        texts = [None if x is None else press.compress(x.encode()) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "packed"])


def _unpacked(batches: Iterator[pa.RecordBatch], step: int = 512) -> Iterator[pa.RecordBatch]:
    opened = zstandard.ZstdDecompressor()
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            texts = [None if x is None else opened.decompress(x).decode() for x in part.column("packed").to_pylist()]
            at = part.schema.get_field_index("packed")
            yield part.set_column(at, "text", pa.array(texts, pa.string()))


def packed(docs: DataFrame) -> DataFrame:
    return documents(docs).mapInArrow(_packed, "doc_id long, packed binary")


def _keyed(rows: DataFrame, *more: str) -> DataFrame:
    """Rows dealt out by anchor (and more); those without one (already settled) by document."""
    return rows.withColumn("anchor", F.coalesce("anchor", F.xxhash64("doc_id", "start"))).repartition("anchor", *more)


def _settled(docs: DataFrame) -> DataFrame:
    """doc_id and the spans (start, windows) of windows that also start earlier."""
    place = Window.partitionBy("anchor", "extension", F.col("known").isNotNull()).orderBy("doc_id", "start")
    seeds = _keyed(documents(docs).where("doc_id is not null").mapInArrow(_seeds, _SEED_ROW))
    ranked = seeds.withColumn("rank", F.rank().over(place))
    kinds = Window.partitionBy("anchor")
    ranked = ranked.withColumns({"low": F.min("extension").over(kinds), "high": F.max("extension").over(kinds)})
    span = F.struct("start", "windows")
    told = ranked.select(
        "doc_id",
        F.when(F.col("known").isNotNull(), F.col("known")).when(F.col("rank") > 1, F.array(span)).alias("found"),
        F.when(F.col("known").isNull() & (F.col("rank") == 1) & (F.col("low") < F.col("high")), span).alias("open"),
    ).where("found is not null or open is not null")
    told = told.groupBy("doc_id").agg(
        F.flatten(F.collect_list("found")).alias("found"), F.collect_list("open").alias("open")
    )
    told = stored(told, "seeded")
    texts = packed(docs)
    unsettled = told.where(F.size("open") > 0).select("doc_id", "open")
    windows = unsettled.join(texts, "doc_id").select("doc_id", "open", "packed").mapInArrow(_windows, _WINDOW_ROW)
    ranked = _keyed(windows, "extension").withColumn("rank", F.rank().over(place))
    more = ranked.select(
        "doc_id",
        F.when(F.col("known").isNotNull(), F.col("known")).when(
            F.col("rank") > 1, F.array(F.struct("start", F.lit(1).alias("windows")))
        ).alias("found"),
    ).where("found is not null")
    return (
        told.select("doc_id", "found")
        .union(more)
        .groupBy("doc_id")
        .agg(F.flatten(F.collect_list("found")).alias("found"))
    )


def _cut(with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(_unpacked(batches)):
            flat, offsets = words(batch.column("text"))
            n = np.diff(offsets)
            lists = batch.column("found")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            spans = lists.flatten()
            row = np.repeat(np.arange(len(n)), counts)
            starts = spans.field("start").to_numpy().astype(np.int64)
            ends = np.minimum(starts + spans.field("windows").to_numpy() + LENGTH - 1, n[row]) + offsets[row]
            change = np.zeros(len(flat) + 1, np.int64)
            np.add.at(change, np.minimum(starts, n[row]) + offsets[row], 1)
            np.add.at(change, ends, -1)
            gone = np.cumsum(change[:-1]) > 0
            before = np.concatenate(([0], np.cumsum(gone)))[offsets]
            removed = np.diff(before)
            kept = flat.filter(pa.array(~gone))
            lists = pa.ListArray.from_arrays(pa.array((offsets - before).astype(np.int32)), kept)
            texts = pc.binary_join(lists, " ")
            digests = [hashlib.sha256(x.as_buffer()).hexdigest() for x in texts]
            columns = [batch.column("doc_id"), pa.array(n), pa.array(removed), pa.array(digests)]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(texts)
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names)

    return cut


def repeats(docs: DataFrame) -> DataFrame:
    """Maximal repeats: doc_id, start and end (words, end excluded) of each removed passage."""
    one = F.explode("found").alias("w")
    spans = _settled(docs).select("doc_id", one)
    spans = spans.select("doc_id", F.col("w.start").alias("start"), (F.col("w.start") + F.col("w.windows") + LENGTH - 1).alias("end"))
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", (F.coalesce(reached, F.lit(-1)) < F.col("start")).cast("int"))
    spans = spans.withColumn("run", F.sum("new").over(order))
    return spans.groupBy("doc_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def without_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """For each row of docs: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text."""
    found = packed(docs).join(_settled(docs), "doc_id", "left").select("doc_id", "packed", "found")
    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return found.mapInArrow(_cut(with_text), kind)
