"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word (a run of letters in lower case) has the scaled sum of the embeddings of its hash and of
the hashes of its 4- and 5-byte parts, so that forms that were never seen share what is known of
their parts.  Filters of several widths slide over the words of the whole text; of each filter
the largest value counts (max pooling), and a logistic unit weighs them.

All labelled texts that aren't held out are learned from, whole, by Spark (``learn``).  Three
quarters of them, by a hash of doc_id, fit the network: counts of hashed words by class, added up
over all tasks, are its start; then, ``EPOCHS`` times, the texts are dealt by hash to shards of about
``SHARD_BYTES``, each shard goes on from the same network, and what the shards make of it is averaged
(of the embedding of a bucket, over the shards that moved it) in whole numbers, so that the order of
adding doesn't matter.  The rest calibrates one threshold for each language with enough labelled
texts, and a common one, from counts of all their scores in bins of 1/``BINS``.  The score moves
each threshold to ``THRESHOLD``, by the language that naive Bayes over hashed words reads off the
text: lang is never read for a score.  The model, of fixed size but for half a megabyte for each
language with a threshold of its own, is all that is broadcast or goes through the driver.

``train`` is for trials: a network from a bounded sample, in one process.  No query uses it.

Words are embedded once for each step of text and the filters are applied to distinct words, then
gathered, added and pooled in blocks; a very long text is a step of its own, pooled by blocks.

Defined results: null and empty texts get the score of a text without words.  Without labelled
texts of both classes each score is 0.  Rows with null doc_id are scored, not learned from;
a doc_id with unlike labels is not learned from, and one text of a doc_id that repeats is.
Other columns are not read.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold.llm.common import documents, mix, released, slices, stored, terms

SAMPLE_DOCS, SAMPLE_BYTES, SAMPLE_LONGEST = 3000, 12 << 20, 1 << 16  # of ``train`` alone
SHARD_BYTES, BINS = 16 << 20, 1024
BUCKETS, DIM, WIDTHS, FILTERS, PARTS = 1 << 17, 16, (1, 2, 3), 16, (4, 5)
EPOCHS, BATCH, RATE, DECAY, SEED = 2, 32, 0.05, 1e-4, 5
THRESHOLD, MIN_CALIBRATION = 0.7, 30  # texts of each class that a language's own threshold needs
_STEP_BYTES, _BLOCK = 4 << 20, 1 << 16
_PAD = max(WIDTHS) - 1
_PRIME = np.uint64(0x100000001B3)
_LARGEST = 64  # logits beyond this are in the last bins
_UNIT = float(1 << 30)
_VALUES = [f"v{i}" for i in range(2 * DIM)]  # of a bucket: its embedding and the state of that


@dataclass
class Words:
    """Distinct words as buckets: their own, and of all their features one after another."""

    own: np.ndarray
    bucket: np.ndarray
    ends: np.ndarray

    def select(self, which: np.ndarray) -> Words:
        n = np.diff(self.ends)[which]
        ends = np.concatenate(([0], np.cumsum(n)))
        at = np.repeat(self.ends[:-1][which] - ends[:-1], n) + np.arange(ends[-1])
        return Words(self.own[which], self.bucket[at], ends)


def featured(distinct: pa.Array) -> Words:
    """The features of distinct words."""
    size = pc.binary_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer("".join(distinct.to_pylist()).encode(), np.uint8)
    row = np.repeat(np.arange(len(size)), size + 2)  # with a mark at each end
    codes = np.ones(len(row), np.uint64)
    codes[np.arange(len(data)) + 1 + 2 * np.repeat(np.arange(len(size)), size)] = data
    start = np.concatenate(([0], np.cumsum(size + 2)))
    powers = np.cumprod(np.full(int(size.max(initial=0)) + 2, _PRIME), dtype=np.uint64)
    whole = np.add.reduceat(codes * powers[np.arange(len(row)) - start[row]], start[:-1]) if len(size) else np.zeros(0, np.uint64)
    own = (mix(whole) % np.uint64(BUCKETS)).astype(np.int64)
    found, rows = [own], [np.arange(len(size))]
    for n in PARTS:
        last = max(0, len(codes) - n + 1)
        inside = np.flatnonzero(row[:last] == row[n - 1 :])
        h = np.full(len(inside), n, np.uint64)
        for i in range(n):
            h = (h ^ codes[inside + i]) * _PRIME
        found.append((mix(h) % np.uint64(BUCKETS)).astype(np.int64))
        rows.append(row[inside])
    rows = np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return Words(own, np.concatenate(found)[order], np.searchsorted(rows[order], np.arange(len(size) + 1)))


@dataclass
class Net:
    table: np.ndarray  # by bucket
    filters: list[np.ndarray]  # by width: (width, DIM, FILTERS)
    bias: list[np.ndarray]
    weight: np.ndarray
    base: float
    langs: list[str] = field(default_factory=list)  # those with a threshold of their own
    word_logs: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    common: float = 0.0

    def embed(self, words: Words) -> np.ndarray:
        """One row for each word, and a last one of zeros for the padding."""
        out = np.zeros((len(words.own) + 1, DIM), np.float32)
        n = np.diff(words.ends)
        row = np.repeat(np.arange(len(n)), n)
        for start in range(0, len(row), 1 << 18):
            part = row[start : start + (1 << 18)]
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            out[part[first]] += np.add.reduceat(self.table[words.bucket[start : start + len(part)]], first, axis=0)
        out[:-1] /= np.sqrt(np.maximum(n, 1))[:, None]
        return out

    def values(self, projected: list[list[np.ndarray]], seq: np.ndarray, a: int, b: int) -> Iterator[np.ndarray]:
        """Of each width, the filters' values at positions a to b; those of padding are -inf."""
        blank = seq[a:b] == len(projected[0][0]) - 1
        for width, offsets, bias in zip(WIDTHS, projected, self.bias):
            z = offsets[0][seq[a:b]]
            for o in range(1, width):
                z += offsets[o][seq[a + o : b + o]]
            z += bias
            z[blank] = -np.inf
            yield z

    def project(self, embedded: np.ndarray) -> list[list[np.ndarray]]:
        return [[embedded @ f[o] for o in range(w)] for w, f in zip(WIDTHS, self.filters)]

    def pooled(self, words: Words, seq: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """The largest value of each filter for each of n texts, at least 0."""
        out = np.zeros((n, len(WIDTHS), FILTERS), np.float32)
        projected = self.project(self.embed(words))
        for a in range(0, len(row), _BLOCK):
            b = min(a + _BLOCK, len(row))
            first = np.flatnonzero(np.concatenate(([True], row[a + 1 : b] != row[a : b - 1])))
            at = row[a + first]
            for k, z in enumerate(self.values(projected, seq, a, b)):
                out[at, k] = np.maximum(out[at, k], np.maximum.reduceat(z, first, axis=0))
        return out.reshape(n, -1)

    def logits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The logit of each text, and the threshold that holds for it."""
        found, row = _words(texts)
        words = featured(found.dictionary)
        code = found.indices.to_numpy().astype(np.int64)
        z = self.pooled(words, *_sequence(code, row, len(texts), len(words.own)), len(texts)) @ self.weight + self.base
        if not self.langs:
            return z, np.full(len(texts), self.common)
        at = words.own[code]
        fit = np.stack([np.bincount(row, weights=logs[at], minlength=len(texts)) for logs in self.word_logs.T], axis=1)
        return z, np.where(np.bincount(row, minlength=len(texts)) > 0, self.thresholds[fit.argmax(axis=1)], self.common)

    def scores(self, texts: pa.Array) -> np.ndarray:
        z, threshold = self.logits(texts)
        return _sigmoid(z.astype(np.float64) - threshold + np.log(THRESHOLD / (1 - THRESHOLD)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    return terms(pc.utf8_lower(pc.fill_null(texts, "")))


def _sequence(code: np.ndarray, row: np.ndarray, n: int, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of n texts, each followed by padding, with the padding of the last window; and the text of each."""
    size = np.bincount(row, minlength=n) + _PAD
    seq = np.full(int(size.sum()) + _PAD, blank)
    seq[np.arange(len(code)) + _PAD * row] = code
    return seq, np.repeat(np.arange(n), size)


def _seen(words: Words, code: np.ndarray, row: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """By class (0, 1) and bucket: how often texts hold it, each word once for a text."""
    counts = []
    for label in (0, 1):
        mine = toxic[row] == label
        once = np.unique(row[mine] * len(words.own) + code[mine]) % max(1, len(words.own))
        counts.append(np.bincount(words.select(once).bucket, minlength=BUCKETS))
    return np.stack(counts)


def _start(seen: np.ndarray, texts: tuple[int, int]) -> Net:
    """A network whose first dimension is the log odds of a bucket, shrunk; all else is drawn."""
    rng = np.random.default_rng(SEED)
    share = [(seen[label] + 2) / (texts[label] + 2) for label in (0, 1)]
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    table[:, 0] = np.log(share[1] / share[0])
    filters = [rng.normal(0, 0.3 / np.sqrt(w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    return Net(table, filters, bias, rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)


class _Adagrad:
    def __init__(self, shape: tuple[int, ...]):
        self.sum = np.full(shape, 1e-3, np.float32)

    def step(self, value: np.ndarray, grad: np.ndarray, at=...) -> None:
        grad = grad + DECAY * value[at]
        self.sum[at] += grad * grad
        value[at] -= RATE * grad / np.sqrt(self.sum[at])


class _Trainer:
    """A network and the state of its training: logistic loss, each class with the same weight, by
    Adagrad over batches of texts."""

    def __init__(self, net: Net, toxic_share: float):
        self.net, self.toxic_share = net, toxic_share
        self.table, self.weight, self.base = _Adagrad(net.table.shape), _Adagrad(net.weight.shape), _Adagrad((1,))
        self.filters, self.bias = [_Adagrad(f.shape) for f in net.filters], [_Adagrad(b.shape) for b in net.bias]
        self.moved = np.zeros(BUCKETS, bool)

    def _best(self, projected: list[list[np.ndarray]], seq: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each filter, the largest value in each of n texts, and its first position."""
        best = np.full((n, len(WIDTHS), FILTERS), -np.inf, np.float32)
        where = np.zeros(best.shape, np.int64)
        for a in range(0, len(at), _BLOCK):
            part = at[a : a + _BLOCK]
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            mine, run = part[first], np.repeat(np.arange(len(first)), np.diff(first, append=len(part)))
            for k, z in enumerate(self.net.values(projected, seq, a, a + len(part))):
                top = np.maximum.reduceat(z, first, axis=0)
                place = np.where(z == top[run], np.arange(a, a + len(part))[:, None], len(at))
                place = np.minimum.reduceat(place, first, axis=0)
                where[mine, k] = np.where(top > best[mine, k], place, where[mine, k])
                best[mine, k] = np.maximum(top, best[mine, k])
        return best, where

    def learn(self, words: Words, code: np.ndarray, row: np.ndarray, toxic: np.ndarray, order: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over texts, in this order."""
        net = self.net
        edges = np.searchsorted(row, np.arange(len(toxic) + 1))
        cost = np.where(toxic == 1, 0.5 / self.toxic_share, 0.5 / (1 - self.toxic_share))
        for start in range(0, len(order), BATCH):
            docs = order[start : start + BATCH]
            mine = np.concatenate([code[edges[d] : edges[d + 1]] for d in docs])
            of = np.repeat(np.arange(len(docs)), np.diff(edges)[docs])
            distinct, local = np.unique(mine, return_inverse=True)
            some = words.select(distinct)
            seq, at = _sequence(local, of, len(docs), len(distinct))
            embedded = net.embed(some)
            best, where = self._best(net.project(embedded), seq, at, len(docs))
            hidden = np.maximum(best, 0).reshape(len(docs), -1)
            drop = (rng.random(hidden.shape) < 0.8) / np.float32(0.8)
            slope = (_sigmoid((hidden * drop) @ net.weight + net.base) - toxic[docs]) * cost[docs] / len(docs)
            slope = slope.astype(np.float32)
            back = slope[:, None] * net.weight * drop * (hidden > 0)
            moved = np.zeros_like(embedded)
            changes = []
            for k, width in enumerate(WIDTHS):
                d = back[:, k * FILTERS : (k + 1) * FILTERS]
                grad = np.zeros_like(net.filters[k])
                for o in range(width):
                    word = seq[where[:, k] + o]
                    grad[o] = np.einsum("bfd,bf->df", embedded[word], d)
                    np.add.at(moved, word, d[:, :, None] * net.filters[k][o].T[None])
                changes.append((grad, d.sum(axis=0)))
            for k, (grad, shift) in enumerate(changes):
                self.filters[k].step(net.filters[k], grad)
                self.bias[k].step(net.bias[k], shift)
            self.weight.step(net.weight, (hidden * drop).T @ slope)
            value = np.array([net.base])
            self.base.step(value, np.array([slope.sum()]))
            net.base = float(value[0])
            touched = np.flatnonzero(moved[:-1].any(axis=1))
            if len(touched):
                parts = some.select(touched)
                n = np.diff(parts.ends)
                bucket, inverse = np.unique(parts.bucket, return_inverse=True)
                grad = np.zeros((len(bucket), DIM), np.float32)
                np.add.at(grad, inverse, np.repeat(moved[touched] / np.sqrt(n)[:, None], n, axis=0))
                self.table.step(net.table, grad, bucket)
                self.moved[bucket] = True

    def _dense(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """All but the embeddings and the base, and their state."""
        return [self.net.weight, *self.net.filters, *self.net.bias], [x.sum for x in (self.weight, *self.filters, *self.bias)]

    def rows(self) -> pa.RecordBatch:
        """What is to be averaged, as whole numbers: a row for each moved bucket, and rows below 0 for all else."""
        at = np.flatnonzero(self.moved)
        dense = [np.concatenate([x.ravel().astype(np.float64) for x in (*part, last)]) for part, last in zip(self._dense(), (np.array([self.net.base]), self.base.sum))]
        dense = [np.pad(x, (0, -len(x) % DIM)).reshape(-1, DIM) for x in dense]
        values = np.vstack([np.hstack(dense), np.hstack([self.net.table[at], self.table.sum[at]])])
        whole = np.rint(values * _UNIT).astype(np.int64)
        names = np.concatenate((-1 - np.arange(len(dense[0])), at)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(names), *(pa.array(c) for c in whole.T)], ["at", *_VALUES])

    def take(self, means: pa.Table) -> None:
        """Go on from the averages of rows of several trainers."""
        at = means.column("at").to_numpy()
        values = np.column_stack([means.column(c).to_numpy() for c in _VALUES])
        own = at >= 0
        self.net.table[at[own]], self.table.sum[at[own]] = values[own, :DIM], values[own, DIM:]
        dense = values[~own][np.argsort(-at[~own])]
        for flat, part, last in zip((dense[:, :DIM].ravel(), dense[:, DIM:].ravel()), self._dense(), (None, self.base.sum)):
            for x in part:
                x[...], flat = flat[: x.size].reshape(x.shape), flat[x.size :]
            if last is None:
                self.net.base = float(flat[0])
            else:
                last[0] = flat[0]


def _fit(words: Words, code: np.ndarray, row: np.ndarray, toxic: np.ndarray) -> Net:
    trainer = _Trainer(_start(_seen(words, code, row, toxic), (np.sum(toxic == 0), np.sum(toxic == 1))), toxic.mean())
    rng = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        trainer.learn(words, code, row, toxic, rng.permutation(len(toxic)), rng)
    return trainer.net


def _cut(n: np.ndarray, hits: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """The middle of the gap, between groups of falling values, at which the F1 of the texts above it is highest."""
    f1 = 2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())
    k = int(f1.argmax())
    return float((low[k] + high[k + 1]) / 2) if k + 1 < len(f1) else float(low[k]) - 0.5


def _threshold(z: np.ndarray, toxic: np.ndarray) -> float:
    """The same between single values; equal ones fall on one side."""
    values, group = np.unique(-z, return_inverse=True)
    return _cut(np.bincount(group), np.bincount(group, weights=toxic), -values, -values)


def _language_logs(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of buckets from counts by bucket and language."""
    counts = counts + 0.1
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def _calibrate(net: Net, texts: pa.Array, lang: np.ndarray, toxic: np.ndarray, words: Words, code: np.ndarray, row: np.ndarray, learned: np.ndarray) -> None:
    """Thresholds from texts that the network has not seen; hashed words of languages from those it has."""
    z, _ = net.logits(texts)
    net.common = _threshold(z, toxic)
    known = [x for x in sorted(set(lang.tolist()) - {None})]
    own = [x for x in known if all(np.sum((lang == x) & (toxic == k)) >= MIN_CALIBRATION for k in (0, 1)) and (learned == x).any()]
    if not own:
        return
    counts = [np.bincount(words.own[code[learned[row] == x]], minlength=BUCKETS) for x in own]
    net.langs, net.word_logs = own, _language_logs(np.stack(counts, axis=1))
    net.thresholds = np.array([_threshold(z[lang == x], toxic[lang == x]) for x in own])


def train_on(sample: pa.Table) -> Net | None:
    """A network from texts (text, lang, toxic); None if they are not of both classes."""
    sample = sample.combine_chunks()
    toxic = sample.column("toxic").to_numpy().astype(np.int64)
    if len(set(toxic.tolist())) < 2:
        return None
    lang = np.array(sample.column("lang").to_pylist(), dtype=object)
    texts = sample.column("text").combine_chunks()
    # Every fourth text of a class calibrates, unless there are too few to spare any.
    rank = np.zeros(len(toxic), int)
    for k in (0, 1):
        rank[toxic == k] = np.arange(np.sum(toxic == k))
    spared = rank % 4 == 3
    if len(set(toxic[spared].tolist())) < 2:
        spared[:] = False
    fit = ~spared
    found, row = _words(texts.filter(pa.array(fit)))
    words, code = featured(found.dictionary), found.indices.to_numpy().astype(np.int64)
    net = _fit(words, code, row, toxic[fit])
    other = spared if spared.any() else fit
    _calibrate(net, texts.filter(pa.array(other)), lang[other], toxic[other], words, code, row, lang[fit])
    return net


def held_out(doc_id: Column) -> Column:
    """A third of all documents, by CRC-32 of the identifier as text; not where it is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _marks(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the documents with one label, not held out."""
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    marks = marks.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    return marks.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other").drop("other")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))


def train(docs: DataFrame, labels: DataFrame) -> Net | None:
    """For trials: a network from at most about ``SAMPLE_DOCS`` texts of each class and ``SAMPLE_BYTES``
    in all, none of them longer than ``SAMPLE_LONGEST``, drawn by a hash of doc_id."""
    marks = _marks(labels)
    n = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}  # two rows at most
    if len(n) < 2:
        return None
    lot = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 40))
    most = F.when(F.col("toxic") == 1, min(1.0, SAMPLE_DOCS / n[1])).otherwise(min(1.0, SAMPLE_DOCS / n[0]))
    drawn = marks.where(lot < (most * (1 << 40)).cast("long")).withColumn("lot", lot)
    rows = _texts(docs).where(F.char_length("text") <= SAMPLE_LONGEST)
    # SAMPLE_DOCS of each class is what is expected at most.
    met = rows.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic", "lot").agg(F.min_by(F.struct("text", "lang"), F.xxhash64("text")).alias("s"))
    size = met.agg(F.sum(F.octet_length("s.text")).alias("n")).first()["n"] or 1
    # The share of the drawn rows that SAMPLE_BYTES has room for, by another part of the hash.
    if size > SAMPLE_BYTES:
        met = met.where(F.pmod(F.xxhash64("lot"), F.lit(1 << 40)) < int(SAMPLE_BYTES / size * (1 << 40)))
    table = met.select("doc_id", "s.text", "s.lang", "toxic").toArrow().sort_by("doc_id")
    return train_on(table)


def _counter(own: list[str]):
    """Counts by class and bucket (lang null), and by language and bucket of words (toxic null), of one task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, spoken = np.zeros((2, BUCKETS), np.int64), {}

        def found(lang: str | None, toxic: int | None, counts: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(counts)
            names = [pa.array([lang] * len(at), pa.string()), pa.array([toxic] * len(at), pa.int32())]
            return pa.RecordBatch.from_arrays([*names, pa.array(at.astype(np.int32)), pa.array(counts[at].astype(np.int64))], ["lang", "toxic", "bucket", "n"])

        for batch in slices(batches, step=_STEP_BYTES):
            coded, row = _words(batch.column("text"))
            words, code = featured(coded.dictionary), coded.indices.to_numpy().astype(np.int64)
            seen += _seen(words, code, row, batch.column("toxic").to_numpy())
            lang = pc.fill_null(pc.index_in(batch.column("lang"), pa.array(own, pa.string())), -1).to_numpy()[row]
            for k in np.unique(lang[lang >= 0]).tolist():
                mine = np.bincount(words.own[code[lang == k]], minlength=BUCKETS)
                spoken[k] = spoken[k] + mine if k in spoken else mine
            if len(spoken) > 64:  # counts of many languages don't wait for the end of the task
                yield from (found(own[k], None, counts) for k, counts in spoken.items())
                spoken.clear()
        yield from (found(None, label, seen[label]) for label in (0, 1))
        yield from (found(own[k], None, counts) for k, counts in spoken.items())
        released()

    return count


def _passer(shared, epoch: int):
    """One pass over each shard of a task (rows of a shard follow each other), from the shared trainer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, rng, now = None, None, None
        for batch in slices(batches, step=_STEP_BYTES):
            shard = batch.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(edges, edges[1:]):
                if shard[a] != now:
                    if trainer is not None:
                        yield trainer.rows()
                    now = int(shard[a])
                    trainer, rng = copy.deepcopy(shared.value), np.random.default_rng((SEED, epoch, now))
                part = batch.slice(a, b - a)
                coded, row = _words(part.column("text"))
                code = coded.indices.to_numpy().astype(np.int64)
                trainer.learn(featured(coded.dictionary), code, row, part.column("toxic").to_numpy(), np.arange(b - a), rng)
        if trainer is not None:
            yield trainer.rows()
        released()

    return run


def _placer(shared):
    """Texts and toxic ones, and the bounds of their logits, by language (null: none of those wanted) and bin."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, own = shared.value
        for batch in slices(batches, step=_STEP_BYTES):
            z = net.logits(batch.column("text"))[0].astype(np.float64)
            bins = np.floor(np.clip(z, -_LARGEST, _LARGEST) * BINS).astype(np.int64)
            lang = pc.fill_null(pc.index_in(batch.column("lang"), pa.array(own, pa.string())), -1).to_numpy()
            order = np.lexsort((bins, lang))
            z, bins, lang, toxic = z[order], bins[order], lang[order], batch.column("toxic").to_numpy().astype(np.int64)[order]
            first = np.flatnonzero(np.concatenate(([True], (bins[1:] != bins[:-1]) | (lang[1:] != lang[:-1]))))
            columns = [np.diff(first, append=len(z)), np.add.reduceat(toxic, first), np.minimum.reduceat(z, first), np.maximum.reduceat(z, first)]
            names = [own[k] if k >= 0 else None for k in lang[first].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bins[first]), *map(pa.array, columns)], ["lang", "bin", "n", "hits", "low", "high"])
        released()

    return place


def _set_thresholds(net: Net, texts: DataFrame, own: list[str]) -> None:
    """The common threshold, and those of the languages ``own``, from all these texts."""
    shared = texts.sparkSession.sparkContext.broadcast((net, own))
    placed = texts.select("text", "lang", "toxic").mapInArrow(_placer(shared), "lang string, bin long, n long, hits long, low double, high double")
    sums = placed.groupBy("lang", "bin").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.min("low").alias("low"), F.max("high").alias("high"))
    found = sums.toArrow().sort_by([("bin", "descending")])  # at most 2 * _LARGEST * BINS rows for each language

    def cut(rows: pa.Table) -> float:
        return _cut(*(rows.column(c).to_numpy() for c in ("n", "hits", "low", "high")))

    everywhere = found.group_by("bin").aggregate([("n", "sum"), ("hits", "sum"), ("low", "min"), ("high", "max")])
    everywhere = everywhere.rename_columns([c.split("_")[0] for c in everywhere.column_names]).sort_by([("bin", "descending")])
    net.common = cut(everywhere)
    net.thresholds = np.array([cut(found.filter(pc.equal(found.column("lang"), x))) for x in own])


def learn(docs: DataFrame, labels: DataFrame) -> Net | None:
    """Learn from all labelled documents (doc_id, text, lang; doc_id, toxic) that aren't held out."""
    rows = _texts(docs).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    met = rows.join(_marks(labels), "doc_id").groupBy("doc_id", "toxic")
    met = met.agg(F.min_by(F.struct("text", "lang"), F.struct(F.xxhash64("text"), "lang")).alias("s")).select("doc_id", "s.text", "s.lang", "toxic")
    spared = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(4)) == 3
    met = stored(met.withColumns({"spared": spared, "size": F.octet_length("text").cast("long")}), "labelled")
    counted = met.groupBy("lang", "spared", "toxic").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()  # four rows for each language
    # A fourth of the texts calibrates, unless it lacks a class.
    apart = {r["toxic"] for r in counted if r["spared"]} == {r["toxic"] for r in counted if not r["spared"]} == {0, 1}
    fit, other = (met.where("not spared"), met.where("spared")) if apart else (met, met)
    fitting, calibrating = [[r for r in counted if not apart or r["spared"] == x] for x in (False, True)]
    texts = tuple(sum(r["n"] for r in fitting if r["toxic"] == label) for label in (0, 1))
    if not all(texts):
        return None
    enough = {}
    for r in calibrating:
        enough[r["lang"], r["toxic"]] = enough.get((r["lang"], r["toxic"]), 0) + r["n"]
    learned = sorted({r["lang"] for r in fitting} - {None})
    own = [x for x in learned if all(enough.get((x, label), 0) >= MIN_CALIBRATION for label in (0, 1))]
    counts = fit.select("text", "lang", "toxic").mapInArrow(_counter(own), "lang string, toxic int, bucket int, n long")
    counts = counts.groupBy("lang", "toxic", "bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows for each class and language

    def by_bucket(rows: pa.Table) -> np.ndarray:
        out = np.zeros(BUCKETS)
        out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
        return out

    seen = np.stack([by_bucket(counts.filter(pc.equal(counts.column("toxic"), label))) for label in (0, 1)])
    trainer = _Trainer(_start(seen, texts), texts[1] / sum(texts))
    shards = max(1, math.ceil(sum(r["size"] for r in fitting) / SHARD_BYTES))
    dealt = fit.select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(shards)).cast("int").alias("shard"), "doc_id")
    for epoch in range(EPOCHS):
        order = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", F.xxhash64("doc_id", F.lit(SEED + 2 + epoch)), "doc_id")
        shared = docs.sparkSession.sparkContext.broadcast(trainer)
        made = order.drop("doc_id").mapInArrow(_passer(shared, epoch), "at int, " + ", ".join(f"{c} long" for c in _VALUES))
        sums = made.groupBy("at").agg(*((F.sum(c) / F.count("*") / _UNIT).cast("float").alias(c) for c in _VALUES))
        trainer.take(sums.toArrow())  # at most BUCKETS rows and those of the filters
    net = trainer.net
    _set_thresholds(net, other, own)
    if own:
        net.langs = own
        net.word_logs = _language_logs(np.stack([by_bucket(counts.filter(pc.equal(counts.column("lang"), x))) for x in own], axis=1))
    return net


def predict(docs: DataFrame, net: Net | None) -> DataFrame:
    """doc_id, score and predicted of every row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, step=_STEP_BYTES):
            score = known.scores(batch.column("text")) if known else np.zeros(batch.num_rows)
            columns = [batch.column("doc_id"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    return documents(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs; learned from labels that aren't held out."""
    return predict(docs, learn(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
