"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, all else becomes one space, and n-grams of 1 to 3 characters are hashed
to BUCKETS.  Counts by language and bucket come from at most about MAX_TRAIN labelled texts of
each language, drawn by a hash of the identifier; whole texts.  The matrix of log probabilities
is broadcast in blocks of LANG_BLOCK languages, so each broadcast has a fixed size however many
languages there are.  A slice of texts is a sparse matrix of n-grams, scored by gathering and
adding matrix rows; with several blocks the best language so far goes on to the next one.

``fit`` is how much less likely the n-grams of a text are, on average, than those of the least
likely text that its language was learned from (at least MIN_GRAMS n-grams; 0 if none less).
Unlike the score, which nears 1 for any long text, it tells texts of no learned language.

Defined results: texts that are null or have no letter are ``und`` with score 1 and fit 0.  Rows
with null lang or doc_id are not learned from.  With nothing to learn from, all texts are ``und``,
score 0.  Ties go to the language that sorts first.  Columns of docs that are called lang_pred,
score or fit are replaced.  A text's result doesn't depend on the texts next to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold.llm.common import released, slices

BUCKETS, ORDERS = 1 << 16, (1, 2, 3)
MAX_TRAIN, SMOOTHING = 4000, 0.5
LANG_BLOCK = 256  # languages in one broadcast: 64 MB
MIN_GRAMS = 60
UNKNOWN = "und"
_STEP_BYTES = 1 << 19  # a step takes some fifty times as much memory
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points with single spaces for what isn't a letter, the text each is from, and whether
    each text has a letter."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    n = pc.utf8_length(lower).to_numpy().astype(np.int64)
    codes = np.frombuffer("".join(lower.to_pylist()).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(n), dtype=np.int32), n)
    letter = _letter_table()[codes]
    has = np.bincount(row[letter], minlength=len(n)) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (row[1:] == row[:-1])  # of a run of other characters behind a letter, the first stays
    return np.where(letter, codes, np.uint32(32))[keep], row[keep], has


def _grams(codes: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of each n-gram, and the text it is from."""
    for n in ORDERS:
        if len(codes) < n:
            return
        last = len(codes) - n + 1
        h = np.full(last, n, np.uint32)
        for i in range(n):
            h = (h ^ codes[i : last + i]) * _FACTORS[i]
            h ^= h >> np.uint32(15)
        inside = row[:last] == row[n - 1 :]
        yield (h[inside] & np.uint32(BUCKETS - 1)).astype(np.int32), row[:last][inside]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language and bucket of one task."""
    counts: dict[str, np.ndarray] = {}

    def found() -> Iterator[pa.RecordBatch]:
        for name, count in counts.items():
            at = np.flatnonzero(count)
            columns = [pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(count[at].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    for batch in slices(batches, step=_STEP_BYTES):
        codes, row, has = _characters(batch.column("text"))
        coded = batch.column("lang").dictionary_encode()
        which, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        for bucket, at in _grams(codes, row):
            good = has[at]
            of = which[at[good]]
            for k, name in enumerate(names):
                mine = np.bincount(bucket[good][of == k] if len(names) > 1 else bucket[good], minlength=BUCKETS)
                counts[name] = counts[name] + mine if name in counts else mine
        if len(counts) > 64:  # counts of many languages don't wait for the end of the task
            yield from found()
            counts.clear()
    yield from found()


@dataclass
class Block:
    """Some of the languages."""

    langs: list[str]
    logs: np.ndarray  # by language and bucket
    prior: np.ndarray
    least: np.ndarray  # mean log probability of the least likely text learned from


@dataclass
class Model:
    blocks: list[Block]

    @property
    def langs(self) -> list[str]:
        return [x for b in self.blocks for x in b.langs]


def train(labelled: DataFrame) -> Model:
    """Learn from labelled texts (doc_id, text, lang)."""
    rows = labelled.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where("doc_id is not null and text is not null and lang is not null")
    found = sorted((r["lang"], r["count"]) for r in rows.groupBy("lang").count().collect())  # a row for each language
    total = sum(n for _, n in found)
    lot = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
    blocks = []
    for start in range(0, len(found), LANG_BLOCK):
        part = found[start : start + LANG_BLOCK]
        langs = [x for x, _ in part]
        share = F.create_map(*(F.lit(x) for lang, n in part for x in (lang, int(min(1.0, MAX_TRAIN / n) * (1 << 30)))))
        sample = rows.where(lot < F.try_element_at(share, F.col("lang"))).select("text", "lang")
        counts = sample.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        table = counts.toArrow()  # at most LANG_BLOCK x BUCKETS numbers
        matrix = np.full((len(langs), BUCKETS), SMOOTHING, np.float32)
        at = pc.index_in(table.column("lang"), pa.array(langs)).to_numpy()
        matrix[at, table.column("bucket").to_numpy()] += table.column("n").to_numpy()
        logs = np.log(matrix / matrix.sum(axis=1, keepdims=True, dtype=np.float64)).astype(np.float32)
        prior = np.log(np.array([n for _, n in part]) / total)
        block = Block(langs, logs, prior, np.full(len(langs), -np.inf))
        _set_least(block, sample)
        blocks.append(block)
    return Model(blocks)


def _set_least(block: Block, sample: DataFrame) -> None:
    shared = sample.sparkSession.sparkContext.broadcast(block)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, step=_STEP_BYTES):
            codes, row, has = _characters(batch.column("text"))
            own = pc.index_in(batch.column("lang"), pa.array(known.langs)).to_numpy()
            total, n = np.zeros(len(has)), np.zeros(len(has), np.int64)
            for bucket, at in _grams(codes, row):
                total += np.bincount(at, weights=known.logs[own[at], bucket], minlength=len(has))
                n += np.bincount(at, minlength=len(has))
            good = np.flatnonzero(has & (n >= MIN_GRAMS))
            yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(good)), pa.array(total[good] / n[good])], ["lang", "mean"])

    means = sample.mapInArrow(least, "lang string, mean double").groupBy("lang").agg(F.min("mean").alias("mean"))
    for r in means.collect():  # a row for each language of the block
        block.least[block.langs.index(r["lang"])] = r["mean"]


_STATE = {"_langid_lang": pa.string(), "_langid_best": pa.float64(), "_langid_sum": pa.float64(), "_langid_fit": pa.float64()}


def _scorer(shared, first: bool, last: bool):
    """Best language, its log probability, the sum of all probabilities by that, and the fit."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Block | None = shared.value
        for batch in slices(batches, step=_STEP_BYTES):
            n = batch.num_rows
            own = [c for c in batch.schema.names if c not in _STATE]
            lang, best, total_sum, fit = ([None] * n, np.full(n, -np.inf), np.zeros(n), np.zeros(n))
            if not first:
                lang = batch.column("_langid_lang").to_pylist()
                best, total_sum, fit = (batch.column(c).to_numpy() for c in ("_langid_best", "_langid_sum", "_langid_fit"))
            codes, row, has = _characters(batch.column("text"))
            if m is not None:
                total, grams = np.tile(m.prior, (n, 1)), np.zeros(n, np.int64)
                for bucket, at in _grams(codes, row):
                    grams += np.bincount(at, minlength=n)
                    for k in range(len(m.langs)):
                        total[:, k] += np.bincount(at, weights=m.logs[k][bucket], minlength=n)
                top = total.argmax(axis=1)
                value = total[np.arange(n), top]
                most = np.maximum(best, value)
                with np.errstate(invalid="ignore"):
                    before = np.where(total_sum > 0, total_sum * np.exp(best - most), 0)
                total_sum = before + np.exp(total - most[:, None]).sum(axis=1)
                better = value > best
                mean = (value - m.prior[top]) / np.maximum(grams, 1)
                short = np.where(grams >= MIN_GRAMS, np.maximum(0, m.least[top] - mean), 0)
                fit = np.where(better, short, fit)
                lang = [m.langs[t] if b else x for t, b, x in zip(top.tolist(), better.tolist(), lang)]
                best = most
            columns = [batch.column(c) for c in own]
            if not last:
                columns += [pa.array(x, kind) for x, kind in zip((lang, best, total_sum, fit), _STATE.values())]
                yield pa.RecordBatch.from_arrays(columns, [*own, *_STATE])
                continue
            names = [x if h and x is not None else UNKNOWN for x, h in zip(lang, has.tolist())]
            value = np.where(total_sum > 0, 1 / np.where(total_sum > 0, total_sum, 1), 0)
            columns += [pa.array(names), pa.array(np.where(has, value, 1.0)), pa.array(np.where(has, fit, 0.0))]
            yield pa.RecordBatch.from_arrays(columns, [*own, "lang_pred", "score", "fit"])
        released()

    return score


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of docs and lang_pred, score and fit."""
    docs = docs.drop("lang_pred", "score", "fit", *_STATE)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    state = ", _langid_lang string, _langid_best double, _langid_sum double, _langid_fit double"
    blocks = model.blocks or [None]
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        shared = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.mapInArrow(_scorer(shared, k == 0, last), kinds + (", lang_pred string, score double, fit double" if last else state))
    return docs


def held_out(doc_id: Column) -> Column:
    """A third of all documents, by CRC-32 of the identifier as text; not where it is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, fit of every row; learned from rows that aren't held out."""
    model = train(docs.where(~held_out(docs["doc_id"])))
    found = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "fit")
