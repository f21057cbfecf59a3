"""A corpus pipeline: language, exact copies, near copies, secrets, packed windows.

Every stage works on all rows that the stage before kept, and is written as Parquet and read
again.  The dedup stages tell rows apart by a number of their own, not by doc_id, so rows that
repeat a doc_id or have none are judged one by one, as any other.  Of equally good rows the one
with the smallest doc_id stays (one without doc_id only if the group has no other).
"""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posofold.llm import exact_dedup, langid, ngram_join, packing, secrets
from posofold.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
TOKENIZER = os.environ.get("WORD_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")
#: Rejected are texts without letters, texts whose best language is no more likely than this, and
#: texts whose n-grams are less likely, by this much on average, than any that the language was learned from.
MIN_SCORE, MAX_MISFIT = 0.5, 0.5
#: Workers outlive a stage: the tokenizer leaves memory for the others.  A step takes some forty times as much.
CACHE, STEP_BYTES = 60_000, 1 << 20


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.col(c).cast(kind).alias(c) for c, kind in COLUMNS.items()))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; learned from those that aren't held out."""
    docs = _documents(docs)
    model = langid.train(docs.where(~langid.held_out(docs["doc_id"])))
    known = langid.predict(docs, model).where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return known.where(F.col("fit") <= MAX_MISFIT).select(*COLUMNS)


def _rows(docs: DataFrame) -> tuple[DataFrame, bool]:
    """The documents with a number for each row: doc_id, if no two rows share one and all have one.
    Otherwise, rows are numbered in a copy, so that the numbers stay as they are."""
    docs = _documents(docs)
    shared = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if shared.isEmpty():
        return docs.withColumn("row", F.col("doc_id")), True
    return stored(docs.withColumn("row", F.monotonically_increasing_id()), "rows"), False


def _one_of_each(rows: DataFrame, groups: DataFrame, *better: Column) -> DataFrame:
    """The first row, by ``better`` and then by doc_id, of each group of (row, group)."""
    place = rows.select("row", *(c.alias(f"by{n}") for n, c in enumerate(better)), F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    order = F.struct(*(f"by{n}" for n in range(len(better))), "unnamed", "doc_id", "row")
    kept = place.join(groups, "row").groupBy("group").agg(F.min(order).alias("first")).select("first.row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def _of_groups(docs: DataFrame, find: Callable[[DataFrame], DataFrame], group: str, *better: Column) -> DataFrame:
    """One row of each group that ``find`` names by the doc_id of the row to keep."""
    rows, named = _rows(docs)
    groups = find(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), F.col(group).alias("group"))
    if named:
        return rows.join(groups.where("row <> group"), "row", "left_anti").select(*COLUMNS)
    return _one_of_each(rows, groups, *better)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the most characters, of each group of equal texts."""
    return _of_groups(docs, exact_dedup.exact_dedup, "keep_id", -F.coalesce(F.char_length("text"), F.lit(0)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of near copies."""
    return _of_groups(docs, ngram_join.near_documents, "component_id")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of secrets."""
    clean = secrets.scan(_documents(docs)).withColumn("text", F.col("clean_text"))
    changed = F.exists("findings", lambda f: f["score"] >= secrets.THRESHOLD)
    return clean.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of token ids."""
    return packing.pack(docs, TOKENIZER, cache=CACHE, step=STEP_BYTES)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("secrets", without_secrets),
    ("packing", windows),
]
#: Stages use models, hashed sets and a tokenizer: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, applied to the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
