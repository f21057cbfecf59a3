"""Counting, uniting, selecting and re-joining instruction corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posofold.functions.skew import hot_keys, join_unique

KEY = "dosage_lower"


def count_instructions(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Distinct raw instructions with their number of records, most frequent first."""
    counted = df.groupBy("dosage").agg(F.count(F.lit(1)).alias("dosage_count"))
    return counted.orderBy(F.desc("dosage_count"), "dosage") if ordered else counted


def unite(real: DataFrame, test: DataFrame) -> DataFrame:
    """Real and curated rows by column name, told apart by ``is_test``."""
    return test.withColumn("is_test", F.lit(True)).unionByName(real.withColumn("is_test", F.lit(False)))


def regroup(normalised: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per normalised text with summed counts; ``variants`` counts its rows."""
    grouped = normalised.groupBy(KEY).agg(
        F.sum("dosage_count").alias("dosage_count"), F.count(F.lit(1)).alias("variants")
    )
    return grouped.orderBy(F.desc("dosage_count"), KEY) if ordered else grouped


def frequent_keys(grouped: DataFrame, min_count: int | None) -> DataFrame:
    """Rows that reach ``min_count``, of a frame with one row per key."""
    return grouped if min_count is None else grouped.where(F.col("dosage_count") >= min_count)


def select_frequent(df: DataFrame, min_count: int | None) -> DataFrame:
    """All rows of the keys whose largest ``dosage_count`` reaches ``min_count``.

    For frames with many rows per key.  A window would gather all rows of a key in one task;
    here the keys are found first, and only the rows of the largest keys are spread.
    """
    if min_count is None:
        return df
    # NULL is one key here, as it is when grouping
    keyed = df.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col(KEY)), F.lit("null")))
    keys = keyed.groupBy("_key").agg(F.max("dosage_count").alias("_most"), F.count(F.lit(1)).alias("_rows"))
    keys = keys.where(F.col("_most") >= min_count)
    hot = hot_keys(keys, "_key", "_rows")
    return join_unique(keyed, keys.select("_key"), "_key", hot, ["dosage"]).select(*df.columns)


def rows_of(normalised: DataFrame, wanted: DataFrame, grouped: DataFrame) -> DataFrame:
    """All rows whose key is among the ``wanted`` ones."""
    return join_unique(normalised, wanted.select(KEY), KEY, hot_keys(grouped, KEY, "variants"), ["dosage"])


def rejoin(
    normalised: DataFrame, assessed: DataFrame, grouped: DataFrame, keep_screening_reason: bool = True
) -> DataFrame:
    """Assessment of each key back to every raw instruction that shares it.

    Screened rows share the blank key with empty ones; the reason of the row itself is
    kept in front of the one of the key.
    """
    normalised = normalised.withColumnRenamed("exclude", "_screened")
    clash = [c for c in assessed.columns if c in normalised.columns and c != KEY]
    hot = hot_keys(grouped, KEY, "variants")
    joined = join_unique(normalised, assessed.drop(*clash, "variants"), KEY, hot, ["dosage"])
    if keep_screening_reason:
        joined = joined.withColumns({"exclude": F.coalesce("_screened", "exclude")})
    return joined.drop("_screened")


def curated_first(df: DataFrame) -> DataFrame:
    """Curated rows first, then by frequency; the text comes last, so that equal counts can be split."""
    return df.orderBy(F.col("is_test").desc_nulls_last(), F.desc("dosage_count"), "dosage")


def not_yet_assessed(counted: DataFrame, lookup: DataFrame) -> DataFrame:
    """Instructions that the lookup does not hold yet."""
    return counted.join(lookup.select("dosage").distinct(), "dosage", "left_anti")


def filter_refined(refined: DataFrame, min_count: int | None) -> DataFrame:
    """Mapped rows of keys that are frequent enough to be reviewed."""
    return select_frequent(refined.where(F.col("mapped")), min_count)
