"""What follows from the extracted elements: implied periods, canonical timing, buckets."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions.text import filled
from posofold.operators.elements import BUCKET_ORDER

_EACH_DAILY = rf"^(each|every)\s+({'|'.join(vocab.DAILY_WORDS)})$"
_EACH = r"^(each|every)\s+"


def _canonical(text: Column) -> Column:
    """First canonical wording whose rule matches, else the text."""
    rule = None
    low = F.lower(text)
    for pattern, wording in vocab.WHEN_CANONICAL:
        test = low.rlike(pattern)
        rule = F.when(test, F.lit(wording)) if rule is None else rule.when(test, F.lit(wording))
    return F.when(filled(text), rule.otherwise(text)).otherwise(text)


def infer_timing(df: DataFrame) -> DataFrame:
    """Implied daily period, default frequency and canonical timing texts.

    "each night" without any frequency or period means once every day; its text then
    reads "at night".
    """
    has_frequency = (
        F.col("frequencyBare_frequency").isNotNull()
        | F.col("frequencyWithMethod_frequency").isNotNull()
        | F.col("periodElement_period_units").isNotNull()
    )
    bare_daily = F.coalesce(F.col("whenBare_captured").rlike(_EACH_DAILY), F.lit(False))
    method_daily = F.coalesce(F.col("whenWithMethod_captured").rlike(_EACH_DAILY), F.lit(False))
    df = df.select(
        "*",
        (bare_daily & ~has_frequency).alias("_bare"),
        (method_daily & ~bare_daily & ~has_frequency).alias("_method"),
    )
    implied = F.col("_bare") | F.col("_method")

    def daily(column: str, value: str | None) -> Column:
        return F.when(implied, F.lit(value).cast("string")).otherwise(F.col(column))

    def timing(column: str, flag: str) -> Column:
        spoken = F.when(F.col(flag), F.regexp_replace(F.col(column), _EACH, "at ")).otherwise(F.col(column))
        return _canonical(spoken)

    frequency = F.when(
        implied | (F.col("periodElement_period_units").isNotNull() & F.col("periodElement_frequency").isNull()),
        F.lit("1"),
    ).otherwise(F.col("periodElement_frequency"))
    changed = {
        "periodElement_frequency": frequency,
        "periodElement_clean": daily("periodElement_clean", "once every day"),
        "periodElement_period": daily("periodElement_period", "1"),
        "periodElement_periodMax": daily("periodElement_periodMax", None),
        "periodElement_period_units": daily("periodElement_period_units", "day"),
        "whenBare_clean": timing("whenBare_clean", "_bare"),
        "whenBare_when": timing("whenBare_when", "_bare"),
        "whenWithMethod_clean": timing("whenWithMethod_clean", "_method"),
        "whenWithMethod_when": timing("whenWithMethod_when", "_method"),
    }
    return df.withColumns(changed).drop("_bare", "_method")


def rescue_offsets(df: DataFrame) -> DataFrame:
    """On excluded rows an offset timing becomes an additional instruction."""
    if "exclude" not in df.columns:
        df = df.select("*", F.lit(None).cast("string").alias("exclude"))
    excluded = filled(F.col("exclude"))
    bare = filled(F.col("whenBare_offset")) & excluded
    method = filled(F.col("whenWithMethod_offset")) & excluded
    return df.withColumns(
        {
            "extras_whenoffset": F.when(bare | method, F.coalesce("whenBare_clean", "whenWithMethod_clean")),
            "whenBare_clean": F.when(~bare, F.col("whenBare_clean")),
            "whenWithMethod_clean": F.when(~method, F.col("whenWithMethod_clean")),
        }
    )


@cache
def bucket_text() -> Column:
    """Cleaned elements in fixed order, joined by " | "."""
    parts = []
    for element in BUCKET_ORDER:
        clean = F.nullif(F.col(f"{element}_clean"), F.lit(""))
        if element == "asNeededCodeableConcept":
            clean = F.concat(F.lit(vocab.AS_NEEDED_CANONICAL + " "), clean)
        parts.append(clean)
    return F.trim(F.concat_ws(" | ", *parts))
