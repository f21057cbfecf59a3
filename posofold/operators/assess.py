"""The whole assessment of an instruction as one DataFrame operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold.operators.crosscolumn import apply_cross_column_rules
from posofold.operators.elements import ELEMENTS
from posofold.operators.extract import extract_elements
from posofold.operators.infer import bucket_text, infer_timing, rescue_offsets
from posofold.operators.normalise import normalise
from posofold.operators.numeric import validate
from posofold.operators.regex_elements import read_leading, read_phrases


def extract(df: DataFrame) -> DataFrame:
    """Normalised text to elements, tags and buckets, without validation."""
    if "dosage_lower" not in df.columns:
        df = normalise(df)
    df = df.select("*", F.col("dosage_lower").alias("dosage_elements"))
    df = read_phrases(infer_timing(extract_elements(read_leading(df))))
    df = rescue_offsets(df)
    return df.select("*", bucket_text().alias("buckets"))


def assess(df: DataFrame, snapshot: Column | None = None) -> DataFrame:
    """Extract and validate every row.

    Takes ``dosage`` (raw) or ``dosage_lower`` (already normalised).  A pure projection:
    rows keep their partition, so the caller decides what to de-duplicate first.
    """
    df = apply_cross_column_rules(validate(extract(df)))
    now = F.current_timestamp()
    return df.select(
        "*",
        now.alias("timestamp"),
        F.lit(" ").alias("space"),
        (now if snapshot is None else snapshot).alias("_snapshot_ts"),
    )


def with_array_fields(df: DataFrame) -> DataFrame:
    """The published column types: element fields as arrays, empty when absent."""
    fields = {f"{e.key}_{f}" for e in ELEMENTS for f in e.fields}
    empty = F.array().cast("array<string>")
    return df.select(
        *[
            F.when(F.col(c).isNull(), empty).otherwise(F.array(c)).alias(c) if c in fields else F.col(c)
            for c in df.columns
        ]
    )
