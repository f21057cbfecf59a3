"""Joins on a key of which one value may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000  # a key with more than 1/1000 of all rows is among the 1000 largest
SALT_ROWS = 100_000  # rows of a hot key that stay together


def hot_keys(counted: DataFrame, key: str, rows: str) -> DataFrame:
    """Hashes of the largest keys of a frame that has one row per key, and their salts.

    Always at most ``HOT_KEYS`` rows of 16 bytes, whatever the size of the data, so the
    result may be broadcast.  Keys that are left out each hold less than 1/1000.  A key gets
    a salt for each ``SALT_ROWS`` rows, so its share of a task does not grow with the data.
    """
    largest = counted.select(F.xxhash64(key).alias("_hot"), F.col(rows).alias("_n"))
    largest = largest.orderBy(F.desc("_n"), "_hot").limit(HOT_KEYS).groupBy("_hot").agg(F.sum("_n").alias("_n"))
    return largest.where(F.col("_n") > SALT_ROWS).select("_hot", F.ceil(F.col("_n") / SALT_ROWS).alias("_salts"))


def join_unique(
    many: DataFrame, unique: DataFrame, key: str, hot: DataFrame, spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """Equi-join where ``key`` is unique on the right and may be skewed on the left.

    Rows of a hot key are spread over its salts by ``spread_by`` and its single right row is
    copied to each of them; other keys join as usual.
    """
    hot = F.broadcast(hot)
    left = many.withColumn("_hash", F.xxhash64(key)).join(hot, F.col("_hash") == F.col("_hot"), "left")
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(*spread_by), F.col("_salts"))).otherwise(F.lit(0))
    left = left.withColumn("_salt", salt.cast("long")).drop("_hash", "_hot", "_salts")
    right = unique.withColumn("_hash", F.xxhash64(key)).join(hot, F.col("_hash") == F.col("_hot"), "left")
    salts = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    right = right.withColumn("_salt", F.explode(salts)).drop("_hash", "_hot", "_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")
