"""Exact dedup by a tree merge of sorted digest runs; DataFrame functions only.

Texts are equal when identical after deleting ASCII white space.  Each row's SHA-256 and length
go to one of ``runs`` runs (by a hash of the identifier, so a hot text is spread evenly).  The
runs meet in binomial rounds: each round clears one digit of the run number, so ``fan_in`` runs
are merged into one, and holds for each digest the group size and the row to keep.  A digest has
one row in each run at most, so a text with a third of all rows costs a round no more than a
rare one.  Every merge works on (digest, run), spread over all tasks; no task sees a whole run.
The result goes down the same tree, so the last join has the hot rows in their runs as well.

Digests are verified by a second, independent hash and the normalised length in the key.

Defined results: null text counts as empty, and all empty texts are equal.  Ties in length go to
the smallest doc_id; a null doc_id loses against any other, and rows that repeat the kept id
(or all rows, where none has an id) are all kept.  Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold.llm.common import stored

SPACE = " \t\n\x0b\x0c\r"
FAN_IN_BITS = 3
KEY = ["digest", "check", "length"]


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rounds = max(1, math.ceil(math.log2(max(2, partitions)) / FAN_IN_BITS))
    runs = 1 << (FAN_IN_BITS * rounds)
    text = normalised(docs["text"].cast("string"))
    rows = stored(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.xxhash64(text).alias("check"),
            F.octet_length(text).alias("length"),
            F.coalesce(F.char_length(docs["text"].cast("string")), F.lit(0)).alias("size"),
            F.pmod(F.xxhash64(docs["doc_id"].cast("long")), F.lit(runs)).cast("int").alias("run"),
        ),
        "digests",
    )
    # bitwise_not turns the order of identifiers round without an overflow.
    best = F.struct("size", F.bitwise_not("doc_id").alias("id"))
    levels = [stored(rows.groupBy(*KEY, "run").agg(F.count("*").alias("n"), F.max(best).alias("best")), "runs")]
    for _ in range(rounds):
        merged = levels[-1].groupBy(*KEY, F.shiftright("run", FAN_IN_BITS).alias("run"))
        levels.append(stored(merged.agg(F.sum("n").alias("n"), F.max("best").alias("best")), "runs"))
    verdict = levels[-1].select(*KEY, "run", F.col("n").alias("group_size"), F.bitwise_not("best.id").alias("keep_id"))
    for level in reversed(levels[:-1]):
        parent = verdict.withColumnRenamed("run", "parent")
        verdict = (
            level.select(*KEY, "run", F.shiftright("run", FAN_IN_BITS).alias("parent"))
            .join(parent, [*KEY, "parent"])
            .select(*KEY, "run", "group_size", "keep_id")
        )
    return rows.join(verdict, [*KEY, "run"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
