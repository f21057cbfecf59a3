"""A second generated corpus, whose readings were written by hand and not by the operators.

Every line item becomes one instruction of a template of ``readings.txt``, which states the
elements that a reader finds in it, with pattern and fields, and for some the numbers of its FHIR
timing or the rule that it fails.
"""

from __future__ import annotations

from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posofold.sources.templates import _SHIP, SLOTS, fill, literal

TIMING = ("period", "periodMax", "unit", "count", "countMax", "low", "high")


@cache
def blocks() -> list[dict[str, list[str]]]:
    """One dictionary for each template: name to its lines."""
    out = []
    for block in (Path(__file__).parent / "readings.txt").read_text().strip().split("\n\n"):
        fields: dict[str, list[str]] = {}
        for line in block.splitlines():
            if not line.startswith("#"):
                name, _, value = line.partition(": ")
                fields.setdefault(name, []).append(value)
        if fields:
            out.append(fields)
    return out


def slots_sql(engine: str, source: str = "lineitem") -> str:
    columns = ", ".join(f"CAST({sql} AS STRING) AS {name}" for name, sql in SLOTS.items())
    number = f"CAST((l_partkey + 5 * l_linenumber) % {len(blocks())} AS INT) AS template"
    return f"SELECT {number}, {columns}, {_SHIP[engine]} AS SHIP FROM {source}"


def text_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN {fill(b['text'][0])}" for i, b in enumerate(blocks()))
    return f"CASE template {cases} END"


def value_sql(name: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {fill(b[name][0])}" for i, b in enumerate(blocks()) if name in b)
    return f"CASE template {cases} END"


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    columns = [f"CAST({sql} AS STRING) AS {name}" for name, sql in SLOTS.items()]
    number = f"CAST((l_partkey + 5 * l_linenumber) % {len(blocks())} AS INT) AS template"
    return items.selectExpr(number, *columns, f"{_SHIP['spark']} AS SHIP").select(F.expr(text_sql()).alias("dosage"))


def _truth(columns: dict[str, str], templates: list[int]) -> str:
    listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    chosen = ", ".join(map(str, templates))
    return (
        f"SELECT dosage, count(*) AS dosage_count, {', '.join(columns)} FROM (SELECT {text_sql()} AS dosage, {listed} "
        f"FROM ({slots_sql('duckdb')}) WHERE template IN ({chosen})) GROUP BY ALL"
    )


def hits_sql() -> str:
    """One row for each element of each instruction."""
    branches = []
    for i, block in enumerate(blocks()):
        for line in block["hit"]:
            element, pattern, clean, fields = (part.strip() for part in line.split(" | "))
            columns = {"element": literal(element), "pattern": literal(pattern), "clean": fill(clean), "fields": fill(fields)}
            branches.append(_truth(columns, [i]))
    return " UNION ALL ".join(branches)


def timing_sql() -> str:
    """Numbers of the FHIR timing."""
    stated = [i for i, b in enumerate(blocks()) if any(n in b for n in TIMING)]
    return _truth({n: value_sql(n) if any(n in b for b in blocks()) else "NULL" for n in TIMING}, stated)


def failures_sql() -> str:
    return _truth({"exclude": value_sql("fails")}, [i for i, b in enumerate(blocks()) if "fails" in b])


# how a word of each kind stands in an instruction
FRAMES = {"route": "1 tablet {}", "latin": "1 tablet {}", "purpose": "1 tablet as needed for {}"}


@cache
def words(kind: str) -> list[tuple[str, str]]:
    """(as written, as read) of the words of a kind."""
    lines = (Path(__file__).parent / "words.txt").read_text().splitlines()
    rows = [[part.strip() for part in line.split("|")] for line in lines if line and not line.startswith("#")]
    return [(written, read) for k, written, read in rows if k == kind]


def _word_sql(kind: str, column: int) -> str:
    """The written or read form of the word of a line item."""
    cases = " ".join(f"WHEN {i} THEN {literal(w[column])}" for i, w in enumerate(words(kind)))
    return f"CASE CAST((l_partkey + 31 * l_linenumber) % {len(words(kind))} AS INT) {cases} END"


def _framed(kind: str) -> str:
    before, after = FRAMES[kind].split("{}")
    return f"{literal(before)} || {_word_sql(kind, 0)} || {literal(after)}"


def word_instructions(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.expr(_framed(kind)).alias("dosage"))


def words_sql(kind: str, name: str) -> str:
    rows = f"SELECT {_framed(kind)} AS dosage, {_word_sql(kind, 1)} AS {name} FROM lineitem"
    return f"SELECT dosage, count(*) AS dosage_count, {name} FROM ({rows}) GROUP BY ALL"
