"""An instruction corpus derived from ``lineitem``, with the expected results.

Every line item becomes one instruction: its keys choose a template and its amounts fill
the slots.  ``truth.txt`` states, per template, what each stage must produce; the same
statements serve as SQL for other engines, which therefore never parse the text.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# slot -> SQL over lineitem that means the same in Spark and in other engines
SLOTS = {
    "A": "2 + l_linenumber % 3",
    "A2": "4 + l_linenumber % 3",
    "B": "2 + CAST(l_quantity AS INT) % 12",
    "C": "2 + CAST(l_quantity AS INT) % 5",
    "M": "10 + 10 * (CAST(l_quantity AS INT) % 9)",
    "DD": "10 + CAST(l_orderkey AS BIGINT) % 11",
    "MM": "10 + CAST(l_suppkey AS BIGINT) % 3",
    "Y": "2020 + CAST(l_partkey AS BIGINT) % 9",
    "Q": "CAST(l_quantity AS INT)",
}
_SHIP = {"spark": "date_format(l_shipdate, 'dd.MM.yyyy')", "duckdb": "strftime(l_shipdate, '%d.%m.%Y')"}


@cache
def blocks() -> list[dict[str, str]]:
    """One dictionary per template: field name to expected text."""
    out = []
    for block in (Path(__file__).parent / "truth.txt").read_text().strip().split("\n\n"):
        fields = {}
        for line in block.splitlines():
            if not line.startswith("#"):
                name, _, value = line.partition(":")
                fields[name] = value[1:]
        if fields:
            out.append(fields)
    return out


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fill(text: str) -> str:
    """SQL text expression of a template with ``<slot>`` marks."""
    parts = [
        slot if slot else literal(plain)
        for plain, slot in re.findall(r"((?:(?!<(?:A2?|B|C|M|DD|MM|Y|Q|SHIP)>).)+)|<(A2?|B|C|M|DD|MM|Y|Q|SHIP)>", text)
    ]
    return " || ".join(parts) if parts else "''"


def slots_sql(engine: str = "duckdb", source: str = "lineitem") -> str:
    """Line items with their template number and slots as text."""
    columns = ", ".join(f"CAST({sql} AS STRING) AS {name}" for name, sql in SLOTS.items())
    number = f"(l_partkey + 31 * l_suppkey + 7 * l_linenumber) % {len(blocks())}"
    return f"SELECT CAST({number} AS INT) AS template, {columns}, {_SHIP[engine]} AS SHIP FROM {source}"


def case_sql(field: str, default: str = "NULL") -> str:
    """SQL for the expected value of a field; ``default`` where a template states none."""
    cases = " ".join(f"WHEN {i} THEN {fill(b[field])}" for i, b in enumerate(blocks()) if field in b)
    return f"CASE template {cases} ELSE {default} END" if cases else default


def fill_sql(field: str) -> tuple[str, str]:
    """Two steps of Spark SQL that together mean ``case_sql(field)``: the text is picked by its number, not compared with
    one number after another, and its marks are replaced.  A missing slot matters where it is used."""
    texts = ", ".join(literal(b[field]) if field in b else "CAST(NULL AS STRING)" for b in blocks())
    names = [*SLOTS, "SHIP"]
    filled = "_text"
    for n in names:
        filled = f"replace({filled}, '<{n}>', coalesce({n}, ''))"
    missing = " OR ".join(f"({n} IS NULL AND contains(_text, '<{n}>'))" for n in names)
    return f"get(array({texts}), template) AS _text", f"CASE WHEN NOT ({missing}) THEN {filled} END"


def instructions(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """``dosage`` of every line item that meets a condition."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where(where).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    ship = _SHIP["spark"]
    number = f"CAST((l_partkey + 31 * l_suppkey + 7 * l_linenumber) % {len(blocks())} AS INT) AS template"
    slots = [f"CAST({sql} AS STRING) AS {name}" for name, sql in SLOTS.items()]
    filled = items.selectExpr(number, *slots, f"{ship} AS SHIP")
    picked, text = fill_sql("text")
    return filled.selectExpr("*", picked).select(F.expr(text).alias("dosage"))


WIDE = "take <A> tablets <C> times a day for <Q> days from <SHIP>"


def wide_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One long instruction per line item, almost all of them different."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_linenumber", "l_quantity", "l_shipdate")
    slots = [f"CAST({SLOTS[name]} AS STRING) AS {name}" for name in ("A", "C", "Q")]
    return items.selectExpr(*slots, f"{_SHIP['spark']} AS SHIP").select(F.expr(fill(WIDE)).alias("dosage"))
