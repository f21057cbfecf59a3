"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_string(value: str | None) -> str:
    """A SQL string literal (or NULL)."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def first_match(text: Column, pattern: str) -> Column:
    """The leftmost match of ``pattern``, or an empty string."""
    return F.regexp_extract(text, pattern, 0)


def replace_first(text: Column, pattern: str, replacement: str) -> Column:
    """Replace the leftmost match only; ``regexp_replace`` alone replaces all."""
    return F.regexp_replace(text, rf"(?s)^(.*?)(?:{pattern})", "$1" + replacement)


def number(text: Column) -> Column:
    """Text to double; NULL where it is not a number (ANSI mode would fail)."""
    return text.try_cast("double")


def filled(text: Column) -> Column:
    """True where the text is neither NULL nor blank."""
    return F.coalesce(F.trim(text) != "", F.lit(False))


def word(text: Column) -> Column:
    """Lower-cased, trimmed text; NULL where there is none."""
    low = F.lower(F.trim(text))
    return F.when((low != "") & ~low.isin("null", "none"), low)


def map_sql(table: Mapping[str, object]) -> str:
    """A small fixed table as a SQL map, folded into the plan as a literal."""
    pairs = ", ".join(
        f"{sql_string(k)}, {sql_string(v) if isinstance(v, str) or v is None else repr(float(v)) + 'D'}"
        for k, v in table.items()
    )
    return f"map({pairs})"


def _literal_sql(value, fields: tuple[str, ...] | None) -> str:
    if fields:
        parts = ", ".join(f"'{f}', {sql_string(v)}" for f, v in zip(fields, value, strict=True))
        return f"named_struct({parts})"
    return sql_string(value)


def lookup_struct(table: Mapping[str, tuple], fields: tuple[str, ...], key: Column) -> Column:
    """The same for several values per key, as one struct."""
    pairs = ", ".join(f"{sql_string(k)}, {_literal_sql(v, fields)}" for k, v in table.items())
    return F.try_element_at(F.expr(f"map({pairs})"), key)


def first_hit_in(column: str, hits, fields: tuple[str, ...] | None = None) -> Column:
    """Value of the first keyword that the lower-cased column contains, else NULL."""
    cases = " ".join(
        f"WHEN contains(lower({column}), {sql_string(k)}) THEN {_literal_sql(v, fields)}" for k, v in hits
    )
    return F.expr(f"CASE WHEN coalesce({column}, '') = '' THEN NULL {cases} END")


def lookup(table: Mapping[str, object], key: Column) -> Column:
    """Value of a small fixed table by key, NULL when absent; needs no join."""
    return F.try_element_at(F.expr(map_sql(table)), key)


def with_missing(df, columns, dtype: str = "string"):
    """Add the given columns as NULL where the frame lacks them."""
    have = set(df.columns)
    extra = [F.lit(None).cast(dtype).alias(c) for c in columns if c not in have]
    return df.select("*", *extra) if extra else df
