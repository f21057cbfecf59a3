"""Numeric plausibility of the extracted fields, and the verdict ``mapped``."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions.fence import fence
from posofold.functions.text import filled, number
from posofold.operators.grammar import check_grammar


def _is_time(text: Column) -> Column:
    """Reads like a clock time: 100-2359 ending in 15/30/45, or digits led by zero."""
    whole = F.floor(number(text))
    quarter = (whole >= 100) & (whole <= 2359) & (whole % 100).isin(15, 30, 45) & (F.length(text) >= 3)
    led = text.startswith("0") & (F.length(text) >= 2) & text.rlike("^[0-9]+$") & (whole <= 2359)
    return quarter | led


# rule -> condition under which it FAILS, given the field and the rule's argument
RULES = {
    "no_negatives": lambda x, _: number(x) < 0,
    "avoid_zero": lambda x, _: number(x) == 0,
    "below": lambda x, limit: number(x) > float(limit),
    "must_be_whole_num": lambda x, _: number(x) != F.floor(number(x)),
    "must_be_greater_than": lambda x, low: number(x) <= number(F.col(low)),
    "avoid_emergency_numbers": lambda x, _: x.isin(*vocab.EMERGENCY_NUMBERS),
    "avoid_years": lambda x, _: number(x).between(*vocab.YEARS) & (number(x) == F.floor(number(x))),
    "avoid_times": lambda x, _: _is_time(x),
    "only_halfs_and_quarters": lambda x, _: (number(x) != F.floor(number(x)))
    & ~(number(x) % 1).isin(0.25, 0.5, 0.75),
    "must_be_at_least": lambda x, low: number(x) < float(low),
}


def configured_rules() -> list[tuple[str, str, str | None]]:
    """(field, rule, argument) in reporting order."""
    out: list[tuple[str, str, str | None]] = []
    for name, limit in vocab.NUMBERS.items():
        rules = {
            "no_negatives": True,
            "avoid_zero": not limit.zero,
            "below": True,
            "must_be_whole_num": limit.whole,
            "avoid_emergency_numbers": limit.bare,
            "avoid_years": limit.bare,
            "avoid_times": limit.bare,
            "only_halfs_and_quarters": limit.quarters,
            "must_be_greater_than": limit.over is not None,
        }
        argument = {"below": str(limit.top), "must_be_greater_than": limit.over}
        out += [(name, rule, argument.get(rule)) for rule, applies in rules.items() if applies]
    return out


@cache
def first_numeric_failure(have: frozenset[str]) -> Column:
    """``numeric_fail: rule(field)`` of the first failing rule, else NULL."""
    by_field: dict[str, list[tuple[str, Column]]] = {}
    for name, rule, argument in configured_rules():
        if name in have and (rule != "must_be_greater_than" or argument in have):
            by_field.setdefault(name, []).append((rule, RULES[rule](F.col(name), argument)))
    # one CASE per field; most fields are NULL and stop at the first test
    cases = []
    for name, checks in by_field.items():
        case = F.when(~filled(F.col(name)), F.lit(None).cast("string"))
        for rule, fails in checks:
            case = case.when(fails, F.lit(f"numeric_fail: {rule}({name})"))
        cases.append(case)
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def spare_text(tagged: Column) -> Column:
    """What is left of the tagged text without tags and their punctuation."""
    steps = [
        (r"\(\*\w+\*\)", ""),
        (r"\*\w+\*\s*\.", ""),
        (r"\*\w+\*\s*\-", ""),
        (r"\*\w+\*\s?", ""),
        (r"\s{2,}", " "),
        (r"^[\.\-\s]+$", ""),
    ]
    return F.trim(reduce(lambda t, s: F.regexp_replace(t, *s), steps, tagged))


def validate(df: DataFrame, tagged: str = "dosage_elements") -> DataFrame:
    """Add ``exclude``, ``dosage_spare`` and ``mapped``.

    The first reason wins: an earlier exclusion, grammar, dose times metric, numbers,
    nothing to read.
    """
    if "exclude" not in df.columns:
        df = df.select("*", F.lit(None).cast("string").alias("exclude"))
    df = check_grammar(df, tagged)
    times_metric = F.col("doseXMilliValueOnly_clean").isNotNull()
    has_tags = filled(F.col(tagged))
    too_empty = F.when(~has_tags, F.lit("general_fail: too empty"))
    df = df.withColumns(
        {
            "exclude": F.coalesce("exclude", "grammar_fail", F.when(times_metric, F.lit("grammar_fail: S8"))),
            "_numeric": first_numeric_failure(frozenset(df.columns)),
            "dosage_spare": spare_text(F.col(tagged)),
        }
    )
    df = df.withColumns({"exclude": F.coalesce("exclude", "_numeric", too_empty)})
    mapped = (
        ~filled(F.col("exclude"))
        & has_tags
        & ~times_metric
        & F.col("_numeric").isNull()
        & ~filled(F.col("dosage_spare"))
    )
    df = df.withColumns({"mapped": mapped}).drop("_numeric", "grammar_fail")
    return fence(df, "dosage_spare", "exclude", "mapped")
