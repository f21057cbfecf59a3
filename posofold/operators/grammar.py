"""Grammar rules over the sequence of tags.

The tagged text is reduced to one short line of names and punctuation, for example
``methodDirect doseQuantity . frequencyBare``; a rule is then a regex over that line.
A bracketed tag stands in a sentence of its own.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold.functions.text import filled
from posofold.operators.elements import ELEMENTS

DOSE = (
    "doseQuantity", "doseRange", "dose_QuantityValueOnly", "dose_QuantityValueAndMaxOnly",
    "doseXMilliValueOnly", "milligramValue", "milligramMax",
)
RATE = ("rateRatio", "rateRange", "rateQuantity")
FREQUENCY = ("frequencyBare", "frequencyWithMethod", "periodElement")
NEEDED = ("asNeededBoolean", "asNeededCodeableConcept")
METHOD = ("methodDirect", "methodPassive")
TO_BE_DONE = ("methodPassive", "frequencyWithMethod", "whenWithMethod")
# at most one element of each group in an instruction
EXCLUSIVE = (
    DOSE,
    RATE,
    FREQUENCY,
    NEEDED,
    METHOD,
    ("durationValue", "durationMax"),
    ("boundsDuration", "boundsPeriod", "boundsAPeriodStartEnd", "count", "event"),
    ("whenBare", "whenWithMethod"),
    ("forElement", "asNeededCodeableConcept"),
    ("maxDosePerPeriod", "maxDosePerAdministration", "maxDosePerLifetime"),
    TO_BE_DONE,
)
TIMING = (
    *NEEDED, *FREQUENCY, "event", "forElement", "whenBare", "whenWithMethod", "dayOfWeek", "timeOfDay",
    "boundsDuration", "boundsPeriod", "boundsAPeriodStartEnd",
)
ENDS_IN_NUMBER = ("dose_QuantityValueOnly", "dose_QuantityValueAndMaxOnly")
STARTS_WITH_NUMBER = (
    "frequencyBare", "dose_QuantityValueOnly", "dose_QuantityValueAndMaxOnly", "doseRange",
    "doseXMilliValueOnly", "milligramMax", "milligramValue", "whenBare", "doseQuantity", "count",
)
REMARKS = ("extrasPAUSE", "extrasALTER", "extras", "extrasAsDirected", "extras_b")

_TAG = r"\(\*\w+\*\)|\*\w+\*|\.|,|(?<!\w)-(?!\w)"


def _any(names) -> str:
    """One of the names, also in its dashed form, as a whole word of the line."""
    return rf"(?<=^| )(?:{'|'.join(names)})(?:Dashed)? "


def _raw(names) -> str:
    return rf"(?<=^| )(?:{'|'.join(names)}) "


_CORE = rf"(?<=^| )(?!(?:{'|'.join(REMARKS)})(?:Dashed)? )\w+ "
_WORDS = r"(?:\w+ )*"  # no punctuation in between
_SENTENCE = r"(?:[\w,\-]+ )*"  # no full stop in between
_PUNCTUATION = r"(?:[.,\-] )*"


def tag_line(tagged: Column) -> Column:
    """Names and punctuation of the tagged text, each followed by a blank."""
    tags = F.regexp_extract_all(tagged, F.lit(f"({_TAG})"), F.lit(1))
    line = F.concat(F.array_join(tags, " "), F.lit(" "))
    line = F.regexp_replace(line, r"\(\*(\w+)\*\)", ". $1 .")
    return F.when(F.size(tags) > 0, F.translate(line, "*", "")).otherwise(F.lit(""))


def _near(left: str, right: str, between: str) -> str:
    return f"{left}{between}{right}|{right}{between}{left}"


@cache
def rule_columns() -> dict[str, Column]:
    """Code -> condition on the tag line under which the rule fails, in reporting order."""
    has = F.col("_line").rlike
    dose, frequency, direct = _any(DOSE), _any(FREQUENCY), _raw(["methodDirect"])
    early = _any(["forElement", *NEEDED])
    dashed = _raw(e.key + "Dashed" for e in ELEMENTS if e.dashable)
    amount = has(_any(DOSE + RATE)) | has(_any(METHOD))
    twice = [has(f"{_any(group)}.*{_any(group)}") for group in EXCLUSIVE]
    several = twice[0]
    for test in twice[1:]:
        several = several | test
    not_yet = rf"(?!(?:{'|'.join(DOSE + FREQUENCY)})(?:Dashed)? )"
    not_dose = rf"(?!(?:{'|'.join(DOSE)})(?:Dashed)? )"
    alone = ~has(_CORE)

    def remark(name: str) -> Column:
        return has(_any([name])) & (alone | has(_near(_any([name]), _CORE, _WORDS)))

    return {
        "S2": ~((amount & has(_any(TIMING))) | has(_any(["extrasAsDirected", *NEEDED]))),
        "S3": several,
        "S5": has(dashed) & ~has(dose),
        "S6": has(f"{_any(ENDS_IN_NUMBER)}{_PUNCTUATION}- {_PUNCTUATION}{_any(STARTS_WITH_NUMBER)}"),
        "O1": has(f"{_raw(TO_BE_DONE)}{_SENTENCE}{_raw(TO_BE_DONE)}"),
        "O2": has(f"{_raw(TO_BE_DONE)}.*{direct}|{direct}{_PUNCTUATION}{_raw(TO_BE_DONE)}"),
        "O3": has(direct) & has(_raw(["methodPassive"])),
        "O4": has(f"{dose}{_SENTENCE}{direct}"),
        "O5": has(f"{frequency}{_WORDS}{dose}"),
        "O6": has(f"{_any(['whenBare', 'site'])}{_WORDS}{dose}"),
        "O7": has(frequency) & has(rf"^(?:{not_yet}\S+ )*{early}(?:{not_dose}\w+ )*{dose}"),
        "O8": remark("extrasALTER"),
        "O9": remark("extrasPAUSE"),
        "O10": has(_any(["extras_b"])) & (alone | has(_near(_any(["extras_b"]), _CORE, _SENTENCE))),
    }


@cache
def _codes() -> Column:
    return F.concat_ws(", ", *[F.when(fails, F.lit(code)) for code, fails in rule_columns().items()])


def check_grammar(df: DataFrame, tagged: str = "dosage_elements") -> DataFrame:
    """Add ``grammar_fail``: all failing codes, NULL where the sequence is valid."""
    text = F.col(tagged)
    rest = F.trim(F.regexp_replace(F.regexp_replace(text, _TAG, ""), r"\s", ""))
    df = df.select("*", tag_line(text).alias("_line"), rest.alias("_rest"))
    codes = _codes()
    failed = (
        F.when(~filled(F.regexp_replace(text, r"\s", " ")), F.lit(None).cast("string"))
        .when(F.col("_rest") != "", F.lit("S1"))
        .when(F.col("_line").rlike(r"^[.,\- ]*$"), F.lit("S7"))
        .otherwise(F.nullif(codes, F.lit("")))
    )
    return df.select("*", F.concat(F.lit("grammar_fail: "), failed).alias("grammar_fail")).drop("_line", "_rest")
