"""Each rule on hand-made rows, apart from the extraction."""

import pytest
from pyspark.sql import functions as F

from posofold.functions.text import with_missing
from posofold.operators.crosscolumn import check_columns
from posofold.operators.grammar import check_grammar
from posofold.operators.numeric import RULES, first_numeric_failure

# tagged text -> failing codes
GRAMMAR = {
    "*methodDirect* *doseQuantity* *frequencyBare*": None,
    "*doseQuantity* left over *frequencyBare*": "S1",
    ", .": "S7",
    "*methodDirect* *doseQuantity*": "S2",
    "*doseQuantity* (*milligramValue*) *frequencyBare*": "S3",
    "*frequencyBareDashed* *methodDirect*": "S5",
    "*dose_QuantityValueOnly* - *frequencyBare*": "S6",
    "*methodPassive* *whenWithMethod* *doseQuantity*": "S3, O1",
    "*methodDirect* *frequencyWithMethod* *doseQuantity*": "O2, O5",
    "*methodDirect* *doseQuantity* *frequencyWithMethod*": None,
    "*methodDirect* *doseQuantity* *methodPassive* *frequencyBare*": "S3, O3",
    "*doseQuantity* *methodDirect* *frequencyBare*": "O4",
    "*doseQuantity*. *methodDirect* *frequencyBare*": None,
    "*frequencyBare* *doseRangeDashed*": "O5",
    "*frequencyBare*, *doseRange*": None,
    "*site* *doseQuantity* *frequencyBare*": "O6",
    "*forElement* *doseQuantity* *frequencyBare*": "O7",
    "*forElement* - *doseQuantity* *frequencyBare*": None,
    "*doseQuantity* *frequencyBare* *extrasALTER*": "O8",
    "*doseQuantity* *frequencyBare*. *extrasALTER*": None,
    "*extrasPAUSE* *extrasAsDirected*": "O9",
    "*doseQuantity* *frequencyBare*, *extras_b*": "O10",
    "(*extras_b*) *doseQuantity* *frequencyBare*": None,
    "": None,
}


def test_grammar(spark):
    df = check_grammar(spark.createDataFrame([(t,) for t in GRAMMAR], "dosage_elements string"))
    got = {r[0]: r[1] for r in df.select("dosage_elements", "grammar_fail").collect()}
    assert got == {t: f"grammar_fail: {c}" if c else None for t, c in GRAMMAR.items()}


# rule, value, argument, fails
NUMERIC = [
    ("no_negatives", "-1", None, True),
    ("no_negatives", "", None, False),
    ("avoid_zero", "0", None, True),
    ("below", "100", "100", False),
    ("below", "100.5", "100", True),
    ("must_be_whole_num", "2.5", None, True),
    ("must_be_whole_num", "2.0", None, False),
    ("avoid_emergency_numbers", "999", None, True),
    ("avoid_years", "1999", None, True),
    ("avoid_years", "2031", None, False),
    ("avoid_times", "0730", None, True),
    ("avoid_times", "1430", None, True),
    ("avoid_times", "1440", None, False),
    ("only_halfs_and_quarters", "1.75", None, False),
    ("only_halfs_and_quarters", "1.3", None, True),
    ("must_be_at_least", "1", "2", True),
]


def test_numeric_rules(spark):
    for rule, value, argument, fails in NUMERIC:
        column = F.coalesce(RULES[rule](F.lit(value), argument), F.lit(False))
        assert spark.range(1).select(column).first()[0] is fails, (rule, value)


def test_first_failure_in_order(spark):
    df = spark.createDataFrame([("120", "5", "3")], "doseQuantity_quantity string, doseRange_low string, doseRange_high string")
    assert df.select(first_numeric_failure(frozenset(df.columns))).first()[0] == "numeric_fail: below(doseQuantity_quantity)"
    df = df.drop("doseQuantity_quantity")
    got = df.select(first_numeric_failure(frozenset(df.columns))).first()[0]
    assert got == "numeric_fail: must_be_greater_than(doseRange_high)"


ONCE = {"frequencyBare_frequency": "1", "frequencyBare_period_unit": "day"}
DAILY = {"periodElement_period": "1", "periodElement_period_units": "day", "periodElement_frequency": "1"}
WEEKLY = {**DAILY, "periodElement_period_units": "week"}
ONE = {"doseQuantity_quantity": "1", "doseQuantity_units": "tablet"}
CROSS = [
    ({**WEEKLY, **ONE, "periodElement_period": "2", "periodElement_period_units": "fortnight"}, "CC1"),
    ({"doseQuantity_quantity": "1", "doseQuantity_units": "tablets"}, "CC2"),
    ({"doseQuantity_quantity": "3", "doseQuantity_units": "tablet(s)"}, None),
    ({"milligramMax_value": "500", "milligramMax_valueMax": "1", "milligramMax_low_unit": "mg",
      "milligramMax_milligram_units": "g"}, None),
    ({"milligramMax_value": "5", "milligramMax_valueMax": "10", "milligramMax_low_unit": "mg",
      "milligramMax_milligram_units": "ml"}, "CC3"),
    ({"maxDosePerPeriod_num_value": "2", "doseRange_high": "4"}, "CC4"),
    ({**ONCE, "whenBare_when": "at night"}, None),
    ({**ONCE, "frequencyBare_frequency": "2", "whenBare_when": "at night"}, "CC5"),
    ({**ONCE, "frequencyBare_frequency": "0"}, "CC5"),
    ({"frequencyBare_frequency": "2", "frequencyBare_period_unit": "fortnight", "dayOfWeek_value": "on mondays"}, None),
    ({"count_count": "3", "timeOfDay_value": "at 8am"}, "CC5, CC6"),
    ({"count_count": "1", "whenBare_when": "with meals"}, "CC5"),
    ({"dayOfWeek_value": "on monday"}, "CC6"),
    ({"dayOfWeek_value": "on mondays"}, None),
    ({**WEEKLY, **ONE, "boundsDuration_value": "5", "boundsDuration_unit": "days"}, "CC7"),
    ({**WEEKLY, **ONE, "boundsDuration_value": "7", "boundsDuration_unit": "days"}, None),
    ({**WEEKLY, **ONE, "boundsDuration_high": "5", "boundsDuration_high_unit": "days"}, "CC7"),
    ({**WEEKLY, **ONE, "event_value": "2.12.2024"}, "CC8"),
    ({"event_value": "2.12.2024", "boundsDuration_value": "5", "boundsDuration_unit": "days"}, "CC9"),
    ({**ONCE, "whenBare_when": "with meals"}, "CC10"),
    ({**ONCE, "durationValue_value": "2", "durationValue_period_units": "hours", "timeOfDay_value": "at 8am"}, "CC11"),
    ({**ONCE, "durationValue_value": "30", "durationValue_period_units": "minutes", "timeOfDay_value": "at 8am"}, None),
    (DAILY, "CC12"),
    ({**DAILY, **ONE}, None),
    ({**WEEKLY, **ONE, "whenBare_captured": "each morning"}, "CC13"),
    ({"durationMax_value": "400", "durationMax_period_units": "days"}, "VC1"),
    ({"doseQuantity_quantity": "12", "doseQuantity_units": "puffs"}, "VC2"),
    ({"frequencyBare_frequency": "13", "frequencyBare_period_unit": "day"}, "VC3"),
]


def test_cross_column_rules(spark):
    names = sorted({k for row, _ in CROSS for k in row})
    rows = [(i, *[row.get(n) for n in names]) for i, (row, _) in enumerate(CROSS)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} string" for n in names))
    got = {r[0]: r[1] for r in check_columns(df).select("id", "cross_column_fail").collect()}
    for i, (row, codes) in enumerate(CROSS):
        assert got[i] == (f"cross_column_fail: {codes}" if codes else None), row


def test_missing_columns_are_added(spark):
    assert with_missing(spark.range(1), ["x"]).columns == ["id", "x"]


@pytest.mark.parametrize("text", ["tablet(s), 5ml (2-4)", "a.b 1/2 x5ml -3", "take 1\n2"])
def test_encoding_keeps_the_text(spark, text):
    from posofold.functions.stream import decode, encode

    got = spark.range(1).select(F.trim(decode(encode(F.lit(text))))).first()[0]
    assert got == text
