"""Instructions in, buckets and verdicts out, in one job."""

import pytest
from pyspark.sql import functions as F

from posofold.operators.assess import assess, with_array_fields
from posofold.operators.elements import ALL_COLUMNS, BUCKET_ORDER, KEYS, REGEX_ELEMENTS, SHORTER_FIRST

# text | buckets | exclude (None: valid)
CASES = [
    ("one to be taken every day", "take | 1 | once every day", None),
    ("take one and a half tablets on alternate days", "take | 1.5 tablets | once every 2 days", "CC12"),
    ("(amber 2) 1 per day", "1 | once every day | amber 2", None),
    ("2-bd", "2 | 2 times every day", "S6"),
    ("Take HALF a tablet To be taken Three Times Daily", "take | 0.5 tablet | 3 times every day", None),
    ("take 1-2 tablets every 6 hours no more than 6 tablets in a day",
     "take | 1 to 2 tablets | once every 6 hours | up to a maximum of 6 tablets in 1 day", "CC12"),
    ("1-2 x 5ml spoonfuls three times a day", "1 to 2 x 5ml spoonfuls | 3 times every day", None),
    ("2 puffs twice a day via spacer", "2 puffs | 2 times every day | via spacer", None),
    ("1 tablet sublingual as required", "1 tablet | sublingual | as needed", None),
    ("instil 1 drop into the left eye every 4 hours", "instil | 1 drop | once every 4 hours | Left eye", None),
    ("2 chewable tablets three times a day", "2 chewable tablets | 3 times every day", None),
    ("5 spray per day", "5 spray | once every day", "CC2, CC12"),
    ("take 1 tablet thirty minutes before food", "take | 1 tablet | before food", "S1"),
    ("1 tablet (500mg) every 4 hours", "1 tablet | 500 mg | once every 4 hours", "S3"),
    ("1 - 2 times every day", "1 to 2 times every day", "S5"),
    ("1 every day take", "take | 1 | once every day", "O4"),
    ("100", "100", "S2"),
    ("take 2024mls every day", "take | 2024 mls | once every day", "avoid_years(milligramValue_value)"),
    ("0 times a day take 2 tablets", "take | 2 tablets | 0 times every day", "O5"),
    ("1 tablet every day in the eye(s)", "1 tablet | once every day | in the eye", "S1"),
    ("1 3 times a day", "", "removed"),
    ("4-6 hourly", "", "removed"),
    ("half of 2 tablets", "", "removed"),
    ("", "", "too empty"),
    ("case***5 ml", "", "S1"),
    ("apply thinly to affected area twice a day", "apply | 2 times every day | Affected area | thinly", None),
    ("1 tablet 1/1/2024", "1 tablet", "S1"),
    ("take 1 tablet every year", "take | 1 tablet", "S1"),
]


@pytest.fixture(scope="module")
def assessed(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, dosage string")
    return {r["id"]: r for r in assess(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] or "empty" for c in CASES])
def test_case(assessed, i):
    _, buckets, exclude = CASES[i]
    row = assessed[i]
    assert row["buckets"] == buckets
    if exclude is None:
        assert row["exclude"] is None and row["mapped"], row["exclude"]
    else:
        assert exclude in row["exclude"] and not row["mapped"]


def test_clean_and_captured_come_in_pairs(assessed):
    for row in assessed.values():
        for key in KEYS:
            if key != "periodElement":  # may be implied
                assert (row[f"{key}_clean"] is None) == (row[f"{key}_captured"] is None)


def test_null_text_stays_unassessed(spark):
    row = assess(spark.createDataFrame([(None,)], "dosage string")).first()
    assert row["dosage_elements"] is None and row["mapped"] is False


def test_array_form(spark):
    df = with_array_fields(assess(spark.createDataFrame([("take 2 tablets",)], "dosage string")))
    row = df.select("doseQuantity_quantity", "doseQuantity_spoonsize", "count_count").first()
    assert (row[0], row[1], row[2]) == (["2"], [""], [])


def test_registry_is_complete():
    assert len(KEYS) == 29 and len(set(BUCKET_ORDER)) == len(KEYS) + len(REGEX_ELEMENTS) == 39
    assert set(BUCKET_ORDER) == set(KEYS) | set(REGEX_ELEMENTS)
    assert len(ALL_COLUMNS) == len(set(ALL_COLUMNS))
    assert all(KEYS.index(a) < KEYS.index(b) for a, b in SHORTER_FIRST)


def test_filters_do_not_copy_the_extraction(spark):
    df = assess(spark.createDataFrame([("take 2 tablets",)], "dosage string"))
    plan = df.where(F.col("mapped") & (F.col("buckets") != ""))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") < 300
