"""Jobs, skew-safe joins, streaming and reports against brute force on small data."""

import json
from collections import Counter

from pyspark.sql import functions as F

from posofold.functions import skew
from posofold.operators import corpus, reports
from posofold.operators.assess import assess
from posofold.operators.enrich import OUTPUT, refine
from posofold.operators.extract import extract_element, extract_elements
from posofold.operators.normalise import normalise
from posofold.plans import jobs
from posofold.sources import tables, templates
from posofold.streaming.rows import assess_stream

TEXTS = ["take 1 tablet once a day", "TAKE one tablet once a day", "2 puffs bd", "nonsense", "oneone", "..."]


def _records(spark, hot=500):
    rows = [(TEXTS[0],)] * hot + [(t,) for t in TEXTS[1:] for _ in range(3)]
    return spark.createDataFrame(rows, "dosage string")


def test_model_matches_a_plain_join(spark):
    counted = corpus.count_instructions(_records(spark)).withColumn("is_test", F.lit(False))
    got = {r["dosage"]: r for r in jobs.model(counted, None).collect()}
    assert set(got) == set(TEXTS) and got[TEXTS[0]]["dosage_count"] == 500
    plain = {r["dosage"]: r for r in assess(normalise(counted).drop("dosage_lower")).collect()}
    for text in TEXTS:
        for name in ("buckets", "exclude", "mapped", "dosage_elements"):
            assert got[text][name] == plain[text][name], (text, name)
    assert got["oneone"]["exclude"] == "general_fail: removed"
    lost = {r["dosage"]: r["exclude"] for r in jobs.model(counted, None, keep_screening_reason=False).collect()}
    assert lost["oneone"] == "general_fail: too empty"


def test_select_frequent_on_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(skew, "SALT_ROWS", 30)  # seven salts for the hot key
    rows = [(f"t{i}", "hot" if i % 3 else f"k{i}", i) for i in range(300)] + [("n1", None, 400), ("n2", None, 1)]
    df = spark.createDataFrame(rows, "dosage string, dosage_lower string, dosage_count long")
    top = {}
    for _, key, count in rows:
        top[key] = max(top.get(key, 0), count)
    want = sorted(t for t, key, _ in rows if top[key] >= 250)
    assert sorted(r[0] for r in corpus.select_frequent(df, 250).collect()) == want
    assert corpus.select_frequent(df, None).count() == len(rows)


def test_batch_run_appends_only_what_is_new(spark, tmp_path):
    at = jobs.Datasets(*[str(tmp_path / n) + "/" for n in "records curated united lookup refined filtered reports".split()])
    tables.write(_records(spark, 5), at.records)
    tables.write(spark.createDataFrame([("1 tablet nocte",)], "dosage string"), at.curated)
    jobs.run_prepare(spark, at)
    jobs.run_model(spark, at, None)
    before = tables.read(spark, at.lookup).count()
    assert before == len(TEXTS) + 1
    more = tables.read(spark, at.united).unionByName(
        spark.createDataFrame([("1 capsule tds", 7, False)], "dosage string, dosage_count long, is_test boolean")
    )
    more.write.parquet(str(tmp_path / "more"))
    later = jobs.Datasets(at.records, at.curated, str(tmp_path / "more"), at.lookup, at.refined, at.filtered, at.reports)
    jobs.run_batch(spark, later, None)
    jobs.run_batch(spark, later, None)
    assert tables.read(spark, at.lookup).count() == before + 1
    jobs.run_refine(spark, later, 3)
    refined = tables.read(spark, at.refined)
    assert tuple(refined.columns) == OUTPUT and len(OUTPUT) == 138
    assert {r["dosage"] for r in tables.read(spark, at.filtered).collect()} == {*TEXTS[:3], "1 capsule tds"}
    jobs.run_reports(spark, later)
    assert tables.read(spark, at.reports + "element_orders_mapped").count() == 2


def test_batch_adds_what_a_full_refresh_has(spark):
    kind = "dosage string, dosage_count long, is_test boolean"
    first = [("take 1 tablet once a day", 20, False), ("1 capsule tds", 4, False)]
    more = [("TAKE 1 tablet once a day", 7, False), ("1 CAPSULE tds", 6, False), ("1 spray nocte", 3, False)]
    lookup = jobs.model(spark.createDataFrame(first, kind), 10)
    added = jobs.batch(spark.createDataFrame(first + more, kind), lookup, 10)
    full = jobs.model(spark.createDataFrame(first + more, kind), 10)
    columns = ["dosage", "dosage_lower", "buckets", "exclude", "mapped"]
    got = sorted(lookup.select(*columns).union(added.select(*columns)).collect())
    assert got == sorted(full.select(*columns).collect()) and len(got) == 4


def test_fhir_json(spark):
    df = refine(assess(spark.createDataFrame([('give 2.5ml "now" at 12 noon',), ("1 tablet for up to 2 weeks prn",)], "dosage string")))
    rows = {r["dosage"]: r for r in df.collect()}
    assert rows['give 2.5ml "now" at 12 noon']["fhir_json"] is None
    body = json.loads(rows["1 tablet for up to 2 weeks prn"]["fhir_json"])
    assert body == {
        "text": "1 tablet for up to 2 weeks prn",
        "timing": {"repeat": {"boundsRange": {"high": {
            "value": 2, "unit": "weeks", "system": "http://unitsofmeasure.org", "code": "wk"}}}},
        "doseQuantity": {"value": 1, "unit": "Tablet", "system": "http://snomed.info/sct", "code": "428673006"},
        "asNeededBoolean": True,
    }


def test_clock_times_and_offsets(spark):
    from posofold.operators.fhir import clock_times, offset_minutes

    row = spark.range(1).select(
        clock_times(F.lit("at 12am")), clock_times(F.lit("at 5 pm")), clock_times(F.lit("at 12 noon")),
        clock_times(F.lit("at night")), offset_minutes(F.lit("2"), F.lit("hour")), offset_minutes(F.lit("0"), F.lit("hour")),
    ).first()
    assert list(row) == [["00:00"], ["17:00"], ["12:00"], None, 120, None]


def test_stream_equals_batch(spark, tmp_path):
    spark.createDataFrame([(t,) for t in TEXTS], "dosage string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("dosage string").parquet(str(tmp_path / "in"))
    columns = ["dosage", "buckets", "mapped"]
    query = assess_stream(stream).select(*columns).writeStream.format("memory").queryName("got").start()
    query.processAllAvailable()
    query.stop()
    want = assess(spark.read.parquet(str(tmp_path / "in"))).select(*columns)
    assert sorted(spark.table("got").collect()) == sorted(want.collect())


def test_vocabulary_usage_by_brute_force(spark):
    df = spark.createDataFrame([("take 2 tablets with evening meal", 3), ("1 tablet every day", 2)],
                               "dosage_lower string, dosage_count long")
    got = {(r[0], r[1]): (r[2], r[3]) for r in reports.vocabulary_usage(df).collect()}
    assert got[("dose_form", "tablet")] == (2, 5) and got[("dose_form", "tablets")] == (1, 3)
    assert got[("when", "evening meal")] == (1, 3) and got[("period_unit", "day")] == (1, 2)
    assert got[("dose_form", "vial")] == (0, 0)


def test_samples_do_not_depend_on_partitions(spark):
    rows = [(f"t{i}", i % 2000 + 1, True) for i in range(3000)]
    df = spark.createDataFrame(rows, "dosage string, dosage_count long, mapped boolean")
    one = [r["dosage"] for r in reports.random_sample(df.repartition(1), 50).collect()]
    assert one == [r["dosage"] for r in reports.random_sample(df.repartition(7), 50).collect()]
    bands = Counter(r["frequency_band"] for r in reports.sample_by_frequency(df, 12).collect())
    assert bands == {"1-10": 12, "11-100": 12, "101-1000": 12, "1000+": 12}


def test_samples_pick_the_rows_of_their_group(spark):
    rows = [("a", 1, True, 0), ("a", 5000, True, 1), ("b", 7, True, 2), ("c", 7, False, 3)]
    df = spark.createDataFrame(rows, "dosage string, dosage_count long, mapped boolean, n int")
    got = sorted((r["frequency_band"], r["n"]) for r in reports.sample_by_frequency(df, 5).collect())
    assert got == [("1-10", 0), ("1-10", 2), ("1000+", 1)]


def test_one_element_as_all_of_them(spark):
    df = spark.createDataFrame([("2 sprays to be taken 3 times a day for 5 days",), ("take 1 tablet",), ("",), (None,)], "t string")
    whole = extract_elements(df.withColumn("at", F.col("t")), "at")
    for key in ("methodPassive", "doseQuantity", "boundsDuration"):
        columns = ["t", f"{key}_clean", f"{key}_captured", f"{key}_pattern"]
        one = extract_element(df.withColumn("at", F.col("t")), key, "at")
        assert sorted(one.select(*columns).collect(), key=str) == sorted(whole.select(*columns).collect(), key=str)
        assert sorted(one.columns) == sorted(c for c in whole.columns if c in ("t", "at") or c.startswith(f"{key}_"))


def test_job_settings_end_with_the_job(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    with jobs.configured(spark, "3m"):
        assert spark.conf.get(name) == "3m"
    assert spark.conf.get(name) == before


def test_templates_fill_in_both_engines():
    assert templates.fill("a <A> b") == "'a ' || A || ' b'"
    assert len(templates.blocks()) == 96
