"""Versions of datasets, and batches that renew counts and terms."""

import json
import subprocess
import sys
import time
import uuid
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from posofold.plans import jobs
from posofold.sources import tables, vocabulary

KIND = "dosage string, dosage_count long, is_test boolean"
CLOCK = ("timestamp", "_snapshot_ts")


def datasets(folder, **more) -> jobs.Datasets:
    names = "records curated united lookup refined filtered reports".split()
    return jobs.Datasets(*[f"{folder}/{n}/" for n in names], **more)


def rows(df):
    """All rows without the times of assessment, as text."""
    return sorted(json.dumps({k: v for k, v in r.asDict().items() if k not in CLOCK}, default=str, sort_keys=True) for r in df.collect())


def files(spark, path):
    """Bucket -> its data files, of the latest version."""
    at = tables.latest(spark, path)
    found = defaultdict(set)
    for part, folders in at.parts.items():
        for f in folders:
            found[part] |= {(p.name, p.stat().st_mtime_ns) for p in Path(path, f).glob("*.parquet")}
    return found


def texts(*counts):
    start = [(f"take {n} tablets {k} times a day", c, False) for k, n, c in counts]
    return [*start, ("2 puffs bd", 9, False), ("oneone", 3, False), ("...", 2, False), ("1 tablet nocte", 1, True)]


FIRST = texts((2, 1, 20), (3, 2, 4), (4, 3, 11), (2, 4, 30), (3, 5, 2))
LATER = [
    *texts((2, 1, 25), (3, 2, 4), (4, 3, 11), (2, 4, 30)),  # one count changed, one text gone
    ("TAKE 2 tablets 3 times a day", 7, False),  # takes a key over the cut-off
    ("1 capsule tds", 12, False),
]


def test_a_batch_equals_a_full_refresh(spark, tmp_path):
    at, full = datasets(tmp_path / "a"), datasets(tmp_path / "b")
    tables.write(spark.createDataFrame(FIRST, KIND), at.united)
    jobs.run_model(spark, at, 5, buckets=16)
    before, keys_before = files(spark, at.lookup), files(spark, at.keys)
    for place in (at, full):
        tables.write(spark.createDataFrame(LATER, KIND), place.united)
    jobs.run_model(spark, full, 5, buckets=16)
    touched = jobs.run_batch(spark, at, 5)
    assert 0 < len(touched) < 16
    assert rows(tables.read(spark, at.lookup)) == rows(tables.read(spark, full.lookup))
    assert rows(tables.read(spark, at.keys)) == rows(tables.read(spark, full.keys))
    after, keys_after = files(spark, at.lookup), files(spark, at.keys)
    stays = [b for b in before if int(b) not in touched]
    assert stays and all(before[b] == after[b] and keys_before[b] == keys_after[b] for b in stays)
    changed = {r["bucket"] for r in spark.createDataFrame([(t,) for t in ("take 1 tablets 2 times a day",)], "dosage_lower string")
               .select(jobs._bucket(16).alias("bucket")).collect()}
    assert changed <= set(touched)
    times = {r["dosage"]: r["timestamp"] for r in tables.read(spark, at.lookup).collect()}
    # known keys were not assessed again, although their bucket was written
    assert times["take 1 tablets 2 times a day"] < times["1 capsule tds"]
    assert jobs.run_batch(spark, at, 5) == []


def test_a_first_batch_and_an_empty_corpus(spark, tmp_path):
    at = datasets(tmp_path)
    tables.write(spark.createDataFrame([], KIND), at.united)
    assert len(jobs.run_batch(spark, at, None)) == jobs.BUCKETS
    assert tables.read(spark, at.lookup).count() == 0
    tables.write(spark.createDataFrame([*FIRST, (None, 5, False)], KIND), at.united)
    assert 0 < len(jobs.run_batch(spark, at, None)) < jobs.BUCKETS
    assert tables.read(spark, at.lookup).count() == len(FIRST)
    tables.write(spark.createDataFrame([], KIND), at.united)
    jobs.run_batch(spark, at, None)
    assert tables.read(spark, at.lookup).count() == 0


def test_a_hot_key_is_counted_anew(spark, tmp_path):
    many = [("  " * n + "2 PUFFS bd", 1, False) for n in range(300)]
    at = datasets(tmp_path)
    tables.write(spark.createDataFrame([*FIRST, *many], KIND), at.united)
    jobs.run_model(spark, at, 5, buckets=8)
    tables.write(spark.createDataFrame([*FIRST, *[(t, 2, x) for t, _, x in many]], KIND), at.united)
    touched = jobs.run_batch(spark, at, 5)
    assert len(touched) == 1
    got = tables.read(spark, at.lookup).where(F.lower(F.trim("dosage")) == "2 puffs bd").agg(F.sum("dosage_count"), F.count_distinct("dosage_lower"))
    assert tuple(got.first()) == (609, 1)


def test_a_changed_site_word_touches_its_rows_alone(spark, tmp_path):
    words = "term string, meaning string"
    at = datasets(tmp_path / "a", vocabulary=f"{tmp_path}/words")
    tables.write(spark.createDataFrame([("tab", "tablet"), ("pill", "capsule")], words), at.vocabulary)
    corpus = [*FIRST, ("take 1 pill once a day", 8, False), ("1 TAB nocte", 6, False), ("pillow", 6, False)]
    tables.write(spark.createDataFrame(corpus, KIND), at.united)
    jobs.run_model(spark, at, 5, buckets=32)
    assert {r["buckets"] for r in tables.read(spark, at.lookup).where("dosage like '%pill once%'").collect()} == {"take | 1 capsule | once every day"}
    before = rows(tables.read(spark, at.lookup).where("dosage not like '%pill once%'"))
    tables.write(spark.createDataFrame([("tab", "tablet"), ("pill", "tablet")], words), at.vocabulary)
    touched = jobs.run_batch(spark, at, 5)
    assert 1 <= len(touched) <= 2
    full = datasets(tmp_path / "b", vocabulary=at.vocabulary)
    tables.write(spark.createDataFrame(corpus, KIND), full.united)
    jobs.run_model(spark, full, 5, buckets=32)
    got = tables.read(spark, at.lookup)
    assert rows(got) == rows(tables.read(spark, full.lookup))
    assert rows(got.where("dosage not like '%pill once%'")) == before
    tables.write(spark.createDataFrame([("two words", "x")], words), at.vocabulary)
    with pytest.raises(ValueError):
        jobs.run_batch(spark, at, 5)


CHANGED = """
import sys
from posofold import vocab
vocab.AS_NEEDED.append("if troubled")
from pyspark.sql import SparkSession
from posofold.plans import jobs
from tests.test_versions import datasets, rows
from posofold.sources import tables
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
jobs.configure(spark)
at, full = datasets(sys.argv[1] + "/a"), datasets(sys.argv[1] + "/b")
touched = jobs.run_batch(spark, at, 5)
jobs.run_model(spark, full, 5, buckets=32)
assert rows(tables.read(spark, at.lookup)) == rows(tables.read(spark, full.lookup))
assert rows(tables.read(spark, at.keys)) == rows(tables.read(spark, full.keys))
print("touched", *touched)
"""


def test_a_changed_term_touches_its_rows_alone(spark, tmp_path):
    at, full = datasets(tmp_path / "a"), datasets(tmp_path / "b")
    corpus = [*FIRST, ("take 1 tablet once a day if troubled", 8, False)]
    for place in (at, full):
        tables.write(spark.createDataFrame(corpus, KIND), place.united)
    jobs.run_model(spark, at, 5, buckets=32)
    old = {r["dosage"]: r["timestamp"] for r in tables.read(spark, at.lookup).collect()}
    was = {r["dosage"]: r["buckets"] for r in tables.read(spark, at.lookup).collect()}
    done = subprocess.run([sys.executable, "-c", CHANGED, str(tmp_path)], cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    touched = done.stdout.split("touched")[1].split()
    assert len(touched) == 1
    got = {r["dosage"]: r for r in tables.read(spark, at.lookup).collect()}
    moved = [d for d in old if got[d]["timestamp"] != old[d]]
    assert moved == ["take 1 tablet once a day if troubled"]
    assert "as needed" in got[moved[0]]["buckets"] and "as needed" not in was[moved[0]]


def test_terms_of_a_changed_entry():
    now = vocabulary.assessed_with()
    entry = next(r for r in sorted(now) if r[0] == "DOSE_FORMS" and r[1] == "lozenge")
    before = {r for r in now if r[2] != entry[2]} | {("DOSE_FORMS", "lozenge", "other"), ("DOSE_FORMS", "lolly", "other")}
    assert vocabulary.changed_terms(before, now) == ["lolly", "lozenge", "lozenges"]
    assert vocabulary.changed_terms(now, now) == []
    other = {r for r in now if r[0] != vocabulary.RULES} | {(vocabulary.RULES, "", "older")}
    assert vocabulary.changed_terms(other, now) is None


def fails(batches):
    for batch in batches:
        yield batch
        raise RuntimeError("killed")


def test_a_job_that_dies_leaves_the_old_version(spark, tmp_path):
    at = datasets(tmp_path)
    tables.write(spark.createDataFrame(FIRST, KIND), at.united)
    jobs.run_model(spark, at, 5, buckets=4)
    old = rows(tables.read(spark, at.lookup))
    broken = tables.read(spark, at.lookup).repartition(3).mapInPandas(fails, tables.read(spark, at.lookup).schema)
    with pytest.raises(Exception):
        tables.write(broken, at.lookup)
    assert rows(tables.read(spark, at.lookup)) == old
    # between the data and the file that names it
    tables.read(spark, at.lookup).limit(1).write.parquet(f"{at.lookup}data/lost")
    assert rows(tables.read(spark, at.lookup)) == old
    # between the keys and the lookup: the lookup still names the keys that it was made of
    tables.write(tables.read(spark, at.keys).limit(1), at.keys)
    assert jobs.run_batch(spark, at, 5) == []
    assert rows(tables.read(spark, at.lookup)) == old
    # so often that these keys are gone: a full refresh, here with other buckets
    for _ in range(tables.KEEP):
        tables.write(tables.read(spark, at.keys).limit(1), at.keys)
    assert len(jobs.run_batch(spark, at, 5)) == jobs.BUCKETS
    assert rows(tables.read(spark, at.lookup)) == old
    assert tables.read(spark, at.keys).count() == tables.read(spark, at.lookup).select("dosage_lower").distinct().count()


KILLED = """
import sys, time
from pyspark.sql import SparkSession
from posofold.sources import tables
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
marker = sys.argv[2]
def slow(batches):
    for batch in batches:
        yield batch
        open(marker, "w").close()
        time.sleep(60)
tables.write(spark.range(10).coalesce(1).mapInPandas(slow, "id long"), sys.argv[1])
"""


def test_a_killed_job_leaves_the_old_version(spark, tmp_path):
    path = f"{tmp_path}/data_set/"
    tables.write(spark.range(5), path)
    begun = tmp_path / "begun"
    script = subprocess.Popen([sys.executable, "-c", KILLED, path, str(begun)], cwd=Path(__file__).parent.parent, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    try:
        for _ in range(600):
            if begun.exists() or script.poll() is not None:
                break
            time.sleep(0.1)
        assert begun.exists()
    finally:
        script.kill()
        script.wait(timeout=60)
    assert tables.read(spark, path).count() == 5
    tables.write(spark.range(7), path)
    assert tables.read(spark, path).count() == 7


def test_a_number_that_was_begun_is_passed_over(spark, tmp_path):
    path = f"{tmp_path}/d/"
    tables.write(spark.range(1), path)
    (tmp_path / "d" / "_versions" / "v=2" / "_temporary").mkdir(parents=True)
    tables.write(spark.range(2), path)
    assert tables.read(spark, path).count() == 2 and tables.latest(spark, path).number == 3


def test_old_versions_go_and_shared_folders_stay(spark, tmp_path):
    path = f"{tmp_path}/d/"
    for n in range(1, 5):
        tables.write(spark.range(n), path, "append")
    assert tables.read(spark, path).count() == 10
    assert len(list((tmp_path / "d" / "_versions").glob("v=*"))) == tables.KEEP
    for n in range(1, 6):
        tables.write(spark.range(n), path)
    assert tables.read(spark, path).count() == 5
    assert len(list((tmp_path / "d" / "data").iterdir())) == tables.KEEP
    first = tables.latest(spark, path)
    tables.write(spark.range(9), path)
    assert tables.read_version(spark, path, first).count() == 5


def test_tables_by_name(spark, tmp_path):
    name = f"versioned_{uuid.uuid4().hex}"
    try:
        tables.write(spark.range(3), name)
        first = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()[1]
        tables.write(spark.range(4), name)
        assert tables.read(spark, name).count() == 4
        second = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()[1]
        assert first != second
        with pytest.raises(Exception):
            tables.write(spark.range(4).repartition(2).mapInPandas(fails, "id long"), name)
        assert tables.read(spark, name).count() == 4
        tables.write(spark.range(2), name, "append")
        assert tables.read(spark, name).count() == 6
        tables.write(spark.range(2).withColumn("x", F.lit("y")), name)
        assert tables.read(spark, name).columns == ["id", "x"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_no_folder_of_one_machine_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "spark://host:7077"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        tables.scratch(Session())
