"""The jobs: prepare a corpus, build or extend the lookup, refine it, report on it."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posofold.operators import corpus, reports
from posofold.operators.assess import assess, with_array_fields
from posofold.operators.enrich import refine
from posofold.operators.normalise import normalise
from posofold.sources import vocabulary
from posofold.sources.tables import Version, is_path, latest, read, read_version, version, write, write_parts

BUCKETS = 64  # parts of a lookup that are written anew or stay


def _settings(partition: str) -> dict[str, str]:
    return {
        "spark.sql.codegen.maxFields": "20",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": partition,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
    }


def configure(spark: SparkSession, partition: str = "8m") -> SparkSession:
    """Session settings for the long projections of the assessment, for the rest of the session.

    Fusing all of them into one generated method would exceed what the JVM compiles, so
    wide projections are generated one by one.  The extraction costs much time per byte,
    so partitions behind a shuffle are kept smaller than the default.
    """
    for name, value in _settings(partition).items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def configured(spark: SparkSession, partition: str = "8m") -> Iterator[SparkSession]:
    """The same settings for one job; afterwards the session has its own again."""
    before = {name: spark.conf.get(name, None) for name in _settings(partition)}
    try:
        yield configure(spark, partition)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def prepare(records: DataFrame, curated: DataFrame) -> DataFrame:
    """Raw records and curated instructions to the united corpus."""
    counted = corpus.count_instructions(records, ordered=False)
    if "dosage_count" not in curated.columns:
        curated = corpus.count_instructions(curated, ordered=False)
    return corpus.unite(counted, curated.select("dosage", "dosage_count"))


def model(
    united: DataFrame,
    min_count: int | None,
    ordered: bool = True,
    keep_screening_reason: bool = True,
) -> DataFrame:
    """The lookup: every raw instruction with the assessment of its normalised text.

    The text is assessed once per distinct normalised form.  Keys below ``min_count``
    drop out (None keeps all).  ``keep_screening_reason=False`` labels screened rows as empty.
    """
    return model_normalised(normalise(united), min_count, ordered, keep_screening_reason)


def model_normalised(
    normalised: DataFrame,
    min_count: int | None,
    ordered: bool = True,
    keep_screening_reason: bool = True,
) -> DataFrame:
    """The same from normalised texts, which are read several times: best a written dataset."""
    grouped = corpus.regroup(normalised)
    keys = corpus.frequent_keys(grouped, min_count)
    assessed = assess(keys, F.current_timestamp())
    joined = corpus.rejoin(normalised, assessed, grouped, keep_screening_reason)
    return corpus.curated_first(joined) if ordered else joined


def batch(united: DataFrame, lookup: DataFrame, min_count: int | None, keep_screening_reason: bool = True) -> DataFrame:
    """What a full refresh over ``united`` would have and the lookup lacks.

    The cut-off holds for the counts of the whole corpus: a new spelling of a frequent key and
    all spellings of a key that has become frequent are included.  Only keys with such rows are
    assessed.  Counts of rows that the lookup has stay as they are until a full refresh.
    """
    return batch_normalised(normalise(united), lookup, min_count, keep_screening_reason)


def batch_normalised(
    normalised: DataFrame, lookup: DataFrame, min_count: int | None, keep_screening_reason: bool = True
) -> DataFrame:
    """The same from normalised texts, which are read several times: best a written dataset."""
    new = corpus.not_yet_assessed(normalised, lookup)
    grouped = corpus.regroup(normalised)
    met = new.select(F.col(corpus.KEY).alias("_met")).distinct()
    wanted = corpus.frequent_keys(grouped, min_count).join(met, F.col(corpus.KEY).eqNullSafe(F.col("_met")), "left_semi")
    assessed = assess(wanted, F.current_timestamp())
    return corpus.rejoin(new, assessed, grouped, keep_screening_reason)


def refined(lookup: DataFrame) -> DataFrame:
    return refine(lookup)


def filtered(refined_lookup: DataFrame, min_count: int | None) -> DataFrame:
    return corpus.filter_refined(refined_lookup, min_count)


def all_reports(lookup: DataFrame, refined_lookup: DataFrame) -> dict[str, DataFrame]:
    return {
        "captured_clean_summary": reports.captured_summary(lookup),
        "random_sample": reports.random_sample(refined_lookup),
        "stratified_by_frequency": reports.sample_by_frequency(refined_lookup),
        "stratified_by_elements": reports.sample_by_element(refined_lookup),
        "element_orders_mapped": reports.tag_orders(refined_lookup),
        "pattern_usage": reports.pattern_usage(lookup),
        "vocabulary_usage": reports.vocabulary_usage(lookup),
        "preprocessing_report": reports.normalisation_usage(lookup),
    }


@dataclass(frozen=True)
class Datasets:
    """Names (tables) or paths (parquet) of the datasets of a run."""

    records: str
    curated: str
    united: str
    lookup: str
    refined: str
    filtered: str
    reports: str  # prefix of the eight report datasets
    vocabulary: str | None = None  # the site's own words (term, meaning), read before normalising

    def _beside(self, name: str, what: str) -> str:
        return name.rstrip("/") + what + "/" * name.endswith("/")

    @property
    def normalised(self) -> str:
        """Work dataset of the model and batch jobs, next to the united one."""
        return self._beside(self.united, "_normalised")

    @property
    def keys(self) -> str:
        """The assessment of each key of the lookup, next to it."""
        return self._beside(self.lookup, "_keys")

    @property
    def assessed_with(self) -> str:
        """The terms and rules that the keys were assessed with, next to the lookup."""
        return self._beside(self.lookup, "_assessed_with")


def _normalised(spark: SparkSession, at: Datasets) -> DataFrame:
    """The united corpus, normalised once and written: the jobs read it several times."""
    united = read(spark, at.united)
    site = vocabulary.site_terms(spark, at.vocabulary)
    if site:
        united = united.withColumn("_text", vocabulary.replace_words(F.col("dosage"), site))
        write(normalise(united, "_text").drop("_text"), at.normalised)
    else:
        write(normalise(united), at.normalised)
    return read(spark, at.normalised)


def run_prepare(spark: SparkSession, at: Datasets) -> None:
    with configured(spark):
        write(prepare(read(spark, at.records), read(spark, at.curated)), at.united)


def run_model(spark: SparkSession, at: Datasets, min_count: int | None, buckets: int = BUCKETS) -> None:
    """Full refresh: assesses all keys and replaces the lookup."""
    with configured(spark):
        _refresh(spark, at, min_count, buckets, None)


def run_batch(spark: SparkSession, at: Datasets, min_count: int | None) -> list[int]:
    """Incremental: the lookup becomes what a full refresh would make of the united corpus.

    Keys that were assessed with the terms of today keep their assessment; new keys, and those
    whose text holds a changed term, are assessed.  Counts are those of today.  Only buckets of
    keys in which a row differs are written again, and their numbers are returned; the files of
    all others stay.  A lookup that is a table, or that was not written by ``run_model``, is
    refreshed as a whole.
    """
    with configured(spark):
        before = latest(spark, at.lookup) if is_path(at.lookup) else None
        known = before if before and "digests" in before.facts else None
        if known and version(spark, at.keys, known.facts["keys"]) is None:
            known = None  # jobs that died have since pushed out the keys of the lookup
        return _refresh(spark, at, min_count, known.facts["buckets"] if known else BUCKETS, known)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(corpus.KEY), F.lit(buckets)).cast("int")


def _digests(rows: DataFrame, buckets: int) -> dict[str, list[int]]:
    """By bucket: number of rows and two hashes of what a row of the lookup is made of.

    Hashes combine within each task, so a bucket is one small row whatever it holds.
    """
    made_of = ["dosage", "dosage_count", "is_test", corpus.KEY, "exclude"]
    hashes = [F.bit_xor(F.xxhash64(*made_of, F.lit(seed))) for seed in (1, 2)]
    sums = rows.groupBy(_bucket(buckets).alias("bucket")).agg(F.count(F.lit(1)), *hashes)
    return {str(r[0]): [r[1], r[2], r[3]] for r in sums.collect()}  # a row for each bucket


def _known_keys(spark: SparkSession, at: Datasets, before: Version) -> DataFrame | None:
    """Keys whose assessment still holds."""
    keys = read_version(spark, at.keys, version(spark, at.keys, before.facts["keys"]))
    terms = version(spark, at.assessed_with, before.facts["assessed_with"])
    if terms is None:
        return None
    with_ = {tuple(r) for r in read_version(spark, at.assessed_with, terms).collect()}  # a bounded list
    changed = vocabulary.changed_terms(with_, vocabulary.assessed_with())
    return None if changed is None else keys.where(~vocabulary.holds(corpus.KEY, changed))


def _refresh(spark: SparkSession, at: Datasets, min_count: int | None, buckets: int, before: Version | None) -> list[int]:
    """Write the keys, then the lookup, where they differ from the version ``before``."""
    normalised = _normalised(spark, at)
    grouped = corpus.regroup(normalised)
    wanted = corpus.frequent_keys(grouped, min_count).where(F.col(corpus.KEY).isNotNull())
    rows = normalised if min_count is None else corpus.rows_of(normalised, wanted, grouped)
    digests = _digests(rows.where(F.col(corpus.KEY).isNotNull()), buckets)
    known = _known_keys(spark, at, before) if before else None
    fresh = wanted if known is None else wanted.join(known.select(corpus.KEY), corpus.KEY, "left_anti")
    if before:
        old = before.facts["digests"]
        touched = {int(k) for k in {*old, *digests} if old.get(k) != digests.get(k)}
        touched |= {r[0] for r in fresh.select(_bucket(buckets)).distinct().collect()}  # one for each bucket at most
    else:
        touched = set(range(buckets))
    if not touched:
        return []
    here = _bucket(buckets).isin(sorted(touched))
    assessed = assess(fresh, F.current_timestamp()).drop("dosage_count", "variants")
    if known is not None:
        stays = known.where(here).join(wanted.select(corpus.KEY), corpus.KEY, "left_semi")
        assessed = assessed.unionByName(stays)
    filled = [k for k in sorted(touched) if str(k) in digests]
    if not is_path(at.lookup):
        write(assessed, at.keys)
        write(corpus.rejoin(normalised, read(spark, at.keys), grouped), at.lookup)
        return sorted(touched)
    old_keys = version(spark, at.keys, before.facts["keys"]) if before else None
    keys = write_parts(assessed.withColumn("bucket", _bucket(buckets)), at.keys, "bucket", old_keys, sorted(touched), filled)
    terms = spark.createDataFrame(sorted(vocabulary.assessed_with()), "list string, term string, entry string")
    write(terms, at.assessed_with)
    facts = {"buckets": buckets, "digests": digests, "keys": keys.number, "assessed_with": latest(spark, at.assessed_with).number}
    new = read_version(spark, at.keys, keys, [str(k) for k in filled])
    lookup = corpus.rejoin(normalised.where(here), new, grouped).withColumn("bucket", _bucket(buckets))
    write_parts(lookup, at.lookup, "bucket", before, sorted(touched), filled, facts)
    return sorted(touched)


def run_refine(spark: SparkSession, at: Datasets, min_count: int | None) -> None:
    with configured(spark):
        write(refined(read(spark, at.lookup)), at.refined)
        write(filtered(read(spark, at.refined), min_count), at.filtered)


def run_reports(spark: SparkSession, at: Datasets) -> None:
    """Reads what the earlier jobs wrote, so no report recomputes the extraction."""
    with configured(spark):
        for name, report in all_reports(read(spark, at.lookup), read(spark, at.refined)).items():
            write(report, at.reports + name)


def published(lookup: DataFrame) -> DataFrame:
    """The lookup with element fields as arrays, for readers of that form."""
    return with_array_fields(lookup)
