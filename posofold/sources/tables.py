"""Reading and writing datasets: a path holds parquet, anything else is a table name.

A dataset at a path is written as versions.  The rows of a version go to new folders below
``data/``; then one small file below ``_versions/`` lists the folders and so makes it the dataset.
Until that file is there readers see the version before, so a job that dies while it writes
changes nothing.  A version may keep folders of the one before: ``append`` adds one, and
``write_parts`` replaces the folders of some parts only.  A path without versions is read as
plain parquet.  One writer at a time is supported, and any number of readers.

A table is pointed at its new rows by one change of its location in the catalog; the old rows go
after that.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

KEEP = 3  # versions whose folders stay: a reader may still be busy with an older one


@dataclass(frozen=True)
class Version:
    """One state of a dataset: its folders by part, relative to the dataset, and facts about it."""

    number: int
    schema: str
    parts: dict[str, list[str]]
    facts: dict = field(default_factory=dict)

    @property
    def folders(self) -> list[str]:
        return sorted({f for folders in self.parts.values() for f in folders})


def is_path(name: str) -> bool:
    return "/" in name


def _versions(spark: SparkSession, path: str) -> list[Version]:
    """All versions that are complete, oldest first."""
    try:
        rows = spark.read.schema("value string, v long").text(f"{path.rstrip('/')}/_versions", wholetext=True).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted((Version(r["v"], **json.loads(r["value"])) for r in rows), key=lambda v: v.number)


def latest(spark: SparkSession, path: str) -> Version | None:
    found = _versions(spark, path)
    return found[-1] if found else None


def version(spark: SparkSession, path: str, number: int) -> Version | None:
    """A version by its number; None if it is gone."""
    return next((v for v in _versions(spark, path) if v.number == number), None)


def read_version(spark: SparkSession, path: str, at: Version, parts: list[str] | None = None) -> DataFrame:
    """The rows of a version, or of some of its parts."""
    folders = at.folders if parts is None else sorted({f for p in parts for f in at.parts.get(p, [])})
    schema = StructType.fromJson(json.loads(at.schema))
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f}" for f in folders])


def read(spark: SparkSession, name: str) -> DataFrame:
    """A dataset by path or table name."""
    if not is_path(name):
        return spark.read.table(name)
    at = latest(spark, name)
    return spark.read.parquet(name) if at is None else read_version(spark, name, at)


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local one only where that is unset and Spark
    runs on this machine alone, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="jobs-")
    return f"{base.rstrip('/')}/jobs-{uuid.uuid4().hex}/"


def publish(spark: SparkSession, path: str, schema: StructType, parts: dict[str, list[str]], facts: dict | None = None) -> Version:
    """Make the folders the dataset: the one step that readers notice."""
    known = _versions(spark, path)
    body = {"schema": schema.json(), "parts": parts, "facts": facts or {}}
    number = known[-1].number + 1 if known else 1
    while True:
        file = spark.createDataFrame([(json.dumps(body),)], "value string").coalesce(1)
        try:
            file.write.text(f"{path.rstrip('/')}/_versions/v={number}")
            break
        except AnalysisException as error:
            # a number that a job took and died before it was complete
            if error.getCondition() != "PATH_ALREADY_EXISTS" or any(v.number >= number for v in _versions(spark, path)):
                raise
            number += 1
    made = Version(number, **body)
    _expire(spark, path, [*known, made])
    return made


def _expire(spark: SparkSession, path: str, known: list[Version]) -> None:
    """Remove versions past ``KEEP``, and folders that none of the others has."""
    old, kept = known[:-KEEP], known[-KEEP:]
    if not old:
        return
    used = {f for v in kept for f in v.folders}
    gone = [f"_versions/v={v.number}" for v in old] + sorted({f for v in old for f in v.folders} - used)
    for folder in gone:
        _remove(spark, f"{path.rstrip('/')}/{folder}")


def _remove(spark: SparkSession, folder: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write(df: DataFrame, name: str, mode: str = "overwrite", facts: dict | None = None) -> None:
    """Write a dataset; ``append`` adds a batch, ``overwrite`` replaces everything."""
    if not is_path(name):
        _write_table(df, name, mode)
        return
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    before = latest(spark, name) if mode == "append" else None
    kept = before.parts if before else {}
    df.write.parquet(f"{name.rstrip('/')}/{folder}")
    publish(spark, name, df.schema, {**kept, "all": [*kept.get("all", []), folder]}, facts)


def write_parts(
    df: DataFrame, path: str, part: str, before: Version | None, replaced: list[int], filled: list[int], facts: dict | None = None
) -> Version:
    """A version like ``before``, but with the rows of ``df`` for the ``replaced`` values of the
    integer column ``part``; the folders of other values stay as they are.  ``filled`` are those of
    the replaced values that have rows."""
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    kept = {k: v for k, v in (before.parts if before else {}).items() if k not in set(map(str, replaced))}
    # AQE unites small parts and cuts a large one into several tasks
    df.hint("rebalance", part).write.partitionBy(part).parquet(f"{path.rstrip('/')}/{folder}")
    new = {str(k): [f"{folder}/{part}={k}"] for k in filled}
    return publish(spark, path, df.drop(part).schema, {**kept, **new}, facts)


def _write_table(df: DataFrame, name: str, mode: str) -> None:
    spark = df.sparkSession
    if mode != "overwrite" or not spark.catalog.tableExists(name):
        df.write.mode(mode).saveAsTable(name)
        return
    same = [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]
    if not same:  # other columns: the catalog has no single step for that
        df.write.mode(mode).saveAsTable(name)
        return
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    folder = f"{place.split('__at_')[0].rstrip('/')}__at_{uuid.uuid4().hex}"
    df.write.parquet(folder)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    _remove(spark, place)
