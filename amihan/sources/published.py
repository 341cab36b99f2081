"""Tables that are published whole: a run that dies leaves the former version readable.

Every write goes to a folder of its own below ``publications``.  A version is
a row of the small ``manifest`` beside it, which names the folders that make
up the table; it is written last, and readers take the row of the highest
version.  Data that no row names, such as that of a killed run, is not read.

A version may share folders with the one before: an append adds one, and a
table partitioned by a column can replace some of its values and keep the
files of all others.  A table may be derived from itself, since its own
files are never touched.  There is one writer at a time.  Partition values
are numbers, dates, booleans or plain words, as they name folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The partition column that keeps the publications of one table apart; not part of the table.
PUBLICATION = "publication"
MANIFEST = "version long, folders array<string>, table_schema string, partition_column string, published_at timestamp"


@dataclass(frozen=True)
class Version:
    number: int
    folders: tuple[str, ...]
    schema: T.StructType
    partition_column: str | None


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def versions(spark: SparkSession, path: str) -> DataFrame | None:
    """The manifest: one row for each version, or None before the first."""
    files, folder = _file_system(spark, f"{path}/manifest")
    return spark.read.schema(MANIFEST).json(f"{path}/manifest") if files.exists(folder) else None


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The highest version, or the one of a number."""
    rows = versions(spark, path)
    if rows is None:
        return None
    rows = rows if number is None else rows.where(F.col("version") == number)
    last = rows.orderBy(F.desc("version"), F.desc("published_at")).first()
    if last is None:
        return None
    schema = T.StructType.fromJson(json.loads(last["table_schema"]))
    return Version(last["version"], tuple(last["folders"]), schema, last["partition_column"])


def _load(spark: SparkSession, path: str, version: Version) -> DataFrame:
    root = f"{path}/publications"
    if not version.folders:
        return spark.createDataFrame([], version.schema)
    # The schema is declared, so no file is opened while planning.
    whole = T.StructType([*version.schema.fields, T.StructField(PUBLICATION, T.StringType())])
    read = spark.read.schema(whole).option("basePath", root).parquet(*[f"{root}/{f}" for f in version.folders])
    return read.select(*version.schema.fieldNames())


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The table as last published, or as of a version; None if there is none."""
    version = current(spark, path, number)
    return None if version is None else _load(spark, path, version)


def _written(df: DataFrame, path: str, partition_by: str | None, cluster_by: Sequence[str], rows_per_file: int) -> tuple[str, ...]:
    """Write rows to a new folder; the folders that now hold them, one for each partition value."""
    if PUBLICATION in df.columns:
        raise ValueError(f"a published table has no column named {PUBLICATION}")
    name = f"{PUBLICATION}=p{uuid.uuid4().hex}"
    root = f"{path}/publications"
    order = [*([partition_by] if partition_by else []), *cluster_by]
    out = df.sortWithinPartitions(*order) if order else df
    writer = out.write.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{root}/{name}")
    if not partition_by:
        return (name,)
    # As many rows as partition values; their folder names come from the files themselves.
    files = df.sparkSession.read.schema(df.schema).option("basePath", root).parquet(f"{root}/{name}")
    folder = F.regexp_extract(F.input_file_name(), f"/({name}/[^/]+)/[^/]+$", 1)
    return tuple(sorted(r[0] for r in files.select(folder).distinct().collect()))


def _record(spark: SparkSession, path: str, version: Version) -> DataFrame:
    row = (version.number, list(version.folders), version.schema.json(), version.partition_column)
    columns = MANIFEST.rsplit(",", 1)[0]
    # A single file, which the commit of the job moves into place.
    one = spark.createDataFrame([row], columns).coalesce(1).withColumn("published_at", F.current_timestamp())
    one.write.mode("append").json(f"{path}/manifest")
    return _load(spark, path, version)


def publish(df: DataFrame, path: str, cluster_by: Sequence[str] = (), partition_by: str | None = None, rows_per_file: int = 0) -> DataFrame:
    """Replace the table; ``cluster_by`` sorts within files for min/max pruning."""
    spark = df.sparkSession
    last = current(spark, path)
    folders = _written(df, path, partition_by, cluster_by, rows_per_file)
    return _record(spark, path, Version(last.number + 1 if last else 1, folders, df.schema, partition_by))


def append(df: DataFrame, path: str, cluster_by: Sequence[str] = (), partition_by: str | None = None, rows_per_file: int = 0) -> DataFrame:
    """Add rows to the table, whose columns they have; what is there keeps its files."""
    spark = df.sparkSession
    last = current(spark, path)
    if last is None:
        return publish(df, path, cluster_by, partition_by, rows_per_file)
    if last.partition_column != partition_by:
        raise ValueError(f"{path} is partitioned by {last.partition_column}, not by {partition_by}")
    folders = _written(df.select(*last.schema.fieldNames()), path, partition_by, cluster_by, rows_per_file)
    return _record(spark, path, Version(last.number + 1, (*last.folders, *folders), last.schema, partition_by))


def replace_partitions(df: DataFrame, path: str, partition_by: str, cluster_by: Sequence[str] = (), rows_per_file: int = 0) -> DataFrame:
    """Replace the partitions whose values occur in the rows; all others keep their files."""
    spark = df.sparkSession
    last = current(spark, path)
    if last is None:
        return publish(df, path, cluster_by, partition_by, rows_per_file)
    if last.partition_column != partition_by:
        raise ValueError(f"{path} is partitioned by {last.partition_column}, not by {partition_by}")
    folders = _written(df.select(*last.schema.fieldNames()), path, partition_by, cluster_by, rows_per_file)
    touched = {f.split("/", 1)[1] for f in folders}
    kept = tuple(f for f in last.folders if f.split("/", 1)[1] not in touched)
    return _record(spark, path, Version(last.number + 1, (*kept, *folders), last.schema, partition_by))


def restore(spark: SparkSession, path: str, number: int) -> DataFrame:
    """Publish a former version again."""
    last, former = current(spark, path), current(spark, path, number)
    if last is None or former is None:
        raise ValueError(f"{path} has no version {number}")
    return _record(spark, path, Version(last.number + 1, former.folders, former.schema, former.partition_column))


def remove_unused(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the folders that none of the last ``keep`` versions names; their number.

    That includes what killed runs left, so no writer may be at work.  Readers
    of versions that are kept are not disturbed.
    """
    rows = versions(spark, path)
    if rows is None or keep < 1:
        raise ValueError("nothing is published here, or no version is to be kept")
    kept = rows.orderBy(F.desc("version")).limit(keep).select(F.explode("folders").alias("f"))
    named = {r[0] for r in kept.distinct().collect()}
    files, root = _file_system(spark, f"{path}/publications")
    removed = 0
    for publication in files.listStatus(root):
        name = publication.getPath().getName()
        if name in named:
            continue
        inner = {n.split("/", 1)[1] for n in named if n.startswith(f"{name}/")}
        for folder in files.listStatus(publication.getPath()) if inner else ():
            if folder.isDirectory() and folder.getPath().getName() not in inner:
                removed += bool(files.delete(folder.getPath(), True))
        if not inner:
            removed += bool(files.delete(publication.getPath(), True))
    return removed
