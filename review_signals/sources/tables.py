"""Parquet tables: scans that fail fast, and the two kinds of write the jobs need."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_signals.session import shared_dir


#: Aggregates of the rows that a write is to count along the way, and where to put them.
Counted = tuple[Observation, Sequence[Column]]


class MissingInput(FileNotFoundError):
    """The table a job should read is not there."""


def read_table(spark: SparkSession, *paths: str, hint: str = "", schema: str | None = None, format: str = "parquet") -> DataFrame:
    """Scan directories, files or globs as one table; a path without any file is an error at once."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.format(format).load(list(paths))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInput(f"No files at {', '.join(paths)}. {hint}".strip()) from error
        raise


def dealt(rows: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows in a layout that only their content decides: dealt by a key, sorted by all other columns and then by it. Rows
    that are alike then lie together, and what goes over them meets the same places of its own tables in a row."""
    others = [c for c in rows.columns if c != key]
    return rows.repartition(partitions, key).sortWithinPartitions(*others, key)


def write_partitioned(rows: DataFrame, path: str, *keys: str, rebalance: bool = True, max_records: int = 5_000_000,
                      counted: Counted | None = None) -> None:
    """Overwrite a table partitioned by the columns that readers prune on.

    One shuffle brings the rows of a partition together, so that it gets few files; Spark splits large ones in it.
    Without ``rebalance`` nothing is shuffled and every task writes its own file per partition. ``counted`` is filled along
    the way.
    """
    if rebalance:
        rows = rows.hint("rebalance", *keys)
    if counted:
        # after the shuffle, in the tasks that write: rows of a stage that is run again are not counted twice
        rows = rows.observe(counted[0], *counted[1])
    rows.write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy(*keys).parquet(path)


def replace_partitions(rows: DataFrame, path: str, *keys: str, rebalance: bool = True) -> None:
    """Write the partitions that ``rows`` has, in place of the table's own; the files of all other partitions stay.

    The rows of a partition are brought together first, as in :func:`write_partitioned`, unless without ``rebalance``: for
    rows that all go to one partition and come from a shuffle, another one is of no use. A table that isn't there yet is
    made. A partition can be replaced by rows, not emptied.
    """
    if rebalance:
        rows = rows.hint("rebalance", *keys)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def read_layouts(spark: SparkSession, schema: str, *paths: str) -> DataFrame:
    """Files of several layouts as one table of ``schema``, with the ``file`` that each row comes from.

    Each path is read with the layout of its own files. Columns are matched by name whatever their case; a missing one is
    null, a value that can't be converted is null, others that the schema doesn't have are left out.
    """
    wanted = T.StructType.fromDDL(schema)
    parts = []
    for path in paths:
        rows = read_table(spark, path)
        there = {name.lower(): name for name in rows.columns}
        columns = [
            (F.col(f"`{there[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in there else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted
        ]
        parts.append(rows.select(*columns, F.col("_metadata.file_path").alias("file")))
    return reduce(DataFrame.unionByName, parts)


def write_by_category(rows: DataFrame, path: str, counted: Counted | None = None) -> None:
    write_partitioned(rows, path, "product_category", counted=counted)


def write_plain(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def write_bucketed(rows: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Lookup with one row per key, bucketed and sorted by it: joins on the key shuffle the other side only."""
    (
        rows.write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )


#: Spark deletes the shuffle files of an execution as soon as it is over, not when the driver collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder of the cluster and read it back.

    Used where several jobs go over one expensive frame. The files outlive lost executors; :func:`unstage` deletes them.
    What the write has shuffled goes with its end, so that it doesn't lie beside the shuffles of the next step.
    """
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        rows.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(rows.schema).parquet(path)


def unstage(staged: DataFrame) -> None:
    """Delete the files of the staged tables that a frame reads, once no job reads them any more."""
    jvm, configuration = staged.sparkSession._jvm, staged.sparkSession._jsc.hadoopConfiguration()
    for name in {file.rsplit("/", 1)[0] for file in staged.inputFiles() if "/staged/" in file}:
        folder = jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(configuration).delete(folder, True)
