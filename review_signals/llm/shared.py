"""Small helpers that several operators use."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_signals.session import shared_dir


def staged(rows: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder of the cluster and read it back: it outlives lost executors."""
    path = f"{shared_dir(rows.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables that no job will read again: what came of them has been written."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            if "/llm/" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded(rows: DataFrame, max_rows: int, sized: str | None = None, max_bytes: int = 16 << 20) -> DataFrame:
    """A staged frame, marked for broadcast if it has at most ``max_rows`` rows, and at most ``max_bytes`` in the binary
    column ``sized``; else the join shuffles as usual."""
    held = F.sum(F.octet_length(sized)) if sized else F.lit(0)
    count, total = rows.agg(F.count(F.lit(1)), held).first()
    return F.broadcast(rows) if count <= max_rows and (total or 0) <= max_bytes else rows


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def is_training(doc_id: Column) -> Column:
    """Rows that models may learn from; the others are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0
