"""Session defaults. A session handed in by the cluster is used as it is."""

from __future__ import annotations

import functools
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, **settings: str) -> SparkSession:
    """Session with the defaults above; master and sizes come from spark-submit or ``settings``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Only a local session may do without the setting and gets a temporary folder. On a cluster, each machine would write
    to a folder of its own, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master or 'the cluster'} share")
        configured = _local_dir()
    return configured.rstrip("/")


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="review-signals-")
