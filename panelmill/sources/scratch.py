"""A folder that all executors share, for tables between steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir; where that is unset (tests), in a temporary folder of this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="panelmill-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base}/panelmill/{name}-{uuid.uuid4().hex}"


@contextmanager
def by_counted_rows(spark: SparkSession) -> Iterator[None]:
    """What is written within broadcasts a side of a join only if its shuffle counted few bytes of rows. Files of a table between
    steps can be a small part of its rows in memory; by their size alone Spark would send millions of rows through the driver."""
    files, counted = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {k: spark.conf.get(k, None) for k in (files, counted)}
    if before[counted] is None:
        spark.conf.set(counted, spark.conf.get(files))
    spark.conf.set(files, "-1")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
