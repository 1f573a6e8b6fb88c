"""Incremental runs: new files once, through a checkpoint; keys once, through an anti join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.operators.relational import pending


def process_new_files(spark: SparkSession, source: str, schema: str, checkpoint: str, step: Callable[[DataFrame], DataFrame], sink: str, files: int = 100) -> None:
    """Runs step over what arrived since the last run and appends to sink; at most files at once."""

    def batch(df: DataFrame, number: int) -> None:
        # a batch that is run again after a failure replaces its own partition
        step(df).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def process_pending(wanted: DataFrame, done: DataFrame, key: list[str], step: Callable[[DataFrame], DataFrame], sink: str) -> None:
    step(pending(wanted, done, key)).write.mode("append").parquet(sink)


def windowed_counts(events: DataFrame, time: str, by: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by event-time windows, for a stream or a table."""
    t = events.withColumn(time, F.col(time).cast("timestamp"))
    return t.withWatermark(time, late).groupBy(F.window(time, size), by).agg(F.count("*").alias("n"))
