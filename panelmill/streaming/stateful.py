"""Streams with state: rows repeated within a watermark dropped, sessions, joins of two streams within a time.

Each takes a streaming (or batch) DataFrame whose watermark column is a timestamp. replayed() runs one over a table in steps, as a
service would meet it: each step's rows arrive, the query is started anew on its checkpoint and ends when it has read them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def once(rows: DataFrame, time: str, key: list[str], delay: str) -> DataFrame:
    """rows without repeats of a key that come within the watermark's delay of the first; later rows are dropped as late."""
    marked = rows.withWatermark(time, delay)
    return marked.dropDuplicatesWithinWatermark(key) if rows.isStreaming else marked.dropDuplicates(key)


def sessions(rows: DataFrame, time: str, by: list[str], gap: str, *sums: Column) -> DataFrame:
    """by, start, end (the last row's time), n and sums: rows of one key no further apart than gap. rows have a watermark; a session
    is given out when it has passed."""
    out = rows.groupBy(F.session_window(time, gap).alias("_s"), *by).agg(F.max(time).alias("end"), F.count("*").alias("n"), *sums)
    return out.select(*by, F.col("_s.start").alias("start"), *[c for c in out.columns if c not in ("_s", *by)])


def within(left: DataFrame, right: DataFrame, key: list[str], left_time: str, right_time: str, most: str) -> DataFrame:
    """Pairs of equal key whose right time lies in (left time, left time + most]. Columns but the key must differ in name. Both sides
    have watermarks, so state of either side goes when no partner can come any more. Time is cut into lots as long as most: a left row
    meets the rows of its own lot and the next, so that a key with many rows is neither one task nor compared with all its rows."""
    lot = lambda c: F.floor(F.unix_micros(c) / (F.lit(1000) * F.expr(f"timestampdiff(millisecond, timestamp_seconds(0), timestamp_seconds(0) + interval {most})"))).cast("bigint")
    a = left.withColumn("_lot", F.explode(F.array(lot(F.col(left_time)), lot(F.col(left_time)) + 1)))
    r = right.withColumnsRenamed({k: f"_{k}" for k in key}).withColumn("_right_lot", lot(F.col(right_time)))
    same = [F.col(k) == F.col(f"_{k}") for k in key] + [F.col("_lot") == F.col("_right_lot")]
    near = (F.col(right_time) > F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"interval {most}"))
    on = near
    for s in same:
        on = s & on
    return a.join(r, on).drop(*[f"_{k}" for k in key], "_lot", "_right_lot")


def _move(spark: SparkSession, old: str, new: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(old).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path(old)):
        files.mkdirs(path(new).getParent())
        if not files.rename(path(old), path(new)):
            raise OSError(f"{old} cannot be moved to {new}")


def replayed(table: DataFrame, step: Column, n: int, query: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """What query writes of the stream in which table's rows arrive in n steps (step: 0 to n - 1; other rows take no part).

    The table is written once, by step; path is a new folder that all executors share. Steps without rows start the query, too.
    """
    spark = table.sparkSession
    table.withColumn("_step", step.cast("int")).where(F.col("_step").between(0, n - 1)).write.partitionBy("_step").parquet(f"{path}/staged")
    schema = StructType([*table.schema.fields, StructField("_step", IntegerType())])
    spark.createDataFrame([], table.schema).write.parquet(f"{path}/in/_step=-1")
    for k in range(n):
        _move(spark, f"{path}/staged/_step={k}", f"{path}/in/_step={k}")
        stream = spark.readStream.schema(schema).parquet(f"{path}/in").drop("_step")
        out = query(stream)
        out.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/out")
