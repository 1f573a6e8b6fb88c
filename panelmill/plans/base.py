"""Registry of queries, and the tables that stand in for the engine's own.

B, boxes in figures of 25, comes from embeddings; lineitem, orders, customer and nation stand for panels,
predictions, figures and articles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self._read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        return self._read(name)

    def boxes(self) -> DataFrame:
        e = lambda i: F.get("embedding", F.lit(i)).cast("double")
        x0, y0 = F.abs(e(0)), F.abs(e(1))
        out = self._read("embeddings").select(F.col("vec_id").alias("id"), F.floor(F.col("vec_id") / 25).alias("fig"), F.col("label").alias("cls"), x0.alias("x0"), y0.alias("y0"), (x0 + F.abs(e(2)) + 0.1).alias("x1"), (y0 + F.abs(e(3)) + 0.1).alias("y1"), F.abs(e(4)).alias("score"))
        return out.withColumn("box", F.struct("x0", "y0", "x1", "y1"))


B = """with b0 as (select vec_id as id, vec_id // 25 as fig, label as cls, abs(embedding[1]::double) as x0, abs(embedding[2]::double) as y0,
  abs(embedding[3]::double) as w, abs(embedding[4]::double) as h, abs(embedding[5]::double) as score from embeddings),
b as (select id, fig, cls, x0, y0, x0 + w + 0.1 as x1, y0 + h + 0.1 as y1, score from b0),
pair as (select p.fig, p.id as p_id, c.id as c_id, p.cls as p_cls, c.cls as c_cls, c.x0, c.y0, c.x1, c.y1, p.score as p_score, c.score as c_score,
  greatest(least(p.x1, c.x1) - greatest(p.x0, c.x0), 0) * greatest(least(p.y1, c.y1) - greatest(p.y0, c.y0), 0) as i,
  (p.x1 - p.x0) * (p.y1 - p.y0) as pa, (c.x1 - c.x0) * (c.y1 - c.y0) as ca from b p join b c on p.fig = c.fig and p.id <> c.id)
"""


def near(*columns: str) -> list[Column]:
    return [F.round(c, 6).alias(c) for c in columns]
