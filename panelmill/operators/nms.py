"""Greedy non-maximum suppression as array expressions, one row for each figure's boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.functions.boxes import iou

_TYPE = "array<struct<rank:double,id:bigint,x0:double,y0:double,x1:double,y1:double>>"


def _kept(boxes: Column, limit: float) -> Column:
    """The ids that stay, taken by falling score and then id."""
    step = lambda acc, b: F.when(F.exists(acc, lambda k: iou(k, b) > limit), acc).otherwise(F.concat(acc, F.array(b)))
    return F.transform(F.aggregate(F.array_sort(boxes), F.array().cast(_TYPE), step), lambda b: b["id"])


def nms(boxes: DataFrame, by: list[str], limit: float = 0.3, least_score: float | None = None) -> DataFrame:
    """by and id of the boxes (id, x0, y0, x1, y1, score) that survive within each group of by."""
    if least_score is not None:
        boxes = boxes.where(F.col("score") >= least_score)
    one = F.struct((-F.col("score")).cast("double").alias("rank"), F.col("id").cast("bigint").alias("id"), *[F.col(n).cast("double").alias(n) for n in ("x0", "y0", "x1", "y1")])
    kept = boxes.groupBy(*by).agg(F.collect_list(one).alias("boxes"))
    return kept.select(*by, F.explode(_kept(F.col("boxes"), limit)).alias("id"))


def offset_nms(boxes: DataFrame, figure: str = "fig", kind: str = "cls", width: str = "width", limit: float = 0.3) -> DataFrame:
    """fig and id of the boxes that survive when each class lies beside the others, its number times (width + 1) to
    the right: boxes of two classes never meet while they lie inside the width."""
    by = F.col(kind) * (F.col(width) + 1)
    return nms(boxes.withColumn("x0", F.col("x0") + by).withColumn("x1", F.col("x1") + by), [figure], limit)


def split_nms(boxes: DataFrame, figure: str = "fig", kind: str = "cls", classwise: tuple = (0, 1), limit: float = 0.3, least_score: float | None = None) -> DataFrame:
    """Panels and identifiers survive if they do among all of them or within their class; images, among images."""
    if least_score is not None:
        boxes = boxes.where(F.col("score") >= least_score)
    # one grouping: the boxes of a figure with their class, split up inside the row
    one = F.struct((-F.col("score")).cast("double").alias("rank"), F.col("id").cast("bigint").alias("id"), *[F.col(n).cast("double").alias(n) for n in ("x0", "y0", "x1", "y1")], F.col(kind).alias("cls"))
    every = boxes.groupBy(figure).agg(F.collect_list(one).alias("boxes"))
    of = lambda test: F.transform(F.filter("boxes", lambda b: F.coalesce(test(b["cls"]), F.lit(False))), lambda b: b.dropFields("cls"))
    kept = [of(lambda c: c.isin(*classwise)), *[of(lambda c, k=k: c == k) for k in classwise], of(lambda c: ~c.isin(*classwise))]
    ids = F.array_distinct(F.concat(*[_kept(b, limit) for b in kept]))
    return every.select(figure, F.explode(ids).alias("id"))
