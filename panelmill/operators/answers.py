"""Agreement of annotators, or of a model's answers, on the panels of a figure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_kind(kinds: Column) -> Column:
    """Aggregate: all answers without evidence, or all with some and all of it of one kind."""
    some = F.flatten(F.collect_list(kinds))
    none, empty = F.count_if(kinds.isNull()), F.count_if(F.size(kinds) == 0)
    return (none == F.count("*")) | ((none == 0) & (empty == 0) & (F.size(F.array_distinct(some)) == 1))


def panel_agreement(answers: DataFrame) -> DataFrame:
    """fig, panel_id, assigned_subcaption, confidences, confidence (their mean), reject of the figures whose answers agree.

    answers (fig, annotator, panel_id, subcaption, kinds, confidence, reject): kinds are the kinds of evidence given, null without
    evidence. A figure agrees unless panels are rejected but none by all annotators, or a panel with several answers has
    two captions or evidence of two kinds. One row for each answer; an annotator without any is not seen.
    """
    n = answers.groupBy("fig").agg(F.count_distinct("annotator").alias("annotators"))
    rejects = answers.where("reject").groupBy("fig", "panel_id").agg(F.count_distinct("annotator").alias("by")).join(n, "fig")
    torn = rejects.groupBy("fig").agg(F.max(F.col("by") == F.col("annotators")).alias("same")).where("not same").select("fig")
    first = lambda c: F.min_by(c, F.struct("annotator", "confidence"))
    each = answers.groupBy("fig", "panel_id").agg(
        F.count("*").alias("votes"), (F.count_distinct("subcaption") + F.max(F.col("subcaption").isNull().cast("int")) == 1).alias("one"), _one_kind(F.col("kinds")).alias("alike"),
        F.max("subcaption").alias("assigned_subcaption"), F.transform(F.array_sort(F.collect_list(F.struct("annotator", "confidence"))), lambda x: x["confidence"]).alias("confidences"), F.avg("confidence").alias("confidence"), first("reject").alias("rejected"),
    )
    fails = each.where("votes > 1 and not (one and alike)").select("fig").distinct()
    kept = each.join(torn.union(fails).distinct(), "fig", "left_anti")
    reject = F.when(F.col("votes") == 1, F.col("rejected")).otherwise(F.col("rejected") | F.col("assigned_subcaption").isNull())
    return kept.select("fig", "panel_id", "assigned_subcaption", "confidences", "confidence", reject.alias("reject"))


def placed_agreement(answers: DataFrame) -> DataFrame:
    """fig, panel_id, assigned_subcaption, images, confidences of the figures whose answers by place agree.

    answers (fig, annotator, n, subcaption, images, kinds, confidence): of an annotator's answers on one caption the last (by n)
    counts. A figure agrees if each caption has one set of images, and evidence of one kind, from all who name it.
    """
    last = answers.groupBy("fig", "annotator", "subcaption").agg(F.max_by(F.struct(F.array_sort(F.array_distinct("images")).alias("images"), "kinds", "confidence"), "n").alias("a"))
    each = last.select("fig", "annotator", "subcaption", "a.*").groupBy("fig", "subcaption").agg(
        (F.count_distinct("images") == 1).alias("one"), _one_kind(F.col("kinds")).alias("alike"), F.min("images").alias("images"), F.transform(F.array_sort(F.collect_list(F.struct("annotator", "confidence"))), lambda x: x["confidence"]).alias("confidences"),
    )
    fails = each.where("not (one and alike)").select("fig").distinct()
    return each.join(fails, "fig", "left_anti").select("fig", F.concat(F.lit("panel_"), F.coalesce(F.col("subcaption").cast("string"), F.lit("None"))).alias("panel_id"), F.col("subcaption").alias("assigned_subcaption"), "images", "confidences")
