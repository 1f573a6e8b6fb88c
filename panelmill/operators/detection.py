"""How well boxes are found: ranked one-to-one matching, average precision by class, the median overlap.

Equal scores are one step of the ranking. A class without a true box has no average precision and does not count in the mean; one
whose true boxes are never found has 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.functions.boxes import iou
from panelmill.operators.assembly import in_order
from panelmill.operators.spatial import spatial_join

#: Scores (0 to 1) are ranked in so many ranges at once: no class is ranked in one task.
RANGES = 1000


def hits(found: DataFrame, truth: DataFrame, least: float = 0.5) -> DataFrame:
    """found (fig, id, cls, score, box) with hit: whether a true box (fig, id, cls, box) stands for it.

    By falling score, then id, each found box takes the true box of its figure and class that it overlaps most (then the least id),
    at least `least`, if none before has taken it.
    """
    key = lambda df: df.select(F.struct("fig", "cls").alias("fig"), "id", "box")
    pairs = spatial_join(key(truth), key(found), condition=lambda t, f: iou(t, f) >= least).select("fig", F.col("child_id").alias("id"), F.col("parent_id").alias("truth_id"), iou(F.col("parent"), F.col("child")).alias("overlap"))
    pairs = pairs.join(found.select(F.struct("fig", "cls").alias("fig"), "id", "score"), ["fig", "id"])
    taken = in_order(pairs, "fig", "id", "truth_id", [-F.col("score").cast("double"), F.col("id"), -F.col("overlap"), F.col("truth_id")])
    return found.join(taken.select("fig.fig", "fig.cls", "id", F.lit(True).alias("hit")), ["fig", "cls", "id"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def precision_steps(ranked: DataFrame, truths: DataFrame) -> DataFrame:
    """cls, score, n_truths, found, right, precision, recall and envelope (the best precision at this recall or a later one) of each step.

    ranked (cls, score, hit), truths (cls, n_truths). Scores run in RANGES ranges: sums and the best precision of whole ranges, a
    thousand rows for each class, are combined with those inside a range.
    """
    place = F.least(F.greatest(F.floor(F.col("score") * RANGES), F.lit(0)), F.lit(RANGES)).alias("_r")
    steps = ranked.groupBy("cls", "score").agg(F.count("*").alias("n"), F.count_if("hit").alias("h")).select("*", place)
    upto = Window.partitionBy("cls", "_r").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("cls").orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = steps.groupBy("cls", "_r").agg(F.sum("n").alias("_n"), F.sum("h").alias("_h"))
    ranges = ranges.select("cls", "_r", F.coalesce(F.sum("_n").over(whole), F.lit(0)).alias("_n"), F.coalesce(F.sum("_h").over(whole), F.lit(0)).alias("_h"))
    steps = steps.join(ranges, ["cls", "_r"]).join(truths.where("n_truths > 0"), "cls")
    steps = steps.select("cls", "score", "_r", "n_truths", (F.sum("n").over(upto) + F.col("_n")).alias("found"), (F.sum("h").over(upto) + F.col("_h")).alias("right"), "h")
    steps = steps.withColumns({"precision": F.col("right") / F.col("found"), "recall": F.col("right") / F.col("n_truths")})
    after = Window.partitionBy("cls").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    later = steps.groupBy("cls", "_r").agg(F.max("precision").alias("_p")).select("cls", "_r", F.max("_p").over(after).alias("_p"))
    below = Window.partitionBy("cls", "_r").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    return steps.join(later, ["cls", "_r"]).select("cls", "score", "n_truths", "found", "right", "h", "precision", "recall", F.greatest(F.max("precision").over(below), F.coalesce("_p", F.lit(0.0))).alias("envelope"))


def average_precision(ranked: DataFrame, truths: DataFrame) -> DataFrame:
    """cls, n_truths, area (the integral of the envelope over recall) and points (its mean at the recalls 0, 0.01, ..., 1)."""
    steps = precision_steps(ranked, truths)
    # the marks k / 100 that a step is the first to reach: those up to its recall, not up to the one before
    marks = lambda right: F.floor(right * 100 / F.col("n_truths") + 1e-9)
    before = F.col("right") - F.col("h")
    sums = steps.groupBy("cls").agg(F.sum(F.col("h") / F.col("n_truths") * F.col("envelope")).alias("area"), F.sum((marks(F.col("right")) - marks(before)) * F.col("envelope")).alias("marks"), F.max("envelope").alias("first"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return truths.where("n_truths > 0").join(sums, "cls", "left").select("cls", "n_truths", zero(F.col("area")).alias("area"), zero((F.col("marks") + F.col("first")) / 101).alias("points"))


def detection_quality(found: DataFrame, truth: DataFrame, least: float = 0.5) -> DataFrame:
    """As average_precision, from boxes: found (fig, id, cls, score, box), truth (fig, id, cls, box)."""
    return average_precision(hits(found, truth, least), truth.groupBy("cls").agg(F.count("*").alias("n_truths")))


def mean_precision(by_class: DataFrame) -> DataFrame:
    return by_class.agg(F.avg("area").alias("area"), F.avg("points").alias("points"), F.count("*").alias("n_classes"))


def best_overlaps(truth: DataFrame, found: DataFrame) -> DataFrame:
    """fig, id and best: of each true box the greatest overlap with a found one of its figure; 0 if none touches it."""
    pairs = spatial_join(truth, found, condition=lambda t, f: iou(t, f) > 0).groupBy("fig", F.col("parent_id").alias("id")).agg(F.max(iou(F.col("parent"), F.col("child"))).alias("best"))
    return truth.select("fig", "id").join(pairs, ["fig", "id"], "left").withColumn("best", F.coalesce("best", F.lit(0.0)))


def median_overlap(truth: DataFrame, found: DataFrame, *by: Column) -> DataFrame:
    return best_overlaps(truth, found).groupBy(*by).agg(F.median("best").alias("median"), F.count("*").alias("n"))
