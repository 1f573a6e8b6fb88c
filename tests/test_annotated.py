"""Annotated figures: what was found where, and what was not."""

from pyspark.sql import functions as F

from panelmill.operators import annotations as ann


def test_annotated_figures_without_regions(spark):
    """Figure 1 was annotated and has no panel, figure 2 has no image; the model speaks for neither where annotators did."""
    shape = "fig bigint, id bigint, kind string"
    whole = lambda df: df.select("fig", "id", "kind", F.lit(1.0).alias("score"), F.lit("Plain").alias("marked"), F.lit(1.0).alias("marked_score"), F.lit(None).cast("string").alias("box"), F.lit(True).alias("survives_nms"))
    known = lambda rows: whole(spark.createDataFrame(rows, shape)).withColumn("source", F.lit("annotation"))
    model = whole(spark.createDataFrame([(f, 10 * f + i, k) for f in range(4) for i, k in enumerate(("Panel", "CFP"))], shape))
    done = spark.createDataFrame([(0, False), (1, False), (2, True)], "fig bigint, images boolean")
    out = ann.known_predictions(known([(0, 100, "Panel")]), known([]), model, done)
    assert sorted((r.fig, r.id, r.source) for r in out.collect()) == [(0, 1, "model"), (0, 100, "annotation"), (1, 11, "model")]
