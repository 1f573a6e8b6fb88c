"""Figures are asked again without their tables going through the driver."""

from pyspark.sql import functions as F

from panelmill.operators import screens
from panelmill.plans.stages import stored


def test_no_table_of_figures_is_broadcast(spark, tmp_path):
    ids = spark.range(300).select(F.col("id").alias("fig"))
    panels = ids.select("fig", F.lit(1).alias("panel_id"), F.lit(False).alias("is_final"), F.struct(*[F.lit(x).alias(n) for n, x in (("x0", 0.0), ("y0", 0.0), ("x1", 9.0), ("y1", 9.0))]).alias("content"))
    of = lambda c, v: ids.select("fig", F.lit(v).alias(c))
    options = screens.allowed(ids.select("fig", F.lit(10).alias("width"), F.lit(10).alias("height")), panels, of("label_id", 5), of("image_id", 6), of("name", "A"))
    plans = []

    def keep(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, path)

    panel, place = '{"assignments": [{"panel_id": %s, "assigned_subcaption": "A", "confidence": 1}]}', '{"assignments": [{"assigned_images": [6], "assigned_subcaption": "A", "confidence": 1}]}'
    first = F.when(F.col("fig") % 4 == 0, panel % 1).when(F.col("fig") % 4 == 1, place).when(F.col("fig") % 4 == 2, panel % 7).otherwise("sorry")
    ask = lambda todo, path: todo.select("fig", F.when((F.size("reasons") > 0) & (F.col("fig") % 4 == 2), panel % 1).otherwise(first).alias("answer"))
    passed, left = screens.asked_again(ids, ask, options, keep, str(tmp_path), rounds=2)
    assert sorted((r.fig, r.round) for r in passed.collect()) == [(i, 1 + (i % 4 == 2)) for i in range(300) if i % 4 < 3]
    assert {(r.fig, *r.reasons) for r in left.collect()} == {(i, "no assignments") for i in range(3, 300, 4)}
    assert sum("Join" in p for p in plans) > 6 and not [p for p in plans if "Broadcast" in p]
