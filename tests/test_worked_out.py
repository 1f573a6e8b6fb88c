"""Steps whose work must not grow faster than their rows."""

from pyspark.sql import functions as F

from panelmill.operators.persist import resumed
from panelmill.operators.relational import lots, worked_out


def test_worked_out_once(spark):
    df = spark.range(10).withColumn("x", F.rand(1))
    x = F.transform(F.array("id", "x"), lambda v: v * 12345.0)
    plan = worked_out(df, {"x": x}).where("x[0] > 1 and x[1] > 1 and size(x) > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("12345.0") == 1
    rows = [(r.id, r.x[0]) for r in worked_out(df, {"x": x}).where("x[0] > 100000").collect()]
    assert rows == [(9, 9 * 12345.0)]


def test_partitions_grow_with_rows(spark):
    assert lots(spark.range(1000), spark.range(10), rows=10) == 100 and lots(spark.range(10)) == 8
    panels = spark.range(60).select((F.col("id") % 20).alias("fig"), F.col("id").alias("panel_id"))
    state = panels.select("fig", "panel_id", F.when(F.col("panel_id") != 41, "done").alias("state"))
    out = resumed(state, panels, "fig", F.col("state") == "done", lambda todo: panels.join(todo, "fig").withColumn("state", F.lit("again")))
    assert sorted((r.fig, r.panel_id) for r in out.where("state = 'again'").collect()) == [(1, 1), (1, 21), (1, 41)] and out.count() == 60


def test_archives_are_written_batch_by_batch(spark, tmp_path):
    from panelmill.sources.shards import shards, write_shards

    rows = spark.range(50).select((F.col("id") % 20).alias("s"), F.concat(F.lit("m"), F.col("id"), F.lit(".txt")).alias("m"), F.col("id").cast("string").cast("binary").alias("b"))
    out = write_shards(rows, f"file://{tmp_path}", "s", "m", "b")
    assert "FlatMapGroups" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sum(r.members for r in out.collect()) == 50
    assert sorted(int(bytes(r.content)) for r in shards(spark, f"file://{tmp_path}").collect()) == list(range(50))


def test_key_with_many_rows_meets_by_time(spark):
    from panelmill.streaming.stateful import within

    side = lambda n, at: spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias(n), F.timestamp_seconds(F.col("id") * 400 + at).alias(f"{n}_at"))
    out = within(side("a", -100_000), side("b", -99_700), ["k"], "a_at", "b_at", "10 minutes")
    assert sorted((r.a, r.b) for r in out.select("a", "b").collect()) == [(i, i) for i in range(2000)]
    assert "_lot" in out._jdf.queryExecution().optimizedPlan().toString()


def test_each_box_is_read_once(spark, tmp_path):
    from panelmill.plans.run import Run
    from panelmill.plans.stage_queries import example_models

    models, asked = example_models(), f"{tmp_path}/asked"
    own = models.read()

    def read():
        def model(row):
            with open(asked, "a") as f:
                f.write(f"{row['fig']} {row['box']['x0']} {row['box']['x1']}\n")
            return own(row)

        return model

    models.read = read
    figures = spark.createDataFrame([(i, i, "c", 100, 100, b"x", "one two") for i in range(1, 4)], "fig bigint, article_id bigint, image_cluster_id string, width int, height int, content binary, caption string")
    articles = spark.createDataFrame([(i, "c", "t", "c", "CC0", ["x"]) for i in range(1, 4)], "article_id bigint, image_cluster_id string, title string, citation string, license string, context array<string>")
    assert Run(spark, figures, articles, models, f"file://{tmp_path}/run").rows().count() == 5
    lines = open(asked).read().splitlines()
    assert len(lines) == len(set(lines)) == 6


def test_reasons_are_grouped_once(spark):
    from panelmill.operators.screens import reasons

    kind = "fig bigint, broken array<struct<rule:string,value:string>>"
    options = spark.createDataFrame([(i, [], ["7"], [], []) for i in (1, 2, 3)], "fig bigint, panels array<struct<id:string>>, label_ids array<string>, image_ids array<string>, names array<string>")
    rows = [(1, [("unknown label", "9"), ("final panel", "3")]), (1, [("unknown label", "8"), ("unknown label", "9")]), (2, [("final panel", "3")]), (3, [("no caption", None)])]
    out = reasons(spark.createDataFrame(rows, kind), options)
    assert {r.fig: r.reasons for r in out.collect()} == {1: ["unknown label: [8, 9]; valid: [7]", "final panel: [3]"], 3: ["no caption: []"]}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
