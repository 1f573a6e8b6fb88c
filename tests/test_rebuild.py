"""Only what changed is redone."""

from pyspark.sql import functions as F

from panelmill.operators.rebuild import build, current, fingerprints, manifest


def test_changes(spark, tmp_path):
    at, made = str(tmp_path / "t"), []
    columns = "fig bigint, n int, content binary"

    def make(rows):
        made.append(sorted(r.fig for r in rows.select("fig").distinct().collect()))
        return rows.groupBy("fig").agg(F.sum("n").alias("total"))

    def state():
        return sorted(tuple(r) for r in current(spark, at).collect())

    first = [(i, i, b"x") for i in range(20)] + [(3, 4, b"y")]
    build(at, spark.createDataFrame(first, columns), ["fig"], make)
    assert made == [list(range(20))] and state()[3] == (3, 7)
    # the same rows in another order: nothing is redone
    _, log = build(at, spark.createDataFrame(first[::-1], columns), ["fig"], make)
    assert len(made) == 1 and log["build"] == 1
    # one changed in its bytes, one gone, one added, one row of a figure gone
    second = [(i, n, b"z" if i == 7 else c) for i, n, c in first if i != 5 and (i, n) != (3, 4)] + [(99, 1, None)]
    _, log = build(at, spark.createDataFrame(second, columns), ["fig"], make)
    assert made[1] == [3, 7, 99] and (log["redone"], log["gone"], log["kept"]) == (3, 1, 17)
    assert state() == sorted((i, i) for i in range(20) if i != 5) + [(99, 1)]
    # a build that was cut off before its manifest leaves the one before in force
    spark.createDataFrame([(1, 1)], "fig bigint, total bigint").withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"{at}/rows/build=3")
    assert state()[-1] == (99, 1) and manifest(spark, at)["build"] == 2
    # other settings: all are redone
    build(at, spark.createDataFrame(second, columns), ["fig"], make, settings="k=2")
    assert len(made[2]) == 20 and len(state()) == 20
    # all vanish
    build(at, spark.createDataFrame([], columns), ["fig"], make, settings="k=2")
    assert state() == []


def test_prints(spark):
    a = spark.createDataFrame([(1, "x", None)], "k int, a string, b string")
    prints = {fingerprints(df, ["k"]).first()["print"] for df in (a, a.selectExpr("k", "b as a", "a as b"), a.withColumn("b", F.lit("")), a.withColumn("a", F.lit(None).cast("string")))}
    assert len(prints) == 4


def test_renewed_run(spark, tmp_path):
    from panelmill.plans.run import renewed
    from panelmill.plans.stage_queries import example_models

    def inputs(captions):
        figures = spark.createDataFrame([(i, i + 5, "c", 100, 100, b"x", t) for i, t in captions.items()], "fig bigint, article_id bigint, image_cluster_id string, width int, height int, content binary, caption string")
        articles = spark.createDataFrame([(i + 5, "c", "t", "c", "CC0", ["x"]) for i in captions], "article_id bigint, image_cluster_id string, title string, citation string, license string, context array<string>")
        return figures, articles

    at = str(tmp_path / "r")
    rows, log = renewed(spark, *inputs({1: "one two", 2: "three four", 3: "whole"}), example_models(), at)
    assert log["redone"] == 3 and {r.fig for r in rows.collect()} == {1, 2, 3}
    rows, log = renewed(spark, *inputs({1: "one two", 2: "five six", 7: "seven eight"}), example_models(), at)
    assert (log["redone"], log["gone"], log["kept"]) == (2, 1, 1)
    assert {(r.fig, r.subcaption_text) for r in rows.collect()} >= {(1, "one"), (2, "five"), (7, "seven")} and 3 not in {r.fig for r in rows.collect()}
