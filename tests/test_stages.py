"""Stages around models, with small functions in place of models."""

import json

from pyspark.sql import functions as F

from panelmill.__main__ import main
from panelmill.plans import stages


def test_applied(spark):
    def load():
        calls = []

        def model(row):
            calls.append(row["i"])
            if row["i"] == 1 or (row["i"] == 2 and calls.count(2) < 2):
                raise ValueError("no")
            return [{"x": row["i"] * 10 + k} for k in range(row["i"] % 3 + (row["i"] == 2))]

        return model

    df = spark.createDataFrame([(i, "extra") for i in range(4)], "i int, x string").coalesce(1)
    out = stages.applied(df, load, ["i"], "x bigint", wait=0)
    assert sorted(map(tuple, out.collect()), key=str) == [(1, None, "ValueError: no"), (2, 20, None), (2, 21, None), (2, 22, None)]
    assert stages.applied(df.limit(0), load, ["i"], "x bigint").count() == 0


def test_detections(spark, tmp_path):
    def load():
        b = {"x0": 0.0, "y0": 0.0, "x1": 50.0, "y1": 50.0, "cls": 0, "score": 0.9}
        return lambda row: [b, b | {"x1": 51.0, "score": 0.8}, b | {"x0": 60.0, "x1": 300.0, "score": 0.7}, b | {"x0": 200.0, "x1": 300.0}] if row["fig"] else 1 / 0

    figures = spark.createDataFrame([(1, 100.0, 100.0, b"")], "fig bigint, width double, height double, content binary")
    rows = [(r.id, r.x1, r.survives_nms) for r in stages.detections(figures, load, f"{tmp_path}/a").orderBy("id").collect()]
    assert rows == [(1, 50, True), (2, 51, False), (3, 100, True)]
    broken = figures.withColumn("fig", F.lit(0).cast("bigint"))
    assert [(r.fig, r.survives_nms, r.error[:17]) for r in stages.detections(broken, load, f"{tmp_path}/b").collect()] == [(0, False, "ZeroDivisionError")]


def test_caption_splits(spark, tmp_path):
    def name():
        return lambda row: [{"answer": "<think>x</think> None" if "(" not in row["caption"] else "a, b"}]

    def split():
        return lambda row: [{"answer": '{"a": "one", "b": "two"' if row["names"] == "a, b" and "bad" not in row["caption"] else "?"}]

    df = spark.createDataFrame([(1, "plain"), (2, "(a) one (b) two"), (3, "(bad)")], "caption_id bigint, caption string")
    out = sorted(tuple(r) for r in stages.caption_splits(df, name, split, str(tmp_path)).na.fill("").collect())
    assert out == [(1, "", "plain", True, ""), (2, "", "(a) one (b) two", True, ""), (2, "a", "one", False, ""), (2, "b", "two", False, ""), (3, "", "", False, "no JSON object of parts"), (3, "", "(bad)", True, "")]


def test_label_texts(spark, tmp_path):
    def ocr():
        return lambda row: [{"text": row["content"].decode()[0], "confidence": len(row["content"]) / 10}] if row["content"] else []

    labels = spark.createDataFrame([(1, 1, b"A"), (2, 1, b""), (3, 2, b""), (4, None, None)], "label_id bigint, panel_id bigint, content binary")
    panels = spark.createDataFrame([(1, b"Bxxxxxxxx"), (2, b"C")], "panel_id bigint, content binary")
    assert sorted((r.label_id, r.text, r.source) for r in stages.label_texts(labels, panels, ocr, str(tmp_path)).collect()) == [(1, "A", "label"), (2, "B", "panel"), (3, None, None), (4, None, None)]


def test_matched_images(spark):
    shape = "article bigint, {} bigint, number int, hashes struct<a:bigint,b:bigint,c:bigint>"
    images = spark.createDataFrame([(1, 1, 1, (0, 0, 0)), (1, 2, 2, (0, 0, -1)), (1, 3, None, (-1, -1, -1)), (2, 4, 1, (0, 0, 0))], shape.format("image_id"))
    figures = spark.createDataFrame([(1, 7, 2, (1, 1, 1)), (1, 8, 3, (0, 0, 0))], shape.format("figure_id"))
    out = stages.matched_images(images, figures, {"a": 4, "b": 4, "c": 4})
    assert sorted((r.image_id, r.figure_id, r.reason) for r in out.collect()) == [(1, 8, None), (2, 7, None), (3, None, "no figure is near"), (4, None, "nothing extracted")]


def test_matched_by_four_tests(spark):
    """Number, look, caption, aspect ratio: two are enough for an image without number, else more or the number."""
    shape = "article bigint, {} bigint, number int, hashes struct<a:bigint,b:bigint,c:bigint,d:bigint>, caption string, aspect double"
    near, far, text = (0, 0, 0, 0), (-1, -1, -1, -1), "Cells of the left eye after four weeks of care"
    images = [(1, None, near, text, 1.0), (2, 1, near, text, 1.0), (3, 1, near, "none", 9.0), (4, 1, far, text, 1.0), (5, None, far, "none", 1.0), (6, None, far, text, 1.02), (7, None, far, "none", 1.0)]
    figures = [(1, 5, near, "other words altogether, and many", 1.0), (2, 2, near, f"Figure 2. {text}", 9.0), (3, 1, near, "other words altogether", 5.0), (4, 2, far, f"Fig 2: {text}", 1.04), (5, 2, near, "other words altogether", 1.0), (6, 9, near, f"Figure 9. {text}", 1.0), (7, 3, near, "Figure 3. Continued", 1.0)]
    images = spark.createDataFrame([(i, i, *r) for i, *r in images], shape.format("image_id"))
    figures = spark.createDataFrame([(i, i + 10, *r) for i, *r in figures], shape.format("figure_id"))
    out = {r.image_id: r.figure_id for r in stages.matched_images(images, figures, {}, holds=stages.likeness).collect()}
    # 1: look and ratio, no number; 2: look and caption, other number; 3: number and look; 4: all but the number; 5: ratio; 6, 7: caption and ratio
    assert out == {1: 11, 2: None, 3: 13, 4: 14, 5: None, 6: 16, 7: 17}


def test_refinement(spark, tmp_path):
    def ask():
        return lambda row: [{"answer": "same" if row["i"] == 1 else f"{row['i']}-{row['poll']}"}]

    def judge():
        return lambda row: [{"answer": row["options"][0] if row["i"] == 2 else "made up"}]

    items = spark.createDataFrame([(1, None), (2, None), (3, None)], "i bigint, answer string")
    out = stages.refined(items.select("i"), ask, judge, ["i"], f"{tmp_path}/polls")
    assert sorted(map(tuple, out.collect())) == [(1, "same", False, None), (2, "2-1", True, None), (3, None, True, "answer outside the options")]
    def broken():
        raise_it = lambda row: 1 / 0
        return raise_it

    none = stages.refined(items.select("i"), broken, judge, ["i"], f"{tmp_path}/none", 1)
    assert [(r.answer, r.reason) for r in none.collect()] == [(None, "no poll answered")] * 3
    failed = stages.refined(items.select("i").where("i = 2"), ask, broken, ["i"], f"{tmp_path}/failed")
    assert [(r.answer, r.reason[:17]) for r in failed.collect()] == [(None, "ZeroDivisionError")]
    rounds = []

    def step(df):
        rounds.append(df.count())
        return df.withColumn("answer", F.when(F.col("i") <= len(rounds), "x"))

    done = stages.until_stable(items, F.col("answer").isNull(), step, ["i"], f"{tmp_path}/rounds", 5)
    assert rounds == [3, 2, 1] and done.where("answer is null").count() == 0 and done.count() == 3


def test_branches(spark):
    df = spark.range(6)
    out = stages.by_branch(df, [(F.col("id") < 2, lambda x: x.withColumn("b", F.lit("low"))), (F.col("id") < 4, lambda x: x.withColumn("b", F.lit("mid")))])
    assert sorted(map(tuple, out.collect())) == [(0, "low"), (1, "low"), (2, "mid"), (3, "mid")]


def test_command_line(spark, tmp_path, capsys):
    assert main(["list"]) == 0 and "eligible_panels" in capsys.readouterr().out
    assert main(["sql", "eligible_panels"]) == 0 and "select" in capsys.readouterr().out.lower()
    assert main(["run", "eligible_panels", "--data", "/root/testdata/sf0.001", "--out", f"{tmp_path}/out"]) == 0
    assert json.loads(spark.read.parquet(f"{tmp_path}/out").limit(1).toJSON().first())


def test_build_goes_on(spark, tmp_path, capsys):
    """A build that stopped after a step does the rest, and does not do again what is there."""
    figures = spark.createDataFrame([(1, 11, "c", 100, 100, bytearray(b"x"), "one two"), (3, 12, "c", 100, 100, bytearray(b"x"), "three four")], "fig long, article_id long, image_cluster_id string, width int, height int, content binary, caption string")
    figures.write.parquet(f"{tmp_path}/figures")
    spark.createDataFrame([(11, "c", "t", "c", "CC0", ["x"])], "article_id long, image_cluster_id string, title string, citation string, license string, context array<string>").write.parquet(f"{tmp_path}/articles")
    args = ["build", "--figures", f"{tmp_path}/figures", "--articles", f"{tmp_path}/articles", "--path", f"{tmp_path}/run", "--models"]
    assert main(["steps"]) == 0 and capsys.readouterr().out.split() == ["boxes", "captions", "texts", "assembled", "rows"]
    assert main([*args, "panelmill.plans.stage_queries:example_models", "--step", "captions"]) == 0
    assert not (tmp_path / "run/rows").exists()
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "run/captions").iterdir()}
    assert main([*args, "panelmill.plans.stage_queries:example_models"]) == 0
    rows = spark.read.parquet(f"{tmp_path}/run/rows").collect()
    assert sorted((r.panel_id, r.panel_name, r.subcaption_text, r.license) for r in rows) == [("p_1000001", "A", "one", "CC0"), ("p_1000002", "B", "two", "CC0"), ("p_3000001", "None", "three four", None)]
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "run/captions").iterdir()}
