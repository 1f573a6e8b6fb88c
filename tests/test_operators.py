import io
import json
import tarfile

from pyspark.sql import functions as F

from panelmill.functions import boxes as bx, text as tx
from panelmill.operators import assembly, relational as rel
from panelmill.operators.nms import split_nms
from panelmill.sources import readers, writers
from panelmill.streaming.incremental import process_new_files


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def box(*v):
    return bx.box(*map(F.lit, v))


def test_geometry(spark):
    assert abs(one(spark, bx.iou(box(0, 0, 100, 100), box(10, 0, 110, 100))) - 9000 / 11000) < 1e-9
    assert one(spark, bx.overlap(box(2, 2, 12, 12), box(0, 0, 100, 100))) == 1
    assert one(spark, bx.overlap(box(2, 2, 2, 2), box(0, 0, 100, 100))) == 0
    assert tuple(one(spark, bx.to_coco(box(1, 2, 5, 9)))) == (1, 2, 4, 7, 28)
    assert tuple(one(spark, bx.from_percent(*map(F.lit, (10, 20, 30, 40, 200, 100))))) == (20, 20, 80, 60)
    assert tuple(one(spark, bx.page_of(box(120, 0, 180, 1), F.array(F.lit(4), F.lit(5)), F.lit(200.0)))) == (5, 20, 80)
    assert one(spark, bx.clip(box(0, 0, 0.5, 100), F.lit(100), F.lit(100))) is None


def test_split_suppression(spark):
    rows = [(1, 10, "P", 0, 0, 100, 100, 0.9), (2, 10, "P", 10, 0, 110, 100, 0.8), (3, 10, "L", 2, 2, 12, 12, 0.7), (4, 10, "I", 5, 15, 95, 95, 0.6), (5, 10, "J", 5, 15, 95, 95, 0.5), (6, 10, "P", 200, 0, 300, 100, 0.2)]
    rows = [(*r[:3], *map(float, r[3:])) for r in rows]
    df = spark.createDataFrame(rows, "id long, fig long, cls string, x0 double, y0 double, x1 double, y1 double, score double")
    assert sorted(r.id for r in split_nms(df, classwise=("P", "L"), least_score=0.25).collect()) == [1, 3, 4]


def test_names(spark):
    f = lambda s: tuple(one(spark, tx.figure_number(F.lit(s))))
    assert (f("pone.0012-g003"), f("gr2_lrg"), f("fig4b"), f("xyz")) == ((3, None), (2, None), (4, "b"), (None, None))
    assert [one(spark, tx.is_alnum_token(F.lit(s))) for s in ("a1", "ab1", "a1b", "12a", "a12", "a", "1")] == [True, True, True, True, False, False, False]
    kind = lambda *n: tuple(one(spark, tx.name_class(F.array(*map(F.lit, n)))))
    assert kind("A", "B", "C") == (False, True, None, False, True, None)
    assert kind("(a)", "(b)") == (False, True, None, True, True, None) and kind("Above", "below")[2] == "position_in_image" and kind("first", "second")[2] is None and kind("None")[0]
    level = lambda text, name, *names: one(spark, tx.match_level(F.lit(text), F.lit(name), F.array(*map(F.lit, names))))
    assert (level("A ", " A", "A"), level("A", "a", "a"), level("A", "a", "a", "B"), level("(a)", "a", "a"), level("A1", "a", "a")) == (1, 2, None, 3, 6)
    assert [one(spark, tx.word_distance(F.lit(a), F.lit(b))) for a, b in (("a b c", "a c"), ("", "x y"), ("a b", "b a"))] == [1, 2, 2]
    assert tuple(one(spark, tx.parse_uuid(F.lit("PMC12_a_b")))) == (12, "a_b")
    assert one(spark, tx.is_continued(F.lit("Figure 3. Control group"))) is False and one(spark, tx.is_continued(F.lit("Fig. 2: continued"))) is True
    assert one(spark, tx.date_number(F.lit("None"))) == -1


def test_texts(spark):
    assert tuple(one(spark, tx.after_thoughts(F.lit("a</think> b")))) == ("a", "b")
    assert one(spark, tx.keywords(F.lit("<a><kwd-group><kwd>b</kwd><kwd>a</kwd></kwd-group></a>"))) == "a, b"
    seg = F.array(*[F.struct(F.lit(i).alias("start"), F.lit(t).alias("text")) for i, t in ((5, ", b"), (0, "a"), (9, "c"))])
    assert one(spark, tx.join_segments(seg)) == "a, b c"
    assert one(spark, tx.attribution(F.lit("t"), F.lit(None).cast("string"))) == "'t', None"


def test_tables(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, None), (4, 3)], "k long, i long")
    assert {r.k: r.i for r in rel.fill_ids(df, "i", "k").collect()} == {1: 2, 2: 1, 3: 4, 4: 3}
    left, right = spark.createDataFrame([(1,)], "k long"), spark.createDataFrame([(2, 1)], "k long, v long")
    try:
        rel.strict_lookup(left, right, "k").collect()
        raise AssertionError("a missing key must raise")
    except Exception as e:
        assert "no k 1" in str(e)
    many = spark.createDataFrame([(1, 2), (1, 3)], "k long, v long")
    try:
        rel.outer_assembly({"a": right, "b": many}, "k").collect()
        raise AssertionError("a repeated key must raise")
    except Exception as e:
        assert "repeated k 1" in str(e)
    try:
        rel.all_there(left, right, ["k"])
        raise AssertionError("a missing key must raise")
    except ValueError as e:
        assert "(1,)" in str(e)
    rows = spark.createDataFrame([(x,) for x in [5.0, 1.0, None, 3.0, 3.0, 2.0] * 20], "x double")
    out = [(r.n, r.x) for r in rel.numbered(rows, "x").orderBy("n").collect()]
    assert [n for n, _ in out] == list(range(1, 121)) and [x for _, x in out] == sorted([5.0, 1.0, 3.0, 3.0, 2.0] * 20) + [None] * 20


def test_panel_flags(spark):
    panels = spark.createDataFrame([(1, 1, [5]), (1, 2, [6, 7]), (1, 3, [6]), (1, 4, []), (1, 5, [9])], "fig long, panel_id long, label_ids array<long>")
    texts = spark.createDataFrame([(1, 5, None), (1, 6, None), (1, 7, None), (1, -1, 4), (1, -2, 4)], "fig long, label_id long, panel_id long")
    matched = spark.createDataFrame([(1, 5, 50), (1, 6, 60), (1, -1, 70)], "fig long, label_id long, caption_id long")
    out = {r.panel_id: r for r in assembly.panel_flags(panels, texts, matched).collect()}
    assert {k: r.assigned_subcaption for k, r in out.items()} == {1: 50, 2: None, 3: None, 4: None, 5: None}
    assert {k: r.needs_review for k, r in out.items()} == {1: False, 2: True, 3: False, 4: True, 5: True}
    assert [k for k, r in sorted(out.items()) if r.has_shared_labels] == [2, 3] and [k for k, r in out.items() if r.has_estimated_labels] == [4]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a").mkdir()
    with tarfile.open(tmp_path / "a/PMC1.tar.gz", "w:gz") as t:
        for name, body in (("x/a.jpg", b"1"), ("x/a.nxml", b"<a/>"), ("x/a.txt", b"")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    (tmp_path / "a/PMC2.tar.gz").write_bytes(b"none")
    members = readers.archive_members(spark, str(tmp_path / "a"))
    assert sorted(r.kind for r in members.collect() if r.kind) == [".jpg", ".nxml"]
    assert {r.path[-11:]: r.reason for r in readers.package_errors(members).collect()} == {"PMC1.tar.gz": "no pdf", "PMC2.tar.gz": "no archive"}
    result = [{"id": "r", "type": "rectanglelabels", "original_width": 200, "original_height": 100, "value": {"x": 10, "y": 20, "width": 30, "height": 40, "rectanglelabels": ["Panel"]}}, {"id": "r", "type": "textarea", "original_width": 200, "original_height": 100, "value": {"x": 10, "y": 20, "width": 30, "height": 40, "text": ["A"]}}]
    (tmp_path / "t.json").write_text(json.dumps([{"id": 1, "annotations": [{"id": 2, "was_cancelled": False, "result": result}]}]))
    r = readers.task_boxes(readers.tasks(spark, str(tmp_path / "t.json"))).first()
    assert (tuple(r.box), r.labels, r.names, r.conflict) == ((20, 20, 80, 60), ["Panel"], ["A"], False)
    assert [tuple(r) for r in readers.shard_names(spark, {"s": 114}).orderBy("package").collect()][-1] == ("s", 2, "000100", "000114")
    b = spark.createDataFrame([("f.jpg", 1, 0)], "file_name string, id long, category_id int").withColumn("box", box(1, 2, 5, 9))
    images = spark.createDataFrame([(1, "f.jpg", 10, 10)], "id long, file_name string, width int, height int")
    kinds = spark.createDataFrame([(0, "Panel")], "id int, name string")
    writers.coco_document(images, b.select("id", F.lit(1).alias("image_id"), "category_id", "box"), kinds, str(tmp_path / "coco"))
    file = next((tmp_path / "coco").glob("part-*"))
    whole = json.loads(file.read_text())
    assert whole["annotations"][0]["bbox"] == [1, 2, 4, 7] and whole["annotations"][0]["segmentation"] == [[1, 2, 5, 2, 5, 9, 1, 9]]
    assert [tuple(r)[1:3] for r in readers.coco(spark, str(tmp_path / "coco")).collect()] == [("f.jpg", "Panel")]
    assert [r.a for r in readers.wanted_members(members, spark.createDataFrame([("a",)], "a string"), "a").select("a").distinct().collect()] == ["a"]
    cut = (tmp_path / "a/PMC1.tar.gz").read_bytes()
    (tmp_path / "a/PMC3.tar.gz").write_bytes(cut[: len(cut) // 2])
    found = readers.archive_members(spark, str(tmp_path / "a")).collect()
    assert {r.path[-11:] for r in found if r.error} == {"PMC2.tar.gz", "PMC3.tar.gz"} and sum(r.kind == ".nxml" for r in found) >= 1


def test_new_files_once(spark, tmp_path):
    src, sink, check = (str(tmp_path / n) for n in ("src", "sink", "check"))
    spark.range(10).write.parquet(src)
    for _ in range(2):
        process_new_files(spark, src, "id long", check, lambda d: d, sink)
    assert spark.read.parquet(sink).count() == 10


def test_oversample_many_labels(spark):
    df = spark.range(2500).withColumn("label", F.when(F.col("id") < 3, 0).otherwise(F.col("id")))
    out = rel.oversample(df, "label")
    assert out.count() == 3 + 2497 * 3 and out.select("id").distinct().count() == 2500
