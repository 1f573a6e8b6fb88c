"""The archive source: pushed filters, the Bloom filter, bytes that are read."""

import io
import tarfile

from panelmill.sources import shards


def archive(path, members, mode="w"):
    with tarfile.open(path, mode) as t:
        for name, body in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))


def test_source(spark, tmp_path):
    archive(tmp_path / "a.tar", {f"d/{i}.txt": b"x" * i for i in range(50)} | {"7.jpg": b"picture"})
    archive(tmp_path / "b.tar.gz", {"7.txt": b"other", "note": b"n"}, "w:gz")
    (tmp_path / "c.txt").write_text("no archive")
    at = f"file://{tmp_path}"
    every = shards.shards(spark, at)
    assert every.count() == 53 and every.rdd.getNumPartitions() == 2
    assert sorted((r.key, r.kind, bytes(r.content)) for r in every.where("key = '7'").collect()) == [("7", ".jpg", b"picture"), ("7", ".txt", b"other"), ("7", ".txt", b"x" * 7)]
    one = every.where(f"path = '{at}/b.tar.gz' and kind in ('.txt', '.jpg')")
    assert one.rdd.getNumPartitions() == 1 and [r.member for r in one.collect()] == ["7.txt"]
    assert every.where("key = '7' and size > 6").count() == 2  # what is not pushed is filtered by Spark
    assert {r.content for r in shards.shards(spark, at, content="false").collect()} == {None}


def test_wanted(spark, tmp_path):
    archive(tmp_path / "a.tar", {f"{i}.txt": b"y" * 1000 for i in range(200)})
    wanted = spark.createDataFrame([("5",), ("é",), ("150",), (None,), ("nowhere",)], "id string")
    at = f"file://{tmp_path}"
    assert sorted(r.key for r in shards.shards(spark, at, wanted, "id").collect()) == ["150", "5"]
    read = spark.read.format("tar_shards").option("wanted", shards.wanted_filter(wanted, "id")).option("counts", "true").load(at).where("kind = '#read' or size > 0")
    assert [r["size"] for r in read.collect() if r.kind == "#read"] == [2000]
    assert shards.shards(spark, at, wanted.limit(0), "id").count() == 0


def test_written(spark, tmp_path):
    rows = spark.createDataFrame([(i % 3, f"{i}.txt", b"z" * i) for i in range(30)], "n int, name string, body binary")
    at = f"file://{tmp_path}/out"
    assert sorted(r.members for r in shards.write_shards(rows, at, "n", "name", "body").collect()) == [10, 10, 10]
    assert sorted((r.member, len(r.content)) for r in shards.shards(spark, at).collect()) == sorted((f"{i}.txt", i) for i in range(30))
