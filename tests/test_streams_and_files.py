"""Streams with late rows, fetching at a pace, files and archives by name, hashes of images."""

import io
import tarfile
import time

import numpy as np
from pyspark.sql import functions as F

from panelmill.functions import hashes
from panelmill.operators import annotations, persist
from panelmill.sources import readers, writers
from panelmill.streaming.incremental import windowed_counts


def test_late_rows(spark, tmp_path):
    """A row that comes after the watermark has passed its window is left out."""
    schema, source = "at timestamp, kind string", str(tmp_path / "in")
    for n, stamps in enumerate([["01:10", "01:20"], ["03:30"], ["01:30", "03:40"], ["06:00"]]):
        rows = [(f"2024-01-01 {s}:00", "a") for s in stamps]
        spark.createDataFrame(rows, "at string, kind string").select(F.col("at").cast("timestamp").alias("at"), "kind").coalesce(1).write.mode("append").parquet(source)
        if n == 0:
            out = windowed_counts(spark.readStream.schema(schema).parquet(source), "at", "kind", "1 hour", "10 minutes").select(F.col("window.start").cast("string").alias("at"), "n")
        out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).option("path", str(tmp_path / "out")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [("2024-01-01 01:00:00", 2), ("2024-01-01 03:00:00", 2)]


def test_pace(spark):
    began = time.time()
    out = readers.fetched(spark.range(6).select(F.col("id").cast("string").alias("path")), str.encode, 1, a_second=4).collect()
    assert time.time() - began > 1.2 and sorted(r.content for r in out) == [str(i).encode() for i in range(6)]


def test_files_by_name(spark, tmp_path):
    for n in ("PMC1", "PMC2"):
        (tmp_path / n).mkdir()
        with tarfile.open(tmp_path / n / f"{n}.tar.gz", "w:gz") as t:
            for name in ("a.jpg", "b.jpg", "c.nxml"):
                info = tarfile.TarInfo(f"{n}/{name}")
                info.size = 3
                t.addfile(info, io.BytesIO(b"abc"))
    members = readers.archive_members(spark, str(tmp_path))
    assert members.count() == 6
    packages = spark.createDataFrame([("PMC1",), ("PMC9",)], "package string")
    assert {r.package: r.path and r.path[-11:] for r in readers.located_packages(packages, members, "package").collect()} == {"PMC1": "PMC1.tar.gz", "PMC9": None}
    found = readers.wanted_members(members, spark.createDataFrame([("a",), ("z",)], "name string"), "name")
    assert sorted(r.member for r in found.collect()) == ["PMC1/a.jpg", "PMC2/a.jpg"]
    assert sorted((r.name, r.length > 0) for r in readers.files_below(spark, str(tmp_path), "*.gz").collect()) == [("PMC1.tar", True), ("PMC2.tar", True)]
    assert readers.any_of(["eye", "retina"]) == "(eye) OR (retina)"


def test_image_hashes(spark):
    rng = np.random.default_rng(4)
    image = rng.integers(0, 255, (40, 60))
    near, other = np.clip(image + rng.integers(-2, 3, image.shape), 0, 255), rng.integers(0, 255, (40, 60))
    a, b, c = (hashes.hashes(x) for x in (image, near, other))
    far = lambda x, y: [bin((x[k] ^ y[k]) & (2**64 - 1)).count("1") for k in "apdw"]
    assert max(far(a, b)) <= 6 < 15 < min(far(a, c))
    assert np.allclose(hashes.shrunk(np.arange(16.0).reshape(4, 4), 2, 2), [[2.5, 4.5], [10.5, 12.5]])
    bad = spark.createDataFrame([(1, [1, 2], 5, 5), (2, None, 1, 1)], "k long, pixels array<int>, width int, height int")
    assert [r.hashes for r in hashes.hashed_images(bad, "k").collect()] == [None, None]


def test_logs_and_updates(spark, tmp_path):
    for n in range(2):
        persist.metrics_log(spark.createDataFrame([(n, 0.5)], "epoch long, loss double"), str(tmp_path / "log"))
    writers.run_metadata(spark.range(1), str(tmp_path / "runs"), model="m")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2 and spark.read.parquet(str(tmp_path / "runs")).count() == 1
    assert persist.merged(spark.createDataFrame([(1, "a")], "k long, v string"), spark.createDataFrame([(1, None), (2, "b")], "k long, v string"), ["k"]).orderBy("k").collect() == [(1, "a"), (2, "b")]
    read = spark.range(1).select(annotations.answers_read(F.lit("no json")).alias("a")).first().a
    assert read.by_panel is None and read.by_place is None
