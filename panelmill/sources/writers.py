"""Sinks: Spark's file commit makes each write whole or absent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.functions import boxes as bx


def batches(df: DataFrame, path: str, rows: int = 1000) -> None:
    df.write.option("maxRecordsPerFile", rows).mode("append").parquet(path)


def once(df: DataFrame, path: str) -> None:
    """Does nothing if the table is there."""
    df.write.mode("ignore").parquet(path)


def coco_document(images: DataFrame, boxes: DataFrame, categories: DataFrame, path: str) -> None:
    """One COCO document: images (id, file_name, width, height), boxes (id, image_id, category_id, box), categories (id, name).

    It is one file, so one task writes it, line by line in order; nothing is collected.
    """
    a = bx.to_coco(F.col("box"))
    annotation = F.struct("id", "image_id", "category_id", F.array(a["x"], a["y"], a["w"], a["h"]).alias("bbox"), a["area"].alias("area"), F.array(bx.polygon(F.col("box"))).alias("segmentation"), F.lit(0).alias("iscrowd"))
    lines = None
    for n, (name, rows, one) in enumerate([("images", images, F.struct("id", "file_name", "width", "height")), ("annotations", boxes, annotation), ("categories", categories, F.struct("id", "name"))]):
        head = rows.sparkSession.range(1).select(F.lit(n).alias("part"), F.lit(-1).cast("bigint").alias("n"), F.lit(("{" if n == 0 else "],") + f'"{name}":[').alias("value"))
        place = F.col("id").cast("bigint")
        first = rows.agg(F.min(place).alias("_first"))
        body = rows.crossJoin(F.broadcast(first)).select(F.lit(n).alias("part"), place.alias("n"), F.concat(F.when(place == F.col("_first"), "").otherwise(","), F.to_json(one)).alias("value"))  # one row is broadcast
        lines = head.unionAll(body) if lines is None else lines.unionAll(head).unionAll(body)
    tail = images.sparkSession.range(1).select(F.lit(9), F.lit(0).cast("bigint"), F.lit("]}"))
    lines.unionAll(tail).orderBy("part", "n").select("value").coalesce(1).write.mode("overwrite").text(path)


def yolo_text(boxes: DataFrame, path: str) -> None:
    """boxes (file_name, id, category_id, box, width, height): for each image a JSON line of file_name and its text, a line
    for each box."""
    y = bx.to_yolo(F.col("box"), F.col("width"), F.col("height"))
    line = F.struct("id", F.concat_ws(" ", "category_id", y["cx"], y["cy"], y["w"], y["h"]).alias("line"))
    lines = F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"])
    boxes.groupBy("file_name").agg(F.array_join(lines, "\n").alias("text")).write.mode("overwrite").json(path)


def figure_json(df: DataFrame, key: str, path: str) -> None:
    df.select(key, F.to_json(F.struct(*[c for c in df.columns if c != key]), {"ignoreNullFields": "false"}).alias("json")).write.mode("overwrite").json(path)


def run_metadata(df: DataFrame, path: str, **about: str) -> None:
    """One row about a run, appended."""
    row = df.sparkSession.range(1).select(F.current_timestamp().alias("created_at"), *[F.lit(v).alias(k) for k, v in about.items()])
    row.write.mode("append").parquet(path)
