"""Nulls of a published table filled again: captions from the parts that were kept of them, pictures from their pages.

A published row may lack its caption's text (subcaption_text) and its picture (panel_image_bytes). What is needed to make them again
is there: the caption's segments, and the picture's place on the article's pages. Only rows that lack something are
looked at; the others go through as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.functions.text import figure_uuid, reconstruct


def segments_of(text: Column) -> Column:
    """JSON of [[literal], [start, length], ...] as the segments that reconstruct() takes; null if it is no such list."""
    parts = F.from_json(text, "array<array<string>>")
    place = lambda s: (F.size(s) == 2) & s[0].rlike(r"^\d+$")
    at = lambda s, i: F.when(place(s), F.get(s, F.lit(i)).try_cast("int"))
    return F.transform(parts, lambda s: F.struct(at(s, 0).alias("start"), at(s, 1).alias("length"), F.when(~place(s), F.get(s, F.lit(0))).alias("literal")))


def shard_captions(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """figure_uuid and caption of the wanted figures, from archives with a text for each figure; other members are passed over."""
    from panelmill.sources.shards import shards

    found = shards(spark, path, wanted, "figure_uuid")
    return found.select(F.col("key").alias("figure_uuid"), F.col("content").cast("string").alias("caption"))


def restored(rows: DataFrame, captions: Callable[[DataFrame], DataFrame], pages: DataFrame, render: Callable[[DataFrame], DataFrame], key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """(rows with what could be filled, reasons: key, field and reason of what could not).

    rows (key, article_id, image_cluster_id, subcaption_text, subcaption_segments, panel_image_bytes, position, dpi and more).
    captions gives figure_uuid and caption of the figures that it is handed (figure_uuid); of several the least counts. pages
    (article_id, pdf). render gets key, pdf, place (the JSON of the picture's pages) and dpi and gives key, picture and error. A
    caption without segments is taken whole.
    """
    marked = rows.withColumn("_uuid", figure_uuid(F.col("article_id"), F.col("image_cluster_id")))
    lacks_text = marked.where("subcaption_text is null").select(key, "_uuid", "subcaption_segments")
    known = captions(lacks_text.select(F.col("_uuid").alias("figure_uuid")).distinct()).groupBy(F.col("figure_uuid").alias("_uuid")).agg(F.min("caption").alias("caption"))
    parts = segments_of(F.col("subcaption_segments"))
    text = F.when(F.col("subcaption_segments").isNull(), F.col("caption")).otherwise(reconstruct(parts, F.col("caption")))
    reason = F.when(F.col("caption").isNull(), "no caption").when(F.col("subcaption_segments").isNotNull() & parts.isNull(), "broken segments")
    texts = lacks_text.join(known, "_uuid", "left").select(key, F.when(reason.isNull(), text).alias("_text"), reason.alias("reason"))

    place = F.get_json_object("position", "$.figure_page_coordinates")
    lacks_picture = marked.where("panel_image_bytes is null").select(key, "article_id", "dpi", place.alias("place"))
    sources = pages.groupBy("article_id").agg(F.min("pdf").alias("pdf"))
    with_pages = lacks_picture.join(sources, "article_id", "left")
    early = F.when(F.col("pdf").isNull(), "no package").when(F.col("place").isNull() | (F.col("place") == "null"), "no place on a page")
    made = render(with_pages.where(early.isNull()).select(key, "pdf", "place", "dpi"))
    pictures = with_pages.select(key, early.alias("_early")).join(made.select(key, F.col("picture").alias("_picture"), "error"), key, "left")
    pictures = pictures.select(key, "_picture", F.when(F.col("_picture").isNull(), F.coalesce("_early", "error", F.lit("nothing rendered"))).alias("reason"))

    out = rows.join(texts.select(key, "_text"), key, "left").join(pictures.select(key, "_picture"), key, "left")
    out = out.withColumns({"subcaption_text": F.coalesce("subcaption_text", "_text"), "panel_image_bytes": F.coalesce("panel_image_bytes", "_picture")}).select(*rows.columns)
    told = lambda df, field: df.where("reason is not null").select(key, F.lit(field).alias("field"), "reason")
    return out, told(texts, "subcaption_text").unionByName(told(pictures, "panel_image_bytes"))
