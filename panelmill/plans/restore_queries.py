"""Nulls filled again, over documents: a document is a figure, its text the caption; what is missing follows from its number."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.operators.restore import restored, shard_captions
from panelmill.plans.base import Tables, query
from panelmill.plans.stages import applied, batched, stored
from panelmill.sources.scratch import folder
from panelmill.sources.shards import write_shards


def _render():
    """A stand-in for a renderer: the page's first bytes, with place and dpi; every thirteenth article's file is damaged."""

    @batched
    def model(rows: list[dict]) -> list:
        return [ValueError("damaged file") if r["row_id"] % 13 == 4 else [{"picture": r["pdf"][:8] + f"|{r['place']}|{r['dpi']}".encode()}] for r in rows]

    return model


def _restored(spark, d):
    docs, at = Tables(spark, d).documents, folder(spark, "captions")
    k = F.col("doc_id")
    shown = docs.where("doc_id % 9 <> 8").select(F.expr("doc_id div 2000").alias("shard"), F.concat(F.lit("PMC"), k, F.lit("_c.txt")).alias("member"), F.col("text").cast("binary").alias("body"))
    write_shards(shown, at, "shard", "member", "body").write.format("noop").mode("overwrite").save()
    segments = F.when(k % 4 == 0, '[["Part: "], [0, 12], ["..."], [3, 5]]').when(k % 4 == 1, '[[2, 7]]').when(k % 4 == 2, "[[1, ")
    rows = docs.select(
        k.alias("row_id"), k.alias("article_id"), F.lit("c").alias("image_cluster_id"), F.when(k % 3 == 0, F.concat(F.lit("old "), k)).alias("subcaption_text"), segments.alias("subcaption_segments"),
        F.when(k % 5 == 0, F.lit(b"old")).alias("panel_image_bytes"), F.when(k % 7 != 0, F.concat(F.lit('{"figure_page_coordinates":{"1":['), k, F.lit("]}}"))).otherwise('{"figure_page_coordinates":null}').alias("position"), F.lit(300).alias("dpi"),
    )
    pages = docs.where("doc_id % 11 <> 10").select(k.alias("article_id"), F.concat(F.lit("pdf "), k).cast("binary").alias("pdf"))
    render = lambda todo: stored(applied(todo, _render, ["row_id"], "picture binary", again=(OSError,)), folder(spark, "pictures"))
    return restored(rows, lambda wanted: shard_captions(spark, at, wanted), pages, render)


_STATE = """with f as (select doc_id as k, case when doc_id % 9 <> 8 then coalesce(text, '') end as caption from documents),
t as (select k, case when k % 3 = 0 then 'old ' || k when caption is null then null when k % 4 = 0 then 'Part: ' || substr(caption, 1, 12) || '...' || substr(caption, 4, 5) when k % 4 = 1 then substr(caption, 3, 7) when k % 4 = 3 then caption end as text,
  case when k % 3 = 0 then null when caption is null then 'no caption' when k % 4 = 2 then 'broken segments' end as text_reason,
  case when k % 5 = 0 then 'old' when k % 11 = 10 or k % 7 = 0 or k % 13 = 4 then null else left('pdf ' || k, 8) || '|{"1":[' || k || ']}|300' end as picture,
  case when k % 5 = 0 then null when k % 11 = 10 then 'no package' when k % 7 = 0 then 'no place on a page' when k % 13 = 4 then 'ValueError: damaged file' end as picture_reason from f)
"""


@query(_STATE + "select k as row_id, text as subcaption_text, picture from t")
def restored_rows(spark, d):
    """Captions from segments, pictures from pages; what was there stays."""
    return _restored(spark, d)[0].select("row_id", "subcaption_text", F.col("panel_image_bytes").cast("string").alias("picture"))


@query(_STATE + "select k as row_id, 'subcaption_text' as field, text_reason as reason from t where text_reason is not null union all select k, 'panel_image_bytes', picture_reason from t where picture_reason is not null")
def unrestored_rows(spark, d):
    """What could not be filled, and why."""
    return _restored(spark, d)[1]
