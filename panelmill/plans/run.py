"""The whole run: figures and captions to panel rows. Models are the caller's loaders, as in stages.

Each step writes a table under path/<step>; a step whose table is there is read, not done again, so a run that
was cut off goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.operators import assembly, spatial
from panelmill.operators.rebuild import build
from panelmill.sources.scratch import by_counted_rows, folder
from panelmill.plans.stages import Loader, applied, caption_splits, detections, stored

#: The classes of the detector.
KINDS = ["Panel", "Label", "CFP", "OCT", "Retinal Imaging", "Other"]
STEPS = ["boxes", "captions", "texts", "assembled", "rows"]


@dataclass
class Models:
    """detect: x0, y0, x1, y1, cls (a place in KINDS), score of a figure's boxes; name and split: a caption's parts; read: text and
    confidence of what a figure's box shows (a row with content, box)."""

    detect: Loader
    name: Loader
    split: Loader
    read: Loader


class Run:
    """figures (fig, article_id, image_cluster_id, width, height, content, caption), articles as in assembly.panel_rows."""

    def __init__(self, spark: SparkSession, figures: DataFrame, articles: DataFrame, models: Models, path: str):
        self.spark, self.figures, self.articles, self.models, self.path = spark, figures, articles, models, path

    def _once(self, step: str, make: Callable[[], DataFrame]) -> DataFrame:
        at = f"{self.path}/{step}"
        try:
            return self.spark.read.parquet(at)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # else the table is not there yet
                raise
            with by_counted_rows(self.spark):
                make().write.mode("overwrite").parquet(at)
            return self.spark.read.parquet(at)

    def _kept(self, step: str) -> Callable[[DataFrame, str], DataFrame]:
        """Writes what a step reads more than once, under path/<step>-<name>; the step does it anew if it was cut off."""
        return lambda df, name: stored(df, f"{self.path}/{step}-{name}")

    def boxes(self) -> DataFrame:
        """fig, id, kind, score, box, survives_nms; ids are the figure's times a million plus the box's."""

        def make() -> DataFrame:
            found = detections(self.figures.select("fig", "width", "height", "content"), self.models.detect, f"{self.path}/detected").where("error is null")
            kind = F.get(F.array(*map(F.lit, KINDS)), F.col("cls"))
            return found.select("fig", (F.col("fig") * 1_000_000 + F.col("id")).alias("id"), kind.alias("kind"), "score", F.struct("x0", "y0", "x1", "y1").alias("box"), "survives_nms")

        return self._once("boxes", make)

    def captions(self) -> DataFrame:
        """fig, caption_id, name, text, place, is_full."""

        def make() -> DataFrame:
            every = self._kept("captions")(caption_splits(self.figures.select(F.col("fig").alias("caption_id"), "caption"), self.models.name, self.models.split, f"{self.path}/split"), "split")
            parts = every.where("error is null")
            whole = every.where("is_full_caption and error is null").join(every.where("not is_full_caption").select("caption_id"), "caption_id", "left_anti")
            parts = parts.unionByName(whole.withColumns({"sub_caption_name": F.lit("None"), "is_full_caption": F.lit(False)}))  # a caption without parts is its only part
            order = F.when(F.col("is_full_caption"), 0).otherwise(F.dense_rank().over(_by("caption_id", "is_full_caption", "sub_caption_name")))
            return parts.select(F.col("caption_id").alias("fig"), (F.col("caption_id") * 1_000 + order).alias("caption_id"), F.col("sub_caption_name").alias("name"), F.col("sub_caption_text").alias("text"), order.alias("place"), F.col("is_full_caption").alias("is_full"))

        return self._once("captions", make)

    def hierarchy(self) -> DataFrame:
        """fig, panel_id, label_ids, image_ids and the box that spans a panel."""

        def make() -> DataFrame:
            b = self.boxes().where("survives_nms")
            return spatial.hierarchy(b.where("kind = 'Panel'"), b.where("kind = 'Label'"), b.where("kind not in ('Panel', 'Label')"))

        return self._once("hierarchy", make)

    def texts(self) -> DataFrame:
        """fig, label_id, panel_id, text, confidence: the surest text of each label; where none of a panel's labels has
        one, the texts in the panel itself, as new labels."""

        def make() -> DataFrame:
            b, figures = self.boxes().where("survives_nms"), self.figures.select("fig", "content")
            labels = b.where("kind = 'Label'").join(figures, "fig").select("fig", "id", "content", "box")
            read = applied(labels, self.models.read, ["fig", "id"], "text string, confidence double").where("error is null and confidence >= 0.8")
            own = self._kept("texts")(read.groupBy("fig", F.col("id").alias("label_id")).agg(F.max_by(F.struct("text", "confidence"), F.struct("confidence", "text")).alias("t")).select("fig", "label_id", F.lit(None).cast("bigint").alias("panel_id"), "t.text", "t.confidence"), "own")
            panels = self.hierarchy()
            heard = panels.select("fig", "panel_id", F.explode("label_ids").alias("label_id")).join(own.select("fig", "label_id"), ["fig", "label_id"], "left_semi").select("fig", "panel_id")
            lone = panels.join(heard, ["fig", "panel_id"], "left_anti").join(figures, "fig").select("fig", "panel_id", "content", F.struct("x0", "y0", "x1", "y1").alias("box"))
            found = applied(lone, self.models.read, ["fig", "panel_id"], "text string, confidence double").where("error is null and confidence >= 0.8")
            n = F.row_number().over(_by("fig", "panel_id", F.desc("confidence"), "text", keys=1))
            return own.unionByName(found.select("fig", (-n).cast("bigint").alias("label_id"), "panel_id", "text", "confidence"))

        return self._once("texts", make)

    def assembled(self) -> DataFrame:
        def make() -> DataFrame:
            c = self.captions()
            figures = c.where("is_full").select("fig", F.col("caption_id").alias("full_caption_id"), F.col("text").alias("full_caption"))
            panels = self.hierarchy().select("fig", "panel_id", "label_ids")
            return assembly.assembled(figures, self.boxes().where("survives_nms"), panels, c.where("not is_full"), self.texts(), self._kept("assembled"))

        return self._once("assembled", make)

    def rows(self) -> DataFrame:
        def make() -> DataFrame:
            tree = self.hierarchy().select("panel_id", "label_ids", "image_ids", F.struct("x0", "y0", "x1", "y1").alias("content_box"))
            panels = self.assembled().where("panel_id is not null").join(tree, "panel_id").withColumn("origin", F.lit("automatic"))
            b = self.boxes().withColumns({"marked": F.lit("Plain"), "marked_score": F.lit(0.0)})
            figures = self.figures.select("fig", "article_id", "image_cluster_id", F.col("width").cast("double").alias("width"), F.col("height").cast("double").alias("height"), F.create_map(F.lit("1"), F.lit(0)).alias("page_boxes"))
            captions = self.captions().select(F.col("caption_id").alias("id"), "name", "text")
            labels = self.spark.createDataFrame([], "id bigint, origin string, confidence double, box struct<x0:double,y0:double,x1:double,y1:double>")
            return assembly.panel_rows(panels, b, figures, self.articles, captions, labels, keep=self._kept("rows"))

        return self._once("rows", make)

    def step(self, name: str) -> DataFrame:
        """The table of one of STEPS, with all before it."""
        return getattr(self, name)()


def renewed(spark: SparkSession, figures: DataFrame, articles: DataFrame, models: Models, path: str, settings: str = "") -> tuple[DataFrame, dict]:
    """(the rows of all figures with fig, the build's manifest): only figures whose own columns, article or settings changed since
    the last call are run again; figures that vanished have no rows any more."""
    of_article = ["article_id", "image_cluster_id"]
    about = articles.groupBy(*of_article).agg(F.array_sort(F.collect_list(F.to_json(F.struct(*[c for c in articles.columns if c not in of_article])))).alias("about"))

    def make(part: DataFrame) -> DataFrame:
        own = part.drop("about")
        rows = Run(spark, own, articles, models, folder(spark, "renewed")).rows()
        return rows.join(own.select("fig", *of_article), of_article)

    return build(path, figures.join(about, of_article, "left"), ["fig"], make, settings)


def _by(*columns, keys: int = 2):
    from pyspark.sql import Window

    return Window.partitionBy(*columns[:keys]).orderBy(*columns[keys:])


def run(spark: SparkSession, figures: DataFrame, articles: DataFrame, models: Models, path: str) -> DataFrame:
    """The output's rows, relevant ones with the method's name."""
    rows = Run(spark, figures, articles, models, path).rows()
    none = rows.limit(0)
    return assembly.final_rows(none, rows, spark.createDataFrame([], "figure_uuid string"))
