"""Figures on pages: boxes of each page, joined boxes, pages stacked into one image."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmill.functions.boxes import gap, intersection, union_of


def page_boxes(records: DataFrame, figure: list[str]) -> DataFrame:
    """figure, page, the box that spans its records there, and the figure's dpi (null unless all records have one value) or dpis.

    records: figure, page, box, dpi, n (their order). A record without a page fails when it is read.
    """
    page = F.coalesce("page", F.raise_error(F.lit("a figure record has no page")).cast("int"))
    dpi = records.groupBy(*figure).agg(F.when((F.count("dpi") == F.count("*")) & (F.count_distinct("dpi") == 1), F.max("dpi")).alias("dpi"), F.transform(F.array_sort(F.collect_list(F.struct("n", "dpi"))), lambda x: x["dpi"]).alias("dpis"))
    boxes = records.withColumn("page", page).groupBy(*figure, "page").agg(union_of(lambda e: F.col("box")[e]).alias("box"))
    return boxes.join(dpi.withColumn("dpis", F.when(F.col("dpi").isNull(), F.col("dpis"))), figure)


def joined_boxes(records: DataFrame, by: list[str], farthest: float = 60.0) -> DataFrame:
    """by, the box that spans the records of one figure on one page, and reason: why it cannot be (box null then).

    records: by, n (their order), box, caption. All must have one caption box, which meets no spanning box, and no
    box may lie farther than `farthest` from the nearest of those after it.
    """
    own = F.array_sort(F.collect_list(F.struct("n", "box")))
    s = records.groupBy(*by).agg(own.alias("boxes"), F.count("caption").alias("captions"), F.count("*").alias("rows"), F.count_distinct("caption").alias("kinds"), F.first("caption", True).alias("caption"), union_of(lambda e: F.col("box")[e]).alias("whole"))
    after = lambda i: F.slice("boxes", i + 2, F.size("boxes"))
    lonely = F.transform("boxes", lambda x, i: F.array_min(F.transform(after(i), lambda y: gap(x["box"], y["box"]))) > farthest)
    reason = F.when((F.col("captions") < F.col("rows")) | (F.col("kinds") != 1), "caption boxes differ").when(intersection(F.col("whole"), F.col("caption")) > 0, "figure meets caption").when(F.exists(lonely, lambda x: F.coalesce(x, F.lit(False))), "boxes too far apart")
    return s.withColumn("reason", reason).select(*by, F.when(F.col("reason").isNull(), F.col("whole")).alias("box"), "reason")


def stacked(pages: DataFrame, figure: list[str]) -> DataFrame:
    """figure, page, y_start and y_end in one image of all pages, by page number, with its width and height.

    pages: figure, page, width, height. Between pages lies a gap of a fiftieth of the image, 10 pixels at least.
    """
    every, before = Window.partitionBy(*figure), Window.partitionBy(*figure).orderBy(F.col("page").cast("int")).rowsBetween(Window.unboundedPreceding, -1)
    wide, high, n = F.max("width").over(every), F.sum("height").over(every), F.count("*").over(every)
    space = F.greatest(F.floor(0.02 * F.greatest(wide, high)), F.lit(10)).cast("bigint")
    start = (F.coalesce(F.sum("height").over(before), F.lit(0)) + F.count("*").over(before) * space).cast("bigint")
    return pages.select(*figure, "page", start.alias("y_start"), (start + F.col("height")).cast("bigint").alias("y_end"), wide.alias("image_width"), (high + space * (n - 1)).cast("bigint").alias("image_height"))


def merged_figures(records: DataFrame, figure: list[str], pixels: float, farthest: float = 60.0) -> DataFrame:
    """figure, page, box, y_start, y_end, image_width, image_height and reason: the records of a figure as one image.

    records as in joined_boxes; pixels are those of a unit of length. A figure with a page that cannot be joined has
    one row for each page with that page's reason, or the figure's least one, and no image.
    """
    each = joined_boxes(records, [*figure, "page"], farthest)
    reasons = each.groupBy(*figure).agg(F.min("reason").alias("reason"))
    side = lambda low, high: F.round((F.col("box")[high] - F.col("box")[low]) * pixels).cast("bigint")
    sound = each.drop("reason").join(reasons, figure).where("reason is null").select(*figure, "page", "box", side("x0", "x1").alias("width"), side("y0", "y1").alias("height"))
    image = stacked(sound, figure).join(sound.select(*figure, "page", "box"), [*figure, "page"])
    failed = each.select(*figure, "page").join(reasons.where("reason is not null"), figure)
    return image.withColumn("reason", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)
