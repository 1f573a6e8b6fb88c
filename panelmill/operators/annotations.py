"""From annotators' regions to the tables of the assembly: predictions, caption parts, nested figures, tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.functions.boxes import EDGES, box, from_percent, to_shares
from panelmill.functions.text import attribution, commercial_use, panel_name
from panelmill.operators.spatial import first_parent

IMAGING = ["CFP", "OCT", "Retinal Imaging", "Other"]


def region_kind(labels: Column) -> Column:
    """Panel, Label or Image by a region's labels; null if it is none."""
    return F.when(F.array_contains(labels, "Panel"), "Panel").when(F.array_contains(labels, "Label"), "Label").when(F.array_contains(labels, "Image"), "Image")


def as_predictions(regions: DataFrame) -> DataFrame:
    """regions (fig, region, labels, box) as sure predictions; regions of no kind are left out. An image has its first kind of
    IMAGING (Other if it names none) and whether it is annotated; other regions have the mark's score -1."""
    kind = region_kind(F.col("labels"))
    own = F.filter(F.array(*map(F.lit, IMAGING)), lambda k: F.array_contains("labels", k))
    name = F.when(kind == "Image", F.coalesce(F.get(own, F.lit(0)), F.lit("Other"))).otherwise(kind)
    image = kind == "Image"
    return regions.where(kind.isNotNull()).select(
        "fig", "region", name.alias("kind"), F.lit(1.0).alias("score"), F.when(F.array_contains("labels", "Annotated"), "Annotated").otherwise("Plain").alias("marked"), F.when(image, 1.0).otherwise(-1.0).alias("marked_score"), "box", F.lit(True).alias("survives_nms"), F.lit("annotation").alias("source"),
    )


def known_predictions(panels: DataFrame, images: DataFrame, model: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Predictions of annotated figures: all regions where the images are annotated too, else the annotated panels with
    the model's other boxes. panels and images as as_predictions gives them; model has the same columns but region.
    done (fig, images: whether the images were annotated, too): the annotated figures, also those in which nothing
    was found; without it those that have a region."""
    if done is None:
        done = panels.select("fig", F.lit(False).alias("images")).unionByName(images.select("fig", F.lit(True).alias("images")))
    figures = done.groupBy("fig").agg(F.bool_or("images").alias("_whole"))
    whole = figures.where("_whole").select("fig")
    rest = panels.where("kind = 'Panel'").join(whole, "fig", "left_anti")
    found = model.where("kind <> 'Panel'").join(figures.where("not _whole").select("fig"), "fig", "left_semi")
    return images.unionByName(rest).unionByName(found.withColumn("source", F.lit("model")), allowMissingColumns=True)


def caption_parts(figures: DataFrame, annotated: DataFrame, split: DataFrame) -> DataFrame:
    """fig, name, text, how: the parts of each figure's caption.

    figures (fig, caption, n_panels), annotated (fig, name, text), split (fig, name, text). What annotators wrote goes first; a figure
    of one panel has its caption whole; others have what a model split.
    """
    own = annotated.select("fig", "name", "text", F.lit("annotated").alias("how"))
    rest = figures.join(own.select("fig").distinct(), "fig", "left_anti")
    one = rest.where("n_panels = 1").select("fig", F.lit("None").alias("name"), F.col("caption").alias("text"), F.lit("whole").alias("how"))
    several = split.join(rest.where("n_panels <> 1").select("fig"), "fig", "left_semi").select("fig", "name", "text", F.lit("split").alias("how"))
    return own.unionByName(one).unionByName(several)


def nested_figures(regions: DataFrame) -> DataFrame:
    """fig, panels and orphans: panels with their images and labels, as arrays of structs.

    regions (fig, id, labels, parent, name, text, box, width, height): an image or label goes to its annotated parent if that is a panel
    of the figure, else to the first panel (by id) that it touches, else to the orphans. Boxes are shares.
    """
    r = regions.withColumn("kind", region_kind(F.col("labels"))).where("kind is not null")
    panels, parts = r.where("kind = 'Panel'"), r.where("kind <> 'Panel'")
    spot = first_parent(panels.select("fig", "id", "box"), parts.select("fig", "id", "box")).select("fig", F.col("child_id").alias("id"), F.col("parent_id").alias("spot"))
    named = panels.select("fig", F.col("id").alias("parent"), F.lit(True).alias("known"))
    parts = parts.join(spot, ["fig", "id"], "left").join(named, ["fig", "parent"], "left").withColumn("panel", F.when(F.col("known"), F.col("parent")).otherwise(F.col("spot")))
    at = F.struct(*[to_shares(F.col("box"), F.col("width"), F.col("height"))[e].alias(e) for e in EDGES])
    own = F.array_intersect("labels", F.array(*map(F.lit, IMAGING)))
    part = F.struct("id", "kind", at.alias("box"), F.when(F.col("kind") == "Image", F.when(F.array_contains("labels", "Annotated"), "Marked").otherwise("Unmarked")).alias("mark_status"), F.when(F.col("kind") == "Image", own).alias("labels"))
    lists = parts.groupBy("fig", "panel").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    of = lambda kind: F.coalesce(F.filter("parts", lambda x: x["kind"] == kind), F.array())
    filled = panels.join(lists.withColumnRenamed("panel", "id"), ["fig", "id"], "left")
    whole = F.struct("id", at.alias("box"), "name", F.col("text").alias("caption_text"), of("Image").alias("images"), of("Label").alias("labels"))
    out = filled.groupBy("fig").agg(F.array_sort(F.collect_list(whole)).alias("panels"))
    return out.join(lists.where("panel is null").select("fig", F.col("parts").alias("orphans")), "fig", "left")


def task_fields(tasks: DataFrame) -> DataFrame:
    """id, article_id and image_cluster_id (from the image's path), n_finished, was_cancelled and the finished annotations."""
    done = F.filter("annotations", lambda a: ~F.coalesce(a["was_cancelled"], F.lit(False)))
    name = F.regexp_extract(F.col("data.image_path"), r"([^/]+)\.[^./]+$", 1)
    n = F.coalesce(F.size("annotations"), F.lit(0))
    return tasks.select("id", F.regexp_extract(name, r"^(?:PMC)?(\d+)_", 1).try_cast("bigint").alias("article_id"), F.regexp_replace(name, r"^[^_]*_", "").alias("image_cluster_id"), F.coalesce(F.size(done), F.lit(0)).alias("n_finished"), ((n > 0) & (F.size(done) == 0)).alias("was_cancelled"), done.alias("finished"))


def usable_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks with just one finished annotation, which has a region."""
    return task_fields(tasks).where((F.col("n_finished") == 1) & (F.size(F.get("finished", F.lit(0))["result"]) > 0))


def preannotated(boxes: DataFrame) -> DataFrame:
    """fig and a task's JSON with a model's boxes as regions in percent. boxes (fig, id, kind, score, box, width, height)."""
    share = to_shares(F.col("box"), F.col("width"), F.col("height"))
    value = F.struct((share["x0"] * 100).alias("x"), (share["y0"] * 100).alias("y"), ((share["x1"] - share["x0"]) * 100).alias("width"), ((share["y1"] - share["y0"]) * 100).alias("height"), F.array("kind").alias("rectanglelabels"))
    region = F.struct(F.col("id").cast("string").alias("id"), F.lit("rectanglelabels").alias("type"), F.col("width").cast("int").alias("original_width"), F.col("height").cast("int").alias("original_height"), F.col("score").alias("score"), value.alias("value"))
    return boxes.groupBy("fig").agg(F.to_json(F.struct(F.array(F.struct(F.array_sort(F.collect_list(region)).alias("result"), F.min("score").alias("score"))).alias("predictions"))).alias("task"))


def answers_read(text: Column) -> Column:
    """A model's answer as (by_panel, by_place): lists of assignments; the form by panel is tried first."""
    evidence = "evidence:array<struct<label_id:string,bbox_2d:array<int>,text:string,positional_type:string,short_description:string>>"
    common = f"assigned_subcaption:string,confidence:double,{evidence}"
    read = lambda own, then: F.get(F.transform(F.array(F.from_json(text, f"assignments array<struct<{own},{common}>>")["assignments"]), then), F.lit(0))  # noqa: E731 (each form is parsed once)
    by_panel = lambda a: (F.size(a) >= 0) & F.forall(a, lambda x: x["panel_id"].isNotNull() & x["confidence"].isNotNull())
    by_place = lambda b: F.when(F.forall(b, lambda x: x["assigned_images"].isNotNull() & x["confidence"].isNotNull()), b)
    place = read("assigned_images:array<string>", by_place)
    return read("panel_id:string,reject_panel:boolean", lambda a: F.struct(F.when(by_panel(a), a).alias("by_panel"), F.when(~F.coalesce(by_panel(a), F.lit(False)), place).alias("by_place")))


def evidence_kinds(evidence: Column) -> Column:
    """existing, new or place for each piece of evidence; null without any list."""
    return F.transform(evidence, lambda e: F.when(e["label_id"].isNotNull(), "existing").when(e["bbox_2d"].isNotNull(), "new").when(e["positional_type"].isNotNull(), "place"))


def annotated_rows(nested: DataFrame, figures: DataFrame, articles: DataFrame) -> DataFrame:
    """The output's rows of annotated figures: nested as nested_figures gives it, figures (fig, article_id, image_cluster_id, page_boxes),
    articles as in assembly.panel_rows. The columns are those of panel_rows but crop; final_rows joins the two."""
    p = nested.select("fig", F.explode("panels").alias("p")).join(figures, "fig").join(articles, ["article_id", "image_cluster_id"], "left")
    images = F.col("p.images")
    has = lambda k: F.exists(images, lambda x: F.array_contains(x["labels"], k))
    at = lambda b: F.array(*[b[e] for e in EDGES])
    corner = lambda name, pick, n: pick(F.col("p.box")[name], F.array_min(F.transform(images, lambda x: x["box"][name])) if n == 0 else F.array_max(F.transform(images, lambda x: x["box"][name])))
    content = F.array(corner("x0", F.least, 0), corner("y0", F.least, 0), corner("x1", F.greatest, 1), corner("y1", F.greatest, 1))
    image = lambda x: F.struct(F.concat(F.lit("gt_"), x["id"].cast("string")).alias("id"), F.struct(x["labels"].alias("label")).alias("imaging_type"), F.struct(x["mark_status"].alias("label")).alias("mark_status"), F.lit(True).alias("is_gt"), F.to_json(F.struct(at(x["box"]).alias("annotated_box"))).alias("position"))
    label = lambda x: F.struct(F.concat(F.lit("gt_"), x["id"].cast("string")).alias("id"), F.lit(True).alias("is_gt"), F.to_json(F.struct(at(x["box"]).alias("annotated_box"))).alias("position"))
    name, text = F.col("p.name"), F.col("p.caption_text")
    return p.select(
        F.concat(F.lit("gt_"), F.col("p.id").cast("string")).alias("panel_id"), "article_id", "image_cluster_id", panel_name(name, text).alias("panel_name"), text.alias("subcaption_text"),
        F.to_json(F.struct(at(F.col("p.box")).alias("annotated_box"), content.alias("content_box"), F.col("page_boxes").alias("figure_page_coordinates"))).alias("position"), F.coalesce(F.size("page_boxes") > 1, F.lit(False)).alias("is_multi_page_figure"), F.to_json("context").alias("in_text_mention"),
        has("CFP").alias("contains_cfp"), has("OCT").alias("contains_oct"), has("Retinal Imaging").alias("contains_retinal"), has("Other").alias("contains_other"), F.exists(images, lambda x: x["mark_status"] == "Marked").alias("contains_marked"),
        F.to_json(F.transform(images, image)).alias("image_data"), F.to_json(F.transform("p.labels", label)).alias("identifier_data"), F.lit("ground_truth").alias("assembly"), F.lit('["panel"]').alias("annotation"), "license", attribution(F.col("title"), F.col("citation")).alias("attribution"), commercial_use(F.col("license")).alias("commercial_use"),
    )


def merged_settings(base: Column, over: Column) -> Column:
    """Two maps of texts to texts as one; the second's values win, and where both values are JSON objects their fields merge."""
    both = F.map_zip_with(base, over, lambda _, a, b: F.when(b.isNull(), a).when(a.startswith("{") & b.startswith("{"), F.to_json(F.map_zip_with(F.from_json(a, "map<string,string>"), F.from_json(b, "map<string,string>"), lambda _, x, y: F.coalesce(y, x)))).otherwise(b))
    return both


def page_regions(tasks: DataFrame) -> DataFrame:
    """id, article_id, image_cluster_id, region, role (figure or caption), label, name, box, page, page_index, on_page (the box there),
    page_width, page_height, dpi and crosses (the box reaches more than a pixel beyond its page).

    tasks as sources.readers.page_tasks gives them; the first annotation that was not cancelled counts. A region's box is its
    last rectangle, its name the first text given under box_name.
    """
    first = F.get(F.filter("annotations", lambda a: ~F.coalesce(a["was_cancelled"], F.lit(False))), F.lit(0))
    image = F.regexp_replace(F.regexp_replace(F.substring_index(F.col("data.base_image_path"), "/", -1), r"^pdf_", ""), r"\.png$", "")
    r = tasks.select("id", F.col("data.article_id").alias("article_id"), F.regexp_replace(F.regexp_replace(image, "_updated$", ""), "^[^_]*_", "").alias("image_cluster_id"), F.col("data.pdf_pages").alias("pages"), "dpi", F.posexplode(first["result"]).alias("n", "r"))
    is_box, is_name = F.col("r.type") == "rectanglelabels", (F.col("r.type") == "textarea") & (F.col("r.from_name") == "box_name")
    g = r.groupBy("id", "article_id", "image_cluster_id", "pages", "dpi", F.col("r.id").alias("region")).agg(F.max_by("r", F.when(is_box, F.col("n"))).alias("r"), F.max_by("r", F.when(is_name, F.col("n"))).alias("t")).where("r is not null")
    v, w, h = F.col("r.value"), F.col("r.original_width"), F.col("r.original_height")
    g = g.withColumns({"box": from_percent(v["x"], v["y"], v["width"], v["height"], w, h), "page_width": w / F.size("pages"), "page_height": h.cast("int")})
    at = F.least(F.floor(F.col("box.x0") / F.col("page_width")), F.size("pages") - 1).cast("int")
    left = F.col("page_index") * F.col("page_width")
    role = F.when(F.col("r.from_name") == "figure_position", "figure").when(F.col("r.from_name") == "caption_position", "caption")
    g = g.withColumn("page_index", at)
    on = box(F.col("box.x0") - left, F.col("box.y0"), F.col("box.x1") - left, F.col("box.y1"))
    return g.select("id", "article_id", "image_cluster_id", "region", role.alias("role"), F.get(v["rectanglelabels"], F.lit(0)).alias("label"), F.get(F.col("t.value.text"), F.lit(0)).alias("name"), "box", F.get("pages", F.col("page_index")).alias("page"), "page_index", on.alias("on_page"), F.col("page_width").cast("int").alias("page_width"), "page_height", "dpi", (F.col("box.x1") > left + F.col("page_width") + 1).alias("crosses"))


def places(regions: DataFrame, role: str) -> DataFrame:
    """id and a map from page to the box of the last region (by name of the region) of a role there."""
    last = regions.where(F.col("role") == role).groupBy("id", "page").agg(F.max_by("on_page", "region").alias("box"))
    return last.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("page", "box")))).alias("pages"))
