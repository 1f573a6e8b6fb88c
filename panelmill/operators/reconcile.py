"""Two hierarchies of an annotated figure made one: what annotators said of regions, and what lies in what.

boxes (fig, id, kind, region, source, box): a figure's boxes that survive; region names the annotators' region, null for a model's
own box; source is annotation or model. regions (fig, region, parent): what annotators drew, parent null where they gave none.
parts (fig, region, name, text): the panels that annotators gave a caption. splits (fig, name, text): the figure's caption in
parts. figures (fig, images_annotated). Regions and ids may repeat between figures. Of repeated regions the least parent
counts, of repeated parts the least name.

A figure takes the first branch that fits:

* whole: its caption is one part. It must be named None and the figure must have one panel, which takes all other boxes.
* annotated: its images are annotated too, and every region is a part or has a parent. Children are as annotated; a panel's
  content spans it and them.
* spatial: children are what touches a panel (it may touch several); a child that has an annotated parent leaves all other panels
  and goes there. A panel's content spans it and the images that touch it.

Each thing that does not fit is a row of the conflict table. Figures with a fatal one are left out of the panels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.functions.boxes import EDGES, box, overlap, union_of
from panelmill.operators.relational import worked_out
from panelmill.operators.spatial import touches

#: Conflicts after which a figure has no panels; the others are settled on the way.
FATAL = [
    "one part with a name", "not one panel", "part of no region", "panel without children", "region without a box", "box of no region",
    "parent without a box", "parent is no panel", "panel without a part", "box without a panel",
]
_NONE = "None"


def _first(rows: Column, holds: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(rows, holds), F.lit(0))


def _figures(figures: DataFrame, boxes: DataFrame, regions: DataFrame, parts: DataFrame, splits: DataFrame) -> DataFrame:
    """One row for each figure, with its boxes (by id), regions, parts and splits as arrays: all that follows stays in the row."""
    rows = lambda df, name, *columns: df.groupBy("fig").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))
    out = figures.select("fig", F.coalesce("images_annotated", F.lit(False)).alias("images_annotated"))
    tables = {"b": rows(boxes, "b", "id", "kind", "region", "source", "box"), "r": rows(regions, "r", "region", "parent"), "p": rows(parts, "p", "region", "name", "text"), "s": rows(splits, "s", "name", "text")}
    for name, table in tables.items():
        out = out.join(table, "fig", "left").withColumn(name, F.coalesce(name, F.array().cast(table.schema[name].dataType)))
    r, p = F.col("r"), F.col("p")
    names = F.array_distinct(F.transform(r, lambda x: x["region"]))
    parent = lambda n: F.array_min(F.transform(F.filter(r, lambda x: x["region"] == n), lambda x: x["parent"]))
    out = worked_out(out, {"r": F.transform(names, lambda n: F.struct(n.alias("region"), parent(n).alias("parent"))), "p": F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1)["region"] != x["region"])), "panels": F.filter("b", lambda x: x["kind"] == "Panel")})
    is_part = lambda region: F.exists("p", lambda x: x["region"] == region)
    settled = F.forall("r", lambda x: is_part(x["region"]) | x["parent"].isNotNull())
    branch = F.when(F.size("s") == 1, "whole").when(F.col("images_annotated") & settled, "annotated").otherwise("spatial")
    out = worked_out(out, {"branch": branch, "forced": F.exists("r", lambda x: ~is_part(x["region"]) & x["parent"].isNotNull())})
    box_of = lambda region: F.array_min(F.transform(F.filter("b", lambda x: x["region"] == region), lambda x: F.struct(x["id"].alias("id"), x["kind"].alias("kind"), x["box"].alias("box"))))
    # annotated: pairs of regions with their boxes, and parts with theirs
    pairs = F.transform(F.filter("r", lambda x: (F.col("branch") == "annotated") & x["parent"].isNotNull() & ~is_part(x["region"])), lambda x: F.struct(x["region"].alias("child"), x["parent"].alias("parent"), box_of(x["region"]).alias("c"), box_of(x["parent"]).alias("q")))
    titled = F.transform(F.filter("p", lambda x: F.col("branch") == "annotated"), lambda x: F.struct(x["region"].alias("region"), x["name"].alias("name"), x["text"].alias("text"), box_of(x["region"]).alias("q")))
    # spatial: children with the panels that they touch, and what was annotated of them
    kids = F.transform(F.filter("b", lambda x: (F.col("branch") == "spatial") & (x["kind"] != "Panel")), lambda k: F.struct(k["id"].alias("id"), k["kind"].alias("kind"), k["box"].alias("box"), k["source"].alias("source"), k["region"].alias("region"), _first(F.col("r"), lambda x: x["region"] == k["region"]).alias("own")))
    out = worked_out(out, {"pairs": pairs, "titled": titled, "kids": kids})
    told = F.filter("pairs", lambda x: x["c"].isNotNull() & x["q"].isNotNull())
    held = lambda k: F.col("forced") & k["region"].isNotNull()
    kids = F.transform("kids", lambda k: F.struct(
        k["id"].alias("id"), k["kind"].alias("kind"), k["box"].alias("box"), k["source"].alias("source"), (held(k) & k["own"].isNull()).alias("unknown"), k["own"]["parent"].alias("parent"), box_of(k["own"]["parent"]).alias("q"),
        F.filter("panels", lambda x: touches(x["box"], k["box"])).alias("touch"), held(k).alias("held"),
    ))
    out = worked_out(out, {"told": told, "kids": kids})
    wrong = lambda k: F.filter(k["touch"], lambda x: k["held"] & k["parent"].isNotNull() & ~x["region"].eqNullSafe(k["parent"]))
    ids = lambda rows: F.transform(rows, lambda x: x["id"])
    out = worked_out(out, {"kids": F.transform("kids", lambda k: F.struct(k.alias("k"), ids(wrong(k)).alias("wrong"), (k["q"]["kind"] == "Panel").alias("may")))})
    moves = lambda x: F.coalesce(x["may"], F.lit(False)) & (F.size(x["wrong"]) > 0)
    at = lambda x: F.when(moves(x), F.array_sort(F.array_union(F.array_except(ids(x["k"]["touch"]), x["wrong"]), F.array(x["k"]["q"]["id"])))).otherwise(ids(x["k"]["touch"]))
    return worked_out(out, {"kids": F.transform("kids", lambda x: F.struct(x["k"].alias("k"), x["wrong"].alias("wrong"), moves(x).alias("moves"), at(x).alias("at")))})


def _conflict(rule: str, child: Column | None = None, before: Column | None = None, after: Column | None = None) -> Column:
    as_text = lambda c, name: (F.lit(None) if c is None else c).cast("string").alias(name)
    return F.struct(F.lit(rule).alias("rule"), as_text(child, "child"), as_text(before, "before"), as_text(after, "after"))


def _conflicts() -> tuple[Column, Column]:
    """Of a row of _figures: the ids of boxes that have a panel; an array of (rule, child, before, after), each once."""
    when = lambda holds, row: F.when(holds, F.array(row)).otherwise(F.array().cast("array<struct<rule:string,child:string,before:string,after:string>>"))
    of = lambda rows, holds, row: F.transform(F.filter(rows, holds), row)
    whole, only = F.col("branch") == "whole", F.get("s", F.lit(0))["name"]
    unnamed = F.coalesce(only != _NONE, F.lit(True))
    known = lambda region: F.exists("r", lambda x: x["region"] == region)
    has_children = lambda region: F.exists("told", lambda x: x["parent"] == region)
    attached = F.when(F.col("branch") == "annotated", F.array_union(F.transform("told", lambda x: x["c"]["id"]), F.transform(F.filter("titled", lambda x: x["q"].isNotNull() & has_children(x["region"])), lambda x: x["q"]["id"]))).otherwise(F.transform(F.filter("kids", lambda x: F.size(x["at"]) > 0), lambda x: x["k"]["id"]))
    loose = lambda x: ~whole & (x["source"] != "model") & ((F.col("branch") != "spatial") | (x["kind"] != "Panel")) & ~F.array_contains("attached", x["id"])
    each = lambda rule, holds, after: F.flatten(of("kids", holds, lambda x: F.transform(x["wrong"], lambda w: _conflict(rule, x["k"]["id"], w, after(x)))))
    rows = F.concat(
        when(whole & unnamed, _conflict("one part with a name", only)),
        when(whole & ~unnamed & (F.size("panels") != 1), _conflict("not one panel", F.size("panels"))),
        of("p", lambda x: ~whole & ~known(x["region"]), lambda x: _conflict("part of no region", x["region"])),
        of("titled", lambda x: ~has_children(x["region"]), lambda x: _conflict("panel without children", x["region"])),
        of("pairs", lambda x: x["c"].isNull(), lambda x: _conflict("region without a box", x["child"])),
        of("titled", lambda x: x["q"].isNull(), lambda x: _conflict("region without a box", x["region"])),
        of("kids", lambda x: x["k"]["unknown"] & (F.size(x["k"]["touch"]) > 0), lambda x: _conflict("box of no region", x["k"]["id"])),
        each("parent without a box", lambda x: x["k"]["q"].isNull(), lambda x: x["k"]["parent"]),
        each("parent is no panel", lambda x: x["k"]["q"].isNotNull() & ~x["moves"], lambda x: x["k"]["parent"]),
        of("panels", lambda x: (F.col("branch") == "spatial") & ~F.exists("p", lambda y: y["region"].eqNullSafe(x["region"])), lambda x: _conflict("panel without a part", x["id"])),
        of("b", loose, lambda x: _conflict("box without a panel", x["id"])),
        each("moved", lambda x: x["moves"], lambda x: x["k"]["q"]["id"]),
        of("kids", lambda x: F.size(x["at"]) > 1, lambda x: _conflict("in several panels", x["k"]["id"], F.array_join(x["at"].cast("array<string>"), ","))),
        of("told", lambda x: overlap(x["c"]["box"], x["q"]["box"]) == 0, lambda x: _conflict("outside its panel", x["c"]["id"], None, x["q"]["id"])),
    )
    return attached, F.array_distinct(rows)


def _panels() -> Column:
    """Of a row of _figures: its panels."""
    ids = lambda rows: F.array_sort(F.array_distinct(F.transform(rows, lambda x: x["id"])))
    low = lambda rows, e: F.array_min(F.transform(rows, lambda x: x["box"][e]))
    high = lambda rows, e: F.array_max(F.transform(rows, lambda x: x["box"][e]))
    span = lambda rows: [(low if e[1] == "0" else high)(rows, e).alias(e) for e in EDGES]
    image, label = lambda x: ~x["kind"].isin("Label", "Panel"), lambda x: x["kind"] == "Label"
    row = lambda panel_id, images, labels, content, name, text: F.struct(panel_id.alias("panel_id"), images.alias("image_ids"), labels.alias("label_ids"), *span(content), name.alias("name"), text.alias("text"))
    none, only, panel = F.array().cast("array<bigint>"), F.get("s", F.lit(0)), F.get("panels", F.lit(0))
    whole = F.array(row(panel["id"], ids(F.filter("b", image)), none, F.col("b"), only["name"], only["text"]))
    plain = lambda rows, name: F.transform(rows, lambda x: F.struct(x[name]["id"].alias("id"), x[name]["kind"].alias("kind"), x[name]["box"].alias("box")))
    own = lambda t: plain(F.filter("told", lambda x: x["parent"] == t["region"]), "c")
    annotated = F.transform(F.filter("titled", lambda t: t["q"].isNotNull() & (F.size(own(t)) > 0)), lambda t: row(t["q"]["id"], ids(F.filter(own(t), image)), ids(F.filter(own(t), label)), F.concat(own(t), F.array(t["q"])), t["name"], t["text"]))
    at = lambda p: plain(F.filter("kids", lambda x: F.array_contains(x["at"], p["id"])), "k")
    lying = lambda p: plain(F.filter("kids", lambda x: image(x["k"]) & F.exists(x["k"]["touch"], lambda y: y["id"] == p["id"])), "k")
    itself = lambda p: F.array(F.struct(p["id"].alias("id"), p["kind"].alias("kind"), p["box"].alias("box")))
    part = lambda p: _first(F.col("p"), lambda x: x["region"] == p["region"])
    spatial = F.transform("panels", lambda p: row(p["id"], ids(F.filter(at(p), image)), ids(F.filter(at(p), label)), F.concat(lying(p), itself(p)), part(p)["name"], part(p)["text"]))
    return F.when(F.col("branch") == "whole", whole).when(F.col("branch") == "annotated", annotated).otherwise(spatial)


def reconciled(figures: DataFrame, boxes: DataFrame, regions: DataFrame, parts: DataFrame, splits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(panels, conflicts).

    panels: fig, branch, panel_id, image_ids, label_ids, x0, y0, x1, y1 (the content's box), name, text.
    conflicts: fig, rule, child, before, after, fatal. child, before and after are ids as texts: of the box or region, of the panel
    that it lies in, of the one that was annotated.

    A figure is one row on the way: figures have tens of boxes. Its tables meet by fig alone, in one shuffle each.
    """
    rows = _figures(figures, boxes, regions, parts, splits)
    attached, conflicts = _conflicts()
    rows = worked_out(worked_out(rows, {"attached": attached}), {"conflicts": conflicts})
    table = rows.select("fig", F.explode("conflicts").alias("c")).select("fig", "c.*").withColumn("fatal", F.col("rule").isin(FATAL))
    sound = rows.where(~F.exists("conflicts", lambda c: c["rule"].isin(FATAL)))
    panels = worked_out(sound, {"panel": _panels()}).select("fig", "branch", F.inline("panel"))
    return panels, table


def clipped_children(panels: DataFrame, boxes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(panels with their content's box anew, children: fig, panel_id, id, kind, box).

    Where a panel has both annotated children and a model's, its content spans the annotated ones alone; a model's box is cut
    to the content.
    """
    ids = panels.select("fig", "panel_id", F.explode(F.concat("image_ids", "label_ids")).alias("id"))
    kids = ids.join(boxes.select("fig", "id", "kind", "source", "box"), ["fig", "id"])
    annotated = F.when(F.col("source") == "annotation", F.col("box"))
    spans = kids.groupBy("fig", "panel_id").agg(union_of(lambda e: annotated[e]).alias("span"), F.bool_or(F.col("source") == "model").alias("has_model"))
    anew = panels.join(spans, ["fig", "panel_id"], "left").withColumn("anew", F.coalesce(F.col("has_model") & F.col("span.x0").isNotNull(), F.lit(False)))
    anew = anew.select(*[F.when(F.col("anew"), F.col("span")[c]).otherwise(F.col(c)).alias(c) if c in EDGES else F.col(c) for c in panels.columns])
    inside = kids.join(anew.select("fig", "panel_id", F.struct(*EDGES).alias("content")), ["fig", "panel_id"])
    b, c = F.col("box"), F.col("content")
    cut = box(F.greatest(b["x0"], c["x0"]), F.greatest(b["y0"], c["y0"]), F.least(b["x1"], c["x1"]), F.least(b["y1"], c["y1"]))
    return anew, inside.select("fig", "panel_id", "id", "kind", F.when(F.col("source") == "model", cut).otherwise(b).alias("box"))


def with_texts(panels: DataFrame, texts: DataFrame) -> DataFrame:
    """panels with labels: for each of label_ids its id, the panel's caption, and the text read on it (texts: fig, label_id, text,
    confidence), null where none was."""
    labels = panels.select("fig", "panel_id", F.col("text").alias("caption"), F.explode("label_ids").alias("label_id")).join(texts.select("fig", "label_id", F.col("text").alias("read"), "confidence"), ["fig", "label_id"], "left")
    entry = F.struct("label_id", F.col("caption").alias("sub_caption_text"), F.col("read").alias("text"), "confidence")
    found = labels.groupBy("fig", "panel_id").agg(F.array_sort(F.collect_list(entry)).alias("labels"))
    return panels.join(found, ["fig", "panel_id"], "left").withColumn("labels", F.coalesce("labels", F.array().cast(found.schema["labels"].dataType)))
