"""Panels to captions: greedy one-to-one matching, hierarchy flags, figure status, output rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.functions.boxes import EDGES, overlap, to_shares, union_of
from panelmill.functions.text import assignable, attribution, commercial_use, figure_uuid, panel_name, stable_forms, tagged_forms, word_distance
from panelmill.operators.nms import split_nms


#: How a panel's caption was assigned, as stored and as given out.
METHODS = {
    "automatic_caption_assignment": "Automatic Caption Assignment",
    "llm_assignment": "LLM Assignment",
    "llm_adjudication": "LLM Assignment (adjudication)",
    "automatic": "Automatic Caption Assignment",
    "llm_refinement": "LLM Assignment",
    "ground_truth": "Ground Truth",
    "llm_refinement_with_adjudication": "LLM Assignment (adjudication)",
    "manual_annotation": "Manual Assignment",
    "manual_assignment": "Manual Assignment",
    "manual_assignment_joining": "Manual Assignment",
    "manual_due_to_positional_captions": "Manual Assignment",
}
#: Origins whose figures get their boxes anew.
RENEWED = ["llm_assignment", "llm_adjudication", "manual_assignment", "manual_assignment_joining"]
RELEVANT = ["CFP", "OCT", "Retinal Imaging"]
#: Writes a table under a name and reads it.
Keep = Callable[[DataFrame, str], DataFrame]


def _as_it_is(df: DataFrame, name: str) -> DataFrame:
    return df


def in_order(candidates: DataFrame, group: str, left: str, right: str, order: list[Column]) -> DataFrame:
    """One-to-one pairs of each group: candidates are taken by order, each unless its left or right is taken."""
    t = dict(candidates.dtypes)
    kind = f"array<struct<l:{t[left]},r:{t[right]}>>"
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(left).alias("l"), F.col(right).alias("r"))
    pairs = candidates.groupBy(group).agg(F.transform(F.sort_array(F.collect_list(rank)), lambda x: F.struct(x["l"].alias("l"), x["r"].alias("r"))).alias("p"))
    step = lambda acc, p: F.when(F.exists(acc, lambda k: (k["l"] == p["l"]) | (k["r"] == p["r"])), acc).otherwise(F.concat(acc, F.array(p)))
    taken = pairs.select(group, F.explode(F.aggregate("p", F.array().cast(kind), step)).alias("p"))
    return taken.select(group, F.col("p.l").alias(left), F.col("p.r").alias(right))


def greedy_match(candidates: DataFrame, group: str, left: str, right: str, score: str) -> DataFrame:
    """One-to-one pairs of each group by falling score, then left, then right."""
    taken = in_order(candidates, group, left, right, [-F.col(score).cast("double"), F.col(left), F.col(right)])
    return taken.join(candidates.groupBy(group, left, right).agg(F.max(score).cast("double").alias(score)), [group, left, right])


def labels_to_captions(texts: DataFrame, captions: DataFrame) -> DataFrame:
    """fig, label_id, caption_id: texts read on labels matched to captions' names, one to one.

    texts (fig, label_id, panel_id, text, confidence): panel_id is null for a label's own box, else the panel in whose
    crop the text was found. captions (fig, caption_id, name, place). Labels' own texts come first, by falling
    confidence; then those of panels, panel by panel; each takes the first caption by place that it matches.
    """
    # what depends on a figure's names, or on one name or text alone, is worked out once for each
    own = captions.where("name is not null").groupBy("fig").agg(F.collect_list(F.struct("caption_id", "place", "name")).alias("caps"))
    own = own.withColumn("stable", stable_forms(F.transform("caps", lambda c: c["name"])))
    own = own.select("fig", F.transform("caps", lambda c: F.struct(c["caption_id"].alias("caption_id"), c["place"].alias("place"), tagged_forms(c["name"], F.col("stable")).alias("forms"))).alias("caps"))
    asked = texts.withColumn("forms", tagged_forms(F.col("text")))
    fits = F.filter("caps", lambda c: F.coalesce(F.arrays_overlap(c["forms"], F.col("forms")), F.lit(False)))
    pairs = asked.join(own, "fig").withColumn("c", F.explode(fits)).select(*texts.columns, "c.caption_id", "c.place")
    order = [F.coalesce(F.col("panel_id").cast("bigint"), F.lit(-(2**63)).cast("bigint")), -F.col("confidence").cast("double"), F.col("label_id"), F.col("place")]
    return in_order(pairs, "fig", "label_id", "caption_id", order)


def panel_flags(panels: DataFrame, texts: DataFrame, matched: DataFrame) -> DataFrame:
    """Flags of each panel, and its caption if exactly one own label has one.

    panels (fig, panel_id, label_ids); texts and matched as in labels_to_captions. A label without text is left out of the
    panel's labels, but their number then differs from that of label_ids, which asks for review.
    """
    own = texts.where("panel_id is null").select("fig", "label_id").distinct()
    at = panels.select("fig", "panel_id", F.explode("label_ids").alias("label_id")).join(own, ["fig", "label_id"]).withColumn("estimated", F.lit(False))
    found = texts.where("panel_id is not null").select("fig", "label_id", "panel_id", F.lit(True).alias("estimated"))
    every = at.unionByName(found).join(matched, ["fig", "label_id"], "left")
    shared = at.join(matched, ["fig", "label_id"], "left_semi").groupBy("fig", "label_id").agg((F.count("*") > 1).alias("shared"))
    every = every.join(shared, ["fig", "label_id"], "left")
    has = F.col("caption_id").isNotNull()
    each = every.groupBy("fig", "panel_id").agg(
        F.count_if(has).alias("n_labels"), F.count_if(~has & ~F.col("estimated")).alias("n_unassigned"), F.bool_or(has & F.col("estimated")).alias("est"), F.bool_or(has & F.col("shared")).alias("sh"), F.max("caption_id").alias("cap"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    no = lambda c: F.coalesce(c, F.lit(False))
    out = panels.join(each, ["fig", "panel_id"], "left")
    out = out.withColumns({"n_labels": zero(F.col("n_labels")), "n_unassigned": zero(F.col("n_unassigned")), "has_estimated_labels": no(F.col("est")), "has_shared_labels": no(F.col("sh"))})
    out = out.withColumn("needs_review", (F.col("n_labels") == 0) | (F.col("n_unassigned") > 0) | (F.col("n_labels") != F.size("label_ids")))
    clean = (F.col("n_labels") == 1) & (F.col("n_unassigned") == 0) & ~F.col("has_estimated_labels") & ~F.col("has_shared_labels")
    return out.withColumn("assigned_subcaption", F.when(clean, F.col("cap"))).drop("est", "sh", "cap")


def assembled(figures: DataFrame, boxes: DataFrame, panels: DataFrame, captions: DataFrame, texts: DataFrame, keep: Keep = _as_it_is) -> DataFrame:
    """Captions of panels without a model: fig, panel_id, relevance, assigned_subcaption and the flags.

    figures (fig, full_caption_id, full_caption), boxes (fig, id, kind, score), panels (fig, panel_id, label_ids), captions (fig,
    caption_id, name, text, place), texts as in labels_to_captions. A figure without an image of RELEVANT has no relevant
    panel. One with a single part that is named None, or whose text is less than 4 words away from the full caption, gives
    the full caption to its best panel (panel_id null if there is none) and no other panel is relevant; with any other
    single part none is. Else labels are matched; texts count only where all names have a stem of one letter. keep is asked
    to write what is read several times.
    """
    kinds = boxes.groupBy("fig").agg(F.bool_or(F.col("kind").isin(RELEVANT)).alias("relevant"), F.max_by(F.when(F.col("kind") == "Panel", F.col("id")), F.when(F.col("kind") == "Panel", F.struct("score", -F.col("id")))).alias("best"))
    own = captions.groupBy("fig").agg(F.count("*").alias("n"), F.collect_list("name").alias("names"), F.count("name").alias("named"), F.max("text").alias("text"))
    status = figures.join(kinds, "fig").join(own, "fig", "left")
    single = (F.col("n") == 1) & ((F.col("named") == 0) | (F.get("names", F.lit(0)) == "None") | (word_distance(F.col("full_caption"), F.col("text")) < 4))
    status = status.withColumn("branch", F.when(~F.col("relevant"), "irrelevant").when(single, "whole").when(F.col("n") == 1, "irrelevant").otherwise("matched"))
    status = status.withColumn("reads", (F.col("branch") == "matched") & assignable(F.coalesce("names", F.array().cast("array<string>"))))
    status = keep(status.select("fig", "full_caption_id", "best", "branch", "reads"), "status")
    of = lambda name: status.where(F.col("branch") == name)
    nothing = lambda t: F.lit(None).cast(t)
    id_type = dict(captions.dtypes)["caption_id"]
    flags = ["has_estimated_labels", "needs_review", "has_shared_labels"]
    plain = lambda value: [F.lit(value).cast("boolean").alias(n) for n in flags]
    none = panels.join(of("irrelevant"), "fig").select("fig", "panel_id", F.lit(False).alias("relevance"), nothing(id_type).alias("assigned_subcaption"), *plain(None))
    whole = of("whole").select("fig", F.col("best").alias("panel_id"), F.lit(True).alias("relevance"), F.col("full_caption_id").cast(id_type).alias("assigned_subcaption"), *plain(False))
    others = panels.join(of("whole"), "fig").where(~F.col("panel_id").eqNullSafe(F.col("best"))).select("fig", "panel_id", F.lit(False).alias("relevance"), nothing(id_type).alias("assigned_subcaption"), *plain(None))
    read = texts.join(status.where("reads").select("fig"), "fig", "left_semi")
    matched = keep(labels_to_captions(read, captions), "matched")
    general = panel_flags(panels.join(of("matched").select("fig"), "fig", "left_semi"), read, matched)
    return none.unionByName(whole).unionByName(others).unionByName(general.select("fig", "panel_id", F.lit(True).alias("relevance"), "assigned_subcaption", *flags))


def figure_status(panels: DataFrame, figure: str = "fig") -> DataFrame:
    """Counts of a figure's panels, and whether some of them still want work: partial.

    panels: relevance, has_shared_labels, needs_review, has_estimated_labels, assigned_subcaption.
    """
    flawed = F.col("has_shared_labels") | F.col("needs_review") | F.col("has_estimated_labels")
    unset = F.col("assigned_subcaption").isNull()
    s = panels.groupBy(figure).agg(F.count("*").alias("n"), F.count_if(~F.col("relevance")).alias("n_irrelevant"), F.count_if(flawed | unset).alias("n_review"), F.count_if(F.col("relevance") & ~flawed & ~unset).alias("n_done"))
    settled = (F.col("n_irrelevant") > 0) & (F.col("n_done") + F.col("n_irrelevant") == F.col("n"))
    return s.withColumn("partial", (F.col("n_irrelevant") != F.col("n")) & ~settled & (F.col("n_review") > 0))


def eligible(panels: DataFrame) -> DataFrame:
    """Panels that go out; a null in any test keeps a panel back."""
    return panels.where("not needs_review and not has_estimated_labels and not has_shared_labels and relevance and assigned_subcaption is not null and origin <> 'manual_assignment_rejection'")


def _position(name: str, b: Column, score: Column) -> Column:
    return F.to_json(F.struct(F.array(*[b[e] for e in EDGES]).alias("predicted_box"), score.alias("prediction_score"))).alias(name)


def panel_rows(panels: DataFrame, predictions: DataFrame, figures: DataFrame, articles: DataFrame, captions: DataFrame, labels: DataFrame, least_overlap: float = 0.9, keep: Keep = _as_it_is) -> DataFrame:
    """The output's rows from the tables of the assembly, one for each eligible panel.

    panels (panel_id, label_ids, image_ids, content_box, assigned_subcaption, origin and the flags), predictions (id, fig, kind,
    score, marked, marked_score, box, survives_nms), figures (fig, article_id, image_cluster_id, width, height,
    page_boxes), articles (article_id, image_cluster_id, title, citation, license, context; of rows under one key the first by these columns counts), captions
    (id, name, text), labels (id, origin, confidence, box). A figure with a panel of RENEWED origin is suppressed anew, and
    takes in the boxes that lie in a panel. Positions are shares of the figure. panel_image is left to the caller, who crops `crop`. keep is
    asked to write what is read several times.
    """
    articles = articles.groupBy("article_id", "image_cluster_id").agg(F.min(F.struct(*[c for c in articles.columns if c not in ("article_id", "image_cluster_id")])).alias("_a")).select("article_id", "image_cluster_id", "_a.*")
    p = eligible(panels).drop("fig").join(predictions.select(F.col("id").alias("panel_id"), "fig"), "panel_id")
    p = p.join(figures.select("fig", "article_id", "image_cluster_id", "width", "height", "page_boxes"), "fig").withColumn("renew", F.coalesce(F.col("origin").isin(RENEWED), F.lit(False)))
    p = keep(p, "eligible")
    renew = p.groupBy("fig").agg(F.bool_or("renew").alias("renew"), F.collect_set("panel_id").alias("used"))
    p = p.drop("renew").join(renew.drop("used"), "fig")
    boxes = predictions.join(renew, "fig").join(figures.select("fig", "width", "height"), "fig")
    flat = boxes.where("renew and survives_nms").select("id", "fig", F.when(F.col("kind") == "Panel", 0).when(F.col("kind") == "Label", 1).otherwise(2).alias("cls"), "box.*", "score")
    kept = split_nms(flat, limit=0.3, least_score=0.25).select("fig", "id", F.lit(True).alias("kept"))
    boxes = boxes.join(kept, ["fig", "id"], "left").where("(survives_nms and (not renew or kept)) or array_contains(used, id)")
    inside = lambda e: F.least(F.greatest(F.col("box")[e], F.lit(0.0)), F.col("width" if e[0] == "x" else "height").cast("double"))
    boxes = boxes.select("fig", "id", "kind", "score", "marked", "marked_score", F.struct(*[inside(e).alias(e) for e in EDGES]).alias("box"))
    boxes = keep(boxes, "boxes")

    # what belongs to each panel: boxes that it names, and in renewed figures those that lie in it
    whole = boxes.select(F.col("id").alias("panel_id"), F.col("box").alias("panel_box"), F.col("score").alias("panel_score"))
    p = keep(p.join(whole, "panel_id"), "panels")
    other = boxes.where("kind <> 'Panel'").select("fig", F.col("id").alias("part"), "kind", "score", "marked", "marked_score", "box")
    near = p.select("fig", "panel_id", "panel_box", "renew", "width", "height", "image_ids", "label_ids").join(other, "fig")
    named = F.when(F.col("kind") == "Label", F.array_contains("label_ids", F.col("part"))).otherwise(F.array_contains("image_ids", F.col("part")))
    near = near.withColumn("named", F.coalesce(named, F.lit(False))).withColumn("added", ~F.col("named") & F.col("renew") & (overlap(F.col("box"), F.col("panel_box")) >= least_overlap)).where("named or added")
    share = to_shares(F.col("box"), F.col("width"), F.col("height"))
    mark = F.struct(F.when(F.col("marked") == "Annotated", "Marked").otherwise("Unmarked").alias("label"), F.col("marked_score").alias("prediction_score")).alias("mark_status")
    image = F.struct(F.col("part"), F.concat(F.lit("i_"), "part").alias("id"), F.struct(F.array("kind").alias("label"), F.array("score").alias("prediction_score")).alias("imaging_type"), mark, F.lit(False).alias("is_gt"), F.lit(True).alias("included_in_content_box"), F.col("added").alias("added_content_box_via_nms"), _position("position", share, F.col("score")))
    label = F.struct(F.col("part"), F.concat(F.lit("lip_"), "part").alias("id"), F.lit("detection").alias("origin"), F.lit(False).alias("is_gt"), F.lit(True).alias("included_in_content_box"), F.col("added").alias("added_content_box_via_nms"), _position("position", share, F.col("score")))
    parts = near.groupBy("panel_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") != "Label", image))).alias("images"), F.array_sort(F.collect_list(F.when(F.col("kind") == "Label", label))).alias("detected"), union_of(lambda e: F.col("box")[e]).alias("parts_box"),
    )
    # labels that only the assignment knows; those of origin -1 are known by their panel alone
    asked = p.select("panel_id", "width", "height", F.explode("label_ids").alias("part")).join(other.select("part").distinct(), "part", "left_anti").join(labels.select(F.col("id").alias("part"), F.col("origin").alias("from"), "confidence", "box"), "part")
    made = F.col("from") == "-1"
    source = predictions.select(F.col("id").cast("string").alias("from"), F.col("id").alias("source"))
    asked = asked.join(source, "from", "left")
    assigned = F.struct(F.col("part"), F.concat(F.lit("la_"), "part").alias("id"), F.lit("assignment").alias("origin"), F.lit(False).alias("is_gt"), (~made).alias("included_in_content_box"), F.lit(False).alias("added_content_box_via_nms"), _position("position", share, F.col("confidence")), F.when(F.col("source").isNotNull(), F.concat(F.lit("lip_"), "source")).alias("origin_identifier"))
    more = asked.groupBy("panel_id").agg(F.array_sort(F.collect_list(assigned)).alias("assigned"), F.bool_or(made).alias("remade"), union_of(lambda e: F.when(~made, F.col("box")[e])).alias("labels_box"))
    p = p.join(parts, "panel_id", "left").join(more, "panel_id", "left")
    every = F.struct(*[(F.least if e[1] == "0" else F.greatest)(F.col("panel_box")[e], F.col("parts_box")[e], F.col("labels_box")[e]).alias(e) for e in EDGES])
    crop = F.when(F.col("renew") | F.coalesce("remade", F.lit(False)), every).otherwise(F.col("content_box"))
    p = p.withColumn("box", crop).withColumn("crop", F.struct(*[inside(e).alias(e) for e in EDGES]))
    names = captions.select(F.col("id").alias("assigned_subcaption"), "name", "text")
    p = p.join(articles, ["article_id", "image_cluster_id"], "left").join(names, "assigned_subcaption", "left")
    listed = lambda c: F.coalesce(c, F.array())
    has = lambda k: F.coalesce(F.exists("images", lambda x: F.array_contains(x["imaging_type"]["label"], k)), F.lit(False))
    at = lambda b: F.array(*[to_shares(b, F.col("width"), F.col("height"))[e] for e in EDGES])
    without = lambda c: F.transform(c, lambda x: x.dropFields("part"))
    identifiers = F.concat(F.coalesce(F.transform("detected", lambda x: F.to_json(x.dropFields("part"))), listed(F.lit(None).cast("array<string>"))), F.coalesce(F.transform("assigned", lambda x: F.to_json(x.dropFields("part"))), F.array().cast("array<string>")))
    return p.select(
        F.concat(F.lit("p_"), "panel_id").alias("panel_id"), "article_id", "image_cluster_id", panel_name(F.col("name"), F.col("text")).alias("panel_name"), F.col("text").alias("subcaption_text"),
        "crop",
        F.to_json(F.struct(at(F.col("panel_box")).alias("predicted_box"), at(F.col("crop")).alias("content_box"), F.col("page_boxes").alias("figure_page_coordinates"), F.col("panel_score").alias("prediction_score"))).alias("position"),
        F.coalesce(F.size("page_boxes") > 1, F.lit(False)).alias("is_multi_page_figure"), F.to_json("context").alias("in_text_mention"),
        has("CFP").alias("contains_cfp"), has("OCT").alias("contains_oct"), has("Retinal Imaging").alias("contains_retinal"), has("Other").alias("contains_other"),
        F.coalesce(F.exists("images", lambda x: x["mark_status"]["label"] == "Marked"), F.lit(False)).alias("contains_marked"),
        F.coalesce(F.to_json(without("images")), F.lit("[]")).alias("image_data"), F.concat(F.lit("["), F.array_join(identifiers, ","), F.lit("]")).alias("identifier_data"),
        F.col("origin").alias("assembly"), F.lit("[]").alias("annotation"), "license", attribution(F.col("title"), F.col("citation")).alias("attribution"), commercial_use(F.col("license")).alias("commercial_use"),
    )


def final_rows(annotated: DataFrame, built: DataFrame, annotated_figures: DataFrame) -> DataFrame:
    """Annotations and, of figures without one, the built rows: those that show a relevant image, with the method's name.

    annotated_figures (figure_uuid): all figures with an annotation, whether it shows a relevant image or not.
    """
    shows = F.col("contains_cfp") | F.col("contains_oct") | F.col("contains_retinal")
    uuid = figure_uuid(F.col("article_id"), F.col("image_cluster_id"))
    rest = built.where(shows).withColumn("figure_uuid", uuid).join(annotated_figures.select("figure_uuid").distinct(), "figure_uuid", "left_anti").drop("figure_uuid")
    out = annotated.where(shows).withColumn("no_buffer_render", F.lit(True)).unionByName(rest.withColumn("no_buffer_render", F.lit(False)), allowMissingColumns=True)
    names = F.create_map(*[F.lit(x) for pair in METHODS.items() for x in pair])
    number = F.col("panel_id").cast("string")
    return out.withColumns({"dpi": F.lit(None).cast("int"), "assembly": names[F.col("assembly")], "panel_id": F.when(number.rlike("^[0-9]+$"), F.concat(F.lit("p_"), number)).otherwise(number)})


def by_name(value: Column, names: dict[str, str]) -> Column:
    """The name under which a value is given out; null for one that has none."""
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[value]


def annotated_parent(attached: DataFrame, annotations: DataFrame) -> DataFrame:
    """fig, child_id, parent_id: a child's annotated parent goes before the one it lies in; one without either has null.

    attached (fig, child_id, parent_id), annotations (fig, child_id, annotated_id).
    """
    return attached.join(annotations, ["fig", "child_id"], "left").select("fig", "child_id", F.coalesce("annotated_id", "parent_id").alias("parent_id")).distinct()


def children_of(attached: DataFrame) -> DataFrame:
    """fig, parent_id and the sorted ids of its children."""
    return attached.where("parent_id is not null").groupBy("fig", "parent_id").agg(F.array_sort(F.collect_set("child_id")).alias("children"))


def consistent_or_list(df: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """The value if all rows of a key have it, else the list of values."""
    return df.groupBy(*key).agg(F.when((F.count_distinct(value) == 1) & (F.count(value) == F.count("*")), F.max(value)).alias("value"), F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias("list")).withColumn("list", F.when(F.col("value").isNull(), F.col("list")))


def restore_text(rows: DataFrame, originals: DataFrame, key: str, column: str) -> DataFrame:
    """Nulls of column filled from originals under the same key."""
    return rows.join(originals.select(key, F.col(column).alias("_o")), key, "left").withColumn(column, F.coalesce(column, "_o")).drop("_o")
