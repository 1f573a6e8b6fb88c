"""Screens on a model's assignments, with reasons, and asking again for what failed.

assignments by panel: fig, panel_id, reject_panel, assigned_subcaption, evidence (an array of structs with label_id for an existing
label, bbox_2d in thousandths for a new one). By place: fig, assigned_images, assigned_subcaption. What a figure allows comes
from its tables; ids are compared as texts. A figure passes if no rule is broken; assignments of final panels are taken out
of what passes, and are a reason only beside an unknown panel, label or caption.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.functions.boxes import area, from_thousandths, overlap
from panelmill.operators.relational import worked_out

#: Rules by panel and by place, in the order in which their reasons are given.
PANEL_RULES = ["unknown panel", "unknown label", "new label outside its panel", "new label too large", "unknown caption", "final panel", "no caption without rejection"]
PLACE_RULES = ["unknown image", "unknown caption", "no caption"]
#: A new label's share that lies in its panel, at least; its area as a share of the panel's, at most.
INSIDE, LARGE = 0.05, 0.2
_STRICT = ["unknown panel", "unknown label", "unknown caption"]


def _beside(rows: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """rows and other joined by figure, never by a broadcast: files of a table with a row for each figure can be a twentieth of its rows
    in memory, and Spark takes their size for that of the rows, so it would send millions of figures through the driver."""
    return rows.join(other.hint("merge"), "fig", how)


def allowed(figures: DataFrame, panels: DataFrame, labels: DataFrame, images: DataFrame, captions: DataFrame) -> DataFrame:
    """One row for each figure with what its assignments may name.

    figures (fig, width, height), panels (fig, panel_id, is_final, content: a box or null), labels (fig, label_id), images (fig,
    image_id), captions (fig, name).
    """
    ids = lambda df, c, name: df.groupBy("fig").agg(F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(name))
    text = F.col("panel_id").cast("string")
    own = panels.groupBy("fig").agg(F.array_sort(F.collect_list(F.struct(text.alias("id"), F.coalesce("is_final", F.lit(False)).alias("is_final"), "content"))).alias("panels"))
    out = _beside(figures.select("fig", "width", "height"), own, "left")
    for df, c, name in ((labels, "label_id", "label_ids"), (images, "image_id", "image_ids"), (captions, "name", "names")):
        out = _beside(out, ids(df, c, name), "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return out.withColumn("panels", F.coalesce("panels", F.array().cast(own.schema["panels"].dataType)))


def _broken(rule: str, holds: Column, value: Column) -> Column:
    """An array with (rule, value) if the rule is broken."""
    return F.when(holds, F.array(F.struct(F.lit(rule).alias("rule"), value.cast("string").alias("value")))).otherwise(F.array().cast("array<struct<rule:string,value:string>>"))


def by_panel(assignments: DataFrame, options: DataFrame) -> DataFrame:
    """The assignments with is_final and broken: (rule, value) of each rule that one breaks."""
    return _panel_rules(_beside(assignments, options), assignments.columns)


def _panel_rules(a: DataFrame, columns: list[str]) -> DataFrame:
    """columns, is_final and broken of assignments beside what their figure allows."""
    a = a.withColumn("panel_id", F.col("panel_id").cast("string"))
    a = a.withColumn("_panel", F.get(F.filter("panels", lambda p: p["id"] == F.col("panel_id")), F.lit(0)))
    final, content = F.coalesce(F.col("_panel.is_final"), F.lit(False)), F.col("_panel.content")
    evidence = F.coalesce("evidence", F.array().cast(a.schema["evidence"].dataType))
    corners = lambda e: F.struct(*[F.get(e["bbox_2d"], F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])
    new = F.transform(F.filter(evidence, lambda e: e["label_id"].isNull() & e["bbox_2d"].isNotNull()), lambda e: from_thousandths(corners(e), F.col("width"), F.col("height")))
    old = F.filter(F.transform(evidence, lambda e: e["label_id"].cast("string")), lambda x: x.isNotNull())
    a = a.withColumns({"_new": new, "_old": old})
    caption = F.col("assigned_subcaption")
    some = lambda test: ~final & content.isNotNull() & F.exists("_new", test)
    unknown = F.flatten(F.transform(F.filter("_old", lambda x: ~F.array_contains("label_ids", x)), lambda x: _broken("unknown label", ~final, x)))
    rules = F.concat(
        _broken("unknown panel", F.col("_panel").isNull(), F.col("panel_id")),
        unknown,
        _broken("new label outside its panel", some(lambda b: overlap(b, content) < INSIDE), F.col("panel_id")),
        _broken("new label too large", some(lambda b: area(b) > LARGE * area(content)), F.col("panel_id")),
        _broken("unknown caption", ~final & caption.isNotNull() & ~F.array_contains("names", caption), caption),
        _broken("final panel", final, F.col("panel_id")),
        _broken("no caption without rejection", ~final & caption.isNull() & ~F.coalesce("reject_panel", F.lit(False)), F.col("panel_id")),
    )
    return a.select(*columns, final.alias("is_final"), rules.alias("broken"))


def by_place(assignments: DataFrame, options: DataFrame) -> DataFrame:
    """As by_panel, for assignments that name images."""
    return _place_rules(_beside(assignments, options), assignments.columns)


def _place_rules(a: DataFrame, columns: list[str]) -> DataFrame:
    caption = F.col("assigned_subcaption")
    images = F.filter(F.transform("assigned_images", lambda x: x.cast("string")), lambda x: ~F.array_contains("image_ids", x))
    rules = F.concat(
        F.flatten(F.transform(images, lambda x: _broken("unknown image", F.lit(True), x))),
        _broken("unknown caption", caption.isNotNull() & ~F.array_contains("names", caption), caption),
        _broken("no caption", caption.isNull(), F.lit("None")),
    )
    return a.select(*columns, F.lit(False).alias("is_final"), rules.alias("broken"))


def reasons(screened: DataFrame, options: DataFrame) -> DataFrame:
    """fig and reasons: of figures that fail, one text for each broken rule, with the values that broke it and those allowed."""
    rows = screened.select("fig", F.explode("broken").alias("b")).groupBy("fig").agg(F.collect_set("b").alias("every"))
    strict = F.exists("every", lambda b: b["rule"].isin(_STRICT))
    order = F.array(*map(F.lit, dict.fromkeys(PANEL_RULES + PLACE_RULES)))
    broken = F.filter(order, lambda r: F.exists("every", lambda b: b["rule"] == r) & ((r != "final panel") | strict))
    values = lambda r: F.array_sort(F.array_compact(F.transform(F.filter("every", lambda b: b["rule"] == r), lambda b: b["value"])))
    rows = _beside(worked_out(rows, {"rules": F.transform(broken, lambda r: F.struct(r.alias("rule"), values(r).alias("values")))}).where("size(rules) > 0"), options)
    listed = lambda x: F.concat(F.lit("["), F.array_join(x, ", "), F.lit("]"))
    valid = lambda rule: F.when(rule == "unknown panel", listed(F.array_distinct(F.transform("panels", lambda p: p["id"])))).when(rule == "unknown label", listed(F.col("label_ids"))).when(rule == "unknown image", listed(F.col("image_ids"))).when(rule == "unknown caption", listed(F.col("names")))
    told = F.transform("rules", lambda r: F.concat(r["rule"], F.lit(": "), listed(r["values"]), F.coalesce(F.concat(F.lit("; valid: "), valid(r["rule"])), F.lit(""))))
    return rows.select("fig", told.alias("reasons"))


def asked_again(items: DataFrame, ask: Callable[[DataFrame, str], DataFrame], options: DataFrame, keep: Callable[[DataFrame, str], DataFrame], path: str, rounds: int = 5) -> tuple[DataFrame, DataFrame]:
    """(passed: fig, round and the assignments without final panels; left: fig, reasons of those that no round passed).

    ask(items, path) gives fig and the raw answer (a JSON text by panel or by place); from the second round on items have the
    answer before and its reasons. Only figures that failed are asked again. keep(df, path) writes a table and reads it, so each
    answer is read as it came, and once. An answer that is neither form is a reason, too.
    """
    from panelmill.operators.annotations import answers_read

    empty = F.array().cast("array<string>")
    options, items = keep(options, f"{path}/options"), keep(items, f"{path}/items")  # read several times in each round
    todo = items.select("*", F.lit(None).cast("string").alias("answer_before"), empty.alias("reasons"))
    passed = None
    for n in range(1, rounds + 1):
        answers = keep(ask(todo, f"{path}/ask-{n}").select("fig", "answer", answers_read(F.col("answer")).alias("form")), f"{path}/answers-{n}")
        said = lambda form, where: _beside(answers.where(where).select("fig", F.col(f"form.{form}").alias("_said")), options).select("*", F.explode("_said").alias("_x")).select(*options.columns, "_x.*")
        own = lambda rows: ["fig", *[c for c in rows.columns if c not in options.columns]]
        panel = said("by_panel", "form.by_panel is not null")
        place = said("by_place", "form.by_panel is null and form.by_place is not null")
        lost = answers.where("form.by_panel is null and form.by_place is null").select("fig", F.array(F.lit("no assignments")).alias("reasons"))
        screened = keep(_panel_rules(panel, own(panel)).unionByName(_place_rules(place, own(place)), allowMissingColumns=True), f"{path}/screened-{n}")
        bad = keep(reasons(screened.select("fig", "broken"), options).unionByName(lost), f"{path}/failed-{n}")
        good = screened.where("not is_final").drop("is_final", "broken")
        good = keep(_beside(good, bad.select("fig"), "left_anti").withColumn("round", F.lit(n)), f"{path}/passed-{n}")
        passed = good if passed is None else passed.unionByName(good)
        todo = keep(_beside(_beside(items, bad), answers.select("fig", F.col("answer").alias("answer_before"))).select(*items.columns, "answer_before", "reasons"), f"{path}/todo-{n}")
        if n == rounds or todo.isEmpty():
            break
    return passed, todo.select("fig", "reasons")
