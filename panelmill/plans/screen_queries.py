"""Queries of screened answers. Figures are orders, panels their lines; what is wrong with an answer follows from the keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.operators.detection import average_precision, median_overlap
from panelmill.operators.screens import allowed, asked_again, by_panel, by_place, reasons
from panelmill.plans.base import B, Tables, query
from panelmill.plans.stages import applied, batched, stored
from panelmill.sources.scratch import folder


def _options(spark, d):
    t = Tables(spark, d)
    lines, orders = t.lineitem, t.orders
    fig = F.col("l_orderkey").alias("fig")
    content = F.when(F.col("l_linenumber") % 6 != 0, F.struct(*[x.cast("double").alias(n) for n, x in (("x0", F.col("l_linenumber") * 10), ("y0", F.lit(0)), ("x1", F.col("l_linenumber") * 10 + 10), ("y1", F.lit(100)))]))
    panels = lines.select(fig, F.col("l_linenumber").alias("panel_id"), (F.col("l_linenumber") == 3).alias("is_final"), content.alias("content"))
    labels = lines.select(fig, (F.col("l_linenumber") + 100).alias("label_id"))
    images = lines.select(fig, (F.col("l_linenumber") + 200).alias("image_id"))
    captions = lines.select(fig, F.chr(F.col("l_linenumber") + 64).alias("name"))
    return lines, allowed(orders.select(F.col("o_orderkey").alias("fig"), F.lit(1000).alias("width"), F.lit(1000).alias("height")), panels, labels, images, captions)


#: Of the figure k and the line n (one assignment each) what is wrong: k modulo 11 chooses the rule.
_WRONG = """l as (select distinct l_orderkey as k, l_linenumber as n, l_orderkey % 11 as w from lineitem),
bad as (
  select k, 1 as r, 'unknown panel' as rule, (n + 50)::varchar as v from l where w = 1
  union all select k, 2, 'unknown label', (n + 150)::varchar from l where w in (2, 8) and n <> 3
  union all select k, 3, 'new label outside its panel', n::varchar from l where w = 3 and n <> 3 and n % 6 <> 0
  union all select k, 4, 'new label too large', n::varchar from l where w = 4 and n <> 3 and n % 6 <> 0
  union all select k, 5, 'unknown caption', 'Z' || n from l where w = 5 and n <> 3
  union all select k, 6, 'final panel', n::varchar from l where n = 3 and w <> 1
  union all select k, 7, 'no caption without rejection', n::varchar from l where w = 6 and n <> 3
), told as (
  select k, r, rule, '[' || string_agg(distinct v, ', ' order by v) || ']' as v from bad group by k, r, rule
), strict as (
  select distinct k from bad where r in (1, 2, 5)
), lists as (
  select k, '[' || string_agg(n::varchar, ', ' order by n::varchar) || ']' as panels, '[' || string_agg((n + 100)::varchar, ', ' order by n) || ']' as labels, '[' || string_agg(chr((n + 64)::int), ', ' order by n) || ']' as names from l group by k
), failed as (
  select told.k as fig, string_agg(rule || ': ' || v || case r when 1 then '; valid: ' || panels when 2 then '; valid: ' || labels when 5 then '; valid: ' || names else '' end, ' | ' order by r) as reasons
  from told join lists using (k) where r <> 6 or k in (select k from strict) group by told.k
)"""


def _assignments(lines):
    k, n, w = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_orderkey") % 11
    piece = lambda label, bbox: F.array(F.struct(label.cast("string").alias("label_id"), bbox.alias("bbox_2d")))
    none = F.lit(None).cast("array<int>")
    inside = F.array(n * 10 + 1, F.lit(0), n * 10 + 4, F.lit(20)).cast("array<int>")
    outside = F.array(n * 10 + 20, F.lit(0), n * 10 + 25, F.lit(20)).cast("array<int>")
    large = F.array(n * 10, F.lit(0), n * 10 + 9, F.lit(50)).cast("array<int>")
    evidence = F.when(w.isin(2, 8), piece(n + 150, none)).when(w == 3, piece(F.lit(None), outside)).when(w == 4, piece(F.lit(None), large)).when(w == 7, piece(F.lit(None), inside)).when(w != 9, piece(n + 100, none))
    caption = F.when(w == 5, F.concat(F.lit("Z"), n.cast("string"))).when((w != 6) & (w != 10), F.chr(n + 64))
    return lines.select(k.alias("fig"), F.when(w == 1, n + 50).otherwise(n).alias("panel_id"), (w == 10).alias("reject_panel"), caption.alias("assigned_subcaption"), evidence.alias("evidence"))


@query("with " + _WRONG + "select fig, reasons from failed")
def screened_answers(spark, d):
    """Assignments by panel against what their figure allows: the reasons for which it fails."""
    lines, options = _options(spark, d)
    out = reasons(by_panel(_assignments(lines), options), options)
    return out.select("fig", F.array_join("reasons", " | ").alias("reasons"))


@query("""with l as (select distinct l_orderkey as k, l_linenumber as n from lineitem), a as (select k, n, case k % 4 when 1 then n + 900 else n + 200 end as image, case k % 4 when 2 then 'Z' when 3 then null else chr((n + 64)::int) end as caption from l),
bad as (select k, 1 as r, 'unknown image' as rule, image::varchar as v from a where k % 4 = 1 union all select k, 2, 'unknown caption', 'Z' from a where k % 4 = 2 union all select k, 3, 'no caption', 'None' from a where k % 4 = 3)
select k as fig, any_value(rule) || ': [' || string_agg(distinct v, ', ' order by v) || ']' || case any_value(r) when 1 then '; valid: [' || (select string_agg((n + 200)::varchar, ', ' order by n) from l where l.k = bad.k) || ']' when 2 then '; valid: [' || (select string_agg(chr((n + 64)::int), ', ' order by n) from l where l.k = bad.k) || ']' else '' end as reasons from bad group by k""")
def screened_places(spark, d):
    """Assignments by place: unknown images, unknown captions, none."""
    lines, options = _options(spark, d)
    k, n = F.col("l_orderkey") % 4, F.col("l_linenumber")
    a = lines.select(F.col("l_orderkey").alias("fig"), F.array(F.when(k == 1, n + 900).otherwise(n + 200)).alias("assigned_images"), F.when(k == 2, "Z").when(k != 3, F.chr(n + 64)).alias("assigned_subcaption"))
    return reasons(by_place(a, options), options).select("fig", F.array_join("reasons", " | ").alias("reasons"))


#: Ranked hits by class: a class's steps, its best later precision, and what each step adds.
_RANKED = """r as (select l_linenumber as cls, (l_extendedprice::double % 1000) / 1000 as score, l_quantity > 25 and l_orderkey % 3 <> 0 as hit from lineitem where l_linenumber < 7),
n as (select l_linenumber as cls, count(*) as n_truths from lineitem where l_quantity > 20 group by 1),
s as (select cls, score, count(*) as n, count(*) filter (hit) as h from r group by cls, score),
c as (select cls, score, h, sum(n) over w as found, sum(h) over w as "right" from s window w as (partition by cls order by score desc)),
e as (select c.*, n_truths, "right" / found as precision, max("right" / found) over (partition by cls order by score) as envelope from c join n using (cls))"""


@query("with " + _RANKED + """ select n.cls, n.n_truths, round(coalesce(sum(h / e.n_truths * envelope), 0), 6) as area, round(coalesce((sum((floor("right" * 100 / e.n_truths + 1e-9) - floor(("right" - h) * 100 / e.n_truths + 1e-9)) * envelope) + max(envelope)) / 101, 0), 6) as points
from n left join e on e.cls = n.cls group by n.cls, n.n_truths""")
def class_precision(spark, d):
    """Average precision of ranked hits by class; the last class is never found."""
    lines = Tables(spark, d).lineitem
    cls = F.col("l_linenumber").alias("cls")
    ranked = lines.where("l_linenumber < 7").select(cls, (F.col("l_extendedprice").cast("double") % 1000 / 1000).alias("score"), F.expr("l_quantity > 25 and l_orderkey % 3 <> 0").alias("hit"))
    truths = lines.where("l_quantity > 20").groupBy(cls).agg(F.count("*").alias("n_truths"))
    return average_precision(ranked, truths).select("cls", "n_truths", F.round("area", 6).alias("area"), F.round("points", 6).alias("points"))


@query(B + """select fig, round(median(best), 6) as median, count(*) as n from (select p.fig, p.id, coalesce(max(case when i > 0 then i / (pa + ca - i) else 0 end), 0) as best from b p left join pair on pair.p_id = p.id and pair.fig = p.fig and pair.c_id % 3 <> 0 where p.id % 3 = 0 group by p.fig, p.id) group by fig""")
def overlap_medians(spark, d):
    """The median overlap of every third box with the other boxes of its figure."""
    boxes = Tables(spark, d).boxes()
    out = median_overlap(boxes.where("id % 3 = 0"), boxes.where("id % 3 <> 0"), F.col("fig"))
    return out.select("fig", F.round("median", 6).alias("median"), "n")


def _answers():
    """Orders whose key leaves 1 modulo 3 name a panel that is not there until they are told so; those that leave 2 never learn."""

    @batched
    def model(rows: list[dict]) -> list[list[dict]]:
        out = []
        for r in rows:
            wrong = r["fig"] % 3 == 2 or r["fig"] % 3 == 1 and not any("unknown panel" in x for x in r["reasons"])
            made = [f'{{"panel_id": {n + 50 * wrong}, "assigned_subcaption": "{chr(n + 64)}", "confidence": 0.5}}' for n in r["lines"]]
            out.append([{"answer": "sorry" if r["fig"] % 9 == 2 else '{"assignments": [' + ", ".join(made) + "]}"}])
        return out

    return model


@query("""with l as (select distinct l_orderkey as k, l_linenumber as n from lineitem where l_linenumber <> 3), o as (select k, n, case k % 3 when 0 then 1 when 1 then 2 end as round from l)
select k as fig, round, n::varchar as panel_id, chr((n + 64)::int) as caption, null as reasons from o where round is not null
union all select l_orderkey, null, null, null, case when l_orderkey % 9 = 2 then 'no assignments' else 'unknown panel: [' || string_agg(distinct (l_linenumber + 50)::varchar, ', ' order by (l_linenumber + 50)::varchar) || ']; valid: [' || string_agg(distinct l_linenumber::varchar, ', ' order by l_linenumber::varchar) || ']' end from lineitem where l_orderkey % 3 = 2 group by l_orderkey""")
def answers_asked_again(spark, d):
    """Figures that pass at once, those that pass when told why they failed, and those that never do."""
    lines, options = _options(spark, d)
    items = lines.groupBy(F.col("l_orderkey").alias("fig")).agg(F.array_sort(F.collect_set("l_linenumber")).alias("lines"))
    ask = lambda todo, path: stored(applied(todo, _answers, ["fig"], "answer string"), path)
    passed, left = asked_again(items, ask, options, stored, folder(spark, "asked"), rounds=3)
    return passed.select("fig", "round", "panel_id", F.col("assigned_subcaption").alias("caption"), F.lit(None).cast("string").alias("reasons")).unionByName(left.select("fig", F.lit(None).cast("int").alias("round"), F.lit(None).cast("string").alias("panel_id"), F.lit(None).cast("string").alias("caption"), F.array_join("reasons", " | ").alias("reasons")))
