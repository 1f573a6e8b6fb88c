"""Queries of figure assembly: panel rows, flags, captions without a model, agreement, pages, matching."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from panelmill.functions import boxes as bx
from panelmill.functions import text as tx
from panelmill.operators import answers, assembly, pages, relational as rel, spatial
from panelmill.plans.base import B, QUERIES, Tables, near, query
from panelmill.plans.queries import _R, _TOUCH, nms_sql
from panelmill.plans.stages import extraction, likeness, matched_images

KINDS = ["Panel", "Label", "CFP", "OCT", "Retinal Imaging", "Other"]
_ORIGINS = ["automatic", "llm_assignment", "manual_assignment_rejection", None, "llm_refinement"]
_LICENCES = ["CC0", "CC BY-NC", None, "CC BY-SA"]


def pick(n: Column, values: list) -> Column:
    """values[n]; null beyond."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), n.cast("int"))


def _sql_pick(n: str, values: list) -> str:
    return f"([{', '.join('null' if v is None else repr(v) for v in values)}])[({n} + 1)::int]"


def _kind() -> Column:
    return F.coalesce(pick(F.col("cls"), KINDS[:5]), F.lit("Other"))


_KIND = "case cls when 0 then 'Panel' when 1 then 'Label' when 2 then 'CFP' when 3 then 'OCT' when 4 then 'Retinal Imaging' else 'Other' end"


def _assembly_tables(spark, d):
    b = Tables(spark, d).boxes().withColumn("kind", _kind())
    i, n, text = F.col("id"), F.col("fig"), lambda c: c.cast("string")
    by = lambda e, v: F.col("box")[e] + v
    p = b.where("kind = 'Panel'").select(
        i.alias("panel_id"), F.array(i + 1, i + 2, i + 1_000_000).alias("label_ids"), F.array(i + 3, i + 5).alias("image_ids"), bx.box(by("x0", -0.05), by("y0", -0.05), by("x1", 0.05), by("y1", 0.05)).alias("content_box"),
        F.when(i % 6 != 0, i % 100).alias("assigned_subcaption"), pick(i % 5, _ORIGINS).alias("origin"), (i % 11 == 0).alias("needs_review"), (i % 13 == 0).alias("has_estimated_labels"), (i % 17 == 0).alias("has_shared_labels"), F.when(i % 19 != 0, i % 7 != 0).alias("relevance"),
    )
    marked = F.when(i % 2 == 1, "Annotated").otherwise("Plain")
    predictions = b.select("id", "fig", "kind", "score", marked.alias("marked"), (F.col("score") / 2).alias("marked_score"), "box", (i % 4 != 3).alias("survives_nms"))
    page = F.struct(F.lit(0.0).alias("x0"), F.lit(1.0).alias("x1"))
    figures = b.select("fig").distinct().select("fig", (n + 100).alias("article_id"), F.concat(F.lit("c"), text(n)).alias("image_cluster_id"), F.lit(0.4).alias("width"), F.lit(0.35).alias("height"), F.when(n % 3 == 0, F.create_map(F.lit("1"), page, F.lit("2"), page)).otherwise(F.create_map(F.lit("1"), page)).alias("page_boxes"))
    articles = figures.where("fig % 5 <> 4").select("article_id", "image_cluster_id", F.concat(F.lit("title "), text(n)).alias("title"), F.when(n % 2 == 0, "cited").alias("citation"), pick(n % 4, _LICENCES).alias("license"), F.array(F.lit("as seen")).alias("context"))
    c = spark.range(100).select("id", F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, "A").alias("name"), F.when(F.col("id") % 8 != 0, F.concat(F.lit("text "), text(F.col("id")))).alias("text"))
    labels = p.select((F.col("panel_id") + 1_000_000).alias("id"), pick(F.col("panel_id") % 3, ["-1", "12", "manual_assignment_joining"]).alias("origin"), F.lit(0.5).alias("confidence"), "panel_id")
    labels = labels.join(b.select(i.alias("panel_id"), "box"), "panel_id").select("id", "origin", "confidence", bx.box(by("x0", 0.0), by("y0", 0.0), by("x1", 0.02), by("y1", 0.02)).alias("box"))
    return p, predictions, figures, articles, c, labels


_ROWS = _R + f"""pre as (select *, {_KIND} as kind, id % 4 <> 3 as survives, least(greatest(x0, 0), 0.4) as cx0, least(greatest(y0, 0), 0.35) as cy0, least(greatest(x1, 0), 0.4) as cx1, least(greatest(y1, 0), 0.35) as cy1 from b),
el as (select *, {_sql_pick('id % 5', _ORIGINS)} as origin from pre where kind = 'Panel' and id % 11 <> 0 and id % 13 <> 0 and id % 17 <> 0 and id % 19 <> 0 and id % 7 <> 0 and id % 6 <> 0 and {_sql_pick('id % 5', _ORIGINS)} <> 'manual_assignment_rejection'),
re as (select fig, bool_or(origin in ('llm_assignment', 'llm_adjudication', 'manual_assignment', 'manual_assignment_joining')) as renew, list(id) as used from el group by fig),
b2 as (select b.id, b.fig, case when b.cls in (0, 1) then b.cls else 2 end as cls, b.x0, b.y0, b.x1, b.y1, b.score from b join re using (fig) where renew and b.id % 4 <> 3 and b.score >= 0.25),
{nms_sql('fig', 'cls in (0, 1)', 'b2', 'ra')}, {nms_sql('fig, cls', 'cls in (0, 1)', 'b2', 'rb')}, {nms_sql('fig', 'cls = 2', 'b2', 'rc')},
kept as (select id from outra union select id from outrb union select id from outrc),
usable as (select pre.* from pre join re using (fig) where (survives and (not renew or id in (select id from kept))) or list_contains(used, id)),
part as (select p.id as panel_id, o.*, case when o.kind = 'Label' then o.id in (p.id + 1, p.id + 2) else o.id in (p.id + 3, p.id + 5) end as named, renew,
  greatest(least(p.cx1, o.cx1) - greatest(p.cx0, o.cx0), 0) * greatest(least(p.cy1, o.cy1) - greatest(p.cy0, o.cy0), 0) as i, (o.cx1 - o.cx0) * (o.cy1 - o.cy0) as oa
  from el p join re using (fig) join usable o on o.fig = p.fig and o.kind <> 'Panel'),
mine as (select *, not named as added from part where named or (renew and oa > 0 and i / oa >= 0.9)),
sums as (select panel_id, count_if(kind <> 'Label') as n_images, count_if(kind = 'Label') as n_detected, count_if(added) as n_added, bool_or(kind = 'CFP') as cfp, bool_or(kind = 'OCT') as oct, bool_or(kind = 'Retinal Imaging') as ret, bool_or(kind = 'Other') as oth, bool_or(kind <> 'Label' and id % 2 = 1) as mk,
  min(cx0) as mx0, min(cy0) as my0, max(cx1) as mx1, max(cy1) as my1 from mine group by 1),
boxed as (select el.*, s.*, renew or el.id % 3 = 0 as anew, el.id % 3 = 0 as made from el join re using (fig) left join sums s on s.panel_id = el.id),
crop as (select *, case when anew then least(cx0, mx0, case when not made then x0 end) else x0 - 0.05 end as c0, case when anew then least(cy0, my0, case when not made then y0 end) else y0 - 0.05 end as c1,
  case when anew then greatest(cx1, mx1, case when not made then x1 + 0.02 end) else x1 + 0.05 end as c2, case when anew then greatest(cy1, my1, case when not made then y1 + 0.02 end) else y1 + 0.05 end as c3 from boxed)
select 'p_' || id as panel_id, fig + 100 as article_id, 'c' || fig as image_cluster_id, case when (id % 100) % 8 = 0 then case (id % 100) % 3 when 0 then '' when 1 then 'A' end when (id % 100) % 3 = 1 then 'A' else 'None' end as panel_name,
  case when (id % 100) % 8 <> 0 then 'text ' || (id % 100) end as subcaption_text, fig % 3 = 0 as is_multi_page_figure, coalesce(cfp, false) as contains_cfp, coalesce(oct, false) as contains_oct, coalesce(ret, false) as contains_retinal, coalesce(oth, false) as contains_other, coalesce(mk, false) as contains_marked,
  coalesce(n_images, 0)::int as n_images, (coalesce(n_detected, 0) + 1)::int as n_identifiers, coalesce(n_added, 0)::int as n_added, origin as assembly, case when fig % 5 <> 4 then {_sql_pick('fig % 4', _LICENCES)} end as license,
  '''' || case when fig % 5 <> 4 then 'title ' || fig else 'None' end || ''', ' || case when fig % 5 <> 4 and fig % 2 = 0 then 'cited' else 'None' end as attribution, coalesce(fig % 5 <> 4 and {_sql_pick('fig % 4', _LICENCES)} in ('CC0', 'CC BY', 'CC BY-ND', 'CC BY-SA'), false) as commercial_use,
  round(least(greatest(c0, 0), 0.4) / 0.4, 6) as c0, round(least(greatest(c1, 0), 0.35) / 0.35, 6) as c1, round(least(greatest(c2, 0), 0.4) / 0.4, 6) as c2, round(least(greatest(c3, 0), 0.35) / 0.35, 6) as c3, round(cx1 / 0.4, 6) as p2, round(score, 6) as score from crop"""


@query(_ROWS)
def eligible_panels(spark, d):
    """The output's rows, their JSON read back."""
    out = assembly.panel_rows(*_assembly_tables(spark, d))
    at = F.from_json("position", "predicted_box array<double>, content_box array<double>, prediction_score double")
    parts = lambda c: F.from_json(c, "array<struct<id:string,added_content_box_via_nms:boolean>>")
    added = F.size(F.filter(F.concat(parts("image_data"), parts("identifier_data")), lambda x: x["added_content_box_via_nms"]))
    names = ["panel_id", "article_id", "image_cluster_id", "panel_name", "subcaption_text", "is_multi_page_figure", "contains_cfp", "contains_oct", "contains_retinal", "contains_other", "contains_marked", "assembly", "license", "attribution", "commercial_use"]
    content = [F.round(F.get(at["content_box"], F.lit(i)), 6).alias(f"c{i}") for i in range(4)]
    return out.select(*names, F.size(parts("image_data")).alias("n_images"), F.size(parts("identifier_data")).alias("n_identifiers"), added.alias("n_added"), *content, F.round(F.get(at["predicted_box"], F.lit(2)), 6).alias("p2"), F.round(at["prediction_score"], 6).alias("score"))


@query(_ROWS[: _ROWS.index("\nselect 'p_' || id as panel_id")] + """
select 'p_' || panel_id as panel_id, case when kind = 'Label' then 'lip_' else 'i_' end || id as id, case when kind = 'Label' then 'detection' end as origin, case when kind <> 'Label' then kind end as kind, case when kind <> 'Label' then round(score, 6) end as kind_score,
  case when kind <> 'Label' then case when id % 2 = 1 then 'Marked' else 'Unmarked' end end as mark, case when kind <> 'Label' then round(score / 2, 6) end as mark_score, false as is_gt, added, true as included,
  round(cx0 / 0.4, 6) as x0, round(cy0 / 0.35, 6) as y0, round(cx1 / 0.4, 6) as x1, round(cy1 / 0.35, 6) as y1, round(score, 6) as score, null as known_as from mine
union all
select 'p_' || id, 'la_' || (id + 1000000), 'assignment', null, null, null, null, false, false, id % 3 <> 0, round(x0 / 0.4, 6), round(y0 / 0.35, 6), round((x1 + 0.02) / 0.4, 6), round((y1 + 0.02) / 0.35, 6), 0.5, case when id % 3 = 1 and exists (from b where b.id = 12) then 'lip_12' end from el""")
def panel_parts(spark, d):
    """The content of the output's lists: each image and identifier of each panel with all its fields."""
    out = assembly.panel_rows(*_assembly_tables(spark, d))
    kind = "struct<label:array<string>,prediction_score:array<double>>"
    fields = f"id:string,origin:string,imaging_type:{kind},mark_status:struct<label:string,prediction_score:double>,is_gt:boolean,included_in_content_box:boolean,added_content_box_via_nms:boolean,position:string,origin_identifier:string"
    lists = lambda c: F.from_json(c, f"array<struct<{fields}>>")
    x = out.select("panel_id", F.explode(F.concat(lists("image_data"), lists("identifier_data"))).alias("x")).select("panel_id", "x.*")
    at = F.from_json("position", "predicted_box array<double>, prediction_score double")
    corners = [F.round(F.get(at["predicted_box"], F.lit(i)), 6).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))]
    first = lambda c: F.get(c, F.lit(0))
    return x.select(
        "panel_id", "id", "origin", first(F.col("imaging_type.label")).alias("kind"), F.round(first(F.col("imaging_type.prediction_score")), 6).alias("kind_score"), F.col("mark_status.label").alias("mark"), F.round("mark_status.prediction_score", 6).alias("mark_score"), "is_gt",
        F.col("added_content_box_via_nms").alias("added"), F.col("included_in_content_box").alias("included"), *corners, F.round(at["prediction_score"], 6).alias("score"), F.col("origin_identifier").alias("known_as"),
    )


@query("""select l_orderkey, l_linenumber from lineitem where l_linenumber <> 4 and l_tax < 0.07 and l_discount > 0.01 and l_quantity > 10 and l_suppkey % 5 <> 0
and case l_returnflag when 'A' then 'automatic' when 'R' then 'manual_assignment_rejection' end <> 'manual_assignment_rejection'""")
def eligible_filter(spark, d):
    origin = F.when(F.col("l_returnflag") == "A", "automatic").when(F.col("l_returnflag") == "R", "manual_assignment_rejection")
    p = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") == 4).alias("needs_review"), (F.col("l_tax") >= 0.07).alias("has_estimated_labels"), (F.col("l_discount") <= 0.01).alias("has_shared_labels"), (F.col("l_quantity") > 10).alias("relevance"), F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("assigned_subcaption"), origin.alias("origin"))
    return assembly.eligible(p).select("l_orderkey", "l_linenumber")


_RAW = [*assembly.METHODS, "unknown"]


@query(f"""with l as (select *, {_sql_pick('l_linenumber % 11', _RAW)} as m from lineitem), o as (select *, {_sql_pick('o_orderkey % 11', _RAW)} as m from orders), u as (
  select case when l_linenumber % 2 = 0 then 'x' || l_orderkey else 'p_' || l_orderkey end as panel_id, l_orderkey as article_id, m, false as no_buffer_render from l where (l_linenumber = 1 or l_quantity > 40) and l_orderkey not in (select o_orderkey from orders where o_custkey % 4 = 0)
  union all select 'p_' || o_orderkey, o_orderkey, m, true from o where o_custkey % 4 = 0 and o_custkey % 8 = 0)
select panel_id, article_id, no_buffer_render, case m when 'automatic_caption_assignment' then 'Automatic Caption Assignment' when 'automatic' then 'Automatic Caption Assignment' when 'llm_assignment' then 'LLM Assignment' when 'llm_refinement' then 'LLM Assignment'
  when 'llm_adjudication' then 'LLM Assignment (adjudication)' when 'llm_refinement_with_adjudication' then 'LLM Assignment (adjudication)' when 'ground_truth' then 'Ground Truth' when 'unknown' then null else 'Manual Assignment' end as assembly from u""")
def final_union(spark, d):
    t = Tables(spark, d)
    flags = lambda a, b: [a.alias("contains_cfp"), b.alias("contains_oct"), F.lit(False).alias("contains_retinal")]
    built = t.lineitem.select(F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("x"), F.col("l_orderkey").cast("string"))).otherwise(F.col("l_orderkey").cast("string")).alias("panel_id"), F.col("l_orderkey").alias("article_id"), F.lit("c").alias("image_cluster_id"), pick(F.col("l_linenumber") % 11, _RAW).alias("assembly"), *flags(F.col("l_linenumber") == 1, F.col("l_quantity") > 40))
    gt = t.orders.where("o_custkey % 4 = 0")
    annotated = gt.select(F.col("o_orderkey").cast("string").alias("panel_id"), F.col("o_orderkey").alias("article_id"), F.lit("c").alias("image_cluster_id"), pick(F.col("o_orderkey") % 11, _RAW).alias("assembly"), *flags(F.col("o_custkey") % 8 == 0, F.lit(False)))
    out = assembly.final_rows(annotated, built, gt.select(tx.figure_uuid(F.col("o_orderkey"), F.lit("c")).alias("figure_uuid")))
    return out.select("panel_id", "article_id", "no_buffer_render", "assembly")


@query("""with f as (select conv_id, turn % 4 <> 3 and conv_id % 7 <> 0 or conv_id % 7 = 1 as relevance, conv_id % 7 = 2 and turn = 0 as shared, turn % 3 = 1 and conv_id % 7 > 2 as review, conv_id % 7 = 3 as estimated, case when turn % 5 <> 2 or conv_id % 7 in (1, 5) then turn end as cap from conversations),
s as (select conv_id, count(*) as n, count_if(not relevance) as n_irrelevant, count_if(shared or review or estimated or cap is null) as n_review, count_if(relevance and not shared and not review and not estimated and cap is not null) as n_done from f group by 1)
select conv_id, n, n_irrelevant::bigint as n_irrelevant, n_review::bigint as n_review, n_done::bigint as n_done, case when n_irrelevant = n then false when n_irrelevant > 0 and n_done = 1 and n_irrelevant = n - 1 then false
  when n_irrelevant > 0 and n_done + n_irrelevant = n then false when n_review = n then true when n_review > 0 then true else false end as partial from s""")
def partially_assigned(spark, d):
    k, turn = F.col("conv_id") % 7, F.col("turn")
    c = Tables(spark, d).conversations.select(
        "conv_id", (((turn % 4 != 3) & (k != 0)) | (k == 1)).alias("relevance"), ((k == 2) & (turn == 0)).alias("has_shared_labels"), ((turn % 3 == 1) & (k > 2)).alias("needs_review"), (k == 3).alias("has_estimated_labels"), F.when((turn % 5 != 2) | k.isin(1, 5), turn).alias("assigned_subcaption"),
    )
    return assembly.figure_status(c, "conv_id")


_LABELS = B + f""", att as (select p_id as panel_id, c_id as label_id, fig from pair where p_cls = 0 and c_cls = 1 and {_TOUCH}), panel as (select id as panel_id, fig from b where cls = 0),
texts as (select id as label_id, fig from b where cls = 1 and id % 4 <> 0), caps as (select label_id, label_id * 10 as cap from texts where label_id % 3 <> 0),
"""


@query(_LABELS + """lone as (select panel_id, fig from panel where panel_id not in (select panel_id from att join texts using (label_id)) and panel_id % 3 <> 0),
shared as (select label_id from att join caps using (label_id) group by 1 having count(*) > 1),
s as (select panel.fig, panel.panel_id, count(distinct att.label_id) as asked, count(distinct caps.label_id) as own, count(distinct texts.label_id) filter (caps.label_id is null) as n_unassigned, count(distinct shared.label_id) > 0 as sh, max(cap) as cap
  from panel left join att using (panel_id) left join texts on texts.label_id = att.label_id left join caps on caps.label_id = att.label_id left join shared on shared.label_id = att.label_id group by 1, 2),
e as (select s.*, own + case when lone.panel_id % 2 = 0 then 1 else 0 end as n_labels, lone.panel_id % 2 = 0 as est from s left join lone using (panel_id))
select fig, panel_id, n_labels::bigint as n_labels, n_unassigned, coalesce(est, false) as has_estimated_labels, sh as has_shared_labels, n_labels = 0 or n_unassigned > 0 or n_labels <> asked as needs_review,
  case when n_labels = 1 and n_unassigned = 0 and not coalesce(est, false) and not sh then cap end as assigned_subcaption from e""")
def panel_flags(spark, d):
    b = Tables(spark, d).boxes()
    panels = spatial.hierarchy(b.where("cls = 0"), b.where("cls = 1"), b.where("cls > 1")).select("fig", "panel_id", "label_ids")
    own = b.where("cls = 1 and id % 4 <> 0").select("fig", F.col("id").alias("label_id"), F.lit(None).cast("bigint").alias("panel_id"))
    matched = own.where("label_id % 3 <> 0").select("fig", "label_id", (F.col("label_id") * 10).alias("caption_id"))
    read = panels.select("fig", "panel_id", F.explode("label_ids").alias("label_id")).join(own.select("label_id"), "label_id", "left_semi")
    lone = panels.join(read, "panel_id", "left_anti").where("panel_id % 3 <> 0").select("fig", (-F.col("panel_id") - 1).alias("label_id"), "panel_id")
    matched = matched.unionByName(lone.where("panel_id % 2 = 0").select("fig", "label_id", F.lit(7).cast("bigint").alias("caption_id")))
    out = assembly.panel_flags(panels, own.unionByName(lone), matched)
    return out.select("fig", "panel_id", "n_labels", "n_unassigned", "has_estimated_labels", "has_shared_labels", "needs_review", "assigned_subcaption")


_CAPTIONS = "abcdef"


@query("""with recursive t as (select l_orderkey as fig, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as label_id, l_quantity as q, chr((97 + l_partkey % 8)::int) as txt from lineitem),
names as (select * from (values (0, 'a'), (1, 'b'), (2, 'c'), (3, 'd'), (4, 'e'), (5, 'f')) as v(place, name)),
r as (select *, row_number() over (partition by fig order by q desc, label_id) as k from t),
step as (select fig, 0::bigint as k, []::bigint[] as ls, []::int[] as cs from (select distinct fig from r)
  union all select s.fig, r.k, case when n.place is null or list_contains(s.cs, n.place) then s.ls else list_append(s.ls, r.label_id) end, case when n.place is null or list_contains(s.cs, n.place) then s.cs else list_append(s.cs, n.place) end
  from step s join r on r.fig = s.fig and r.k = s.k + 1 left join names n on n.name = r.txt)
select fig, unnest(ls) as label_id, unnest(cs)::bigint as caption_id from (select fig, ls, cs from step qualify row_number() over (partition by fig order by k desc) = 1)""")
def text_to_captions(spark, d):
    """Labels in capitals and with marks match names in small letters."""
    li = Tables(spark, d).lineitem
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    letter = F.char(F.lit(97) + F.col("l_partkey") % 8)
    form = F.when(F.col("l_suppkey") % 3 == 0, F.upper(letter)).when(F.col("l_suppkey") % 3 == 1, F.concat(F.lit(" ("), letter, F.lit(")"))).otherwise(letter)
    texts = li.select(F.col("l_orderkey").alias("fig"), n.cast("bigint").alias("label_id"), F.lit(None).cast("bigint").alias("panel_id"), form.alias("text"), F.col("l_quantity").alias("confidence"))
    captions = texts.select("fig").distinct().select("fig", F.posexplode(F.array(*map(F.lit, _CAPTIONS))).alias("place", "name")).withColumn("caption_id", F.col("place").cast("bigint"))
    return assembly.labels_to_captions(texts, captions)


@query(B + f""", g as (select fig, bool_or(cls in (2, 3, 4)) and fig % 5 <> 4 as relevant, case when fig % 6 = 5 then null else arg_max(id, struct_pack(s := score, i := -id)) filter (cls = 0) end as best from b group by 1),
br as (select fig, best, case when not relevant then 'irrelevant' when fig % 4 = 0 then 'whole' when fig % 4 = 1 and fig % 3 = 0 then 'whole' when fig % 4 = 1 then 'irrelevant' else 'matched' end as branch from g),
panel as (select id as panel_id, fig from b where cls = 0 and fig % 6 <> 5), att as (select p_id as panel_id, c_id as label_id, fig from pair where p_cls = 0 and c_cls = 1 and fig % 6 <> 5 and {_TOUCH}),
lab as (select fig, id as label_id, row_number() over (partition by fig order by score desc, id) as r from b where cls = 1 and fig % 6 <> 5), cap as (select fig, label_id, fig * 10 + r - 1 as cap from lab where r <= 2 and fig % 4 <> 3),
shared as (select label_id from att join cap using (label_id) group by 1 having count(*) > 1),
s as (select panel.fig, panel.panel_id, count(distinct att.label_id) as asked, count(distinct cap.label_id) as own, count(distinct att.label_id) filter (cap.label_id is null and panel.fig % 4 <> 3) as un, count(distinct shared.label_id) > 0 as sh, max(cap) as cap
  from panel left join att using (panel_id) left join cap on cap.label_id = att.label_id left join shared on shared.label_id = att.label_id group by 1, 2)
select fig, panel_id, false as relevance, null::bigint as assigned_subcaption, null::boolean as needs_review, null::boolean as has_shared_labels from panel join br using (fig) where branch = 'irrelevant'
union all select fig, best, true, fig * 100, false, false from br where branch = 'whole'
union all select fig, panel_id, false, null, null, null from panel join br using (fig) where branch = 'whole' and panel_id is distinct from best
union all select fig, panel_id, true, case when own = 1 and un = 0 and not sh then cap end, own = 0 or un > 0 or own <> asked, sh from s join br using (fig) where branch = 'matched'""")
def auto_assembly(spark, d):
    """All branches: no relevant image, one part (None, near the full caption, far from it), letters, longer names."""
    b = Tables(spark, d).boxes().withColumn("kind", _kind())
    b = b.withColumn("kind", F.when((F.col("fig") % 5 == 4) & F.col("kind").isin(assembly.RELEVANT), "Other").otherwise(F.col("kind"))).where("not (fig % 6 = 5 and cls in (0, 1))")
    n = F.col("fig")
    figures = b.select("fig").distinct().select("fig", (n * 100).alias("full_caption_id"), F.lit("one two three four five six seven").alias("full_caption"))
    part = lambda i, name, text: F.struct((n * 10 + i).alias("caption_id"), F.lit(name).cast("string").alias("name"), F.lit(text).alias("text"), F.lit(i).alias("place"))
    near_text, far_text = "one two 3 four 5 six 7", "x y z u v w"
    parts = F.when(n % 8 == 0, F.array(part(0, "None", far_text))).when(n % 8 == 4, F.array(part(0, None, far_text))).when((n % 4 == 1) & (n % 3 == 0), F.array(part(0, "A", near_text))).when(n % 4 == 1, F.array(part(0, "A", far_text))).when(n % 4 == 2, F.array(part(0, "A", "t"), part(1, "B", "t"))).otherwise(F.array(part(0, "left", "t"), part(1, "right", "t")))
    captions = figures.select("fig", F.inline(parts))
    panels = spatial.hierarchy(b.where("cls = 0"), b.where("cls = 1"), b.where("cls > 1")).select("fig", "panel_id", "label_ids")
    rank = F.row_number().over(Window.partitionBy("fig").orderBy(F.desc("score"), "id"))
    text = F.when(F.col("r") == 1, "A").when(F.col("r") == 2, "B").otherwise("Z")
    texts = b.where("cls = 1").withColumn("r", rank).select("fig", F.col("id").alias("label_id"), F.lit(None).cast("bigint").alias("panel_id"), text.alias("text"), F.col("score").alias("confidence"))
    out = assembly.assembled(figures, b.select("fig", "id", "kind", "score"), panels, captions, texts)
    return out.select("fig", "panel_id", "relevance", "assigned_subcaption", "needs_review", "has_shared_labels")


_VOTES = """with v as (select l_orderkey as fig, l_linenumber % 2 as annotator, l_partkey % 2 as panel_id, case when l_quantity > 48 then null when l_quantity > 44 then 9 else l_orderkey % 3 end as cap, case when l_suppkey % 20 = 0 then 'new' when l_suppkey % 20 = 1 then null else 'existing' end as kind, l_extendedprice as confidence, l_discount > 0.09 as reject from lineitem)"""


@query(_VOTES + """, n as (select fig, count(distinct annotator) as n from v group by 1), rej as (select fig, panel_id, count(distinct annotator) as k from v where reject group by 1, 2),
torn as (select fig from rej join n using (fig) group by 1 having not bool_or(k = n)),
p as (select fig, panel_id, count(*) as votes, count(distinct coalesce(cap, -1)) = 1 as one, count(distinct coalesce(kind, '-')) = 1 as alike, max(cap)::bigint as assigned_subcaption, list(confidence order by annotator, confidence) as confidences, avg(confidence) as mean,
  first(reject order by annotator, confidence) as r from v group by 1, 2)
select fig, panel_id, assigned_subcaption, confidences, round(mean, 4) as confidence, case when votes = 1 then r else r or assigned_subcaption is null end as reject from p
where fig not in (select fig from torn) and fig not in (select fig from p where votes > 1 and not (one and alike))""")
def answers_agree(spark, d):
    li = Tables(spark, d).lineitem
    cap = F.when(F.col("l_quantity") > 48, None).when(F.col("l_quantity") > 44, 9).otherwise(F.col("l_orderkey") % 3).cast("bigint")
    kinds = F.when(F.col("l_suppkey") % 20 == 0, F.array(F.lit("new"), F.lit("new"))).when(F.col("l_suppkey") % 20 != 1, F.array(F.lit("existing")))
    votes = li.select(F.col("l_orderkey").alias("fig"), (F.col("l_linenumber") % 2).alias("annotator"), (F.col("l_partkey") % 2).alias("panel_id"), cap.alias("subcaption"), kinds.alias("kinds"), F.col("l_extendedprice").alias("confidence"), (F.col("l_discount") > 0.09).alias("reject"))
    return answers.panel_agreement(votes).withColumn("confidence", F.round("confidence", 4))


@query("""with v as (select l_orderkey as fig, l_linenumber % 3 as annotator, l_linenumber::bigint * 1000000000 + round(l_extendedprice * 100)::bigint as n, case when l_partkey % 4 = 3 then null else l_partkey % 2 end as cap, case when l_quantity > 40 then [1, 2, 3] when l_quantity > 20 then [2, 1] else [1, 2] end as images, case when l_suppkey % 20 = 0 then null else 'place' end as kind, l_extendedprice as c from lineitem),
a as (select fig, annotator, cap, arg_max(struct_pack(i := list_sort(images), k := kind, c := c), n) as x from v group by 1, 2, 3),
p as (select fig, cap, count(distinct x.i) = 1 as one, count(distinct coalesce(x.k, '-')) = 1 as alike, min(x.i) as images, list(x.c order by annotator) as confidences from a group by 1, 2)
select fig, 'panel_' || coalesce(cap::varchar, 'None') as panel_id, cap as assigned_subcaption, images, confidences from p where fig not in (select fig from p where not (one and alike))""")
def places_agree(spark, d):
    li = Tables(spark, d).lineitem
    a = lambda *v: F.array(*map(F.lit, v))
    n = F.col("l_linenumber").cast("bigint") * F.lit(1_000_000_000) + F.round(F.col("l_extendedprice") * 100).cast("bigint")
    votes = li.select(F.col("l_orderkey").alias("fig"), (F.col("l_linenumber") % 3).alias("annotator"), n.alias("n"), F.when(F.col("l_partkey") % 4 != 3, F.col("l_partkey") % 2).alias("subcaption"), F.when(F.col("l_quantity") > 40, a(1, 2, 3)).when(F.col("l_quantity") > 20, a(2, 1)).otherwise(a(1, 2)).alias("images"), F.when(F.col("l_suppkey") % 20 != 0, a("place")).alias("kinds"), F.col("l_extendedprice").alias("confidence"))
    return answers.placed_agreement(votes)


@query(B + """, r as (select *, id % 3 as page, case when fig % 3 = 0 then 72 when fig % 3 = 1 then 72 + 72 * (id % 2) else case when id % 25 <> 3 then 144 end end as dpi from b),
x as (select fig, count(dpi) = count(*) and count(distinct dpi) = 1 as one, max(dpi) as dpi, list(dpi order by id) as dpis from r group by 1)
select fig, page::int as page, round(min(x0), 6) as x0, round(min(y0), 6) as y0, round(max(x1), 6) as x1, round(max(y1), 6) as y1, any_value(case when one then x.dpi end)::int as dpi, case when any_value(one) then 0 else any_value(len(dpis)) end::int as n_dpis from r join x using (fig) group by fig, page""")
def page_boxes(spark, d):
    i, n = F.col("id"), F.col("fig") % 3
    dpi = F.when(n == 0, 72).when(n == 1, 72 + 72 * (i % 2)).otherwise(F.when(i % 25 != 3, 144)).cast("int")
    out = pages.page_boxes(Tables(spark, d).boxes().select("fig", (i % 3).cast("int").alias("page"), "box", dpi.alias("dpi"), i.alias("n")), ["fig"])
    edges = [F.round(F.col("box")[e], 6).alias(e) for e in bx.EDGES]
    return out.select("fig", "page", *edges, "dpi", F.coalesce(F.size("dpis"), F.lit(0)).alias("n_dpis"))


@query(B + """, r as (select *, id % 5 as page, case when fig % 4 = 1 and id % 10 >= 5 then null when fig % 4 = 2 then 0.2 else 10.0 + case when fig % 8 = 7 then id % 2 else 0 end end as top from b),
s as (select fig, page, count(top) = count(*) and count(distinct top) = 1 as same, any_value(top) as top, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from r group by 1, 2),
lonely as (select a.fig, a.page, a.id from r a join r c on a.fig = c.fig and a.page = c.page and a.id < c.id group by 1, 2, 3
  having min(sqrt(power(greatest(0, a.x0 - c.x1, c.x0 - a.x1), 2) + power(greatest(0, a.y0 - c.y1, c.y0 - a.y1), 2))) > 0.01),
t as (select *, case when not same then 'caption boxes differ' when least(y1, top + 1) > greatest(y0, top) and least(x1, 1) > greatest(x0, 0) then 'figure meets caption' when (fig, page) in (select fig, page from lonely) then 'boxes too far apart' end as reason from s)
select fig, page, reason, case when reason is null then round(x0, 6) end as x0, case when reason is null then round(y1, 6) end as y1 from t""")
def joined_boxes(spark, d):
    n, i = F.col("fig"), F.col("id")
    top = F.when((n % 4 == 1) & (i % 10 >= 5), None).when(n % 4 == 2, F.lit(0.2)).otherwise(10.0 + F.when(n % 8 == 7, i % 2).otherwise(0))
    records = Tables(spark, d).boxes().select("fig", (i % 5).alias("page"), i.alias("n"), "box", F.when(top.isNotNull(), bx.box(F.lit(0.0), top, F.lit(1.0), top + 1)).alias("caption"))
    return pages.joined_boxes(records, ["fig", "page"], 0.01).select("fig", "page", "reason", F.round("box.x0", 6).alias("x0"), F.round("box.y1", 6).alias("y1"))


@query("""with p as (select o_custkey as fig, o_orderkey::varchar as page, floor(o_totalprice)::bigint % 700 + 50 as width, floor(o_totalprice / 7)::bigint % 900 + 50 as height, o_orderkey from orders),
g as (select fig, max(width) as w, sum(height) as h, count(*) as n, greatest(floor(0.02 * greatest(max(width), sum(height))), 10) as gap from p group by 1),
r as (select p.*, w, h, n, gap, coalesce(sum(height) over (partition by fig order by o_orderkey rows between unbounded preceding and 1 preceding), 0) + gap * (row_number() over (partition by fig order by o_orderkey) - 1) as y from p join g using (fig))
select fig, page, y::bigint as y_start, (y + height)::bigint as y_end, w::bigint as image_width, (h + gap * (n - 1))::bigint as image_height from r""")
def stacked_pages(spark, d):
    """Page numbers are texts, ordered as numbers."""
    size = lambda c, n: (F.floor(c) % n + 50).alias("width" if n == 700 else "height")
    return pages.stacked(Tables(spark, d).orders.select(F.col("o_custkey").alias("fig"), F.col("o_orderkey").cast("string").alias("page"), size(F.col("o_totalprice"), 700), size(F.col("o_totalprice") / 7, 900)), ["fig"])


_IMAGE = "p_partkey // 5 as article, p_size % 4 as number"


_HITS = f"""with i as (select {_IMAGE}, p_partkey as image_id, p_name as caption, 1.0 + (p_partkey % 40) / 100 as aspect, [(p_partkey * 37) % 8, (p_partkey * 11) % 16, p_partkey % 4, p_size % 32] as h from part where p_partkey % 2 = 0),
f as (select {_IMAGE}, p_partkey as figure_id, case when p_size % 5 = 0 then 'Continued' else 'Figure 3. ' || p_name || p_size::varchar end as caption, 1.0 + (p_partkey % 36) / 100 as aspect, [(p_partkey * 37) % 8, (p_partkey * 11) % 16, p_partkey % 4, p_size % 32] as h from part where p_partkey % 2 = 1 and p_partkey % 50 < 40),
x as (select i.article, i.image_id, f.figure_id, case when i.number = 3 then null else i.number end as inum, f.number as fnum, list_transform(range(1, 5), lambda k: bit_count(xor(i.h[k]::bigint, f.h[k]::bigint))) as far, replace(i.caption, ' ', '') as a,
  case when f.caption = 'Continued' then 'Continued' else replace(substr(f.caption, 11), ' ', '') end as c, abs((i.aspect - f.aspect) / i.aspect) < 0.05 as ratio, f.caption = 'Continued' as cont from i join f using (article)),
t as (select *, coalesce(inum = fnum, false) as same, len(list_filter(far, lambda v: v <= 2)) > 0 or list_sum(far) <= 5 as visual, cont or levenshtein(a, c) < greatest(5, ceil(length(c) * 0.05)) or levenshtein(left(a, least(length(a), length(c))), left(c, least(length(a), length(c)))) < greatest(2, ceil(least(length(a), length(c)) * 0.03)) as text, list_sum(far) as s from x),
hit as (select *, same::int + visual::int + text::int + ratio::int as passed from t), ok as (select * from hit where passed >= 2 and (inum is null or same or passed > 2))"""


@query(_HITS + """,
best as (select article, image_id, arg_min(figure_id, struct_pack(s := s, f := figure_id)) as figure_id from ok group by 1, 2)
select i.article, i.image_id, best.figure_id, case when best.figure_id is not null then null when i.article not in (select article from f) then 'nothing extracted' else 'no figure is near' end as reason from i left join best using (article, image_id)""")
def image_match(spark, d):
    """Four tests: number, look, caption, aspect ratio; two must hold, and the number or a third where there is a number."""
    images, figures = _pictures(spark, d)
    return matched_images(images, figures, {}, holds=likeness)


def _pictures(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size")
    hashes = F.struct(((k * 37) % 8).alias("a"), ((k * 11) % 16).alias("p"), (k % 4).alias("d"), (size % 32).cast("bigint").alias("w"))
    part, article = Tables(spark, d).part, F.floor(k / 5).alias("article")
    images = part.where("p_partkey % 2 = 0").select(article, k.alias("image_id"), F.when(size % 4 != 3, size % 4).alias("number"), F.col("p_name").alias("caption"), (1.0 + (k % 40) / 100).alias("aspect"), hashes.alias("hashes"))
    caption = F.when(size % 5 == 0, "Continued").otherwise(F.concat(F.lit("Figure 3. "), "p_name", size.cast("string")))
    figures = part.where("p_partkey % 2 = 1 and p_partkey % 50 < 40").select(article, k.alias("figure_id"), (size % 4).alias("number"), caption.alias("caption"), (1.0 + (k % 36) / 100).alias("aspect"), hashes.alias("hashes"))
    return images, figures


@query(_HITS + """,
pk as (select article, image_id, article % 7 as m, image_id % 3 <> 0 or article % 7 in (4, 5, 6) as here, image_id % 4 = 0 as sub, article in (select article from f) as filled from i),
sh as (select article from pk where not here group by 1),
e as (select *, case when m = 0 then 'article not found' when m = 1 then 'broken' when m = 2 and not here then 'image is not in its package' when m <> 2 and not filled then 'no figures found' when m <> 2 and article in (select article from sh) then 'an image of the article is not in its package' end as reason from pk),
r as (select ok.*, sub, row_number() over (partition by ok.article, ok.image_id order by s, figure_id) as n from ok join e using (article, image_id) where reason is null and m <> 2),
g as (select * from r where not sub or n = 1)
select article, image_id, 'figure' as kind, figure_id, null as reason from g union all select article, image_id, 'image', null, null from e where m = 2 and reason is null union all select article, image_id, 'error', null, reason from e where reason is not null
union all select article, image_id, 'error', null, case when (article, image_id) in (select article, image_id from hit where passed >= 2) then 'no figure with its number' else 'no relevant figure' end from e where reason is null and m <> 2 and (article, image_id) not in (select article, image_id from g)""")
def extraction_rows(spark, d):
    """Articles that are missing, broken, without a PDF, without figures or short of an image; figures on several pages."""
    images, figures = _pictures(spark, d)
    m = F.col("article") % 7
    packages = images.select("article").distinct().where(m != 0).select("article", F.when(m == 1, "broken").alias("error"), (m != 2).alias("has_pdf"), F.lit(True).alias("has_xml"))
    members = images.where((F.col("image_id") % 3 != 0) | m.isin(4, 5, 6)).select("article", "image_id")
    return extraction(images.withColumn("sub", F.when(F.col("image_id") % 4 == 0, "a")), packages, members, figures, {}, likeness)


_NAMES = [["None"], ["a", "b", "c"], ["(a)", "b", "d"], ["above", "below"], ["first", "second"], ["Left column", "Right column"], ["1", "2", "4"], ["a1", "b12", "A1"], ["B", "a"], ["Row 1", "upper row"], ["x"], ["1", "a"], ["(2)", "3"], ["a1b2", "a1"], ["é", "b"], ["1a", "2b"]]
_CLASS = [
    (True, False, None, False, False, None), (False, True, None, False, True, None), (False, True, None, True, False, None), (False, False, "position_in_image", False, False, None), (False, False, None, False, False, None), (False, False, "column", False, False, None), (False, True, None, False, False, None), (False, True, None, True, False, None),
    (False, True, None, False, True, None), (False, False, "row", False, False, None), (False, False, None, False, False, "a lone name"), (False, False, None, False, False, None), (False, True, None, True, True, None), (False, False, None, False, False, None), (False, False, None, False, False, None), (False, True, None, False, False, None),
]


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(_quoted, values)) + "]"


@query(f"""with n as (select p_partkey, ([{', '.join(map(_list, _NAMES))}])[(p_partkey % {len(_NAMES)} + 1)::int] as names from part),
m as (select *, list_transform(names, lambda x: regexp_replace(lower(x), '[^a-z0-9]', '', 'g')) as bare, len(names) as k from n),
f as (select *, k > 1 and len(list_filter(bare, lambda x: not regexp_full_match(x, '[a-z]'))) = 0 as letters, k > 1 and len(list_filter(bare, lambda x: not regexp_full_match(x, '[0-9]'))) = 0 as digits from m),
g as (select *, k > 1 and not letters and not digits and len(list_filter(bare, lambda x: not regexp_full_match(x, '[a-z]+[0-9][a-z]*|[0-9]+[a-z][0-9]*'))) = 0 as tokens, array_to_string(bare, ' ') as j from f),
c as (select p_partkey, k = 1 and names[1] = 'None' as full_caption, letters or digits or tokens as alphanum, case when k = 1 or letters or digits or tokens then null when contains(j, 'column') then 'column' when contains(j, 'row') then 'row' when regexp_matches(j, 'top|bottom|middle|left|right|center|lower|upper|above|below') then 'position_in_image' end as "positional",
  case when letters then list_transform(names, lambda x: lower(x)) <> bare when digits then names <> bare when tokens then len(list_distinct(bare)) <> k else false end as ambiguous, case when letters or digits then ascii(list_max(bare)) - ascii(list_min(bare)) + 1 = k else false end as sequential, case when k = 1 and names[1] <> 'None' then 'a lone name' end as error from g)
select *, case when full_caption then '' when "positional" is not null then "positional" else 'alphanum' || case when ambiguous then ',ambiguous' else '' end || case when not sequential then ',missing' else '' end end as asks from c""")
def name_class(spark, d):
    names = F.get(F.array(*[F.array(*map(F.lit, x)) for x in _NAMES]), (F.col("p_partkey") % len(_NAMES)).cast("int"))
    out = Tables(spark, d).part.select("p_partkey", tx.name_class(names).alias("c"))
    return out.select("p_partkey", "c.*", F.array_join(tx.instruction_kinds(F.col("c")), ",").alias("asks"))


#: text, caption's name, all names: each level of the ladder, with and without its guard.
_LADDER = [("A", "A", ["A", "b"]), (" A\t", "A ", ["A "]), ("A", "a", ["a", "b"]), ("A", "a", ["a", "B"]), ("(a)", "a", ["a"]), ("(A)", "A", ["A", "(B)"]), ("a1", "a", ["a", "b"]), ("a1.", "a", ["a", "1"]), ("(B1)", "b1", ["b1", "c2"]), ("(B1)", "b", ["b"]), ("x", "y", ["y"]), ("B 1", "b", ["b", "C"])]
_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


def _form(level: int, x: str) -> str:
    return [x, f"lower({x})", f"regexp_replace({x}, '[^a-zA-Z0-9]', '', 'g')", f"regexp_replace({x}, '[^a-zA-Z]', '', 'g')", f"lower(regexp_replace({x}, '[^a-zA-Z0-9]', '', 'g'))", f"lower(regexp_replace({x}, '[^a-zA-Z]', '', 'g'))"][level]


@query(f"""with c as (select p_partkey, ([{', '.join(map(_quoted, (x[0] for x in _LADDER)))}])[(p_partkey % {len(_LADDER)} + 1)::int] as t, ([{', '.join(map(_quoted, (x[1] for x in _LADDER)))}])[(p_partkey % {len(_LADDER)} + 1)::int] as n, ([{', '.join(_list(x[2]) for x in _LADDER)}])[(p_partkey % {len(_LADDER)} + 1)::int] as names from part)
select p_partkey, case {' '.join(f"when {_form(k, _STRIP.format('t'))} = {_form(k, _STRIP.format('n'))} and list_sort(list_distinct(names)) = list_sort(list_distinct(list_transform(names, lambda x: {_form(k, 'x')}))) then {k + 1}" for k in range(6))} end::int as level from c""")
def match_ladder(spark, d):
    k = (F.col("p_partkey") % len(_LADDER)).cast("int")
    at = lambda i: F.get(F.array(*[F.array(*map(F.lit, x[i])) if i == 2 else F.lit(x[i]) for x in _LADDER]), k)
    return Tables(spark, d).part.select("p_partkey", tx.match_level(at(0), at(1), at(2)).alias("level"))


@query(B + f""", a as (select b.fig, b.id as child_id, min(p_id) as parent_id from b left join pair on pair.c_id = b.id and p_cls = 0 and {_TOUCH} where b.cls <> 0 group by 1, 2),
ann as (select fig, id as child_id, fig * 25 + 1 as annotated_id from b where cls <> 0 and id % 6 = 0), r as (select a.fig, child_id, coalesce(annotated_id, parent_id) as parent_id from a left join ann using (fig, child_id))
select fig, parent_id, list(child_id order by child_id) as children from r where parent_id is not null group by 1, 2""")
def reparented(spark, d):
    b = Tables(spark, d).boxes()
    ann = b.where("cls <> 0 and id % 6 = 0").select("fig", F.col("id").alias("child_id"), (F.col("fig") * 25 + 1).alias("annotated_id"))
    return assembly.children_of(assembly.annotated_parent(spatial.first_parent(b.where("cls = 0"), b.where("cls <> 0")), ann))


@query(B + """, h as (select p_id as parent_id, c_id as child_id, fig, i / nullif(ca, 0) as share from pair where p_cls = 0 and c_cls <> 0) select fig, child_id, count(*)::int as n, round(sum(share), 6) as total from h where share > 0.05 group by 1, 2""")
def label_overlaps(spark, d):
    b = Tables(spark, d).boxes()
    out = spatial.overlaps_of(b.where("cls = 0"), b.where("cls <> 0"))
    return out.select("fig", "child_id", F.size("overlaps").alias("n"), F.round(F.aggregate(F.map_values("overlaps"), F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query(B + """select fig, p_id, c_id from pair where p_cls = 0 and c_cls > 1 and ca > 0 and i / ca >= 0.9""")
def extra_detections(spark, d):
    b = Tables(spark, d).boxes()
    out = spatial.spatial_join(b.where("cls = 0"), b.where("cls > 1"), condition=lambda p, c: bx.overlap(c, p) >= 0.9)
    return out.select("fig", F.col("parent_id").alias("p_id"), F.col("child_id").alias("c_id"))


@query(B.replace("with b0", "with recursive b0") + """, hits as (select fig, p_id, c_id, round(case when pa + ca - i > 0 then i / (pa + ca - i) else 0 end, 9) as s from pair where p_cls = 0 and c_cls <> 0 and (i / nullif(pa + ca - i, 0) >= 0.3 or i / nullif(ca, 0) >= 0.7)),
r as (select *, row_number() over (partition by fig order by s desc, p_id, c_id) as k from hits),
step as (select distinct fig, 0::bigint as k, []::bigint[] as ps, []::bigint[] as cs from r union all select s.fig, r.k, case when list_contains(s.ps, r.p_id) or list_contains(s.cs, r.c_id) then s.ps else list_append(s.ps, r.p_id) end, case when list_contains(s.ps, r.p_id) or list_contains(s.cs, r.c_id) then s.cs else list_append(s.cs, r.c_id) end from step s join r on r.fig = s.fig and r.k = s.k + 1)
select fig, unnest(ps) as parent_id, unnest(cs) as child_id from (select fig, ps, cs from step qualify row_number() over (partition by fig order by k desc) = 1)""")
def greedy_match(spark, d):
    b = Tables(spark, d).boxes()
    hits = spatial.spatial_join(b.where("cls = 0"), b.where("cls <> 0")).withColumn("score", F.round(bx.iou(F.col("parent"), F.col("child")), 9))
    return assembly.greedy_match(hits, "fig", "parent_id", "child_id", "score").select("fig", "parent_id", "child_id")


@query("select p_partkey, levenshtein(replace(p_name, ' ', ''), replace(other, ' ', ''))::int as whole, levenshtein(left(replace(p_name, ' ', ''), n), left(replace(other, ' ', ''), n))::int as cut, n::int as n, words::int as words from (select p_partkey, p_name, p_type, p_size, lead(p_name) over (order by p_partkey) as other, least(length(replace(p_name, ' ', '')), length(replace(lead(p_name) over (order by p_partkey), ' ', ''))) as n, (split_part(p_name, ' ', 1) <> split_part(lead(p_name) over (order by p_partkey), ' ', 1))::int + (split_part(p_name, ' ', 2) <> split_part(lead(p_name) over (order by p_partkey), ' ', 2))::int as plain, case when split_part(p_name, ' ', 1) <> split_part(lead(p_name) over (order by p_partkey), ' ', 1) and split_part(p_name, ' ', 2) <> split_part(lead(p_name) over (order by p_partkey), ' ', 2) then 2 else (split_part(p_name, ' ', 1) <> split_part(lead(p_name) over (order by p_partkey), ' ', 1))::int + (split_part(p_name, ' ', 2) <> split_part(lead(p_name) over (order by p_partkey), ' ', 2))::int end as words from part) where other is not null")
def caption_distance(spark, d):
    """Names of each part and the one with the next key, by letters and by words (names have two)."""
    t = Tables(spark, d).part.select("p_partkey", "p_name")
    other = t.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other"))
    out = t.join(other, "p_partkey").withColumn("d", tx.caption_distance(F.col("p_name"), F.col("other")))
    return out.select("p_partkey", "d.whole", "d.cut", "d.n", tx.word_distance(F.col("p_name"), F.col("other")).alias("words"))


@query("""with t as (select p_partkey, case p_partkey % 8 when 0 then 'pone.0012-g00' || p_size when 1 then 'gr' || p_size || '_lrg' when 2 then 'x-f' || p_size || 'b' when 3 then '1471-2415-i' || p_size when 4 then 'thefig' || p_size when 5 then 'a.g' || p_size || 'c' when 6 then 'nothing here' else 'gr' || p_size || 'a_x' end as c, p_size from part)
select p_partkey, case when p_partkey % 8 in (6, 7) then null else p_size end as id, case p_partkey % 8 when 2 then 'b' when 5 then 'c' end as sub, regexp_replace(c, '^[^_]*_?', '') as rest from t""")
def figure_id_parse(spark, d):
    s, k = F.col("p_size").cast("string"), F.col("p_partkey") % 8
    forms = [("pone.0012-g00", ""), ("gr", "_lrg"), ("x-f", "b"), ("1471-2415-i", ""), ("thefig", ""), ("a.g", "c"), None, ("gr", "a_x")]
    c = F.lit("nothing here")
    for i, f in enumerate(forms):
        if f:
            c = F.when(k == i, F.concat(F.lit(f[0]), s, F.lit(f[1]))).otherwise(c)
    out = Tables(spark, d).part.select("p_partkey", c.alias("c")).withColumn("n", tx.figure_number(F.col("c")))
    uuid = tx.parse_uuid(tx.figure_uuid(F.col("p_partkey"), F.concat(F.lit("x_"), F.when(F.contains("c", F.lit("_")), F.substring_index("c", "_", -1)).otherwise(""))))
    return out.select("p_partkey", "n.id", "n.sub", F.substring(uuid["image_cluster_id"], 3, 100).alias("rest"))


__all__ = ["QUERIES", "near", "rel"]
