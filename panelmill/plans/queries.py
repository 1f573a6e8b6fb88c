"""Queries of the engine's operators over the driver's tables, with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelmill.functions import boxes as bx
from panelmill.functions import text as tx
from panelmill.operators import assembly, relational as rel, spatial
from panelmill.operators.nms import nms, offset_nms, split_nms
from panelmill.plans.base import B, QUERIES, Tables, near, query


@query("select doc_id, source from documents where doc_id in (select doc_id from labels where quality = 1) or (contains(text, 'the') and doc_id in (select doc_id from labels where toxic = 0))")
def corpus_filter(spark, d):
    t = Tables(spark, d)
    return rel.member_or(t.documents, "doc_id", t.labels.where("quality = 1"), t.labels.where("toxic = 0"), F.contains("text", F.lit("the"))).select("doc_id", "source")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def pending_ids(spark, d):
    t = Tables(spark, d)
    return rel.pending(t.documents, t.labels, ["doc_id"]).select("doc_id")


@query("""select doc_id, 'annotation' as origin, quality from labels union all
select doc_id, 'model', null from documents where doc_id not in (select doc_id from labels)""")
def gt_override(spark, d):
    t = Tables(spark, d)
    first = t.labels.select("doc_id", F.lit("annotation").alias("origin"), "quality")
    return rel.overriding(first, t.documents.select("doc_id", F.lit("model").alias("origin"), F.lit(None).cast("int").alias("quality")), ["doc_id"])


@query("""with c as (select conv_id as id, count(*) as turns from conversations group by 1)
select coalesce(d.doc_id, l.doc_id, p.page_id, c.id) as id, d.lang, l.quality, p.url, c.turns
from documents d full join labels l on d.doc_id = l.doc_id full join pages p on coalesce(d.doc_id, l.doc_id) = p.page_id full join c on coalesce(d.doc_id, l.doc_id, p.page_id) = c.id""")
def four_way_assembly(spark, d):
    t = Tables(spark, d)
    parts = {"d": t.documents.select(F.col("doc_id").alias("id"), "lang"), "l": t.labels.select(F.col("doc_id").alias("id"), "quality"), "p": t.pages.select(F.col("page_id").alias("id"), "url"), "c": t.conversations.groupBy(F.col("conv_id").alias("id")).agg(F.count("*").alias("turns"))}
    return rel.outer_assembly(parts, "id").select("id", "d.lang", "l.quality", "p.url", "c.turns")


@query(B + "select fig, p_id, c_id, round(case when pa + ca - i > 0 then i / (pa + ca - i) else 0 end, 6) as iou, round(case when pa > 0 then i / pa else 0 end, 6) as overlap from pair where p_id < c_id and i > 0")
def box_pairs(spark, d):
    b = Tables(spark, d).boxes()
    out = spatial.spatial_join(b, b, condition=lambda p, c: bx.intersection(p, c) > 0).where("parent_id < child_id")
    return out.select("fig", F.col("parent_id").alias("p_id"), F.col("child_id").alias("c_id"), F.round(bx.iou(F.col("parent"), F.col("child")), 6).alias("iou"), F.round(bx.overlap(F.col("parent"), F.col("child")), 6).alias("overlap"))


def nms_sql(groups: str, where: str = "true", table: str = "b", name: str | None = None) -> str:
    """Greedy suppression as a recursion over the rank of boxes within a group: the CTE out<name>."""
    n = name or groups.replace(", ", "_")
    both = "greatest(least(z.x1, n.x1) - greatest(z.x0, n.x0), 0) * greatest(least(z.y1, n.y1) - greatest(z.y0, n.y0), 0)"
    box = lambda t: f"struct_pack(id := {t}id, x0 := {t}x0, y0 := {t}y0, x1 := {t}x1, y1 := {t}y1)"
    own = lambda t: ", ".join(f"{t}.{g}" for g in groups.split(", "))
    return f"""ranked{n} as (select *, row_number() over (partition by {groups} order by score desc, id) as r from {table} where {where}),
kept{n} as (select {groups}, 1 as r, [{box('')}] as acc from ranked{n} where r = 1
  union all select {own('k')}, n.r, case when len(list_filter(k.acc, lambda z: {both} > 0.3 * ((z.x1 - z.x0) * (z.y1 - z.y0) + (n.x1 - n.x0) * (n.y1 - n.y0) - {both}))) > 0 then k.acc else list_append(k.acc, {box('n.')}) end
  from kept{n} k join ranked{n} n on {' and '.join(f'k.{g} = n.{g}' for g in groups.split(', '))} and n.r = k.r + 1),
out{n} as (select {groups}, unnest(acc).id as id from (select {groups}, acc from kept{n} qualify row_number() over (partition by {groups} order by r desc) = 1))"""


_R = B.replace("with b0", "with recursive b0").rstrip() + ",\n"


@query(_R + nms_sql("fig") + " select fig, id from outfig")
def nms_global(spark, d):
    return nms(Tables(spark, d).boxes(), ["fig"])


@query(_R + nms_sql("fig, cls") + " select fig, cls, id from outfig_cls")
def nms_classwise(spark, d):
    return nms(Tables(spark, d).boxes(), ["fig", "cls"])


@query(_R + nms_sql("fig, cls", "cls < 3") + " select fig, id from outfig_cls")
def nms_offset(spark, d):
    """Classes side by side, each beyond the width of all boxes: as class by class."""
    b = Tables(spark, d).boxes().where("cls < 3")
    return offset_nms(b.withColumn("width", F.lit(64)))


@query(_R + ",\n".join([nms_sql("fig", "cls in (0, 1)"), nms_sql("fig, cls", "cls in (0, 1)"), nms_sql("fig", "cls not in (0, 1)", name="rest")]) + " select fig, id from outfig union select fig, id from outfig_cls union select fig, id from outrest")
def nms_split(spark, d):
    return split_nms(Tables(spark, d).boxes())


_TOUCH = "(i / nullif(pa + ca - i, 0) >= 0.3 or i / nullif(ca, 0) >= 0.7)"


@query(B + f""", hit as (select * from pair where p_cls = 0 and c_cls <> 0 and {_TOUCH})
select b.fig, b.id as panel_id, count(*) filter (c_cls = 1) as n_labels, coalesce(list_sum(list(c_id) filter (c_cls <> 1)), 0)::bigint as image_sum,
 round(least(b.x0, min(hit.x0) filter (c_cls <> 1)), 6) as x0, round(greatest(b.y1, max(hit.y1) filter (c_cls <> 1)), 6) as y1
from b left join hit on hit.p_id = b.id where b.cls = 0 group by b.fig, b.id, b.x0, b.y1""")
def panel_hierarchy(spark, d):
    b = Tables(spark, d).boxes()
    out = spatial.hierarchy(b.where("cls = 0"), b.where("cls = 1"), b.where("cls > 1"))
    return out.select("fig", "panel_id", F.size("label_ids").cast("bigint").alias("n_labels"), F.aggregate("image_ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("image_sum"), *near("x0", "y1"))


@query(B + f"select b.fig, b.id as child_id, min(p_id) as parent_id from b left join pair on pair.c_id = b.id and p_cls = 0 and {_TOUCH} where b.cls <> 0 group by 1, 2")
def first_parent(spark, d):
    b = Tables(spark, d).boxes()
    return spatial.first_parent(b.where("cls = 0"), b.where("cls <> 0"))


@query(B + """, c as (select id, greatest(0, least(x0, 0.3)) as x0, greatest(0, least(y0, 0.3)) as y0, greatest(0, least(x1, 0.3)) as x1, greatest(0, least(y1, 0.3)) as y1 from b)
select id, round(x0, 6) as x0, round(y0, 6) as y0, round(x1, 6) as x1, round(y1, 6) as y1 from c where x1 - x0 > 0.003 and y1 - y0 > 0.003""")
def content_box_clip(spark, d):
    b = Tables(spark, d).boxes().select("id", bx.clip(F.col("box"), F.lit(0.3), F.lit(0.3)).alias("c")).where("c is not null").select("id", "c.*")
    return b.select("id", *near("x0", "y0", "x1", "y1"))


@query(B + """select id, round(x1 - x0, 6) as w, round((x1 - x0) * (y1 - y0), 6) as area, round((x0 + x1) / 2 / 4, 6) as cx, round(x0 / 4, 6) as nx0,
 round_even(x0 / 4 * 1000, 0)::int as vx0, round(x0 - 0.02 * greatest(x1 - x0, y1 - y0), 6) as ex0 from b""")
def box_formats(spark, d):
    b, four = F.col("box"), F.lit(4.0)
    return Tables(spark, d).boxes().select("id", F.round(bx.to_coco(b)["w"], 6).alias("w"), F.round(bx.to_coco(b)["area"], 6).alias("area"), F.round(bx.to_yolo(b, four, four)["cx"], 6).alias("cx"), F.round(bx.to_shares(b, four, four)["x0"], 6).alias("nx0"), bx.to_thousandths(b, four, four)["x0"].alias("vx0"), F.round(bx.expand(b)["x0"], 6).alias("ex0"))


@query(B + "select fig, id, round(score, 6) as score from b qualify row_number() over (partition by fig order by score desc, id) = 1")
def best_panel(spark, d):
    return rel.latest(Tables(spark, d).boxes(), ["fig"], [F.desc("score"), F.col("id")]).select("fig", "id", *near("score"))


@query("select conv_id, count(*) as n_votes, count(distinct role) = 1 as agreed, min(role) as lowest, max(role) as highest from conversations group by 1")
def agreement(spark, d):
    return rel.agreement(Tables(spark, d).conversations, ["conv_id"], "role")


_SHORT = "left(regexp_replace(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'), '\\s+', '', 'g'), 60)"


@query("""select p_partkey, lower(regexp_replace(p_brand, '[^a-zA-Z]', '', 'g')) as stem, regexp_matches(p_brand, '^([A-Za-z]+[0-9][A-Za-z]*|[0-9]+[A-Za-z][0-9]*)$') as token,
 regexp_matches(substr(p_brand, 1, 1) || (p_size % 10)::varchar, '^([A-Za-z]+[0-9][A-Za-z]*|[0-9]+[A-Za-z][0-9]*)$') as short from part""")
def stem_names(spark, d):
    return Tables(spark, d).part.select("p_partkey", tx.stem(F.col("p_brand")).alias("stem"), tx.is_alnum_token(F.col("p_brand")).alias("token"), tx.is_alnum_token(F.concat(F.substring("p_brand", 1, 1), (F.col("p_size") % 10).cast("string"))).alias("short"))


@query("select doc_id, left(text, 5) || '-' || substr(text, n_chars // 2 + 1, 7) || '-' || substr(text, greatest(n_chars - 7, 0) + 1, 7) as text from documents")
def segment_reconstruct(spark, d):
    n = F.col("n_chars").cast("int")
    seg = lambda s, n, x: F.struct(s.cast("int").alias("start"), F.lit(n).alias("length"), F.lit(x).cast("string").alias("literal"))
    dash, parts = seg(F.lit(0), 0, "-"), (F.lit(0), F.floor(n / 2), F.greatest(n - 7, F.lit(0)))
    first, middle, last = (seg(s, 7 if k else 5, None) for k, s in enumerate(parts))
    return Tables(spark, d).documents.select("doc_id", tx.reconstruct(F.array(first, dash, middle, dash, last), F.col("text")).alias("text"))


@query("select event_id, props as fixed, json_extract(props, '$.k')::bigint as k from events")
def json_repair(spark, d):
    broken = F.when(F.col("event_id") % 3 == 0, F.regexp_replace("props", r"\}\s*$", "")).when(F.col("event_id") % 3 == 1, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    out = Tables(spark, d).events.select("event_id", tx.repair_json(broken).alias("fixed"))
    return out.withColumn("k", F.from_json("fixed", "k bigint")["k"])


@query("select doc_id, [doc_id, doc_id + 1] as ids from documents")
def json_lists(spark, d):
    i = F.col("doc_id").cast("string")
    j = (F.col("doc_id") + 1).cast("string")
    flat, deep = F.concat(F.lit("["), i, F.lit(","), j, F.lit("]")), F.concat(F.lit("[["), i, F.lit(","), j, F.lit("]]"))
    return Tables(spark, d).documents.select("doc_id", tx.id_list(F.when(F.col("doc_id") % 2 == 0, flat).otherwise(deep)).alias("ids"))


@query("""with k as (select source, row_number() over (order by ('0x' || substr(md5(source), 1, 15))::bigint) <= floor(count(*) over () * 0.7) as in_train from (select distinct source from documents)) select doc_id, in_train, doc_id % 5 as fold from documents join k using (source)""")
def split_by_key(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "source")
    return rel.split_by_key(docs, "source", 0.7, F.conv(F.left(F.md5("source"), F.lit(15)), 16, 10).cast("bigint")).select("doc_id", "in_train", rel.fold(F.col("doc_id")).alias("fold"))


@query("""with s as (select quality, count(*) as n from labels group by 1), t as (select quality, ceil((select max(n) from s) / n)::int as times from s)
select doc_id, quality, copy::int as copy from labels join t using (quality), lateral unnest(range(1, times + 1)) as u(copy)""")
def oversample(spark, d):
    return rel.oversample(Tables(spark, d).labels.select("doc_id", "quality"), "quality").select("doc_id", "quality", "copy")


@query("select quality, count(*) as n, round(1 / count(*), 9) as weight from labels group by 1")
def class_weights(spark, d):
    return rel.class_weights(Tables(spark, d).labels, "quality").withColumn("weight", F.round("weight", 9))


@query("select quality, count(*) filter (toxic = 0) as p0, count(*) filter (toxic = 1) as p1 from labels group by 1")
def confusion(spark, d):
    return rel.confusion(Tables(spark, d).labels, "quality", "toxic", 2).withColumnsRenamed({"0": "p0", "1": "p1"})


@query("""with s as (select avg((quality = toxic)::int) as a, count_if(quality = 1 and toxic = 1) as tp, count_if(quality <> 1 and toxic = 1) as fp, count_if(quality = 1 and toxic <> 1) as fn from labels),
r as (select a, tp / (tp + fp + 1e-8) as p, tp / (tp + fn + 1e-8) as q from s) select round(a, 6) as accuracy, round(p, 6) as precision, round(q, 6) as recall, round(2 * p * q / (p + q + 1e-8), 6) as f1 from r""")
def prf(spark, d):
    return rel.scores(Tables(spark, d).labels, F.col("quality") == 1, F.col("toxic") == 1).select(*near("accuracy", "precision", "recall", "f1"))


@query("select doc_id, lang = 'en' and doc_id % 10 <> 3 or lang = 'fr' and doc_id % 10 = 3 as in_train from documents where lang in ('en', 'fr')")
def split_repair(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "lang")
    en, fr = docs.where("lang = 'en'"), docs.where("lang = 'fr'")
    a, b = rel.swap_split(en, fr, en.where("doc_id % 10 = 3").select("doc_id"), fr.where("doc_id % 10 = 3").select("doc_id"), "doc_id")
    return a.select("doc_id", F.lit(True).alias("in_train")).unionByName(b.select("doc_id", F.lit(False).alias("in_train")))


@query("select o_orderkey, strftime(o_orderdate, '%Y%m%d')::int as date_int from orders")
def date_int(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", tx.date_number(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_int"))


@query("""select event_id, case event_id % 6 when 0 then 'x } y' when 1 then 'x { y' when 2 then 'a "q" } b' when 3 then 'plain' when 4 then 'plain' end as text from events""")
def json_with_braces(spark, d):
    """Braces in texts: what is JSON stays, one brace too few or too many is mended, the rest has no text."""
    k = F.col("event_id") % 6
    raw = F.when(k == 0, '{"a": "x } y"}').when(k == 1, '{"a": "x { y"}').when(k == 2, '{"a": "a \\"q\\" } b"}').when(k == 3, '{"a": "plain"').when(k == 4, '{"a": "plain"}}').otherwise('{"a": "lost } twice"')
    return Tables(spark, d).events.select("event_id", F.from_json(tx.repair_json(raw), "map<string,string>")["a"].alias("text"))


@query("select event_type, event_id, value from events qualify row_number() over (partition by event_type order by event_id desc) = 1")
def latest_meta(spark, d):
    return rel.latest(Tables(spark, d).events, ["event_type"], [F.desc("event_id")]).select("event_type", "event_id", "value")


@query(B + """, broken as (select id, list_filter([case when x0 >= 0.1 then null else 'left' end, case when x1 - x0 <= 0.4 then null else 'wide' end], lambda x: x is not null) as broken from b) select id, broken from broken where len(broken) > 0""")
def validity_screen(spark, d):
    return rel.violations(Tables(spark, d).boxes(), ["id"], {"left": F.col("x0") >= 0.1, "wide": F.col("x1") - F.col("x0") <= 0.4})


@query("select source, case when count(distinct lang) = 1 and count(lang) = count(*) then max(lang) end as value, count(*) as n from documents group by 1")
def consistent_value(spark, d):
    docs = Tables(spark, d).documents
    return assembly.consistent_or_list(docs, ["source"], "lang", "doc_id").join(docs.groupBy("source").agg(F.count("*").alias("n")), "source").select("source", "value", "n")
