"""Queries of the annotation path, of tables between steps and of model answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.functions import boxes as bx
from panelmill.operators import annotations as ann, pages, persist, relational as rel
from panelmill.plans.base import B, Tables, query
from panelmill.sources import readers
from panelmill.sources.scratch import folder

_KIND = "case cls when 0 then 'Panel' when 1 then 'Label' when 2 then 'CFP' when 3 then 'OCT' when 4 then 'Retinal Imaging' else 'Other' end"


def _regions(t: Tables):
    sets = [["Panel"], ["Label"], ["Image", "CFP"], ["Image", "Annotated", "OCT"], ["Image", "Retinal Imaging"]]
    labels = F.coalesce(F.get(F.array(*[F.array(*map(F.lit, s)) for s in sets]), F.col("cls").cast("int")), F.when(F.col("id") % 7 == 0, F.array(F.lit("note"))).otherwise(F.array(F.lit("Image"))))
    return t.boxes().withColumn("labels", labels).withColumn("region", F.col("id"))


@query(B + f"""select fig, id, {_KIND} as kind, case when fig % 3 = 0 or cls = 0 then 1.0::double else round(score, 6) end as score, case when cls = 3 and fig % 3 = 0 then 'Annotated' else 'Plain' end as marked, case when fig % 3 <> 0 and cls <> 0 then 0.5::double when cls > 1 then 1.0 else -1.0 end as marked_score, case when fig % 3 = 0 or cls = 0 then 'annotation' else 'model' end as source
from b where fig % 3 <> 2 and not (cls > 4 and id % 7 = 0 and fig % 3 = 0)""")
def known_predictions(spark, d):
    """Figures with annotated images, with annotated panels only, and with neither."""
    r = _regions(Tables(spark, d))
    every = ann.as_predictions(r).withColumnRenamed("region", "id")
    kind = F.coalesce(F.get(F.array(*map(F.lit, ["Panel", "Label", "CFP", "OCT", "Retinal Imaging"])), F.col("cls").cast("int")), F.lit("Other"))
    model = r.select("fig", "id", kind.alias("kind"), F.round("score", 6).alias("score"), F.lit("Plain").alias("marked"), F.lit(0.5).alias("marked_score"), "box", F.lit(True).alias("survives_nms"))
    done = r.where("fig % 3 <> 2").select("fig", (F.col("fig") % 3 == 0).alias("images"))
    out = ann.known_predictions(every.where("fig % 3 <> 2 and kind = 'Panel'"), every.where("fig % 3 = 0"), model, done)
    return out.select("fig", "id", "kind", "score", "marked", "marked_score", "source")


@query("""select conv_id as fig, 'A' as name, text, 'annotated' as how from conversations where conv_id % 3 = 0
union all select conv_id, 'None', 'all of it', 'whole' from (select distinct conv_id from conversations) where conv_id % 3 = 1
union all select conv_id, role, text, 'split' from conversations where conv_id % 3 = 2""")
def caption_parts(spark, d):
    c = Tables(spark, d).conversations.withColumnRenamed("conv_id", "fig")
    figures = c.select("fig").distinct().select("fig", F.lit("all of it").alias("caption"), F.when(F.col("fig") % 3 == 1, 1).otherwise(4).alias("n_panels"))
    return ann.caption_parts(figures, c.where("fig % 3 = 0").select("fig", F.lit("A").alias("name"), "text"), c.select("fig", F.col("role").alias("name"), "text"))


_HIT = "(i / nullif(pa + ca - i, 0) >= 0.3 or i / nullif(ca, 0) >= 0.7)"


@query(B + f""", r as (select *, case when cls in (0, 1) then cls when cls <= 4 or id % 7 <> 0 then 2 end as k, case when id % 4 = 0 then fig * 25 + id % 25 // 3 end as parent from b),
p as (select fig, id from r where k = 0), s as (select c_id as id, min(p_id) as spot from pair join r c on c.id = c_id and c.k > 0 where p_cls = 0 and {_HIT} group by 1),
x as (select r.fig, r.id, r.k, coalesce(p.id, s.spot) as panel from r left join p on p.id = r.parent and p.fig = r.fig left join s on s.id = r.id where r.k > 0),
n as (select fig, panel, count_if(k = 2) as images, count_if(k = 1) as labels from x group by 1, 2)
select p.fig, count(*)::int as n_panels, coalesce(sum(n.images), 0)::bigint as n_images, coalesce(sum(n.labels), 0)::bigint as n_labels, coalesce(any_value(o.images + o.labels), 0)::int as n_orphans from p left join n on n.panel = p.id left join n o on o.panel is null and o.fig = p.fig group by 1""")
def nested_figures(spark, d):
    r = _regions(Tables(spark, d))
    i, n = F.col("id"), F.col("fig")
    regions = r.select("fig", "id", "labels", F.when(i % 4 == 0, n * 25 + F.floor(i % 25 / 3)).alias("parent"), F.lit("A").alias("name"), F.lit("t").alias("text"), "box", F.lit(1.0).alias("width"), F.lit(1.0).alias("height"))
    out = ann.nested_figures(regions)
    total = lambda name: F.aggregate("panels", F.lit(0).cast("bigint"), lambda a, p: a + F.size(p[name]))
    return out.select("fig", F.size("panels").alias("n_panels"), total("images").alias("n_images"), total("labels").alias("n_labels"), F.coalesce(F.size("orphans"), F.lit(0)).alias("n_orphans"))


_CHILDREN = f""", r as (select *, case when cls in (0, 1) then cls when cls <= 4 or id % 7 <> 0 then 2 end as k from b), p as (select * from r where k = 0),
s as (select c_id as id, min(p_id) as panel from pair join r c on c.id = c_id and c.k > 0 where p_cls = 0 and {_HIT} group by 1), x as (select r.*, panel from r join s using (id) where k = 2)"""


@query(B + _CHILDREN + """, g as (select panel, count(*) as n, bool_or(cls = 2) as cfp, bool_or(cls = 3) as oct, max(x1) as x1 from x group by 1)
select 'gt_' || p.id as panel_id, fig + 100 as article_id, coalesce(cfp, false) as contains_cfp, coalesce(oct, false) as contains_oct, coalesce(oct, false) as contains_marked, coalesce(n, 0)::int as n_images, round(greatest(p.x1, g.x1), 6) as x1, 'ground_truth' as assembly, case when fig % 2 = 0 then 'CC0' end as license, fig % 2 = 0 as commercial_use from p left join g on g.panel = p.id""")
def annotated_rows(spark, d):
    r = _regions(Tables(spark, d))
    nested = ann.nested_figures(r.select("fig", "id", "labels", F.lit(None).cast("bigint").alias("parent"), F.lit("A").alias("name"), F.lit("t").alias("text"), "box", F.lit(1.0).alias("width"), F.lit(1.0).alias("height")))
    n = F.col("fig")
    figures = r.select("fig").distinct().select("fig", (n + 100).alias("article_id"), F.lit("c").alias("image_cluster_id"), F.create_map(F.lit("1"), F.lit(0)).alias("page_boxes"))
    articles = figures.select("article_id", "image_cluster_id", F.lit("t").alias("title"), F.lit("c").alias("citation"), F.when(n % 2 == 0, "CC0").alias("license"), F.array(F.lit("x")).alias("context"))
    out = ann.annotated_rows(nested, figures, articles)
    x1 = F.get(F.from_json("position", "content_box array<double>")["content_box"], F.lit(2))
    return out.select("panel_id", "article_id", "contains_cfp", "contains_oct", "contains_marked", F.size(F.from_json("image_data", "array<struct<id:string>>")).alias("n_images"), F.round(x1, 6).alias("x1"), "assembly", "license", "commercial_use")


@query("""select p_partkey, 'new' as a, '{"x":"1","y":"3"}' as b, p_name as c from part""")
def merged_settings(spark, d):
    m = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    out = ann.merged_settings(m("a", "old", "b", '{"x": "1", "y": "2"}', "c", F.col("p_name")), m("a", "new", "b", '{"y": "3"}'))
    return Tables(spark, d).part.select("p_partkey", out.alias("m")).select("p_partkey", *[F.col("m")[k].alias(k) for k in "abc"])


@query("select conv_id as id, conv_id + 7 as article_id, 'fig_1' as image_cluster_id from conversations group by conv_id having count(*) filter (role <> 'user') = 1")
def usable_tasks(spark, d):
    """Tasks with one finished annotation."""
    c = Tables(spark, d).conversations
    annotation = F.struct(F.col("turn").alias("id"), (F.col("role") == "user").alias("was_cancelled"), F.array(F.struct(F.lit("r").alias("id"))).alias("result"))
    path = F.concat(F.lit("/x/images/PMC"), (F.col("conv_id") + 7).cast("string"), F.lit("_fig_1.jpg"))
    tasks = c.groupBy(F.col("conv_id").alias("id"), F.struct(path.alias("image_path")).alias("data")).agg(F.collect_list(annotation).alias("annotations"))
    return ann.usable_tasks(tasks).select("id", "article_id", "image_cluster_id")


@query(B + "select fig, count(*)::int as n, round(min(score), 6) as least, round(arg_min(x0 / 4 * 100, id::varchar), 6) as x from b group by 1")
def preannotated(spark, d):
    out = ann.preannotated(Tables(spark, d).boxes().select("fig", "id", F.lit("Panel").alias("kind"), "score", "box", F.lit(4).alias("width"), F.lit(4).alias("height")))
    p = F.get(F.from_json("task", "predictions array<struct<score:double,result:array<struct<id:string,value:struct<x:double>>>>>")["predictions"], F.lit(0))
    return out.select("fig", F.size(p["result"]).alias("n"), F.round(p["score"], 6).alias("least"), F.round(F.get(p["result"], F.lit(0))["value"]["x"], 6).alias("x"))


@query("""select p_partkey, case when p_partkey % 3 = 0 then 'panel' when p_partkey % 3 = 1 then 'place' end as form, case when p_partkey % 3 = 0 then 'existing,new' when p_partkey % 3 = 1 then 'place' end as kinds from part""")
def answers_read(spark, d):
    k = F.col("p_partkey") % 3
    panel = '{"assignments": [{"panel_id": 3, "assigned_subcaption": "A", "confidence": 0.5, "evidence": [{"label_id": 7}, {"bbox_2d": [1, 2, 3, 4], "text": "A"}]}]}'
    place = '{"assignments": [{"assigned_images": ["1", 2], "assigned_subcaption": null, "confidence": 0.5, "evidence": [{"positional_type": "ROW", "short_description": "x"}]}]}'
    a = ann.answers_read(F.when(k == 0, panel).when(k == 1, place).otherwise('{"assignments": [{"confidence": 1}]}'))
    out = Tables(spark, d).part.select("p_partkey", a.alias("a"))
    kinds = lambda c: F.array_join(ann.evidence_kinds(F.get(c, F.lit(0))["evidence"]), ",")
    return out.select("p_partkey", F.when(F.col("a.by_panel").isNotNull(), "panel").when(F.col("a.by_place").isNotNull(), "place").alias("form"), F.coalesce(kinds(F.col("a.by_panel")), kinds(F.col("a.by_place"))).alias("kinds"))


@query(B + "select fig, (row_number() over (partition by fig order by id) - 1)::int as n, id, case when id % 25 < 20 then round(score, 6) end as score from b")
def predictions_flat(spark, d):
    own = lambda c, keep=True: F.transform(F.array_sort(F.collect_list(F.struct("id", c.alias("v")))), lambda x: x["v"])
    score = F.when(F.col("id") % 25 < 20, F.round("score", 6))
    lists = Tables(spark, d).boxes().groupBy("fig").agg(own(F.col("id")).alias("id"), own(score).alias("score"))
    return persist.predictions_flat(lists, ["fig"], ["id", "score"])


@query("""select o_orderkey, case when o_orderkey % 3 = 0 then 'new' when o_orderkey % 2 = 0 then 'old' else o_orderpriority end as text, case when o_orderkey % 2 = 0 then o_custkey end as owner, case when o_orderkey % 9 = 0 then true end as deleted from orders where o_orderkey % 2 = 0 or o_orderkey % 3 = 0""")
def merged_updates(spark, d):
    """Values that are not null replace the old ones; a deleted row is marked."""
    o = Tables(spark, d).orders
    old = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("old").alias("text"), F.col("o_custkey").alias("owner"))
    new = o.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("new").alias("text"), F.lit(None).cast("bigint").alias("owner"), F.when(F.col("o_orderkey") % 9 == 0, True).alias("deleted"))
    return persist.merged(old, new, ["o_orderkey"])


@query(B + """, p as (select fig, count(*) as n from b where cls = 0 group by 1) select fig, id as panel_id, 2::int as n_labels, 1::bigint as n_new, true as agrees from b where cls = 0""")
def stored_labels(spark, d):
    """Negative ids of new labels become lasting ones, in both tables alike."""
    b = Tables(spark, d).boxes()
    p = b.where("cls = 0").select("fig", F.col("id").alias("panel_id"), F.array(F.col("id") + 1, -F.col("id") - 1).alias("label_ids"))
    labels = p.select("fig", (-F.col("panel_id") - 1).alias("label_id"), F.lit("A").alias("text"))
    panels, new = persist.stored_labels(p, labels)
    known = new.select("fig", F.col("id").alias("new_id"))
    each = panels.select("fig", "panel_id", F.size("label_ids").alias("n_labels"), F.explode("label_ids").alias("new_id")).join(known.withColumn("is_new", F.lit(1)), ["fig", "new_id"], "left")
    return each.groupBy("fig", "panel_id", "n_labels").agg(F.count("is_new").alias("n_new"), (F.min("new_id") > -1).alias("agrees"))


@query("""with t as (select distinct l_orderkey as fig from lineitem where l_quantity <= 5)
select l_orderkey as fig, l_linenumber as panel_id, case when l_orderkey in (select fig from t) then 'again' else 'done' end as state, count(*) as n from lineitem group by 1, 2, 3""")
def resumed_run(spark, d):
    """Figures with an unfinished panel are done again as a whole."""
    li = Tables(spark, d).lineitem
    panels = li.select(F.col("l_orderkey").alias("fig"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("panel_id"), "l_quantity")
    state = panels.select("fig", "panel_id", F.when(F.col("l_quantity") > 5, "done").otherwise("open").alias("state"))
    again = lambda todo: panels.join(todo, "fig", "left_semi").select("fig", "panel_id", F.lit("again").alias("state"))
    out = persist.resumed(state, panels, "fig", F.col("state") == "done", again)
    return out.groupBy("fig", F.col("panel_id.l_linenumber").alias("panel_id"), "state").agg(F.count("*").alias("n"))


@query(B + """, s as (select fig, id % 3 as page, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, max(case when fig % 5 = 3 and id % 3 = 1 then 1 else 0 end) as bad from b group by 1, 2),
f as (select fig, max(bad) as bad, count(*) as n, max(round((x1 - x0) * 1000)::bigint) as w, sum(round((y1 - y0) * 1000)::bigint)::bigint as h from s group by 1)
select fig, case when bad = 1 then 'figure meets caption' end as reason, case when bad = 0 then w end as image_width, case when bad = 0 then (h + greatest(floor(0.02 * greatest(w, h)), 10) * (n - 1))::bigint end as image_height from f""")
def merged_figures(spark, d):
    """Records of a figure on several pages become one image, or a reason why not."""
    top = F.when((F.col("fig") % 5 == 3) & (F.col("id") % 3 == 1), 0.1).otherwise(10.0)
    records = Tables(spark, d).boxes().select("fig", (F.col("id") % 3).alias("page"), F.col("id").alias("n"), "box", bx.box(F.lit(0.0), top, F.lit(1.0), top + 1).alias("caption"))
    return pages.merged_figures(records, ["fig"], 1000.0).select("fig", "reason", "image_width", "image_height").distinct()


@query("select p_partkey, p_name, p_size from part where p_size > 10")
def csv_tables(spark, d):
    at = folder(spark, "csv")
    Tables(spark, d).part.select("p_partkey", "p_name", "p_size").write.option("header", True).csv(at)
    return readers.csv_table(spark, at, "p_partkey bigint, p_name string, p_size int").where("p_size > 10")


@query("select p_partkey::varchar as query, i as n, p_partkey || '-' || i as id from part, lateral unnest(range(least(p_partkey % 60, 45))) r(i)")
def paged_search(spark, d):
    """Each part's search has up to 59 results, of which the first 45 are asked for, 20 a page."""

    def ask(query, start, step):
        total = int(query) % 60
        return total, [f"{query}-{i}" for i in range(start, min(start + step, total))]

    return readers.searched_each(Tables(spark, d).part, "p_partkey", ask, 45, 20)


@query("select doc_id::varchar as path, 'body of ' || doc_id as body, case when doc_id % 10 = 0 then 'no such file' end as error from documents where doc_id not in (select doc_id from labels)")
def downloads(spark, d):
    """Only what is not there yet is fetched; what fails has its error."""
    t = Tables(spark, d)

    def fetch(path: str) -> bytes:
        if int(path) % 10 == 0:
            raise OSError("no such file")
        return b"body of " + path.encode()

    path = F.col("doc_id").cast("string").alias("path")
    out = readers.downloaded(t.documents.select(path), t.labels.select(path), fetch, 4)
    return out.select("path", F.coalesce(F.col("content").cast("string"), F.concat(F.lit("body of "), "path")).alias("body"), "error")


@query("""with r as (select conv_id, turn, turn % 10 * 10.0 as x0, least(turn % 10 * 10 + 6 + turn % 7, 100) as x1, case turn % 3 when 0 then 'figure' when 1 then 'caption' end as role from conversations where conv_id % 5 <> 2),
p as (select *, least(floor(x0 / (100 / 3)), 2)::int as i from r)
select conv_id as id, 'PMC' || conv_id as article_id, 'gr_' || conv_id as image_cluster_id, turn::varchar as region, role, case when turn % 2 = 0 then 'A' || turn end as name, [4, 7, 9][i + 1] as page, i as page_index, round(x0 - i * 100 / 3, 6) as x0, round(x1 - i * 100 / 3, 6) as x1, 33 as page_width, 72 as dpi, x1 > (i + 1) * 100 / 3 + 1 as crosses from p""")
def page_regions(spark, d):
    """Regions on three pages side by side, 50 tasks a file; tasks that cannot be read, and cancelled annotations, are left out."""
    at = folder(spark, "pages")
    turn = F.col("turn")
    part = lambda kind, source, value: F.struct(turn.cast("string").alias("id"), F.lit(kind).alias("type"), source.alias("from_name"), F.lit(100).alias("original_width"), F.lit(50).alias("original_height"), value.alias("value"))
    x = (turn % 10 * 10).cast("double")
    nothing = lambda t: F.lit(None).cast(t)
    value = lambda x, w, labels, text: F.struct(x.alias("x"), F.lit(1.0).alias("y"), w.alias("width"), F.lit(2.0).alias("height"), labels.alias("rectanglelabels"), text.alias("text"))
    source = F.when(turn % 3 == 0, "figure_position").when(turn % 3 == 1, "caption_position").otherwise("other")
    shape = part("rectanglelabels", source, value(x, F.least(6 + turn % 7, 100 - turn % 10 * 10).cast("double"), F.array(F.lit("Actual Figure")), nothing("array<string>")))
    name = part("textarea", F.lit("box_name"), value(nothing("double"), nothing("double"), nothing("array<string>"), F.array(F.concat(F.lit("A"), turn.cast("string")))))
    regions = F.flatten(F.collect_list(F.when(turn % 2 == 0, F.array(shape, name)).otherwise(F.array(shape))))
    c = F.col("conv_id")
    data = F.struct(F.concat(F.lit("/x/pdf_PMC"), c.cast("string"), F.lit("_gr_"), c.cast("string"), F.when(c % 2 == 0, "_updated").otherwise(""), F.lit(".png")).alias("base_image_path"), F.array(F.lit(4), F.lit(7), F.lit(9)).alias("pdf_pages"), F.concat(F.lit("PMC"), c.cast("string")).alias("article_id"))
    cancelled = F.struct(F.lit(1).alias("id"), F.lit(True).alias("was_cancelled"), F.col("result"))
    tasks = Tables(spark, d).conversations.groupBy("conv_id").agg(regions.alias("result")).select(F.expr("conv_id div 50").alias("k"), F.when(c % 5 == 2, '{"id": {}, "data": 3}').otherwise(F.to_json(F.struct(c.alias("id"), data.alias("data"), F.array(cancelled, F.struct(F.lit(2).alias("id"), F.lit(False).alias("was_cancelled"), F.col("result"))).alias("annotations")))).alias("t"))
    tasks.groupBy("k").agg(F.concat(F.lit("["), F.array_join(F.collect_list("t"), ","), F.lit("]")).alias("value")).write.partitionBy("k").text(at)
    out = ann.page_regions(readers.page_tasks(spark, at))
    return out.select("id", "article_id", "image_cluster_id", "region", "role", "name", "page", "page_index", F.round("on_page.x0", 6).alias("x0"), F.round("on_page.x1", 6).alias("x1"), "page_width", "dpi", "crosses")


@query("""with r as (select conv_id as id, turn, least(floor(turn % 10 * 10 / (100 / 3)), 2)::int as i from conversations where turn % 3 = 0), l as (select id, i, max(turn::varchar) as region from r group by 1, 2)
select id, list([4, 7, 9][i + 1] order by i) as pages, round(sum(region::int % 10 * 10), 6)::double as total from l group by 1""")
def figure_places(spark, d):
    t, turn = Tables(spark, d).conversations, F.col("turn")
    at = F.least(F.floor(turn % 10 * 10 / (100 / 3)), F.lit(2)).cast("int")
    regions = t.select(F.col("conv_id").alias("id"), F.when(turn % 3 == 0, "figure").alias("role"), turn.cast("string").alias("region"), F.get(F.array(F.lit(4), F.lit(7), F.lit(9)), at).alias("page"), bx.box(turn % 10 * 10, F.lit(0), F.lit(1), F.lit(1)).alias("on_page"))
    out = ann.places(regions, "figure")
    return out.select("id", F.map_keys("pages").alias("pages"), F.round(F.aggregate(F.map_values("pages"), F.lit(0.0), lambda a, b: a + b["x0"]), 6).alias("total"))


__all__ = ["rel"]
