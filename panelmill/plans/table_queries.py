"""Queries of the relational operators, predicates and columns."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelmill.functions import boxes as bx
from panelmill.functions import text as tx
from panelmill.operators import assembly, relational as rel
from panelmill.plans.base import B, Tables, near, query
from panelmill.streaming.incremental import windowed_counts


@query(B + "select id, fig, dense_rank() over (order by fig) as image_id, row_number() over (order by id) as annotation_id from b")
def dense_ids(spark, d):
    return rel.coco_ids(Tables(spark, d).boxes().select("id", "fig"), "fig", "id")


@query(B + "select fig, count(*) as n, round(min(x0), 6) as x0, round(max(y1), 6) as y1 from b group by fig")
def union_boxes(spark, d):
    u = Tables(spark, d).boxes().groupBy("fig").agg(F.count("*").alias("n"), bx.union_of(F.col).alias("u"))
    return u.select("fig", "n", F.round("u.x0", 6).alias("x0"), F.round("u.y1", 6).alias("y1"))


@query("""with g as (select o_orderkey, case when o_orderkey % 5 = 0 then null when o_orderkey % 3 = 0 then o_orderkey // 3 + 2 else o_orderkey + 100000000 end as id from orders),
u as (select i, row_number() over (order by i) as k from range(1, (select 2 * count(*) + 3 from orders)) r(i) where i not in (select id from g where id is not null)),
n as (select o_orderkey, row_number() over (order by o_orderkey) as k from g where id is null)
select o_orderkey, id from g where id is not null union all select o_orderkey, i from n join u using (k)""")
def fill_ids(spark, d):
    k = F.col("o_orderkey")
    ids = F.when(k % 5 == 0, None).when(k % 3 == 0, F.floor(k / 3) + 2).otherwise(k + 100_000_000)
    return rel.fill_ids(Tables(spark, d).orders.select("o_orderkey", ids.cast("bigint").alias("id")), "id", "o_orderkey")


@query("select conv_id, turn, -row_number() over (partition by conv_id order by turn desc)::int as id from conversations")
def negative_ids(spark, d):
    return rel.negative_ids(Tables(spark, d).conversations.select("conv_id", "turn"), ["conv_id"], [F.desc("turn")])


@query("select conv_id, list(distinct role order by role) as roles, count(distinct role) filter (role not in ('user', 'assistant')) = 0 as is_subset from conversations group by 1")
def subset_check(spark, d):
    roles = Tables(spark, d).conversations.groupBy("conv_id").agg(F.array_sort(F.collect_set("role")).alias("roles"))
    return roles.withColumn("is_subset", rel.is_subset(F.col("roles"), F.array(F.lit("user"), F.lit("assistant"))))


@query("select doc_id, 'both' as side from (select doc_id from documents intersect select doc_id from labels) union all select doc_id, 'rest' from (select doc_id from documents except select doc_id from labels)")
def set_operations(spark, d):
    t = Tables(spark, d)
    a, b = t.documents.select("doc_id"), t.labels.select("doc_id")
    return a.intersect(b).withColumn("side", F.lit("both")).unionByName(a.subtract(b).withColumn("side", F.lit("rest")))


@query("select l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus)::bigint as level, count(*) as n, sum(l_quantity)::bigint as quantity from lineitem group by cube (l_returnflag, l_linestatus)")
def grouping_sets(spark, d):
    return Tables(spark, d).lineitem.cube("l_returnflag", "l_linestatus").agg(F.grouping_id().cast("bigint").alias("level"), F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query("select o_orderkey, lag(o_orderkey) over w as before, lead(o_orderkey, 2) over w as after, rank() over (partition by o_custkey order by o_orderpriority)::int as rank, ntile(4) over w::int as part, count(*) over (partition by o_custkey order by o_orderkey rows between 1 preceding and 1 following) as near from orders window w as (partition by o_custkey order by o_orderkey)")
def frames(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return Tables(spark, d).orders.select("o_orderkey", F.lag("o_orderkey").over(w).alias("before"), F.lead("o_orderkey", 2).over(w).alias("after"), F.rank().over(Window.partitionBy("o_custkey").orderBy("o_orderpriority")).alias("rank"), F.ntile(4).over(w).alias("part"), F.count("*").over(w.rowsBetween(-1, 1)).alias("near"))


@query("select user_id, bool_or(value > 50) as any_ok, bool_and(value > 5) as all_ok, count(*) as n, round(avg(value), 4) as mean, min(value) as least from events group by 1")
def rollup_flags(spark, d):
    e = Tables(spark, d).events
    both = rel.rollups(e, ["user_id"], F.col("value") > 50).drop("all_ok").join(rel.rollups(e, ["user_id"], F.col("value") > 5).drop("any_ok", "n"), "user_id")
    means = e.groupBy("user_id").agg(F.round(F.avg("value"), 4).alias("mean"), F.min("value").alias("least"))
    return both.join(means, "user_id").select("user_id", "any_ok", "all_ok", "n", "mean", "least")


@query("select user_id, list(distinct event_type order by event_type) as keys, count(*) as n, first(value order by event_id) filter (event_type = 'click') as click from events group by 1")
def meta_merge(spark, d):
    e = Tables(spark, d).events.select("user_id", "event_id", F.create_map("event_type", "value").alias("meta"))
    out = rel.merged_meta(e, ["user_id"], "meta", "event_id")
    n = F.aggregate(F.map_values("meta"), F.lit(0).cast("bigint"), lambda a, x: a + F.size(x))
    return out.select("user_id", F.array_sort(F.map_keys("meta")).alias("keys"), n.alias("n"), F.get(F.element_at("meta", "click"), F.lit(0)).alias("click"))


@query("select conv_id, first(text order by turn) filter (role in ('user', 'assistant')) as text from conversations group by 1")
def first_record(spark, d):
    c = Tables(spark, d).conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("r"))
    return c.select("conv_id", F.get(F.filter("r", lambda x: x["role"].isin("user", "assistant")), F.lit(0))["text"].alias("text"))


@query("select doc_id, lang from documents order by md5(doc_id || ':0'), doc_id limit 100")
def sample_n(spark, d):
    return rel.sample(Tables(spark, d).documents.select("doc_id", "lang"), 100, "doc_id")


@query("select doc_id, case when doc_id % 7 = 0 then source || ' ' || doc_id else text end as text from documents")
def null_restore(spark, d):
    docs = Tables(spark, d).documents
    originals = docs.where("doc_id % 14 = 0 or doc_id % 7 <> 0").unionByName(docs.where("doc_id % 14 = 7")).select("doc_id", F.concat_ws(" ", "source", F.col("doc_id").cast("string")).alias("text"))
    return assembly.restore_text(docs.select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("text")), originals, "doc_id", "text")


@query("select o_orderkey, o_totalprice, 'new' as batch from orders where o_orderkey % 3 = 0 union all select o_orderkey, o_totalprice * 2, 'old' from orders where o_orderkey % 3 <> 0 and o_orderkey % 2 = 0")
def union_batches(spark, d):
    o = Tables(spark, d).orders
    old = o.where("o_orderkey % 2 = 0").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("old").alias("batch"))
    return rel.upsert(old, o.where("o_orderkey % 3 = 0").select("o_orderkey", "o_totalprice", F.lit("new").alias("batch")), ["o_orderkey"])


@query("select o_orderkey, c_name, 'a/' || c_custkey || '/PMC' || c_custkey as path, 'PMC' || c_custkey as key from orders join customer on o_custkey = c_custkey")
def file_list_join(spark, d):
    t = Tables(spark, d)
    k = F.col("c_custkey").cast("string")
    files = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", tx.list_path(F.concat(F.lit("oa_package/a/"), k, F.lit("/PMC"), k, F.lit(".tar.gz"))).alias("p"))
    return rel.strict_lookup(t.orders.select("o_orderkey", "o_custkey"), files, "o_custkey").select("o_orderkey", "c_name", "p.path", "p.key")


@query("select event_id, case event_type when 'click' then 'Automatic' when 'view' then 'LLM' when 'purchase' then 'Manual Assignment' end as assembly from events")
def value_names(spark, d):
    return Tables(spark, d).events.select("event_id", assembly.by_name(F.col("event_type"), {"click": "Automatic", "view": "LLM", "purchase": "Manual Assignment"}).alias("assembly"))


@query("""select p_partkey, case when p_partkey % 3 = 0 then 'other' when p_partkey % 3 = 1 then 'non_commercial' else 'commercial' end as licence,
case p_partkey % 6 when 0 then 0 when 1 then 2 when 5 then 3 else -1 end::int as class, case p_partkey % 4 when 0 then 'CFP' when 1 then 'OCT' end as kind, p_partkey % 6 <> 2 as present from part""")
def labelling_columns(spark, d):
    k = F.col("p_partkey")
    path = F.concat(F.lit("/other.d/"), F.when(k % 3 == 0, "oa_other_1.tar").when(k % 3 == 1, "noncommercial.tar").otherwise("commercial.tar"))
    sets = [["Image", "CFP"], ["Marked", "Image", "Retinal Imaging"], ["CFP"], ["Image", "CFP", "OCT"], ["Image", "Panel", "CFP"], ["Image", "Other"]]
    labels = F.get(F.array(*[F.array(*map(F.lit, s)) for s in sets]), (k % 6).cast("int"))
    name = F.when(k % 4 == 0, "cfp").when(k % 4 == 1, "Oct").when(k % 4 == 2, "CF").otherwise(None)
    return Tables(spark, d).part.select("p_partkey", tx.licence_kind(path).alias("licence"), tx.class_index(labels, ["CFP", "OCT", "Retinal Imaging", "Other"]).alias("class"), tx.one_of(name, ["CFP", "OCT"]).alias("kind"), F.array_contains(labels, "Image").alias("present"))


@query("""select '/label-studio/images/' || doc_id || '_' || source || '.jpg' as image_path, text as caption, 'on ' || lang || ' (' || case when doc_id % 2 = 0 then 'cited' else 'None' end || ')' as citation, doc_id as article_id, n_chars as row,
case when doc_id % 3 = 0 then 'a, ' || lang else lang end as keywords, source as image_cluster_id, case when doc_id % 4 = 0 then 'extra' else 'base' end as origin from documents""")
def labelling_rows(spark, d):
    k = F.col("doc_id")
    rows = Tables(spark, d).documents.select(k.alias("article_id"), F.col("source").alias("image_cluster_id"), F.col("text").alias("caption"), F.concat(F.lit("on "), "lang").alias("title"), F.when(k % 2 == 0, "cited").alias("citation"), F.array(F.col("lang"), F.when(k % 3 == 0, "a"), F.lit(None)).alias("keywords"), F.col("n_chars").alias("n"), F.when(k % 4 == 0, "extra").alias("type"))
    return rel.labelling_rows(rows)


@query("select p_partkey from part where regexp_matches(p_name, 'red|blue', 'i') and regexp_matches(p_type, 'econ|stan', 'i') and regexp_matches(p_brand, '#1|#2', 'i')")
def search_terms(spark, d):
    return Tables(spark, d).part.where(tx.corpus_terms(F.col("p_name"), F.col("p_type"), F.col("p_brand"), ["red", "blue"], ["econ", "stan"], ["#1", "#2"])).select("p_partkey")


@query(B + "select id from b where id % 4 <> 3 and score >= 0.1 or id in (select doc_id from labels)")
def survives_or_used(spark, d):
    t = Tables(spark, d)
    return rel.survives_or_used(t.boxes(), t.labels.select(F.col("doc_id").alias("id")), "id", (F.col("id") % 4 != 3) & (F.col("score") >= 0.1)).select("id")


@query("""with r as (select conv_id, list(struct_pack(t := case when turn % 3 = 0 then '' else 'x' end, n := case when turn % 4 = 1 and conv_id % 2 = 0 then 'A' end, rel := role = 'user' and conv_id % 5 <> 0, k := case when turn % 2 = 0 then 'Label' end)) as r, count(*) as n from conversations group by 1)
select conv_id, len(list_filter(r, lambda x: x.t <> '')) > 0 and len(list_filter(r, lambda x: x.t <> '' and x.n is null)) <= 1 as captioned,
 len(list_filter(r, lambda x: x.rel)) > 0 and len(list_filter(r, lambda x: x.rel and x.t = '')) = 0 and (len(list_filter(r, lambda x: x.rel)) = 1 or len(list_filter(r, lambda x: x.rel and x.n is null)) = 0) as fully, len(list_filter(r, lambda x: x.rel and x.k is null)) > 0 as image_level from r""")
def region_predicates(spark, d):
    turn, c = F.col("turn"), F.col("conv_id")
    region = F.struct(F.when(turn % 3 == 0, "").otherwise("x").alias("text"), F.when((turn % 4 == 1) & (c % 2 == 0), "A").alias("name"), ((F.col("role") == "user") & (c % 5 != 0)).alias("relevant"), F.when(turn % 2 == 0, "Label").alias("kind"))
    r = Tables(spark, d).conversations.groupBy("conv_id").agg(F.collect_list(region).alias("r"))
    return r.select("conv_id", rel.captioned(F.col("r")).alias("captioned"), rel.fully_captioned(F.col("r")).alias("fully"), rel.image_level(F.col("r")).alias("image_level"))


@query("select l_orderkey, l_linenumber, not (l_quantity > 10) or (not (l_tax > 0.05) and l_suppkey % 5 <> 0) as final from lineitem where l_returnflag = 'A'")
def final_panels(spark, d):
    """Rows of one model version; those that need no more work."""
    final = rel.is_final(F.col("l_quantity") > 10, F.col("l_tax") > 0.05, F.when(F.col("l_suppkey") % 5 != 0, 1))
    return Tables(spark, d).lineitem.where("l_returnflag = 'A'").select("l_orderkey", "l_linenumber", final.alias("final"))


@query(B + "select id from b where x0 >= 0 and y0 >= 0 and x1 > 0 and y1 > 0 and x1 <= 0.35 and y1 <= 0.4 and x0 < x1 and y0 < y1 and score >= 0.05")
def boxes_within(spark, d):
    return Tables(spark, d).boxes().where(bx.within(F.col("box"), F.lit(0.35), F.lit(0.4)) & (F.col("score") >= 0.05)).select("id")


@query("select distinct source from documents where source not in ('web', 'books') and doc_id not in (select doc_id from labels) and doc_id in (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)")
def excluded_names(spark, d):
    """Names of a list are left out, keys of another table too, and only listed ids are looked up."""
    t = Tables(spark, d)
    rest = rel.missing_from(t.documents, t.labels, ["doc_id"]).join(t.documents, "doc_id")
    return rest.where(~F.col("source").isin("web", "books") & F.col("doc_id").isin(1, 2, 3, 5, 8, 13, 21, 34, 55, 89)).select("source").distinct()


@query("select o_orderkey, l_partkey from orders join (select l_orderkey, arg_min(l_partkey, struct_pack(n := l_linenumber, p := l_partkey)) as l_partkey from lineitem where l_quantity > 10 group by 1) on o_orderkey = l_orderkey")
def first_lookup(spark, d):
    """Each order's first line; an order without one goes."""
    t = Tables(spark, d)
    lines = t.lineitem.where("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", F.struct("l_linenumber", "l_partkey").alias("n"))
    return rel.first_lookup(t.orders.select("o_orderkey"), lines, ["o_orderkey"], "l_partkey", "n")


@query("select o_orderkey, list(l_partkey order by l_partkey) filter (l_partkey is not null) as ids, count(l_partkey) = 0 as missing from orders left join lineitem on o_orderkey = l_orderkey and l_quantity > 25 group by 1")
def ids_filled(spark, d):
    t = Tables(spark, d)
    lines = t.lineitem.where("l_quantity > 25").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return rel.with_ids(t.orders.select("o_orderkey"), lines, ["o_orderkey"], "l_partkey")


@query(B + """, c as (select o_custkey as fig, count(*) as n_captions, bool_or(o_orderkey % 4 = 0) and bool_or(o_orderkey % 4 <> 0) as ok from orders group by 1)
select fig, c.n_captions::int as n_captions, count(b.id)::int as n_boxes from c left join b using (fig) where ok group by 1, 2""")
def figure_bundles(spark, d):
    t = Tables(spark, d)
    captions = t.orders.select(F.col("o_custkey").alias("fig"), F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 4 == 0).alias("is_full"), F.col("o_orderpriority").alias("text"))
    out = rel.bundles(captions.select("fig").distinct(), captions, t.boxes().select("fig", "id", F.col("cls").alias("kind"), "score"))
    return out.select("fig", F.size("captions").alias("n_captions"), F.greatest(F.coalesce(F.size("predictions"), F.lit(0)), F.lit(0)).alias("n_boxes"))


@query("select event_id, json_extract_string(props, '$.k') as k, null::varchar as title, '[]' as context, [event_id::varchar, 'a', '2'] as plain, 'file' as origin, strftime(ts, '%Y%m%d_%H%M%S') as at, event_id::int as n from events")
def flat_records(spark, d):
    listed = F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit(', ["x", "y"], "a", {"b": 1}, 2]'))
    e = Tables(spark, d).events.withColumn("listed", listed)
    return e.select("event_id", *rel.flat_record(F.col("props"), {"k": "$.k", "title": "$.article.title"}, {"context": "$.context"}), tx.plain_elements(F.col("listed")).alias("plain"), F.lit("file").alias("origin"), tx.stamp(F.col("ts")).alias("at"), F.replace(F.concat(F.lit("PMC"), F.col("event_id").cast("string")), F.lit("PMC"), F.lit("")).cast("int").alias("n"))


@query("""select p_partkey, 'b. ' || p_name || ', ' || p_brand as joined, case when p_partkey % 3 = 0 then null else p_name end as only, p_name as answer, '{"role":"user","content":"' || p_name || '\\n' || p_brand || '"}' as prompt, {'a': p_name}::json::varchar as quoted, '(' || p_name || ')' as rest, p_partkey % 2 = 0 as cont, p_name as number_gone, 'x.tar' as base from part""")
def text_forms(spark, d):
    n, k = F.col("p_name"), F.col("p_partkey")
    seg = lambda i, s: F.struct(F.lit(i).alias("start"), s.alias("text"))
    joined = tx.join_segments(F.array(seg(9, F.col("p_brand")), seg(1, F.lit("b.")), seg(5, F.lit(",")), seg(3, n)))
    thought = F.when(k % 3 == 0, F.concat(F.lit("a</think> b</think>"), n)).otherwise(F.concat(F.lit("<think>a</think> "), n))
    caption = F.concat(F.when(k % 2 == 0, "Figure 2. Cont. ").otherwise("Fig 2: Contour "), n)
    return Tables(spark, d).part.select(
        "p_partkey", joined.alias("joined"), tx.only_answer(thought).alias("only"), tx.after_thoughts(F.concat(F.lit("<think>a</think> "), n))["answer"].alias("answer"), tx.prompt(F.lit("user"), n, F.lit(None).cast("string"), F.col("p_brand")).alias("prompt"),
        F.to_json(F.from_json(tx.json_quotes(F.concat(F.lit("{'a': '"), n, F.lit("'}"))), "a string")).alias("quoted"), F.concat(F.lit("("), tx.without_number(F.concat(F.lit("Figure 3a. "), n)), F.lit(")")).alias("rest"), tx.is_continued(caption).alias("cont"), tx.without_number(F.concat(F.lit("Fig. 12) "), n)).alias("number_gone"), F.substring_index(F.lit("a/b/x.tar"), "/", -1).alias("base"),
    )


@query("""with t as (select p_partkey as k, p_name as n, ['?  yes', '! no', ', b', '; c', ': d', ') e', '] f', '} g', ' h', chr(10) || 'i', '(j)', '[k]', 'l'][(p_partkey % 13 + 1)::int] as second from part)
select k as p_partkey, case when k % 5 = 0 then '' else n end || case when k % 5 = 0 then second when k % 13 > 9 then ' ' || second else second end || case when k % 3 = 0 then '' else ' end' end as joined,
n || ' (x)' as bracket from t""")
def joined_segments(spark, d):
    """Null texts, each mark of punctuation, brackets, and segments that begin at one place."""
    k, n = F.col("p_partkey"), F.col("p_name")
    seg = lambda start, end, text: F.struct(F.lit(start).alias("start"), F.lit(end).alias("end"), text.cast("string").alias("text"))
    second = F.element_at(F.array(*map(F.lit, ["?  yes", "! no", ", b", "; c", ": d", ") e", "] f", "} g", " h", "\ni", "(j)", "[k]", "l"])), (k % 13 + 1).cast("int"))
    first, last = F.when(k % 5 != 0, n), F.when(k % 3 != 0, F.lit("end"))
    joined = tx.join_segments(F.array(seg(4, 9, last), seg(4, 8, F.lit(None)), seg(0, 3, second), seg(0, 2, first)))
    bracket = tx.join_segments(F.array(seg(0, 1, F.concat(n, F.when(k % 2 != 0, " ").otherwise(""))), seg(1, 2, F.lit("(x)"))))
    return Tables(spark, d).part.select("p_partkey", joined.alias("joined"), bracket.alias("bracket"))


@query("""select p_partkey, len(list_filter([p_name, p_brand], lambda x: len(regexp_replace(x, '[^a-zA-Z]', '', 'g')) <> 1)) = 0 as assignable, p_name in ('CC0') as commercial, length(p_name) as n,
'''' || p_name || ''', None' as attribution, coalesce(nullif(case when p_partkey % 2 = 0 then '' else p_name end, ''), 'None') as name, levenshtein(p_name, p_name || 'xyz') < greatest(5, ceil(length(replace(p_name, ' ', '')) * 0.05)) as alike, 'a' || p_size as key from part""")
def name_columns(spark, d):
    n = F.col("p_name")
    d_ = tx.caption_distance(n, F.concat(n, F.lit("xyz")))
    return Tables(spark, d).part.select("p_partkey", tx.assignable(F.array("p_name", "p_brand")).alias("assignable"), tx.commercial_use(n).alias("commercial"), F.char_length(n).cast("bigint").alias("n"), tx.attribution(n, F.lit(None).cast("string")).alias("attribution"), tx.panel_name(F.when(F.col("p_partkey") % 2 == 0, "").otherwise(n), n).alias("name"), tx.captions_alike(d_).alias("alike"), tx.parse_uuid(tx.figure_uuid(F.col("p_partkey"), F.concat(F.lit("a"), F.col("p_size").cast("string"))))["image_cluster_id"].alias("key"))


@query(B + """select id, round(x0 * 100 * 8 / 100, 6) as px0, round((x0 + 0.25) * 8, 6) as px1, round_even(round_even(x0 / 4 * 1000, 0) * 4 / 1000, 0) as back, round(x1, 6) as poly, round(y0, 6) as pts, (case when x0 * 8 < 1 then 3 when x0 * 8 < 2 then 5 when x0 * 8 < 3 then 8 else 9 end)::int as page, round(x0 * 8 - least(floor(x0 * 8), 3), 6) as local, round(sqrt(power(greatest(0, x0 - 0.2), 2) + power(greatest(0, y0 - 0.2), 2)), 6) as gap, round(x0 + (x1 - x0), 6) as cx1 from b""")
def box_forms(spark, d):
    b = F.col("box")
    x, y = b["x0"], b["y0"]
    four, corner = F.lit(4.0), lambda i, j: F.struct(i.alias("x"), j.alias("y"))
    px = bx.from_percent(x * 100, y, F.lit(25.0), F.lit(1.0), F.lit(8.0), F.lit(8.0))
    moved = bx.box(x * 8, y, x * 8 + 1, y + 1)
    page = bx.page_of(moved, F.array(F.lit(3), F.lit(5), F.lit(8), F.lit(9)), F.lit(4.0))
    points = bx.from_points(F.array(corner(b["x0"], b["y0"]), corner(b["x1"], b["y0"]), corner(b["x1"], b["y1"]), corner(b["x0"], b["y1"])))
    coco = bx.to_coco(b)
    r = lambda c, n: F.round(c, 6).alias(n)
    return Tables(spark, d).boxes().select(
        "id", r(px["x0"], "px0"), r(px["x1"], "px1"), bx.from_thousandths(bx.to_thousandths(b, four, four), four, four)["x0"].alias("back"), r(F.get(bx.polygon(bx.checked(b, four, four)), F.lit(2)), "poly"), r(points["y0"], "pts"),
        page["page"].alias("page"), r(page["x0"], "local"), r(bx.gap(b, bx.box(F.lit(-1.0), F.lit(-1.0), F.lit(0.2), F.lit(0.2))), "gap"), r(bx.from_coco(coco["x"], coco["y"], coco["w"], coco["h"])["x1"], "cx1"),
    )


@query("select o_custkey, list(o_orderkey order by o_totalprice desc, o_orderkey) as orders, arg_max(o_orderkey, struct_pack(a := o_totalprice, b := -o_orderkey)) as dearest, arg_min(o_orderkey, struct_pack(a := o_totalprice, b := o_orderkey)) as cheapest, count(distinct o_orderpriority) as kinds, list(o_orderkey order by o_totalprice desc, o_orderkey)[1:3] as first_three from orders group by 1")
def grouped_orders(spark, d):
    """Groups, their order, extremes, distinct values and first rows."""
    own = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("o_totalprice")).alias("p"), F.col("o_orderkey").alias("k")))), lambda x: x["k"])
    return Tables(spark, d).orders.groupBy("o_custkey").agg(own.alias("orders"), F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("dearest"), F.min_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("cheapest"), F.count_distinct("o_orderpriority").alias("kinds"), F.slice(own, 1, 3).alias("first_three"))


@query("select date_trunc('hour', ts) as at, event_type, count(*) as n from events group by 1, 2")
def windowed(spark, d):
    return windowed_counts(Tables(spark, d).events, "ts", "event_type").select(F.col("window.start").alias("at"), "event_type", "n")


@query("select 'left' as side, count(*) as n, count(distinct source) as k from documents where doc_id not in (select doc_id from labels) union all select 'right', count(*), count(distinct quality) from labels")
def counts(spark, d):
    t = Tables(spark, d)
    left = rel.pending(t.documents, t.labels, ["doc_id"]).agg(F.lit("left").alias("side"), F.count("*").alias("n"), F.count_distinct("source").alias("k"))
    return left.unionByName(t.labels.agg(F.lit("right").alias("side"), F.count("*").alias("n"), F.count_distinct("quality").alias("k")))


@query("""with h as (select vec_id, [case when embedding[i] > 0 then 1 else 0 end for i in range(1, 65)] as s from embeddings)
select q.vec_id as a, h.vec_id as b, list_sum(list_transform(range(1, 65), lambda i: abs(q.s[i] - h.s[i])))::int as distance from h q join h on q.vec_id <> h.vec_id where q.vec_id % 50 = 0 and list_sum(list_transform(range(1, 65), lambda i: abs(q.s[i] - h.s[i]))) <= 24""")
def hamming(spark, d):
    """The stated queries, vec_id divisible by 50, against all vectors, by the signs of all 64 components."""
    from panelmill.operators.spatial import hamming_search

    bit = lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))
    h = F.aggregate(F.transform("embedding", bit), F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))
    rows = Tables(spark, d).embeddings.select("vec_id", h.alias("h"))
    return hamming_search(rows.where("vec_id % 50 = 0"), rows, "vec_id", "h", 24)


_HASH = "case when event_id % 3 = 0 then 0 else ((event_id {div} 4) * 69069 + 12345) % 2147483648 end * 4294967296 + ((event_id {div} 4) * 1103515245 + 12345) % 2147483648"


@query(f"""with h as (select event_id as id, xor(({_HASH.format(div="//")})::bigint, (1::bigint << (event_id % 4 * 7)::int)) as h from events)
select a.id as a, b.id as b, bit_count(xor(a.h, b.h))::int as distance from h a join h b on a.id < b.id where bit_count(xor(a.h, b.h)) <= 3""")
def near_hashes(spark, d):
    """All pairs within 3 bits. A third of all rows has one upper half, so the bands there are hot and split."""
    from panelmill.operators.spatial import hamming_pairs

    h = F.expr(f"cast({_HASH.format(div='div')} as bigint)").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("event_id") % 4 * 7).cast("int")))
    return hamming_pairs(Tables(spark, d).events.select("event_id", h.alias("h")), "event_id", "h", 3, bands=4)


__all__ = ["near"]
