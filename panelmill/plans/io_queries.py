"""Queries through sources and sinks: a table is written in a format and read back by its reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.functions import text as tx
from panelmill.plans.base import B, Tables, query
from panelmill.sources import readers, writers
from panelmill.sources.scratch import folder
from panelmill.streaming.incremental import process_new_files, process_pending


@query("select o_orderkey, o_totalprice from orders")
def parquet_batches(spark, d):
    at = folder(spark, "batches")
    writers.batches(Tables(spark, d).orders, at, 1000)
    writers.once(Tables(spark, d).orders.limit(0), at)  # does nothing, as the table is there
    return readers.table(spark, at, columns=["o_orderkey", "o_totalprice"])


@query("select 'a/' || c_name as file, c_mktsegment as citation, 'PMC' || c_custkey as accession_id, 'CC BY' as license from customer")
def csv_file_list(spark, d):
    at = folder(spark, "list")
    c = Tables(spark, d).customer
    c.select(F.concat(F.lit("a/"), "c_name").alias("File"), F.col("c_mktsegment").alias("Article Citation"), F.concat(F.lit("PMC"), F.col("c_custkey").cast("string")).alias("Accession ID"), F.lit("CC BY").alias("License"), F.lit("1").alias("PMID")).write.option("header", True).csv(at)
    return readers.file_list(spark, at)


@query("select user_id as key, arg_max(value, event_id) as value from events where event_id % 10 <> 0 group by 1")
def json_lines(spark, d):
    """Of each key the last line counts; lines that are cut off do not."""
    at = folder(spark, "lines")
    line = F.to_json(F.struct(F.col("user_id").alias("key"), F.col("event_id").alias("n"), "value"))
    Tables(spark, d).events.select(F.when(F.col("event_id") % 10 == 0, F.left(line, F.lit(9))).otherwise(line).alias("value")).write.text(at)
    return readers.lines_latest(spark, at, "key bigint, n bigint, value double", "key", F.desc("n")).select("key", "value")


@query(B + "select id, 'f' || fig || '.png' as file_name, 'class ' || cls as category, round(x0, 6) as x, round(x1 - x0, 6) as w from b")
def coco_files(spark, d):
    at = folder(spark, "coco")
    b = Tables(spark, d).boxes()
    images = b.select("fig").distinct().select(F.col("fig").alias("id"), F.concat(F.lit("f"), F.col("fig").cast("string"), F.lit(".png")).alias("file_name"), F.lit(4).alias("width"), F.lit(4).alias("height"))
    kinds = b.select("cls").distinct().select(F.col("cls").alias("id"), F.concat(F.lit("class "), F.col("cls").cast("string")).alias("name"))
    writers.coco_document(images, b.select("id", F.col("fig").alias("image_id"), F.col("cls").alias("category_id"), "box"), kinds, at)
    return readers.coco(spark, at).select("id", "file_name", "category", F.round(F.get("bbox", F.lit(0)), 6).alias("x"), F.round(F.get("bbox", F.lit(2)), 6).alias("w"))


@query(B + "select 'f' || fig as file_name, count(*)::int as n, round(arg_min((x0 + x1) / 2 / 4, id), 6) as cx from b group by 1")
def yolo_files(spark, d):
    at = folder(spark, "yolo")
    writers.yolo_text(Tables(spark, d).boxes().select(F.concat(F.lit("f"), F.col("fig").cast("string")).alias("file_name"), "id", F.col("cls").alias("category_id"), "box", F.lit(4).alias("width"), F.lit(4).alias("height")), at)
    lines = F.split("text", "\n")
    return spark.read.schema("file_name string, text string").json(at).select("file_name", F.size(lines).alias("n"), F.round(F.get(F.split(F.get(lines, F.lit(0)), " "), F.lit(1)).cast("double"), 6).alias("cx"))


@query("select r_regionkey::varchar as key, r_name as value from region")
def map_files(spark, d):
    at = folder(spark, "maps")
    Tables(spark, d).region.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(F.col("r_regionkey").cast("string"), "r_name"))).alias("m")).select(F.to_json("m").alias("value")).write.text(at)
    return readers.map_files(spark, at, "string")


@query("select p_partkey, json_object('name', p_name, 'size', null)::varchar as json from part")
def figure_files(spark, d):
    at = folder(spark, "figures")
    writers.figure_json(Tables(spark, d).part.select("p_partkey", F.col("p_name").alias("name"), F.lit(None).cast("int").alias("size")), "p_partkey", at)
    return spark.read.schema("p_partkey bigint, json string").json(at)


@query("select p_name as filename, n::int as n, (p_size + n)::double as x0, 1.0::double as y0, (p_size + n + 2)::double as x1, 3.0::double as y1 from part, (values (0), (2)) v(n)")
def clef_xml(spark, d):
    """The second object has three points and is left out."""
    at = folder(spark, "clef")
    point = lambda x, y: F.format_string('<point x="%s" y="%s"/>', x.cast("string"), F.lit(str(y)))
    corner = lambda n: [point(F.col("p_size") + n + dx, y) for dx, y in ((0, 1), (2, 1), (2, 3), (0, 3))]
    thing = lambda n, k: F.concat(F.lit("<object>"), *corner(n)[:k], F.lit("</object>"))
    one = F.concat(F.lit("<annotation><filename>"), "p_name", F.lit("</filename>"), thing(0, 4), thing(1, 3), thing(2, 4), F.lit("</annotation>"))
    files = Tables(spark, d).part.groupBy(F.floor(F.col("p_partkey") / 1000).alias("k")).agg(F.concat(F.lit("<annotations>"), F.array_join(F.collect_list(one), "\n"), F.lit("</annotations>")).alias("value"))
    files.write.partitionBy("k").text(at)
    return readers.image_clef(spark, at).select("filename", "n", "x0", "y0", "x1", "y1")


@query("select p_brand as name, p_name || '. ' || p_type as text from part")
def captions_tsv(spark, d):
    at = folder(spark, "tsv")
    Tables(spark, d).part.select(F.concat("p_brand", F.lit("\t"), "p_name", F.lit(" . "), "p_type").alias("value")).write.text(at)
    return readers.captions_tsv(spark, at)


@query("select 'a/' || p_partkey as file_name, p_size::double as panel_x0, p_name as panel_name, p_brand as label_name from part")
def panel_csv(spark, d):
    at = folder(spark, "panels")
    size = F.col("p_size").cast("double")
    Tables(spark, d).part.select(F.concat(F.lit("a\\"), F.col("p_partkey").cast("string")), *[size.alias(f"a{i}") for i in range(4)], "p_name", *[size.alias(f"b{i}") for i in range(4)], "p_brand").write.option("escape", "").csv(at)
    return readers.panel_csv(spark, at).select("file_name", "panel_x0", "panel_name", "label_name")


@query("select conv_id as id, turn::varchar as region, round(turn / 100 * 50, 6) as x0, round((turn + 10) / 100 * 50, 6) as x1, [role] as labels, turn % 3 = 0 as conflict from conversations where conv_id % 7 <> 3")
def task_files(spark, d):
    """Lists of at most 50 tasks in a file; a task that cannot be read does not take its file along."""
    at = folder(spark, "tasks")
    value = lambda **c: F.struct(*[v.alias(k) for k, v in c.items()])
    box = F.struct(F.col("turn").cast("string").alias("id"), F.lit("rectanglelabels").alias("type"), F.lit(50).alias("original_width"), F.lit(50).alias("original_height"), value(x=F.col("turn").cast("double"), y=F.lit(1.0), width=F.lit(10.0), height=F.lit(5.0), rectanglelabels=F.array("role"), text=F.array(F.lit("A"))).alias("value"))
    other = F.struct(F.col("turn").cast("string").alias("id"), F.lit("textarea").alias("type"), F.lit(50).alias("original_width"), F.lit(50).alias("original_height"), value(x=F.lit(None).cast("double"), y=F.lit(None).cast("double"), width=F.lit(None).cast("double"), height=F.lit(None).cast("double"), rectanglelabels=F.lit(None).cast("array<string>"), text=F.array(F.lit("B"))).alias("value"))
    regions = F.flatten(F.collect_list(F.when(F.col("turn") % 3 == 0, F.array(box, other)).otherwise(F.array(box))))
    task = Tables(spark, d).conversations.groupBy("conv_id").agg(regions.alias("result"))
    annotation = F.array(F.struct(F.lit(1).alias("id"), F.lit(False).alias("was_cancelled"), F.col("result")), F.struct(F.lit(2).alias("id"), F.lit(True).alias("was_cancelled"), F.col("result")))
    text = F.when(F.col("conv_id") % 7 == 3, F.lit('{"id": "none", "annotations": 5}')).otherwise(F.to_json(F.struct(F.col("conv_id").alias("id"), annotation.alias("annotations"))))
    lists = task.select(F.expr("conv_id div 50").alias("k"), text.alias("t")).groupBy("k").agg(F.concat(F.lit("["), F.array_join(F.collect_list("t"), ","), F.lit("]")).alias("value"))
    lists.write.partitionBy("k").text(at)
    out = readers.task_boxes(readers.tasks(spark, at))
    return out.select("id", "region", F.round("box.x0", 6).alias("x0"), F.round("box.x1", 6).alias("x1"), "labels", "conflict")


@query("""with s as (select coalesce(source, 'none') as split, count(*) - 1 as last from documents group by 1)
select split, k::int as package, lpad((k * 50)::varchar, 6, '0') as first, lpad(least(k * 50 + 49, last)::varchar, 6, '0') as last from s, lateral unnest(range(last // 50 + 1)) r(k)""")
def shard_names(spark, d):
    """Shards of one document each, in lots of 50, by source."""
    sizes = Tables(spark, d).documents.groupBy(F.coalesce("source", F.lit("none")).alias("split")).agg((F.count("*") - 1).cast("int").alias("last"))
    return readers.shard_names(spark, sizes)


@query("select p_partkey, case when p_name < 'b. ' || p_brand then p_name || ', ' || 'b. ' || p_brand else 'b. ' || p_brand || ', ' || p_name end as keywords from part")
def keyword_extract(spark, d):
    group = lambda *k: F.concat(F.lit("<kwd-group>"), *[F.concat(F.lit("<kwd>"), x, F.lit("</kwd>")) for x in k], F.lit("</kwd-group>"))
    xml = F.concat(F.lit("<article><kwd>no</kwd>"), group(F.concat(F.lit("b. "), "p_brand"), F.lit("")), group(F.col("p_name")), F.lit("</article>"))
    return Tables(spark, d).part.select("p_partkey", tx.keywords(xml).alias("keywords"))


@query("""select p_partkey, array_to_string(list_sort(list_filter([p_name || ' ', p_brand, case when p_partkey % 2 = 0 then 'plain' end], lambda x: x is not null)), ', ') as keywords from part""")
def keyword_markup(spark, d):
    """Markup inside keywords: the text before the first element counts; a keyword that begins with one has none."""
    n, b = F.col("p_name"), F.col("p_brand")
    last = F.when(F.col("p_partkey") % 2 == 0, "<kwd>plain</kwd><kwd/>").otherwise("<kwd><bold>all</bold> of it</kwd>")
    xml = F.concat(F.lit("<article><kwd-group><title>no</title><kwd>"), n, F.lit(" <italic>in vivo</italic> test</kwd></kwd-group><sub><kwd-group><kwd>"), b, F.lit("</kwd>"), last, F.lit("</kwd-group></sub></article>"))
    return Tables(spark, d).part.select("p_partkey", tx.keywords(xml).alias("keywords"))


@query("select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def pending_run(spark, d):
    """Only what is not done yet goes through the step and into the sink."""
    at, t = folder(spark, "pending"), Tables(spark, d)
    process_pending(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"], lambda df: df, at)
    return readers.table(spark, at, "doc_id bigint, lang string")


@query("select event_id, value * 2 as twice from events")
def stream_run(spark, d):
    """A file stream that runs twice: what came before is not read again."""
    source, sink, checkpoint, e = folder(spark, "in"), folder(spark, "out"), folder(spark, "at"), Tables(spark, d).events
    step = lambda df: df.select("event_id", (F.col("value") * 2).alias("twice"))
    for rest in (0, 1):
        e.where(F.col("event_id") % 2 == rest).write.mode("append").parquet(source)
        process_new_files(spark, source, "event_id bigint, value double", checkpoint, step, sink)
    return spark.read.parquet(sink).select("event_id", "twice")


@query("select 'v1' as model, 2 as runs")
def run_rows(spark, d):
    at = folder(spark, "runs")
    for _ in range(2):
        writers.run_metadata(Tables(spark, d).region, at, model="v1", prompt="p")
    return spark.read.parquet(at).where("created_at is not null").groupBy("model").agg(F.count("*").cast("int").alias("runs"))


@query("select doc_id::varchar as key, doc_id % 16 as shard, '.txt' as kind, coalesce(strlen(text), 0) as size, sha256(coalesce(text, '')) as hash from documents where doc_id in (select doc_id from labels where quality = 1)")
def wanted_texts(spark, d):
    """Texts written as archives, of which those of some keys are read back: the scan passes over the others."""
    from panelmill.sources.shards import shards, write_shards

    t, at = Tables(spark, d), folder(spark, "shards")
    rows = t.documents.select((F.col("doc_id") % 16).alias("shard"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"), F.col("text").cast("binary").alias("body"))
    write_shards(rows, at, "shard", "member", "body").write.format("noop").mode("overwrite").save()
    found = shards(spark, at, t.labels.where("quality = 1"), "doc_id")
    return found.select("key", F.regexp_extract("path", r"shard-(\d+)", 1).cast("bigint").alias("shard"), "kind", "size", F.sha2("content", 256).alias("hash"))
