"""Queries of the stages around models, with models whose answers follow from their input."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.functions.hashes import hashed_images
from panelmill.operators.rebuild import build
from panelmill.plans.base import Tables, query
from panelmill.plans.run import Models, run
from panelmill.plans.stages import by_branch, caption_splits, detections, label_texts, refined, until_stable
from panelmill.sources.scratch import folder


def _detect():
    def model(row: dict) -> list[dict]:
        if row["fig"] % 11 == 5:
            raise ValueError("no picture")
        wide = row["fig"] % 15 + 1
        return [{"x0": 10.0 * i - 1, "y0": 0.0, "x1": 10.0 * i + wide, "y1": 10.0, "cls": max(i - 1, 0), "score": 0.9 - 0.1 * i} for i in range(4)]

    return model


@query("""with f as (select p_partkey as fig, p_partkey % 15 + 1 as w from part where p_partkey % 11 <> 5), b as (select fig, i + 1 as id, greatest(10 * i - 1, 0)::double as x0, least(10 * i + w, 35)::double as x1, greatest(i - 1, 0)::int as cls, round(0.9 - 0.1 * i, 6)::double as score from f, lateral unnest(range(4)) r(i)),
n as (select a.fig, c.id from b a join b c on a.fig = c.fig and a.id < c.id and a.cls = c.cls where greatest(least(a.x1, c.x1) - greatest(a.x0, c.x0), 0) > 0.3 * (greatest(a.x1, c.x1) - least(a.x0, c.x0)))
select b.fig, b.id, x0, x1, cls, score, (b.fig, b.id) not in (select fig, id from n) as survives_nms, null as error from b where x1 - x0 > 0.35
union all select p_partkey, 1, null, null, null, null, false, 'ValueError: no picture' from part where p_partkey % 11 = 5""")
def detected(spark, d):
    """Boxes of a model, clipped, numbered by score and suppressed; a figure that fails has its error."""
    figures = Tables(spark, d).part.select(F.col("p_partkey").alias("fig"), F.lit(35).alias("width"), F.lit(10).alias("height"), F.lit(b"").alias("content"))
    out = detections(figures, _detect, folder(spark, "detected"))
    return out.select("fig", "id", "x0", "x1", "cls", F.round("score", 6).alias("score"), "survives_nms", "error")


def _name():
    return lambda row: [{"answer": "None" if row["caption_id"] % 3 == 0 else "<think>two</think> A, B"}]


def _split():
    def model(row: dict) -> list[dict]:
        one, two = row["caption"].split(" ", 1)
        return [{"answer": "sorry" if row["caption_id"] % 7 == 6 else f'<think>x</think>{{"A": "{one}", "B": "{two}"' + "}" * (row["caption_id"] % 2)}]

    return model


@query("""with p as (select p_partkey as caption_id, p_name, split_part(p_name, ' ', 1) as a, split_part(p_name, ' ', 2) as b from part)
select caption_id, null as name, p_name as text, true as is_full, null as error from p
union all select caption_id, 'A', a, false, null from p where caption_id % 3 <> 0 and caption_id % 7 <> 6 union all select caption_id, 'B', b, false, null from p where caption_id % 3 <> 0 and caption_id % 7 <> 6
union all select caption_id, null, null, false, 'no JSON object of parts' from p where caption_id % 3 <> 0 and caption_id % 7 = 6""")
def captions_split(spark, d):
    """Names first, then parts; a missing brace is repaired; what is no JSON is an error."""
    captions = Tables(spark, d).part.select(F.col("p_partkey").alias("caption_id"), F.col("p_name").alias("caption"))
    out = caption_splits(captions, _name, _split, folder(spark, "split"))
    return out.select("caption_id", F.col("sub_caption_name").alias("name"), F.col("sub_caption_text").alias("text"), F.col("is_full_caption").alias("is_full"), "error")


def _ocr():
    def model(row: dict) -> list[dict]:
        kind, n = row["content"].decode().split(" ")
        if kind == "label":
            return [] if int(n) % 4 == 0 else [{"text": f"t{n}", "confidence": 0.5}, {"text": "", "confidence": 1.0}]
        return [{"text": "P", "confidence": 0.9 if int(n) % 2 else 0.7}, {"text": "Q", "confidence": 0.85}]

    return model


@query("""select vec_id as label_id, case when vec_id % 4 <> 0 then 't' || vec_id when label % 2 = 1 then 'P' else 'Q' end as text, case when vec_id % 4 <> 0 then 0.5 when label % 2 = 1 then 0.9 else 0.85 end::double as confidence, case when vec_id % 4 <> 0 then 'label' else 'panel' end as source from embeddings""")
def texts_read(spark, d):
    """A label without a text of its own takes the surest of its panel."""
    e = Tables(spark, d).embeddings
    content = lambda kind, c: F.concat(F.lit(f"{kind} "), F.col(c).cast("string")).cast("binary").alias("content")
    labels = e.select(F.col("vec_id").alias("label_id"), F.col("label").alias("panel_id"), content("label", "vec_id"))
    panels = e.select(F.col("label").alias("panel_id")).distinct().select("panel_id", content("panel", "panel_id"))
    return label_texts(labels, panels, _ocr, folder(spark, "ocr"))


def _ask():
    return lambda row: [{"answer": "same" if row["o_orderkey"] % 4 == 0 else f"{row['o_orderkey']}-{row['poll']}"}]


def _judge():
    return lambda row: [{"answer": sorted(row["options"])[-1] if row["o_orderkey"] % 4 < 3 else "made up"}]


@query("""select o_orderkey, case o_orderkey % 4 when 0 then 'same' when 3 then null else o_orderkey || '-3' end as answer, o_orderkey % 4 <> 0 as used_adjudication, case when o_orderkey % 4 = 3 then 'answer outside the options' end as reason from orders where o_orderkey % 5 = 0""")
def refined_answers(spark, d):
    """Three polls; where they differ an adjudicator chooses among their answers."""
    return refined(Tables(spark, d).orders.where("o_orderkey % 5 = 0").select("o_orderkey"), _ask, _judge, ["o_orderkey"], folder(spark, "polls"))


@query("select o_orderkey, case when o_orderkey % 5 < 3 then o_orderkey % 5 end as round from orders")
def stable_rounds(spark, d):
    """Three rounds: each settles what it can, the rest stays open."""
    done = []

    def step(df):
        done.append(0)
        return df.withColumn("round", F.when(F.col("o_orderkey") % 5 == len(done) - 1, F.col("o_orderkey") % 5))

    o = Tables(spark, d).orders.select("o_orderkey", F.lit(None).cast("bigint").alias("round"))
    return until_stable(o, F.col("round").isNull(), step, ["o_orderkey"], folder(spark, "rounds"))


@query("select conv_id, turn, case when role = 'user' then 'asks' when turn > 3 then 'late' else 'rest' end as branch from conversations")
def branches(spark, d):
    mark = lambda name: lambda df: df.select("conv_id", "turn", F.lit(name).alias("branch"))
    return by_branch(Tables(spark, d).conversations, [(F.col("role") == "user", mark("asks")), (F.col("turn") > 3, mark("late")), (F.lit(True), mark("rest"))])


@query("select vec_id, true as same, true as d_is_up from embeddings where vec_id % 2 = 0")
def picture_hashes(spark, d):
    """A brighter copy has the same hashes; where each row's pixels rise all differences are up."""
    e = Tables(spark, d).embeddings.where("vec_id % 2 = 0")
    pixel = lambda extra: F.transform(F.sequence(F.lit(0), F.lit(16 * 12 - 1)), lambda i: (i % 16 * 3 + (i * (F.col("vec_id") % 5 + 1)) % 2 + extra).cast("int"))
    image = lambda extra: hashed_images(e.select("vec_id", pixel(extra).alias("pixels"), F.lit(16).alias("width"), F.lit(12).alias("height")), "vec_id")
    both = image(0).join(image(40).withColumnRenamed("hashes", "other"), "vec_id")
    return both.select("vec_id", ((F.col("hashes.a") == F.col("other.a")) & (F.col("hashes.p") == F.col("other.p")) & (F.col("hashes.d") == F.col("other.d")) & (F.col("hashes.w") == F.col("other.w"))).alias("same"), (F.col("hashes.d") == -1).alias("d_is_up"))


def _two_panels():
    def model(row: dict) -> list[dict]:
        def box(x0, x1, y0, y1, cls, score):
            return {"x0": float(x0), "x1": float(x1), "y0": float(y0), "y1": float(y1), "cls": cls, "score": score}

        kind = 5 if row["fig"] % 5 == 4 else 2
        return [box(0, 50, 0, 50, 0, 0.9), box(50, 100, 0, 50, 0, 0.8), box(2, 8, 2, 8, 1, 0.7), box(52, 58, 2, 8, 1, 0.6), box(10, 48, 10, 48, kind, 0.5), box(60, 98, 10, 48, 3 if kind == 2 else 5, 0.4)]

    return model


def _names_two():
    return lambda row: [{"answer": "None" if row["caption_id"] % 3 == 0 else "A, B"}]


def _read():
    return lambda row: [{"text": "A" if row["box"]["x0"] < 50 else "B", "confidence": 0.95}] if row["box"]["x1"] - row["box"]["x0"] < 10 else []


def example_models() -> Models:
    """Models that find two panels in every figure."""
    return Models(_two_panels, _names_two, _split, _read)


@query("""with every as (select p_partkey as fig, p_name, p_partkey % 5 <> 4 as relevant, p_partkey % 3 <> 0 as several, p_partkey % 7 = 6 as unread from part),
f as (select fig, p_name from every where relevant and not (several and unread))
select 'p_' || (fig * 1000000 + 1) as panel_id, fig + 5 as article_id, case when fig % 3 = 0 then 'None' else 'A' end as panel_name, case when fig % 3 = 0 then p_name else split_part(p_name, ' ', 1) end as subcaption_text, true as contains_cfp, false as contains_oct, 'CC0' as license from f
union all select 'p_' || (fig * 1000000 + 2), fig + 5, 'B', split_part(p_name, ' ', 2), false, true, 'CC0' from f where fig % 3 <> 0""")
def whole_run(spark, d):
    """From figures to panel rows: detection, captions, texts, assembly. Figures of no relevant kind, and those whose
    caption could not be split, give no rows."""
    part = Tables(spark, d).part
    k = F.col("p_partkey")
    figures = part.select(k.alias("fig"), (k + 5).alias("article_id"), F.lit("c").alias("image_cluster_id"), F.lit(100).alias("width"), F.lit(100).alias("height"), F.lit(b"x").alias("content"), F.col("p_name").alias("caption"))
    articles = part.select((k + 5).alias("article_id"), F.lit("c").alias("image_cluster_id"), F.lit("t").alias("title"), F.lit("c").alias("citation"), F.lit("CC0").alias("license"), F.array(F.lit("x")).alias("context"))
    out = run(spark, figures, articles, example_models(), folder(spark, "run"))
    return out.select("panel_id", "article_id", "panel_name", "subcaption_text", "contains_cfp", "contains_oct", "license")


@query("""select p_partkey, case when p_partkey % 10 = 2 then p_size + 1 else p_size end as size, case when p_partkey % 10 in (0, 2) then 2 else 1 end as build from part where p_partkey % 10 <> 1
union all select -1, count(*) filter (p_partkey % 10 in (0, 2)), count(*) filter (p_partkey % 10 = 1) from part""")
def rebuilt_parts(spark, d):
    """Two builds: what was added or changed is of the second, what vanished is gone, the rest is of the first. The last row counts
    the keys that the second has redone and dropped."""
    part, at = Tables(spark, d).part.select("p_partkey", "p_size"), folder(spark, "rebuilt")
    make = lambda n: lambda rows: rows.select("p_partkey", F.col("p_size").alias("size"), F.lit(n).alias("build"))
    build(at, part.where("p_partkey % 10 <> 0"), ["p_partkey"], make(1))
    out, log = build(at, part.where("p_partkey % 10 <> 1").withColumn("p_size", F.when(F.col("p_partkey") % 10 == 2, F.col("p_size") + 1).otherwise(F.col("p_size"))), ["p_partkey"], make(2))
    return out.unionByName(spark.createDataFrame([(-1, log["redone"], log["gone"])], out.schema))
