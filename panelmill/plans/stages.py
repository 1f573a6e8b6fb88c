"""Stages around models: the caller gives a loader of the model, the stage does the rest in Spark.

A loader takes nothing and returns a function from one row (a dict) to a list of result rows (dicts); or, marked with batched, one
from a list of rows to a list of such lists, in which an exception may stand for a row that failed. It runs
once in each task. Models are slow and their answers differ between calls, so a stage that reads answers twice
writes them under path first (a folder that all executors share) and reads that table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType

from panelmill.functions.boxes import box, clip, hamming
from panelmill.functions.text import after_thoughts, caption_distance, captions_alike, is_continued, repair_json, without_number, without_space
from panelmill.operators.nms import split_nms
from panelmill.operators.relational import upsert, worked_out

Loader = Callable[[], Callable[[dict], list[dict]]]
#: Rows that a model gets in one call.
AT_ONCE = 64


def batched(model: Callable[[list[dict]], list]) -> Callable[[list[dict]], list]:
    """Marks a model that takes a list of rows."""
    model.batched = True
    return model


def _calls(model: Callable, rows: list[dict], at_once: int) -> list:
    """What the model gives for each row: a list of result rows, or the exception that it raised."""

    def alone(row: dict):
        try:
            return model(row)
        except Exception as e:  # a model's own failure is a result of that row
            return e

    if not getattr(model, "batched", False):
        return [alone(dict(r)) for r in rows]
    out: list = []
    for low in range(0, len(rows), at_once):
        part = rows[low : low + at_once]
        try:
            found = list(model([dict(r) for r in part]))
            if len(found) != len(part):
                raise ValueError(f"{len(found)} results for {len(part)} rows")
        except Exception as e:  # the call failed as a whole
            found = [e] * len(part)
        out += found
    return out


def spread_out(df: DataFrame) -> DataFrame:
    """df over all cores, if its files are fewer."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df._jdf.inputFiles()) < cores else df


def applied(df: DataFrame, load: Loader, key: list[str], result: str, tries: int = 3, wait: float = 0.5, again: tuple[type[Exception], ...] = (Exception,), at_once: int = AT_ONCE) -> DataFrame:
    """key, the columns of result and error: what the model returns for each row of df.

    Rows that fail with one of the errors named in again are tried again, all those of a batch together: one wait, then one call
    for each at_once of them, up to tries times in all, each wait twice the one before. A row that fails for good gives one
    row of nulls with the last error; a row for which the model returns nothing gives none. Results leave batch by batch.
    """
    fields = StructType.fromDDL(result)
    schema = StructType([df.schema[k] for k in key] + fields.fields).add("error", StringType())
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            rows = batch.to_pylist()
            found = _calls(model, rows, at_once)
            for n in range(1, tries):
                failed = [i for i, x in enumerate(found) if isinstance(x, again)]
                if not failed:
                    break
                time.sleep(wait * 2 ** (n - 1))
                for i, x in zip(failed, _calls(model, [rows[i] for i in failed], at_once), strict=True):
                    found[i] = x
            out = []
            for row, x in zip(rows, found, strict=True):
                error = f"{type(x).__name__}: {x}" if isinstance(x, Exception) else None
                out += [{k: row[k] for k in key} | {f.name: r.get(f.name) for f in fields} | {"error": error} for r in ([{}] if error else x)]
            if out:
                yield from pa.Table.from_pylist(out, schema=arrow).to_batches()

    return spread_out(df).mapInArrow(run, schema)


def stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def detections(figures: DataFrame, load: Loader, path: str, limit: float = 0.3, again: tuple[type[Exception], ...] = (OSError,)) -> DataFrame:
    """figures (fig, width, height, content) to boxes: fig, id, x0, y0, x1, y1, cls, score, survives_nms, error.

    The model returns x0, y0, x1, y1, cls, score of each box; boxes are clipped to the figure, those that lie
    outside go, and ids number a figure's boxes by falling score. Errors named in again (by default those of reading and of
    connections) are tried again; a picture that cannot be read stays so.
    """
    found = stored(applied(figures, load, ["fig", "width", "height"], "x0 double, y0 double, x1 double, y1 double, cls int, score double", again=again), path)
    inside = clip(box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")), F.col("width"), F.col("height"))
    found = found.withColumn("box", inside).where("box is not null or error is not null")
    order = Window.partitionBy("fig").orderBy(F.col("score").desc_nulls_last(), "box", "cls")
    boxes = found.select("fig", F.row_number().over(order).cast("bigint").alias("id"), "box.*", "cls", "score", "error")
    kept = split_nms(boxes.where("error is null"), limit=limit).withColumn("_kept", F.lit(True))
    return boxes.join(kept, ["fig", "id"], "left").withColumn("survives_nms", F.coalesce("_kept", F.lit(False))).drop("_kept")


def caption_splits(captions: DataFrame, name: Loader, split: Loader, path: str, key: str = "caption_id") -> DataFrame:
    """captions (key, caption) to key, sub_caption_name, sub_caption_text, is_full_caption, error.

    The first model answers with the names of the parts (text None or empty: there are none), the second, which
    also gets names, with a JSON object from name to text. Each caption has a full row; one with parts, a row for each.
    """
    names = stored(applied(captions.select(key, "caption"), name, [key, "caption"], "answer string"), f"{path}/names")
    names = worked_out(names, {"names": after_thoughts(F.col("answer"))["answer"]}).select(key, "caption", "names", F.col("error").alias("name_error"))
    several = names.where("name_error is null and names is not null and names not in ('', 'None')")
    answers = stored(applied(several.select(key, "caption", "names"), split, [key], "answer string"), f"{path}/parts")
    answers = worked_out(answers, {"answer": after_thoughts(F.col("answer"))["answer"]})  # each step reads its text often
    answers = worked_out(answers, {"answer": repair_json(F.col("answer"))})
    answers = worked_out(answers, {"parts": F.from_json("answer", "map<string,string>")}).withColumn("error", F.coalesce("error", F.when(F.col("parts").isNull() | (F.size("parts") == 0), F.lit("no JSON object of parts"))))
    sub = answers.select(key, F.explode_outer("parts").alias("sub_caption_name", "sub_caption_text"), F.lit(False).alias("is_full_caption"), "error").where("sub_caption_name is not null or error is not null")
    whole = names.select(key, F.lit(None).cast("string").alias("sub_caption_name"), F.col("caption").alias("sub_caption_text"), F.lit(True).alias("is_full_caption"), F.col("name_error").alias("error"))
    return whole.unionByName(sub)


def label_texts(labels: DataFrame, panels: DataFrame, ocr: Loader, path: str, least: float = 0.8) -> DataFrame:
    """labels (label_id, panel_id, content) and panels (panel_id, content) to label_id, text, confidence, source.

    A label whose own crop gives no text takes the surest text of its panel's crop, if that is sure enough.
    """
    shape = "text string, confidence double"
    best = lambda df, key: df.where("error is null and trim(text) <> ''").groupBy(key).agg(F.max_by(F.struct("text", "confidence"), F.struct("confidence", "text")).alias("best"))
    own = best(stored(applied(labels.select("label_id", "content"), ocr, ["label_id"], shape), f"{path}/labels"), "label_id")
    left = labels.select("label_id", "panel_id").join(own, "label_id", "left_anti")
    crops = panels.select("panel_id", "content").join(left, "panel_id", "left_semi")
    around = best(stored(applied(crops, ocr, ["panel_id"], shape), f"{path}/panels").where(F.col("confidence") >= least), "panel_id")
    out = own.withColumn("source", F.lit("label")).unionByName(left.join(around, "panel_id").select("label_id", "best", F.lit("panel").alias("source")))
    return labels.select("label_id").join(out, "label_id", "left").select("label_id", "best.text", "best.confidence", "source")


def likeness(image: Column, figure: Column) -> list[Column]:
    """Three tests of an image (struct with caption, aspect) against a figure (with far besides): they look alike, have one
    caption or the figure's says that it continues another, and have one aspect ratio."""
    text = without_number(figure["caption"])
    captions = is_continued(figure["caption"]) | captions_alike(caption_distance(image["caption"], text), F.char_length(without_space(text)))
    visual = F.exists(figure["far"], lambda x: x <= 2) | (F.aggregate(figure["far"], F.lit(0), lambda a, x: a + x) <= 5)
    return [visual, captions, F.abs((image["aspect"] - figure["aspect"]) / image["aspect"]) < 0.05]


def matched_images(images: DataFrame, extracted: DataFrame, tests: dict[str, int], least: int = 2, holds: Callable[[Column, Column], list[Column]] | None = None) -> DataFrame:
    """images (article, image_id, number, hashes) and extracted (article, figure_id, number, hashes) to article, image_id,
    figure_id, reason. hashes are structs of 64-bit hashes; tests give the largest distance of each. holds makes
    further tests from an image's row and a figure's (structs; the figure's has the distances of all hashes as the array `far`).

    Equal numbers are a test as well. A figure stands for an image if at least `least` tests hold and, where the image has a
    number, either more do or the numbers agree; the one with the smallest sum of distances is taken, then the
    smallest id. tests = {} with holds = likeness are the four tests of the survey's similarity join.
    """
    near = scored_images(images, extracted, tests, least, holds).where("relevant")
    best = near.groupBy("article", "image_id").agg(F.min_by("figure_id", F.struct("far", "figure_id")).alias("figure_id"))
    has = extracted.select("article").distinct().withColumn("_has", F.lit(True))
    reason = F.when(F.col("figure_id").isNotNull(), None).when(F.col("_has").isNull(), "nothing extracted").otherwise("no figure is near")
    return images.select("article", "image_id").join(best, ["article", "image_id"], "left").join(has, "article", "left").select("article", "image_id", "figure_id", reason.alias("reason"))


def scored_images(images: DataFrame, extracted: DataFrame, tests: dict[str, int], least: int = 2, holds: Callable[[Column, Column], list[Column]] | None = None) -> DataFrame:
    """article, image_id, figure_id, far (the sum of distances), passed, near (enough tests hold) and relevant (and the number's
    rule holds) of all images and figures of one article."""
    names = list(tests) or images.select("hashes.*").columns
    far = lambda n: hamming(F.col("_image.hashes")[n], F.col("_figure.hashes")[n])
    figures = extracted.select("article", F.struct(*[c for c in extracted.columns if c != "article"]).alias("_figure"))
    pairs = images.select("article", "image_id", F.struct(*[c for c in images.columns if c != "article"]).alias("_image")).join(figures, "article")
    pairs = pairs.withColumn("_figure", F.col("_figure").withField("far", F.array(*[F.coalesce(far(n), F.lit(64)).cast("int") for n in names])))
    same = F.coalesce(F.col("_image.number") == F.col("_figure.number"), F.lit(False))
    passed = [same, *[far(n) <= most for n, most in tests.items()], *(holds(F.col("_image"), F.col("_figure")) if holds else [])]
    pairs = pairs.withColumn("passed", sum((F.coalesce(p, F.lit(False)).cast("int") for p in passed), F.lit(0))).withColumn("near", F.col("passed") >= least)
    relevant = F.col("near") & (F.col("_image.number").isNull() | same | (F.col("passed") > least))
    return pairs.select("article", "image_id", F.col("_figure.figure_id").alias("figure_id"), F.aggregate("_figure.far", F.lit(0), lambda a, x: a + x).alias("far"), "passed", "near", relevant.alias("relevant"))


def extraction(images: DataFrame, packages: DataFrame, members: DataFrame, extracted: DataFrame, tests: dict[str, int], holds: Callable[[Column, Column], list[Column]] | None = None) -> DataFrame:
    """article, image_id, kind, figure_id, reason: what stands for each image. One row for each figure that does (kind figure), one
    for an image that is taken as it is (image) or for which there is none (error).

    images as in matched_images, with sub (its part of a figure, null for a whole one); packages (article, error, has_pdf, has_xml);
    members (article, image_id): the images that packages hold. An article without PDF or XML gives its images as they are.
    An image that is part of a figure takes the nearest of several figures, others take all (a figure on several pages).
    """
    here = members.select("article", "image_id").distinct().withColumn("here", F.lit(True))
    some = extracted.select("article").distinct().withColumn("some", F.lit(True))
    rows = images.select("article", "image_id", "sub").join(packages.withColumn("package", F.lit(True)), "article", "left").join(here, ["article", "image_id"], "left").join(some, "article", "left")
    short = rows.where("here is null").select("article").distinct().withColumn("short", F.lit(True))
    rows = rows.join(short, "article", "left")
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    direct = no("has_pdf") | no("has_xml")
    early = (
        F.when(no("package"), "article not found").when(F.col("error").isNotNull(), F.col("error")).when(direct & no("here"), "image is not in its package")
        .when(~direct & no("some"), "no figures found").when(~direct & F.col("short"), "an image of the article is not in its package")
    )
    rows = rows.withColumn("reason", early).withColumn("direct", F.col("reason").isNull() & direct)
    open_rows = rows.where("reason is null and not direct").select("article", "image_id", "sub")
    scored = scored_images(images.drop("sub").join(open_rows.select("article", "image_id"), ["article", "image_id"], "left_semi"), extracted, tests, 2, holds).where("near")
    order = Window.partitionBy("article", "image_id").orderBy("far", "figure_id")
    fits = scored.where("relevant").withColumn("n", F.row_number().over(order)).join(open_rows, ["article", "image_id"]).where("sub is null or n = 1")
    nothing = F.lit(None).cast(dict(extracted.dtypes)["figure_id"])
    out = fits.select("article", "image_id", F.lit("figure").alias("kind"), "figure_id", F.lit(None).cast("string").alias("reason"))
    out = out.unionByName(rows.where("direct").select("article", "image_id", F.lit("image").alias("kind"), nothing.alias("figure_id"), F.lit(None).cast("string").alias("reason")))
    left = open_rows.join(fits.select("article", "image_id").distinct(), ["article", "image_id"], "left_anti").join(scored.select("article", "image_id").distinct().withColumn("close", F.lit(True)), ["article", "image_id"], "left")
    late = left.select("article", "image_id", F.when(F.col("close"), "no figure with its number").otherwise("no relevant figure").alias("reason"))
    errors = rows.where("reason is not null").select("article", "image_id", "reason").unionByName(late)
    return out.unionByName(errors.select("article", "image_id", F.lit("error").alias("kind"), nothing.alias("figure_id"), "reason"))


def polled(items: DataFrame, ask: Loader, key: list[str], n: int = 3) -> DataFrame:
    """key, poll, answer and error: n independent answers for each item."""
    return applied(items.withColumn("poll", F.explode(F.sequence(F.lit(1), F.lit(n)))), ask, [*key, "poll"], "answer string")


def decided(answers: DataFrame, key: list[str]) -> DataFrame:
    """key, answer (null unless all polls that did not fail gave it), agreed, options and n_failed."""
    votes = F.array_sort(F.collect_set("answer"))
    out = answers.groupBy(*key).agg(votes.alias("options"), F.count_if(F.col("answer").isNull()).alias("n_failed"))
    agreed = F.size("options") == 1
    return out.select(*key, F.when(agreed, F.get("options", F.lit(0))).alias("answer"), agreed.alias("agreed"), "options", "n_failed")


def refined(items: DataFrame, ask: Loader, adjudicate: Loader, key: list[str], path: str, n: int = 3) -> DataFrame:
    """key, answer, used_adjudication, reason: what the polls agree on; where they do not, the adjudicator chooses.

    The polls are written to path first. The adjudicator gets the item and options. An item without an answer keeps its row, with
    a null answer and the reason: no poll answered, the adjudicator failed, or it answered outside the options.
    """
    votes = decided(stored(polled(items, ask, key, n), f"{path}/polls"), key)
    open_items = items.join(votes.where("not agreed and size(options) > 0").select(*key, "options"), key)
    chosen = stored(applied(open_items, adjudicate, [*key, "options"], "answer string"), f"{path}/choices")
    fits = F.coalesce(F.array_contains("options", F.col("answer")), F.lit(False))
    chosen = chosen.groupBy(*key).agg(F.min_by(F.when(fits, F.col("answer")), F.struct(~fits, "answer")).alias("answer"), F.bool_or(fits).alias("fits"), F.max("error").alias("error"))
    said = votes.join(chosen.select(*key, F.col("answer").alias("choice"), "fits", "error"), key, "left")
    agreed, none = F.col("agreed"), F.size("options") == 0
    reason = F.when(agreed | F.col("fits"), None).when(none, "no poll answered").otherwise(F.coalesce("error", F.lit("answer outside the options")))
    return said.select(*key, F.when(agreed, F.col("answer")).otherwise(F.col("choice")).alias("answer"), (~agreed & ~none).alias("used_adjudication"), reason.alias("reason"))


def until_stable(state: DataFrame, is_open: Column, step: Callable[[DataFrame], DataFrame], key: list[str], path: str, rounds: int = 3) -> DataFrame:
    """state after at most `rounds` times of step on the rows that are still open; each round is a table under path."""
    for n in range(rounds):
        todo = state.where(is_open)
        if todo.isEmpty():
            break
        state = stored(upsert(state, stored(step(todo), f"{path}/step-{n}"), key), f"{path}/round-{n}")
    return state


def by_branch(df: DataFrame, branches: list[tuple[Column, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """The union of what each branch makes of its rows; a row goes to the first branch whose condition holds."""
    which = F.lit(None).cast("int")
    for n, (condition, _) in reversed(list(enumerate(branches))):
        which = F.when(condition, n).otherwise(which)
    marked, out = df.withColumn("_branch", which), None
    for n, (_, make) in enumerate(branches):
        part = make(marked.where(F.col("_branch") == n).drop("_branch"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
