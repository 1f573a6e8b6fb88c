"""Set, key and table operators: DataFrame in, DataFrame out, nothing collected."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pending(wanted: DataFrame, have: DataFrame, key: list[str]) -> DataFrame:
    """What is wanted and not there yet."""
    return wanted.join(have.select(*key).distinct(), key, "left_anti")


def strict_lookup(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """An inner join that fails if a key has no match, when rows are read."""
    out = left.join(right.withColumn("_found", F.lit(True)), key, "left")
    return out.where(F.coalesce("_found", F.raise_error(F.concat(F.lit(f"no {key} "), F.col(key).cast("string"))).cast("boolean"))).drop("_found")


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def overriding(first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """first, and what second has under other keys."""
    return first.unionByName(second.join(first.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def member_or(df: DataFrame, key: str, always: DataFrame, only_if: DataFrame, condition: Column) -> DataFrame:
    """Rows whose key is in always, or is in only_if while the condition holds."""
    a = always.select(F.col(key)).distinct().withColumn("_a", F.lit(True))
    b = only_if.select(F.col(key)).distinct().withColumn("_b", F.lit(True))
    return df.join(a, key, "left").join(b, key, "left").where(F.coalesce("_a", F.lit(False)) | (F.coalesce("_b", F.lit(False)) & condition)).drop("_a", "_b")


def once_each(df: DataFrame, key: str) -> DataFrame:
    """df; reading it fails if a key that is not null repeats."""
    many = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(F.col(key).alias("_k"))
    out = df.join(many, F.col(key) == F.col("_k"), "left")
    fails = F.raise_error(F.concat(F.lit(f"repeated {key} "), F.col("_k").cast("string"))).cast("boolean")
    return out.where(F.when(F.col("_k").isNull(), True).otherwise(fails)).drop("_k")


def outer_assembly(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Full outer joins of all parts on one key, each part as a struct under its name; a key that repeats within
    a part fails when rows are read."""
    out = None
    for name, df in parts.items():
        one = once_each(df, key).select(F.col(key), F.struct(*[c for c in df.columns if c != key]).alias(name))
        out = one if out is None else out.join(one, key, "full")
    return out


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).count().where("count > 1")


def numbered(df: DataFrame, order: str, name: str = "n", ranges: int = 64) -> DataFrame:
    """df with the place of each row by a numeric column, from 1, equal values in any order; nulls stand last.

    Rows are numbered within ranges of the column, which begin at its quantiles, and ranges by a sum over their sizes, so no
    task sorts the whole table. The quantiles are found when this is called.
    """
    shares = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(df.agg(F.percentile_approx(order, shares, 10_000)).first()[0] or []))
    at = sum(((F.col(order) >= b).cast("int") for b in bounds), F.lit(0))
    rows = df.withColumn("_range", F.coalesce(at, F.lit(len(bounds) + 1)))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(order).asc_nulls_last()))
    return rows.join(F.broadcast(starts), "_range").withColumn(name, (place + F.col("_start")).cast("bigint")).drop("_range", "_start")  # at most `ranges` + 1 rows are broadcast


def swap_split(train: DataFrame, test: DataFrame, to_test: DataFrame, to_train: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The split after the named keys changed sides."""
    a = train.join(to_test, key, "left_anti").unionByName(test.join(to_train, key, "left_semi"))
    b = test.join(to_train, key, "left_anti").unionByName(train.join(to_test, key, "left_semi"))
    return a, b


def split_by_key(df: DataFrame, key: str, share: float, order: Column | None = None) -> DataFrame:
    """in_train: rows of one key stay together; the first share of the keys, by a number (their hash), train."""
    keys = df.select(key).distinct().withColumn("_order", order if order is not None else F.xxhash64(key))
    n = keys.count()
    return df.join(numbered(keys, "_order", "_n").select(key, (F.col("_n") <= math.floor(n * share)).alias("in_train")), key)


def fold(key: Column, k: int = 5) -> Column:
    return F.pmod(key, F.lit(k))


def sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n rows, the same in every run: those of the least hashes of key and seed."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(seed))), key).limit(n)


def oversample(df: DataFrame, label: str) -> DataFrame:
    """Rows of each label repeated ceil(largest / size) times."""
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    sizes = sizes.withColumn("_times", F.ceil(F.max("_n").over(Window.partitionBy()) / F.col("_n")).cast("int")).drop("_n")
    return df.join(sizes, label).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"), (1 / F.count("*")).alias("weight"))


def confusion(df: DataFrame, truth: str, predicted: str, n: int) -> DataFrame:
    return df.groupBy(truth).pivot(predicted, list(range(n))).count().na.fill(0)


def scores(df: DataFrame, truth: Column, predicted: Column, tiny: float = 1e-8) -> DataFrame:
    """accuracy, precision, recall, f1 of booleans."""
    s = df.agg(F.avg((truth == predicted).cast("int")).alias("accuracy"), F.count_if(truth & predicted).alias("tp"), F.count_if(~truth & predicted).alias("fp"), F.count_if(truth & ~predicted).alias("fn"))
    s = s.withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp") + tiny)).withColumn("recall", F.col("tp") / (F.col("tp") + F.col("fn") + tiny))
    return s.select("accuracy", "precision", "recall", (2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + tiny)).alias("f1"))


def fill_ids(df: DataFrame, column: str, order: str) -> DataFrame:
    """Null ids become the smallest unused positive integers, in order."""
    n = df.where(F.col(column).isNull()).count()
    used = df.select(F.col(column).cast("bigint").alias("_id")).where("_id > 0").distinct()
    # the smallest n unused integers lie among the first n + (number of used ones)
    spark = df.sparkSession
    unused = spark.range(1, n + used.count() + 1).select(F.col("id").alias("_id")).join(used, "_id", "left_anti") if n else used.limit(0)
    gaps = numbered(df.where(F.col(column).isNull()), order, "_n")
    filled = gaps.join(numbered(unused, "_id", "_n"), "_n").withColumn(column, F.col("_id").cast(df.schema[column].dataType)).select(*df.columns)
    return df.where(F.col(column).isNotNull()).unionByName(filled)


def negative_ids(df: DataFrame, by: list[str], order: list[Column], name: str = "id") -> DataFrame:
    """-1, -2 and so on within each group, by order."""
    return df.withColumn(name, -F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def missing_from(wanted: DataFrame, have: DataFrame, key: list[str]) -> DataFrame:
    """Wanted keys that are not there."""
    return wanted.select(*key).distinct().join(have.select(*key).distinct(), key, "left_anti")


def all_there(wanted: DataFrame, have: DataFrame, key: list[str]) -> None:
    """Fails with the first keys that are missing, if any is."""
    gone = missing_from(wanted, have, key).orderBy(*key).limit(10).collect()
    if gone:
        raise ValueError(f"missing: {[tuple(r) for r in gone]}")


def is_subset(a: Column, b: Column) -> Column:
    """All elements of array a are in array b."""
    return F.size(F.array_except(a, b)) == 0


def survives_or_used(boxes: DataFrame, used: DataFrame, key: str, survives: Column) -> DataFrame:
    """Boxes that survive suppression or that another table names."""
    marks = used.select(key).distinct().withColumn("_used", F.lit(True))
    return boxes.join(marks, key, "left").where(F.coalesce(survives, F.lit(False)) | F.coalesce("_used", F.lit(False))).drop("_used")


def merged_meta(df: DataFrame, by: list[str], meta: str, order: str) -> DataFrame:
    """One map for each group, from each key to the list of its values by order."""
    pairs = df.select(*by, order, F.explode(meta).alias("key", "value"))
    lists = pairs.groupBy(*by, "key").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "value"))), lambda x: x["value"]).alias("values"))
    return lists.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "values")))).alias("meta"))


def with_ids(df: DataFrame, ids: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """df with the sorted ids that each key has, and whether it has none."""
    lists = ids.groupBy(*key).agg(F.array_sort(F.collect_list(id_col)).alias("ids"))
    return df.join(lists, key, "left").withColumn("missing", F.col("ids").isNull())


def bundles(figures: DataFrame, captions: DataFrame, predictions: DataFrame, key: str = "fig") -> DataFrame:
    """Figures that have a full caption and a part, with their captions and predictions as arrays.

    captions (key, id, is_full, text), predictions (key, id, kind, score).
    """
    parts = captions.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("id", "is_full", "text"))).alias("captions"), F.bool_or("is_full").alias("_full"), F.bool_or(~F.col("is_full")).alias("_part"))
    boxes = predictions.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("id", "kind", "score"))).alias("predictions"))
    return figures.join(parts.where("_full and _part").drop("_full", "_part"), key).join(boxes, key, "left")


def first_lookup(df: DataFrame, other: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """df with the first value (by order) that other has under its key; a row without one goes."""
    first = other.groupBy(*key).agg(F.min_by(value, order).alias(value))
    return df.join(first.where(F.col(value).isNotNull()), key)


def rollups(df: DataFrame, by: list[str], ok: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.bool_or(ok).alias("any_ok"), F.bool_and(ok).alias("all_ok"), F.count("*").alias("n"))


def agreement(votes: DataFrame, item: list[str], answer: str) -> DataFrame:
    """Whether all annotators of an item gave one answer, and that answer."""
    return votes.groupBy(*item).agg(F.count("*").alias("n_votes"), (F.count_distinct(F.coalesce(F.col(answer).cast("string"), F.lit("\x00"))) == 1).alias("agreed"), F.min(answer).alias("lowest"), F.max(answer).alias("highest"))


def violations(df: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """key and the names of the rules that a row breaks; a rule that is null is broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return df.select(*key, broken.alias("broken")).where(F.size("broken") > 0)


def coco_ids(boxes: DataFrame, image: str, box: str) -> DataFrame:
    """boxes with image_id, which numbers the images by a numeric column, and annotation_id, which numbers boxes."""
    images = numbered(boxes.select(image).distinct(), image, "image_id")
    return numbered(boxes, box, "annotation_id").join(images, image)


def captioned(regions: Column) -> Column:
    """Of an array of regions (name, text): some has a text, and at most one of those has no name."""
    own = F.filter(regions, lambda r: F.coalesce(r["text"] != "", F.lit(False)))
    return (F.size(own) > 0) & (F.size(F.filter(own, lambda r: r["name"].isNull())) <= 1)


def fully_captioned(regions: Column) -> Column:
    """Of an array of regions (relevant, name, text): some are relevant, all of those have a text and, if several, a name."""
    own, some = F.filter(regions, lambda r: r["relevant"]), lambda c: F.coalesce(c != "", F.lit(False))
    return (F.size(own) > 0) & F.forall(own, lambda r: some(r["text"])) & ((F.size(own) == 1) | F.forall(own, lambda r: some(r["name"])))


def image_level(regions: Column) -> Column:
    """Of an array of regions (relevant, kind): a relevant one is an image or of no kind."""
    return F.exists(regions, lambda r: r["relevant"] & (r["kind"].isNull() | (r["kind"] == "Image")))


def is_final(relevance: Column, flawed: Column, caption: Column) -> Column:
    """A panel that needs no more work: not relevant, or with a caption and without a flaw."""
    return ~relevance | (~flawed & caption.isNotNull())


def labelling_rows(df: DataFrame) -> DataFrame:
    """The rows that annotators get. df: article_id, image_cluster_id, caption, title, citation, keywords (array), n, type."""
    path = F.concat(F.lit("/label-studio/images/"), F.col("article_id").cast("string"), F.lit("_"), "image_cluster_id", F.lit(".jpg"))
    return df.select(
        path.alias("image_path"), "caption", F.concat(F.coalesce("title", F.lit("None")), F.lit(" ("), F.coalesce("citation", F.lit("None")), F.lit(")")).alias("citation"), "article_id",
        F.col("n").alias("row"), F.array_join(F.array_sort(F.array_compact("keywords")), ", ").alias("keywords"), "image_cluster_id", F.coalesce("type", F.lit("base")).alias("origin"),
    )


def flat_record(record: Column, fields: dict[str, str], lists: dict[str, str]) -> list[Column]:
    """Columns of a JSON text: fields by path, and for each name in lists the JSON list there, [] if it is absent."""
    at = lambda path: F.get_json_object(record, path)
    return [at(p).alias(n) for n, p in fields.items()] + [F.coalesce(at(p), F.lit("[]")).alias(n) for n, p in lists.items()]


def worked_out(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns (in place of those of the same names), each worked out once for each row: filters and steps that follow
    read the values. withColumns leaves it to the optimizer, which may copy an expression into each place that names it."""
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def lots(*tables: DataFrame, rows: int = 250_000) -> int:
    """The number of partitions that leaves about `rows` rows of the largest of tables to each, but no fewer than Spark's own."""
    own = int(tables[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(own, *[-(-t.count() // rows) for t in tables])
