"""Tables that are rebuilt where their inputs changed.

Each key's inputs and the step's settings have a fingerprint. A build redoes the keys whose fingerprint is new, drops those that
vanished and leaves the rest as it is. Rows lie in buckets by a hash of the key; only buckets with a changed key are written
anew, under the build's number. A manifest, written last, says for each bucket which build holds it: a build that was cut off leaves
the one before in force.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def fingerprints(inputs: DataFrame, key: list[str], settings: str = "") -> DataFrame:
    """key and print: one for all rows of a key, whatever their order; nulls, types and names of columns count."""
    columns = sorted(c for c in inputs.columns if c not in key)
    row = F.sha2(F.concat_ws("\\x1f", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.base64(F.col(c)) if kind == "binary" else F.to_json(F.struct(F.col(c))), F.lit("null"))) for c, kind in inputs.select(*columns).dtypes], F.lit(settings)), 256)
    return inputs.groupBy(*key).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(row)), ","), 256).alias("print"))


def _files(spark: SparkSession, at: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The last manifest: build, settings, buckets (bucket to build), redone, gone, kept and the rows' schema."""
    files, at = _files(spark, f"{path}/manifest")
    if not files.exists(at):
        return None
    done = [s.getPath().getName() for s in files.listStatus(at) if files.exists(_files(spark, f"{path}/manifest/{s.getPath().getName()}/_SUCCESS")[1])]
    last = max((int(n.removeprefix("build=")) for n in done), default=None)
    return None if last is None else json.loads(spark.read.text(f"{path}/manifest/build={last}").first()[0])


def current(spark: SparkSession, path: str, what: str = "rows") -> DataFrame | None:
    """The rows (or prints) in force."""
    m = manifest(spark, path)
    if m is None:
        return None
    paths = [f"{path}/{what}/build={n}/_bucket={b}" for b, n in m["buckets"].items()]
    paths = [p for p in paths if (lambda f: f[0].exists(f[1]))(_files(spark, p))]
    empty = spark.createDataFrame([], m[f"{what}_schema"])
    return spark.read.schema(empty.schema).parquet(*paths) if paths else empty


def build(path: str, inputs: DataFrame, key: list[str], make: Callable[[DataFrame], DataFrame], settings: str = "") -> tuple[DataFrame, dict]:
    """(the rows in force after this build, its manifest).

    make turns inputs of whole keys into rows that hold the key's columns. Where nothing changed nothing is written.
    """
    spark = inputs.sparkSession
    bucket: Column = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")
    old, before = manifest(spark, path), current(spark, path, "prints")
    number = 1 if old is None else old["build"] + 1
    prints = fingerprints(inputs, key, settings)
    if before is None:
        before = prints.limit(0)
    at = f"{path}/changes/build={number}"
    both = prints.join(before.withColumnRenamed("print", "_old"), key, "full").where(~F.col("print").eqNullSafe(F.col("_old")))
    both.select(*key, "print", bucket.alias("_bucket"), F.col("print").isNull().alias("gone")).write.mode("overwrite").parquet(at)
    changes = spark.read.parquet(at)
    touched = sorted(r[0] for r in changes.select("_bucket").distinct().collect())  # at most BUCKETS numbers
    if old is not None and not touched:
        return current(spark, path), old
    todo = changes.where("not gone").select(*key)
    made = make(inputs.join(todo, key, "left_semi"))
    rows_schema, prints_schema = made.schema, before.schema
    held = {int(b): n for b, n in old["buckets"].items()} if old else {}

    def write(what: str, fresh: DataFrame, schema) -> None:
        kept = [f"{path}/{what}/build={held[b]}/_bucket={b}" for b in touched if b in held]
        kept = [p for p in kept if (lambda f: f[0].exists(f[1]))(_files(spark, p))]
        out = fresh
        if kept:
            out = fresh.unionByName(spark.read.schema(schema).parquet(*kept).join(changes.select(*key), key, "left_anti"))
        out.withColumn("_bucket", bucket).write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/{what}/build={number}")

    write("rows", made, rows_schema)
    write("prints", changes.where("not gone").select(*key, "print"), prints_schema)
    counts = changes.agg(F.count_if(~F.col("gone")), F.count_if("gone")).first()
    total = prints.count()
    now = {"build": number, "settings": settings, "buckets": {str(b): n for b, n in (held | dict.fromkeys(touched, number)).items()}, "redone": counts[0], "gone": counts[1], "kept": total - counts[0], "rows_schema": ddl(rows_schema), "prints_schema": ddl(prints_schema)}
    spark.createDataFrame([(json.dumps(now),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest/build={number}")
    return current(spark, path), now


def ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
