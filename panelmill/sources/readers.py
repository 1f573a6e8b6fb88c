"""Sources: each gives a DataFrame with an explicit schema."""

from __future__ import annotations

import io
import tarfile
import time
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PANEL_CSV = "file_name string, panel_x0 double, panel_y0 double, panel_x1 double, panel_y1 double, panel_name string, label_x0 double, label_y0 double, label_x1 double, label_y1 double, label_name string"
COCO = "images array<struct<id:bigint,file_name:string,width:int,height:int>>, annotations array<struct<id:bigint,image_id:bigint,category_id:int,bbox:array<double>,area:double>>, categories array<struct<id:int,name:string>>"
RESULT = "struct<id:string,parentID:string,type:string,from_name:string,from_id:string,to_id:string,original_width:int,original_height:int,value:struct<x:double,y:double,width:double,height:double,rotation:double,rectanglelabels:array<string>,text:array<string>>>"
TASKS = f"id bigint, project bigint, cancelled_annotations int, data struct<image_path:string,caption:string,citation:string,article_id:string>, annotations array<struct<id:bigint,was_cancelled:boolean,result:array<{RESULT}>>>, _corrupt_record string"


def table(spark: SparkSession, path: str, schema: str | None = None, columns: list[str] | None = None) -> DataFrame:
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df.select(*columns) if columns else df


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """The CSV of article packages, keyed by the last part of its path."""
    return spark.read.option("header", True).csv(path).select(F.col("File").alias("file"), F.col("Article Citation").alias("citation"), F.col("Accession ID").alias("accession_id"), F.col("License").alias("license"))


def shard_names(spark: SparkSession, sizes: dict[str, int] | DataFrame, a_package: int = 50) -> DataFrame:
    """split, package, first and last shard number (six digits): sizes (split and last shard) split into lots of at most a_package."""
    rows = sizes if isinstance(sizes, DataFrame) else spark.createDataFrame(list(sizes.items()), "split string, last int")
    lots = rows.withColumn("package", F.explode(F.sequence(F.lit(0), F.ceil((F.col("last") + 1) / a_package).cast("int") - 1)))
    number = lambda c: F.format_string("%06d", c)
    return lots.select("split", "package", number(F.col("package") * a_package).alias("first"), number(F.least((F.col("package") + 1) * a_package - 1, "last")).alias("last"))


def _stream(path: str):
    """A file of any store that pyarrow knows, read from front to back."""
    system, at = pa.fs.FileSystem.from_uri(path)
    return system.open_input_stream(at, compression=None)


def archive_members(spark: SparkSession, path: str, kinds: tuple[str, ...] = (".jpg", ".nxml", ".pdf"), opened: Callable[[str], io.IOBase] = _stream) -> DataFrame:
    """path, member, kind, content of tar archives (gzip or not), one member in memory at a time.

    What is no archive, or ends early, gives its members up to there and a row with error. opened gives the bytes of a path.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "member", "kind", "content", "error"]
        types = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]
        row = lambda *v: pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(v, types, strict=True)], names)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                try:
                    with opened(p) as file, tarfile.open(fileobj=file, mode="r|*") as archive:
                        for m in archive:
                            kind = next((k for k in kinds if m.name.endswith(k)), None)
                            if m.isfile() and kind:
                                yield row(p, m.name, kind, archive.extractfile(m).read(), None)
                except (tarfile.TarError, OSError, EOFError, zlib.error) as e:
                    yield row(p, None, None, None, f"{type(e).__name__}: {e}")

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")  # the contents are not read here
    return files.mapInArrow(run, "path string, member string, kind string, content binary, error string")


def wanted_members(members: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The members whose name, without folders and ending, is a wanted key."""
    name = F.regexp_extract("member", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return members.withColumn(key, name).join(wanted.select(F.col(key).cast("string")).distinct(), key, "left_semi")


def located_packages(packages: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """packages with the archive that holds each key in its path; null where there is none."""
    paths = members.select("path").distinct().withColumn(key, F.regexp_extract("path", r"([^/]+?)(?:\.tar)?(?:\.gz)?$", 1))
    return packages.join(paths.groupBy(key).agg(F.min("path").alias("path")), key, "left")


def package_errors(members: DataFrame) -> DataFrame:
    """For each archive, what it lacks."""
    has = members.groupBy("path").agg(F.bool_or(F.col("kind") == ".nxml").alias("xml"), F.bool_or(F.col("kind") == ".pdf").alias("pdf"), F.max("error").alias("error"))
    return has.select("path", F.when(F.col("error").isNotNull(), "no archive").when(~F.coalesce("xml", F.lit(False)), "no xml").when(~F.coalesce("pdf", F.lit(False)), "no pdf").alias("reason")).where("reason is not null")


def tasks(spark: SparkSession, path: str) -> DataFrame:
    """Annotation tasks of files that hold one list each; a task that cannot be read is left out, not its file."""
    each = spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", "array<string>")).alias("task"))
    read = each.select(F.from_json("task", TASKS, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("t")).select("t.*")
    return read.where("_corrupt_record is null and id is not null").drop("_corrupt_record")


#: A task over the pages of an article, side by side in one image.
PAGES = f"id bigint, data struct<image_path:string,base_image_path:string,pdf_pages:array<int>,caption:string,citation:string,article_id:string,meta_annotation:string>, annotations array<struct<id:bigint,was_cancelled:boolean,result:array<{RESULT}>>>, _corrupt_record string"


def page_tasks(spark: SparkSession, path: str, dpi: int = 72) -> DataFrame:
    """Tasks over pages, with dpi; one that cannot be read, or has no pages, is left out."""
    each = spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", "array<string>")).alias("task"))
    read = each.select(F.from_json("task", PAGES, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("t")).select("t.*")
    return read.where("_corrupt_record is null and id is not null and data.pdf_pages is not null").drop("_corrupt_record").withColumn("dpi", F.lit(dpi))


def task_boxes(tasks: DataFrame) -> DataFrame:
    """One row for each region of each annotation that was not cancelled: box in pixels, labels, name, parent."""
    r = tasks.select("id", F.explode("annotations").alias("a")).where("not coalesce(a.was_cancelled, false)").select("id", F.col("a.id").alias("annotation_id"), F.posexplode("a.result").alias("n", "r"))
    v = F.col("r.value")
    at = F.struct((v["x"] * F.col("r.original_width") / 100).alias("x0"), (v["y"] * F.col("r.original_height") / 100).alias("y0"), ((v["x"] + v["width"]) * F.col("r.original_width") / 100).alias("x1"), ((v["y"] + v["height"]) * F.col("r.original_height") / 100).alias("y1"))
    in_order = lambda c: F.flatten(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("n", v[c].alias("x")))), lambda p: p["x"]), lambda x: x.isNotNull()))
    out = r.where("r.type <> 'relation'").groupBy("id", "annotation_id", F.col("r.id").alias("region")).agg(
        F.min_by(F.when(v["x"].isNotNull(), at), F.when(v["x"].isNotNull(), F.col("n"))).alias("box"),
        in_order("rectanglelabels").alias("labels"), in_order("text").alias("names"), F.max("r.parentID").alias("parent"),
    )
    return out.withColumn("conflict", F.size(F.array_distinct("names")) > 1)


def lines_latest(spark: SparkSession, path: str, schema: str, key: str, order: Column) -> DataFrame:
    """JSON lines; the last of each key counts, what cannot be read does not."""
    df = spark.read.schema(f"{schema}, _corrupt_record string").json(path).where("_corrupt_record is null").drop("_corrupt_record")
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def image_clef(spark: SparkSession, path: str) -> DataFrame:
    """filename and the box of each object of four points."""
    schema = "filename string, object array<struct<point:array<struct<_x:double,_y:double>>>>"
    o = spark.read.format("xml").option("rowTag", "annotation").schema(schema).load(path).select("filename", F.posexplode("object").alias("n", "o"))
    xs, ys = F.transform("o.point", lambda p: p["_x"]), F.transform("o.point", lambda p: p["_y"])
    return o.where(F.size("o.point") == 4).select("filename", "n", F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def captions_tsv(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(parts[0].alias("name"), F.replace(parts[1], F.lit(" . "), F.lit(". ")).alias("text"))


def panel_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PANEL_CSV).csv(path).withColumn("file_name", F.replace("file_name", F.lit("\\"), F.lit("/")))


def coco(spark: SparkSession, path: str) -> DataFrame:
    """One row for each annotation with its image and category."""
    d = spark.read.schema(COCO).option("multiLine", True).json(path)
    images, kinds = d.select(F.explode("images").alias("i")), d.select(F.explode("categories").alias("c"))
    a = d.select(F.explode("annotations").alias("a"))
    out = a.join(images, F.col("a.image_id") == F.col("i.id")).join(kinds, F.col("a.category_id") == F.col("c.id"), "left")
    return out.select(F.col("a.id").alias("id"), F.col("i.file_name").alias("file_name"), F.col("c.name").alias("category"), F.col("a.bbox").alias("bbox"))


def map_files(spark: SparkSession, path: str, value: str) -> DataFrame:
    """key and value of JSON files that hold one object."""
    return spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("key", "value"))


def fetched(wanted: DataFrame, fetch: Callable[[str], bytes], at_once: int, key: str = "path", a_second: float | None = None) -> DataFrame:
    """key, content and error of what fetch returns; at_once tasks run it, together at most a_second calls each second."""
    pause = at_once / a_second if a_second else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after = 0.0
        for batch in batches:
            for k in batch.column(0).to_pylist():
                content = error = None
                time.sleep(max(0.0, after - time.monotonic()))
                after = time.monotonic() + pause
                try:
                    content = fetch(k)
                except OSError as e:
                    error = str(e)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.string()), pa.array([content], pa.binary()), pa.array([error], pa.string())], [key, "content", "error"])

    return wanted.select(F.col(key).cast("string")).repartition(at_once).mapInArrow(run, f"{key} string, content binary, error string")


def searched(spark: SparkSession, ask: Callable[[int, int], tuple[int, list[str]]], most: int, step: int = 100, at_once: int = 1) -> DataFrame:
    """n and id of what a paged search finds, `most` at the most: ask(start, step) gives the total and a page's ids.

    The first page tells the total; each further page is one row, which at_once tasks ask for.
    """
    total = min(ask(0, step)[0], most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column(0).to_pylist():
                ids = ask(start, step)[1][: total - start]
                yield pa.RecordBatch.from_arrays([pa.array(range(start, start + len(ids)), pa.int64()), pa.array(ids, pa.string())], ["n", "id"])

    return spark.range(0, total, step, at_once).mapInArrow(run, "n bigint, id string")


def searched_each(queries: DataFrame, query: str, ask: Callable[[str, int, int], tuple[int, list[str]]], most: int, step: int = 100) -> DataFrame:
    """query, n and id of what a paged search finds for each query, `most` of each at the most: ask(query, start, step) gives the total
    and a page's ids. Totals come first; then each page is a row of its own, so a query with many pages is no long task."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([min(ask(q, 0, 1)[0], most) for q in batch.column(0).to_pylist()], pa.int64())], ["query", "total"])

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, total, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = ask(q, start, step)[1][: total - start]
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(ids), pa.string()), pa.array(range(start, start + len(ids)), pa.int64()), pa.array(ids, pa.string())], ["query", "n", "id"])

    found = queries.select(F.col(query).cast("string").alias("query")).distinct().mapInArrow(totals, "query string, total bigint").where("total > 0")
    starts = found.withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("total") - 1, F.lit(step).cast("bigint"))))
    return starts.repartition("query", "start").mapInArrow(pages, "query string, n bigint, id string")


def any_of(terms: list[str]) -> str:
    """A search term that asks for any of some."""
    return " OR ".join(f"({t})" for t in terms)


def downloaded(wanted: DataFrame, have: DataFrame, fetch: Callable[[str], bytes], at_once: int, key: str = "path") -> DataFrame:
    """What is wanted and not there yet, fetched."""
    return fetched(wanted.select(key).distinct().join(have.select(key).distinct(), key, "left_anti"), fetch, at_once, key)


def files_below(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name (without ending) and length of all files below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("name"), "length")


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
