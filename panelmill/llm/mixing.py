"""A training mix: target sizes for each source, and a place in a time-varying curriculum for each document.

Targets: the sources, by code point with null last, share a budget by repeating weights; no target exceeds
CAP times its source's size, and what a source cannot take is shared again by weight.

Curriculum: over training time t from 0 to 1 a source's weight is its target times 1 + k (1 - 2 t), with k
of its own; integrated, T (t + k (t - t^2)) words have been asked for by time t. A source's documents stand in
the order of a hash; the middle of a document in the running sum of sizes, put into the inverse of that
integral, is its training position. A second pass over the source follows where the target asks for it.
Documents are then range-sorted by position.

A source's time runs at the pace of its own schedule; the position of time t is the number of words that the whole mix has
asked for by then, the sum of the sources' integrals, so positions measure the mix and not one source.

Running sums take two levels: hash ranges of about RANGE documents each are summed first, then documents inside
one range, so no source is one task. Rows that are equal in id and text are one unit, taken together.
A document is taken 0, 1 or 2 times, whole; its size is its number of words (null text: 0). Documents of
size 0 are taken with 0 words. Source names that are null form one source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.common import as_text, column, spread, written
from panelmill.llm.rules import WORD

WEIGHTS = (5.0, 2.0, 1.0)
#: The slope k of each weight's schedule: the heavy sources fade out, the light ones come in.
SLOPES = (0.5, 0.0, -0.5)
BUDGET, CAP = 1.5, 2.0
RANGE = 2_000


def targets(sources: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """sources (source, source_size) with place, weight and target: the shares by weight under the caps.

    With sources in the order of cap / weight, the capped ones come first; the share of a unit of weight is
    what they leave, divided by the weight of the others. One row for each source goes through one window.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    out = sources.withColumn("place", place).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    out = out.withColumn("limit", cap * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    capped = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    out = out.withColumn("unit", (budget * F.sum("source_size").over(every) - capped) / left)
    # the first source that stays below its cap gives the share of a unit to all after it
    out = out.withColumn("level", F.min(F.when(F.col("unit") * F.col("weight") <= F.col("limit"), F.struct((F.col("limit") / F.col("weight")).alias("r"), "place", "unit"))).over(every)["unit"])
    return out.withColumn("target", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))).drop("unit", "level", "limit")


def position(share: Column, slope: Column) -> Column:
    """The time t at which t + k (t - t^2) reaches share."""
    root = F.sqrt(F.greatest((1 + slope) * (1 + slope) - 4 * slope * share, F.lit(0.0)))
    return F.when(slope == 0, share).otherwise(((1 + slope) - root) / (2 * slope))


def _key(id_col: str, text_col: str) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit("mix"), column(id_col).cast("string"), as_text(text_col)))
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("bigint")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Units of equal rows: doc_id, source, key, n_rows, size, source_size, target, copies, positions (array)."""
    rows = spread(docs).select(column(id_col).cast("bigint").alias("doc_id"), column(source_col).cast("string").alias("source"), _key(id_col, text_col).alias("key"), F.coalesce(F.regexp_count(as_text(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))
    units = written(rows.groupBy("doc_id", "source", "key", "size").agg(F.count("*").alias("n_rows")), "units")
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size"), F.count("*").alias("n_units"))
    slopes = F.element_at(F.array(*map(F.lit, SLOPES)), (F.col("place") % len(SLOPES) + 1).cast("int"))
    sources = written(targets(sources).withColumn("slope", slopes).withColumn("mix", F.sum("target").over(Window.partitionBy())).withColumn("bend", F.sum(F.col("target") * F.col("slope")).over(Window.partitionBy())).withColumn("ranges", F.ceil(F.col("n_units") / RANGE).cast("bigint")), "sources")
    at = F.floor(F.pmod(F.col("key"), F.lit(1 << 31)) / F.lit(1 << 31) * F.col("ranges")).cast("bigint")
    units = units.withColumn("has", F.col("source").isNotNull()).withColumn("source", F.coalesce("source", F.lit("")))
    sources = sources.withColumn("has", F.col("source").isNotNull()).withColumn("source", F.coalesce("source", F.lit("")))
    units = units.join(sources, ["has", "source"]).withColumn("range", at).withColumn("order", F.pmod(F.col("key"), F.lit(1 << 31)))
    own = Window.partitionBy("has", "source")
    sums = units.groupBy("has", "source", "range").agg(F.sum(F.col("size") * F.col("n_rows")).alias("words"))
    sums = sums.withColumn("start", F.coalesce(F.sum("words").over(own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("words")
    units = units.join(sums, ["has", "source", "range"])
    inside = Window.partitionBy("has", "source", "range").orderBy("order", "key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("size") * F.col("n_rows")
    middle = F.col("start") + F.coalesce(F.sum(words).over(inside), F.lit(0)) + words / 2
    units = units.withColumn("middle", middle)
    share = lambda k: F.least((F.col("middle") + k * F.col("source_size")) / F.greatest("target", F.lit(1.0)), F.lit(1.0))
    copies = (F.col("middle") <= F.col("target")).cast("int") + ((F.col("middle") + F.col("source_size") <= F.col("target")) & (F.col("size") > 0)).cast("int")
    asked = lambda t: F.col("mix") * t + F.col("bend") * (t - t * t)
    times = F.slice(F.array(*[position(share(k), F.col("slope")) for k in (0, 1)]), F.lit(1), F.col("copies"))
    units = units.withColumn("copies", copies).withColumn("positions", F.transform(times, asked))
    return units.select("doc_id", F.when(F.col("has"), F.col("source")).alias("source"), "key", "n_rows", "size", "source_size", "target", "copies", "positions")


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken and position (the first; null if not taken) of every row, in
    training order. position: words of the whole mix that come before."""
    out = plan(docs, id_col, text_col, source_col).withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    out = out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("bigint").alias("taken"), F.get("positions", F.lit(0)).alias("position"))
    return out.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs as often as they are taken, with all columns, range-sorted by training position."""
    chosen = plan(docs, id_col, text_col, source_col).where("copies > 0").select("key", "doc_id", "source", "positions")
    own = docs.select(F.struct(*[column(n) for n in docs.columns]).alias("row"), _key(id_col, text_col).alias("own_key"), column(id_col).cast("bigint").alias("own_id"), column(source_col).cast("string").alias("own_source"))
    same = (F.col("own_key") == F.col("key")) & F.col("own_id").eqNullSafe(F.col("doc_id")) & F.col("own_source").eqNullSafe(F.col("source"))
    return own.join(chosen, same).withColumn("position", F.explode("positions")).orderBy("position", "key").select("row.*")
