"""Tables between steps: predictions flattened, labels with lasting ids, updates merged, runs resumed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.operators.relational import lots, upsert


def predictions_flat(results: DataFrame, key: list[str], lists: list[str]) -> DataFrame:
    """key, n and one row for each place of the lists; a list that is shorter gives nulls."""
    rows = results.select(*key, F.posexplode(F.arrays_zip(*lists)).alias("n", "r"))
    return rows.select(*key, "n", *[F.col("r")[name].alias(name) for name in lists])


def lasting_id(*key: Column) -> Column:
    """The same positive id for the same key in every run; 63 bits."""
    return F.xxhash64(*key).bitwiseAND(F.lit(2**63 - 1))


def stored_labels(panels: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tables of panels and labels after new labels got lasting ids instead of their negative ones.

    panels (fig, panel_id, label_ids), labels (fig, label_id, text and more; label_id below 0: new).
    """
    new = labels.where("label_id < 0").withColumn("id", lasting_id(F.lit("label"), F.col("fig"), F.col("label_id")))
    ids = new.select("fig", "label_id", "id")
    each = panels.select("fig", "panel_id", F.posexplode("label_ids").alias("n", "label_id")).join(ids, ["fig", "label_id"], "left")
    lists = each.groupBy("fig", "panel_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", F.coalesce("id", "label_id").alias("id")))), lambda x: x["id"]).alias("label_ids"))
    kept = panels.drop("label_ids").join(lists, ["fig", "panel_id"], "left").withColumn("label_ids", F.coalesce("label_ids", F.array().cast("array<bigint>")))
    return kept, new.drop("label_id")


def merged(old: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """old with the values of updates that are not null, and the rows that only updates has. A column `deleted`, if
    updates has one, marks rows and removes none."""
    names = [c for c in dict.fromkeys([*old.columns, *updates.columns]) if c not in key]
    a = old.select(*key, *[F.col(c).alias(f"a_{i}") for i, c in enumerate(names) if c in old.columns])
    b = updates.select(*key, *[F.col(c).alias(f"b_{i}") for i, c in enumerate(names) if c in updates.columns])
    both = a.join(b, key, "full")
    value = lambda i, c: F.coalesce(*[F.col(f"{s}_{i}") for s, t in (("b", updates), ("a", old)) if c in t.columns]).alias(c)
    return both.select(*key, *[value(i, c) for i, c in enumerate(names)])


def resumed(state: DataFrame, panels: DataFrame, figure: str, done: Column, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """state after step ran again on every figure that has a panel without a finished row; a figure's old rows go as
    a whole, so none is left half done. panels (figure, panel_id), state (figure, panel_id and more)."""
    n = lots(state, panels)  # a task's share does not grow with the tables
    finished = state.where(done).select(figure, "panel_id").repartition(n, figure, "panel_id")
    todo = panels.select(figure, "panel_id").repartition(n, figure, "panel_id").join(finished, [figure, "panel_id"], "left_anti").select(figure).distinct().repartition(n, figure)
    kept = state.repartition(n, figure).join(todo, figure, "left_anti")
    return kept.unionByName(step(todo), allowMissingColumns=True).repartition(n, figure)


def metrics_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def finished_once(old: DataFrame, new: DataFrame, figure: str) -> DataFrame:
    """old with the rows of whole figures replaced by new."""
    return upsert(old, new, [figure])
