"""Nested records of unknown shape: flattened to leaves, merged by path, rebuilt.

A leaf is (path, kind, value): `$.device.os`, `$.items[0].sku`; keys that are no plain names are quoted. Kinds are string, number,
boolean, null and, for empty ones, object and array. Numbers keep their spelling. Of keys that repeat in an object the
last counts. A text that is no JSON, or null, has no leaves. A record of one value has the leaf `$`.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import StringType

_PLAIN = re.compile(r"[A-Za-z_]\w*\Z")
_STEP = re.compile(r'\.([A-Za-z_]\w*)|\."((?:[^"\\]|\\.)*)"|\[(\d+)\]')


class _Number(str):
    """A number as it is spelled."""


def _no_constant(name: str):
    raise ValueError(name)  # NaN and Infinity are no JSON


def walk(text: str | None, arrays: bool = True) -> Iterator[tuple[str, str, str | None]]:
    """The leaves of a JSON text; arrays=False: a whole array is one leaf, as JSON."""
    try:
        todo = [("$", json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_no_constant))]
    except (TypeError, ValueError, RecursionError):
        return
    while todo:  # no recursion: any depth that the parser takes
        path, x = todo.pop()
        if isinstance(x, dict) and x:
            todo += [(path + (f".{k}" if _PLAIN.match(k) else "." + json.dumps(k, ensure_ascii=False)), v) for k, v in reversed(x.items())]
        elif isinstance(x, list) and x and arrays:
            todo += [(f"{path}[{i}]", v) for i, v in reversed(list(enumerate(x)))]
        elif isinstance(x, _Number):
            yield path, "number", str(x)
        elif isinstance(x, str):
            yield path, "string", x
        elif isinstance(x, bool):
            yield path, "boolean", "true" if x else "false"
        elif x is None:
            yield path, "null", None
        elif isinstance(x, list):
            yield path, "array", _spelled(x) if x else None
        else:
            yield path, "object", None


def _spelled(x) -> str:
    if isinstance(x, dict):
        return "{" + ",".join(json.dumps(k, ensure_ascii=False) + ":" + _spelled(v) for k, v in x.items()) + "}"
    if isinstance(x, list):
        return "[" + ",".join(map(_spelled, x)) + "]"
    return str(x) if isinstance(x, _Number) else json.dumps(x, ensure_ascii=False)


@udtf(returnType="path string, kind string, value string")
class JsonLeaves:
    """json_leaves(text, arrays): one row for each leaf."""

    def eval(self, text: str, arrays: bool):
        yield from walk(text, arrays)


def register(spark: SparkSession) -> None:
    """json_leaves as a table function of SQL."""
    spark.udtf.register("json_leaves", JsonLeaves)


def leaves(df: DataFrame, key: list[str], column: str, arrays: bool = True) -> DataFrame:
    """key, path, kind and value of each leaf of the texts in column."""
    register(df.sparkSession)
    rows = df.select(*key, F.col(column).alias("_text"))
    names = ", ".join(f"`{k}`" for k in key)
    return df.sparkSession.sql(f"select {names}, path, kind, value from {{rows}}, lateral json_leaves(_text, {str(arrays).lower()})", rows=rows)


def shapes(found: DataFrame) -> DataFrame:
    """pattern (a path with * for places in arrays), kinds (how many leaves of each) and n."""
    each = found.groupBy(F.regexp_replace("path", r"\[\d+\]", "[*]").alias("pattern"), "kind").agg(F.count("*").alias("n"))
    return each.groupBy("pattern").agg(F.array_sort(F.collect_list(F.struct("kind", "n"))).alias("kinds"), F.sum("n").alias("n"))


def _parents() -> Column:
    """A path and all its ancestors."""
    steps = F.regexp_extract_all("path", F.lit(r'(?U)\.[A-Za-z_]\w*|\."(?:[^"\\]|\\.)*"|\[\d+\]'), F.lit(0))
    return F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.concat(F.lit("$"), F.array_join(F.slice(steps, 1, n), "")))


def merged(base: DataFrame, over: DataFrame, key: list[str]) -> DataFrame:
    """Leaves of both records (leaves with arrays=False, one record a key): objects merge key by key, anything else of over
    replaces what base has at its path, below it, or as a single value above it."""
    paths = over.groupBy(*key).agg(F.collect_list("path").alias("_over"), F.array_distinct(F.flatten(F.collect_list(_parents()))).alias("_way"))
    replaced = F.arrays_overlap(_parents(), "_over") | F.array_contains("_way", F.col("path"))
    return base.join(paths, key, "left").where(~F.coalesce(replaced, F.lit(False))).select(*base.columns).unionByName(over)


def _record(found) -> str:
    root: dict = {}
    for leaf in found:
        path, kind, value = leaf["path"], leaf["kind"], leaf["value"]
        x = json.dumps(value, ensure_ascii=False) if kind == "string" else "null" if kind == "null" else "{}" if kind == "object" else (value or "[]") if kind == "array" else value
        node, steps = root, [(m[1], m[2], m[3]) for m in _STEP.finditer(path)]
        at: list = ["$", *[plain if plain is not None else json.loads(f'"{quoted}"') if quoted is not None else int(place) for plain, quoted, place in steps]]
        for step in at[:-1]:
            node = node.setdefault(step, {})
        node[at[-1]] = x

    def spelled(node) -> str:
        if isinstance(node, str):
            return node
        if node and all(isinstance(k, int) for k in node):
            return "[" + ",".join(spelled(node[k]) for k in sorted(node)) + "]"
        return "{" + ",".join(json.dumps(k, ensure_ascii=False) + ":" + spelled(v) for k, v in node.items()) + "}"

    return spelled(root["$"]) if root else "{}"


def rebuilt(found: DataFrame, key: list[str]) -> DataFrame:
    """key and json: the record of each key's leaves, keys in the order of paths."""
    return found.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("path", "kind", "value"))).alias("_l")).select(*key, F.udf(_record, StringType(), useArrow=True)("_l").alias("json"))
