"""Leaves, merging and rebuilding of nested records."""

import json
import random

from panelmill.functions import nested


def merge(a, b):
    if not (isinstance(a, dict) and isinstance(b, dict)):
        return b
    return a | {k: merge(a[k], v) if k in a else v for k, v in b.items()}


def test_leaves():
    text = '{"a": {"b": [{"c": [1, [2.50, null]]}, {}]}, "x y": true, "q\\"z.[0]": "s", "a1": [], "d": 1, "d": "two", "é": ""}'
    assert list(nested.walk(text)) == [
        ("$.a.b[0].c[0]", "number", "1"), ("$.a.b[0].c[1][0]", "number", "2.50"), ("$.a.b[0].c[1][1]", "null", None), ("$.a.b[1]", "object", None),
        ('$."x y"', "boolean", "true"), ('$."q\\"z.[0]"', "string", "s"), ("$.a1", "array", None), ("$.d", "string", "two"), ('$."é"', "string", ""),
    ]
    assert list(nested.walk("7")) == [("$", "number", "7")] and list(nested.walk("{}")) == [("$", "object", None)]
    assert not [*nested.walk(None), *nested.walk("{"), *nested.walk(""), *nested.walk('{"a": NaN}'), *nested.walk("[" * 100_000)]
    assert list(nested.walk('{"a": [1, {"b": 2.0}]}', arrays=False)) == [("$.a", "array", '[1,{"b":2.0}]')]


def some(rng, depth=0):
    kind = rng.randrange(7 if depth < 4 else 4)
    if kind < 4:
        return [rng.randrange(9), "s" * rng.randrange(3), None, rng.random() < 0.5][kind]
    if kind == 4:
        return [some(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(["a", "b", "c d", 'q"', "e.f", "é"]): some(rng, depth + 1) for _ in range(rng.randrange(4))}


def test_round_trip_and_merge(spark):
    rng = random.Random(4)
    a, b = [some(rng) for _ in range(300)], [some(rng) for _ in range(300)]
    df = spark.createDataFrame([(i, json.dumps(x), json.dumps(y)) for i, (x, y) in enumerate(zip(a, b))], "k bigint, a string, b string")
    for arrays in (True, False):
        got = {r.k: json.loads(r.json) for r in nested.rebuilt(nested.leaves(df, ["k"], "a", arrays), ["k"]).collect()}
        assert got == dict(enumerate(a))
    objects = [i for i in range(300) if isinstance(a[i], dict) and isinstance(b[i], dict) and a[i] and b[i]]
    own = df.where(df.k.isin(objects))
    out = nested.rebuilt(nested.merged(nested.leaves(own, ["k"], "a", False), nested.leaves(own, ["k"], "b", False), ["k"]), ["k"])
    got = {r.k: json.loads(r.json) for r in out.collect()}
    assert len(objects) > 10 and got == {i: merge(a[i], b[i]) for i in objects}


def test_repeats_and_none(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, "{"), (3, None)], "k bigint, t string")
    assert [tuple(r) for r in nested.leaves(df, ["k"], "t").collect()] == [(1, "$.a", "number", "1")]
    assert nested.leaves(df.limit(0), ["k"], "t").count() == 0
    assert [r.pattern for r in nested.shapes(nested.leaves(spark.createDataFrame([(1, '[{"a": 1}, {"a": "x"}]')], "k bigint, t string"), ["k"], "t")).collect()] == ["$[*].a"]


def test_merge_of_rows_in_any_order(spark):
    """Rows come in another order each time that they are read."""

    def mixed(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            yield b.take(pa.array(np.random.default_rng().permutation(b.num_rows)))

    df = spark.createDataFrame([(i, '{"a": "x", "b": {"c": 1, "d": 2}, "e": [1]' + ', "f": 0' * (i % 3 > 0) + "}", '{"a": {"y": 1}, "b": {"c": "z"}, "aé": 1}') for i in range(400)], "k bigint, a string, b string").coalesce(1)
    df = df.mapInArrow(mixed, df.schema)
    out = nested.rebuilt(nested.merged(nested.leaves(df, ["k"], "a", False), nested.leaves(df, ["k"], "b", False), ["k"]), ["k"])
    assert {r.k: json.loads(r.json) for r in out.collect()} == {i: {"a": {"y": 1}, "aé": 1, "b": {"c": "z", "d": 2}, "e": [1]} | ({"f": 0} if i % 3 else {}) for i in range(400)}
