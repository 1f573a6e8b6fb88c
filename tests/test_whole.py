"""Queries that take part of their table elsewhere, over all of it: against brute force on small tables."""

import random

from pyspark.sql import functions as F

from panelmill.operators import spatial
from panelmill.plans import QUERIES
from panelmill.plans import run as runs
from panelmill.plans.stages import stored


def test_hamming_pairs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spatial, "BLOCK", 32)
    draw = random.Random(1)
    bases = [[draw.choice((-1.0, 1.0)) for _ in range(64)] for _ in range(40)]
    rows = [(i * 7, [-x if draw.random() < 0.09 else x for x in bases[i % 40]]) for i in range(300)]
    rows += [(9001, bases[0]), (9002, bases[0][:32] + [-x for x in bases[0][32:]]), (9003, None), (9001, bases[1])]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    far = lambda v, w: sum((x > 0) != (y > 0) for x, y in zip(v, w, strict=True))
    want = sorted((i, j, far(v, w)) for i, v in rows for j, w in rows if v and w and i < j and far(v, w) <= 10)
    assert len(want) > 100 and any(i > 100 for i, _, _ in want)
    bit = lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))
    hashes = spark.read.parquet(f"{tmp_path}/embeddings.parquet").select("vec_id", F.aggregate(F.transform("embedding", bit), F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x)).alias("h"))
    assert sorted(map(tuple, spatial.hamming_pairs(hashes, "vec_id", "h", 10).collect())) == want


def test_segments_reach_the_end(spark, tmp_path):
    rows = [(1, "x" * 30 + "middle!" + "y" * 30 + "the end", 74), (2, "short", 5), (3, "", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.text for r in QUERIES["segment_reconstruct"](spark, str(tmp_path)).collect()}
    assert found == {i: f"{t[:5]}-{t[n // 2 : n // 2 + 7]}-{t[max(n - 7, 0) :]}" for i, t, n in rows}


def test_all_parts_are_run(spark, tmp_path):
    """Keys that leave 6 modulo 7 take part: a caption without parts gives its row, one whose split failed none."""
    spark.createDataFrame([(i, f"one{i} two{i}") for i in (6, 13, 15, 20, 27)], "p_partkey bigint, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    found = sorted((r.panel_id, r.article_id, r.panel_name, r.subcaption_text) for r in QUERIES["whole_run"](spark, str(tmp_path)).collect())
    assert found == [(f"p_{i}000001", i + 5, "None", f"one{i} two{i}") for i in (15, 27, 6)]


def test_no_table_of_the_run_is_broadcast(spark, tmp_path, monkeypatch):
    """The size of a table's files says little of its rows; the session's own thresholds are back after the run."""
    plans, before = [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.range(40).selectExpr("id as p_partkey", "concat('one', id, ' two', id) as p_name").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(runs, "stored", lambda df, path: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stored(df, path))
    assert QUERIES["whole_run"](spark, str(tmp_path)).count() == sum(i % 5 != 4 and (i % 3 == 0 or i % 7 != 6) and 1 + (i % 3 != 0) for i in range(40))
    assert sum("SortMergeJoin" in p for p in plans) > 3 and not [p for p in plans if "Broadcast" in p]
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before and spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None
