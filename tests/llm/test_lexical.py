"""Lexical search against scores worked out document by document, and its bitmap arithmetic against integers."""

import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from panelmill.llm import lexical, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def ranked(docs, items, k):
    own = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    total, n_docs = sum(n for _, _, n in own), len(own)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(words(t))
    out = []
    for item, terms in asked.items():
        found = []
        for doc, tf, n in own:
            m = 75 + 25 * n * n_docs // total
            score = 0
            for t, often in terms.items():
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in x for _, x, _ in own) + 1)))
                    score += often * w * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(found)[:k], 1)]
    return out


def order(rows):
    return sorted(map(repr, rows))


def test_bits_are_integers():
    rng = np.random.default_rng(4)
    numbers = rng.integers(0, 2**20, (50, 64))
    bits = np.stack([lexical.bitmaps(np.arange(64), row, 1)[:, 0] for row in numbers], axis=1)
    read = lambda b: np.stack([sum((b[s] >> np.uint64(i) & np.uint64(1)).astype(np.int64) << s for s in range(len(b))) for i in range(64)], axis=1)
    assert (read(bits) == numbers).all()
    factor = rng.integers(1, 20_000, 50)
    product = lexical.times(bits, factor, 44)
    assert (read(product) == numbers * factor[:, None]).all()
    key = np.sort(rng.integers(0, 7, 50))
    sums, keys = lexical.added(product, key)
    assert keys.tolist() == sorted(set(key.tolist()))
    assert (read(sums) == np.stack([(numbers * factor[:, None])[key == k].sum(axis=0) for k in keys])).all()


@pytest.mark.parametrize("k", [1, 3, 20, 1000])
def test_best(k):
    rng = np.random.default_rng(k)
    for top in (2, 5, 2**20):
        numbers = rng.integers(0, top, (9, 64))
        bits = np.stack([lexical.bitmaps(np.arange(64), row, 1)[:, 0] for row in numbers], axis=1)
        first = np.array([0, 4, 5])
        at, bit = lexical.best(bits, first, k)
        for low, high in ((0, 4), (4, 5), (5, 9)):
            every = sorted((-numbers[c, b], c, b) for c in range(low, high) for b in range(64) if numbers[c, b] > 0)[:k]
            assert sorted((c, b) for _, c, b in every) == sorted((c, b) for c, b in zip(at.tolist(), bit.tolist(), strict=True) if low <= c < high)


def test_norms_beyond_64_bits():
    n = np.array([1, 10**12, 7], np.int64)
    assert lexical.norms(n, 10**10, 10**13).tolist() == [75 + 25 * x * 10**10 // 10**13 for x in n.tolist()]


def _random(seed, n):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "b", "the", "Zeta", "é", "É", "naïve", "x1", "世界", "q" * 300] + [f"w{i}" for i in range(200)]
    gaps = [" ", ", ", "\n", "-", "\0", "'", "_"]
    return ["".join(rng.choice(vocabulary[: rng.choice([3, 11, 200])]) + rng.choice(gaps) for _ in range(rng.choice([1, 3, 20, 80]))) for _ in range(n)]


def test_as_document_by_document(spark, monkeypatch):
    docs = list(enumerate(_random(1, 300))) + [(i, "the same words") for i in range(300, 420)] + [(420, None), (421, ""), (422, " .,-"), (5, "the same words"), (None, "the same words zeta"), (None, "zeta"), (423, "long " * 60_000)]
    items = [(1, "the zeta"), (2, "The the THE b"), (3, None), (4, "nowhere at all"), (5, " ".join(_random(3, 40))), (None, "naïve É"), (None, "é"), (6, "same words"), (7, "")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumnRenamed("doc_id", "item_id").repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("item_id", "text", "1 as term", "2 as score")
    index = lexical.build(df, id_col="item_id")
    for k in (1, 20):
        assert order(tuple(r) for r in lexical.search(index, asked, k).collect()) == order(ranked(docs, items, k))
    # more blocks of items, one item at once
    monkeypatch.setattr(lexical, "ITEMS", 2)
    monkeypatch.setattr(lexical, "WORDS", 1)
    assert order(tuple(r) for r in lexical.search(index, asked, 20).collect()) == order(ranked(docs, items, 20))


def test_without_broadcast(spark):
    docs = list(enumerate(_random(8, 60)))
    items = [(1, "the w1 w2 b"), (2, "é w7")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lexical.search(lexical.build(spark.createDataFrame(docs, "doc_id bigint, text string")), spark.createDataFrame(items, "item_id bigint, text string"), 20).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert order(map(tuple, got)) == order(ranked(docs, items, 20))


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.search(lexical.build(docs.limit(0)), items).count() == 0
    assert lexical.search(lexical.build(docs), items.limit(0)).count() == 0
    assert lexical.search(lexical.build(docs), items).count() == 1


def test_query_as_sql(spark):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{os.path.join(SF, t + '.parquet')}'")
    assert sorted(tuple(r) for r in queries.op13_lexical_search(spark, SF).collect()) == sorted(c.execute(queries.LEXICAL).fetchall())
