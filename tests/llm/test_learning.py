"""What models and lists learn: known rules are found, and the order of rows does not matter."""

import random

import numpy as np
from pyspark.sql import Row
from pyspark.sql import functions as F

from panelmill.llm import language, quality, rules

SF = "/root/testdata/sf0.01"


def stats(n, bad_if, seed=1):
    rng, out = random.Random(seed), []
    for i in range(n):
        words = rng.randrange(20, 400)
        r = {"doc_id": i, "n_words": words, "word_chars": words * rng.randrange(3, 9), "n_symbols": rng.randrange(0, words // 4), "n_dup_lines": rng.randrange(0, 4), "n_repeat_words": rng.randrange(0, words // 3), "n_distinct_words": rng.randrange(5, words + 1), "n_loud": rng.randrange(3), "n_capitals": rng.randrange(50), "n_digits": rng.randrange(9)}
        out.append(Row(**r, quality=int(not bad_if(r))))
    return out


def test_known_rules():
    found = rules.learn(stats(900, lambda r: r["n_symbols"] / r["n_words"] >= 0.15))
    assert len(found) >= 1 and found[0][0][:2] == ("symbols_a_word", ">=") and abs(found[0][0][2] - 0.15) < 0.02
    two = rules.learn(stats(2000, lambda r: r["n_symbols"] / r["n_words"] >= 0.2 or r["n_distinct_words"] / r["n_words"] < 0.2))
    assert {c[0] for rule in two for c in rule} >= {"symbols_a_word", "distinct_share"}
    for r in stats(400, lambda r: r["n_symbols"] / r["n_words"] >= 0.2 or r["n_distinct_words"] / r["n_words"] < 0.2, 2):
        m = rules._measured(r)
        if abs(m["symbols_a_word"] - 0.2) > 0.02 and abs(m["distinct_share"] - 0.2) > 0.05:
            assert any(rules._holds(m, rule) for rule in two) == m["bad"]
    assert rules.learn(stats(300, lambda r: False)) == [] and rules.learn([]) == []
    coin = random.Random(3)
    assert rules.learn(stats(900, lambda r: coin.random() < 0.3)) == []  # no rule is precise on the pruning part


def test_order_of_rows():
    rows = stats(700, lambda r: r["n_capitals"] / r["word_chars"] >= 0.03)
    again = rows[:]
    random.Random(7).shuffle(again)
    assert rules.learn(rows) == rules.learn(again)


def test_pruning():
    rows = [rules._measured(r) for r in stats(400, lambda r: r["n_symbols"] / r["n_words"] >= 0.15)]
    rule = [("symbols_a_word", ">=", 0.15), ("digit_share", ">=", 0.001)]
    assert rules._prune(rule, rows) == rule[:1] and rules._prune([], rows) == []


def test_models_do_not_depend_on_partitions(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    twice = docs.unionByName(docs.where("doc_id % 3 = 0"))
    found = []
    for n in (1, 7):
        d = twice.repartition(n, "text") if n > 1 else twice.coalesce(1)
        a, b = language.fit(d, F.lit(True)), quality.fit(d, labels.repartition(n), F.lit(True))
        found.append((a, b, rules.fit(d, labels.repartition(n))))
    (a, b, c), (x, y, z) = found
    assert a["names"] == x["names"] and all(np.array_equal(a[k], x[k]) for k in ("idf", "centroids", "least"))
    assert all(np.array_equal(b[k], y[k]) for k in b) and c == z


def test_every_label_is_learned(spark):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)} " * 20, f"l{i}") for i in range(520)]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True))
    assert len(set(model["names"])) == 520
