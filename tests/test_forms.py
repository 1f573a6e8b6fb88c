"""Forms worked out once match where the ladder does."""

import random

from pyspark.sql import functions as F

from panelmill.functions import text as tx


def test_forms_as_ladder(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(" aAbB1(.é") for _ in range(rng.randint(0, 3)))
    rows = [(word(), word(), [word() for _ in range(rng.randint(0, 2))]) for _ in range(3000)]
    rows = [(t, n, [n, *rest]) for t, n, rest in rows] + [(None, "a", ["a"]), ("a", "a", ["a"])]
    df = spark.createDataFrame(rows, "text string, name string, names array<string>")
    ladder = tx.match_level(F.col("text"), F.col("name"), F.col("names")).isNotNull()
    forms = F.coalesce(F.arrays_overlap(tx.tagged_forms(F.col("name"), tx.stable_forms(F.col("names"))), tx.tagged_forms(F.col("text"))), F.lit(False))
    wrong = df.select("text", "name", "names", ladder.alias("a"), forms.alias("b")).where("a <> b").collect()
    assert not wrong
    assert df.where(ladder).count() > 100
