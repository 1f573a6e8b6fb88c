"""Quality rules as a learned decision list; Spark columns only.

Statistics of each text are Spark expressions: array functions inside a row, in n log n time, so a text of
any length needs no shuffle. Sequential covering learns the list on the driver from the statistics of a
bounded labelled sample (SAMPLE documents picked by a hash of the id, a repeated one with its least label and text): a conjunction of thresholds is grown by
information gain on two thirds of it, pruned on the other third, and kept while it is precise there; rows
it covers leave the sample. The list becomes one ordered conditional expression.

Rows: one for each input row, repeated rows included; other columns are left out. A null or empty text has
no words and fails the base. Without labels the list is empty and keeps what passes the base.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from panelmill.llm.common import as_text, column, spread

SAMPLE = 4000
#: A rule is kept if it covers this many junk rows of the pruning part, this precisely.
LEAST_COVER, LEAST_PRECISION = 3, 0.97
RULES, CONDITIONS, CUTS = 12, 3, 24
WINDOW = 5
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words in windows that occur twice or more."""

    def covered(sums: Column) -> Column:
        # windows in the order of their hash stand beside their equals
        def places(s: Column) -> Column:
            def place(x: Column, i: Column) -> Column:
                alike = (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])
                return F.when(F.coalesce(alike, F.get(s, i + 1)["h"] == x["h"], F.lit(False)), x["i"])

            return F.array_sort(F.array_compact(F.transform(s, place)))

        step = lambda acc, p: F.struct((acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n"), (p + WINDOW).alias("end"))
        return F.aggregate(_let(F.sort_array(F.transform(sums, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), places), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"])

    def windows(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return _let(every, lambda sums: F.when(F.size(F.array_distinct(sums)) == F.size(sums), F.lit(0)).otherwise(covered(sums)))

    return F.when(F.size(words) > WINDOW, _let(F.transform(words, lambda x: F.xxhash64(x)), windows)).otherwise(F.lit(0))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and further counts (long)."""
    text = F.coalesce(as_text(text_col), F.lit(""))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            _repeated(words).cast("bigint").alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct_words"),
        )

    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(WORD))
    without = lambda chars: F.char_length("_text") - F.char_length(F.translate("_text", chars, ""))
    out = docs.select(column(id_col).cast("bigint").alias("doc_id"), *more, text.alias("_text"))
    out = out.withColumn("_w", _let(F.regexp_extract_all(F.col("_text"), F.lit(WORD), F.lit(0)), counts)).withColumn("_l", _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))))
    return out.select(
        "doc_id",
        *more,
        F.col("_w.n_words").alias("n_words"),
        (F.char_length("_text") - without(" \t\n\x0b\x0c\r")).cast("bigint").alias("word_chars"),
        without(SYMBOLS).cast("bigint").alias("n_symbols"),
        F.col("_l").cast("bigint").alias("n_dup_lines"),
        F.col("_w.n_repeat_words").alias("n_repeat_words"),
        F.col("_w.n_distinct_words").alias("n_distinct_words"),
        without("!?").cast("bigint").alias("n_loud"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("bigint").alias("n_capitals"),
        without("0123456789").cast("bigint").alias("n_digits"),
    )


#: What the rules test: shares and means, each of (numerator, denominator).
MEASURES = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_a_word": ("n_symbols", "n_words"),
    "dup_lines_a_word": ("n_dup_lines", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "loud_a_word": ("n_loud", "n_words"),
    "capital_share": ("n_capitals", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
}

Condition = tuple[str, str, float]


def _holds(row: dict, rule: list[Condition]) -> bool:
    return all(row[m] >= x if op == ">=" else row[m] < x for m, op, x in rule)


def _measured(r: Row) -> dict:
    return {m: r[a] / max(r[b], 1) for m, (a, b) in MEASURES.items()} | {"bad": not r["quality"]}


def _grow(rows: list[dict]) -> list[Condition]:
    """Conditions added one by one, each the best by FOIL's information gain."""
    rule: list[Condition] = []
    while len(rule) < CONDITIONS:
        p0, n0 = sum(r["bad"] for r in rows), sum(not r["bad"] for r in rows)
        if not p0 or not n0:
            break
        before, best = math.log2(p0 / (p0 + n0)), (0.0, None)
        for m in MEASURES:
            values = sorted({r[m] for r in rows})
            cuts = sorted({values[len(values) * i // CUTS] for i in range(1, CUTS)} | {(a + b) / 2 for a, b in zip(values, values[1:], strict=False) if len(values) <= CUTS})
            for x in cuts:
                p = sum(r["bad"] and r[m] >= x for r in rows)
                n = sum(not r["bad"] and r[m] >= x for r in rows)
                for op, a, b in ((">=", p, n), ("<", p0 - p, n0 - n)):
                    gain = a * (math.log2(a / (a + b)) - before) if a else 0.0
                    if gain > best[0] + 1e-9:
                        best = (gain, (m, op, x))
        if best[1] is None:
            break
        rule.append(best[1])
        rows = [r for r in rows if _holds(r, rule[-1:])]
    return rule


def _prune(rule: list[Condition], rows: list[dict]) -> list[Condition]:
    def worth(k: int) -> float:
        p = sum(r["bad"] and _holds(r, rule[:k]) for r in rows)
        n = sum(not r["bad"] and _holds(r, rule[:k]) for r in rows)
        return (p - n) / (p + n) if p + n else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (round(worth(k), 6), -k))] if rule else rule


def learn(rows: list[Row]) -> list[list[Condition]]:
    """The list of rules for junk, from rows of statistics with their quality (0 or 1)."""
    measured = [_measured(r) for r in sorted(rows, key=lambda r: (r["doc_id"], r["quality"]))]
    grow, prune = [r for i, r in enumerate(measured) if i % 3], [r for i, r in enumerate(measured) if not i % 3]
    rules: list[list[Condition]] = []
    while len(rules) < RULES:
        rule = _prune(_grow(grow), prune)
        bad = sum(r["bad"] and _holds(r, rule) for r in prune)
        good = sum(not r["bad"] and _holds(r, rule) for r in prune)
        if not rule or bad < LEAST_COVER or bad < LEAST_PRECISION * (bad + good):
            break
        rules.append(rule)
        grow, prune = [r for r in grow if not _holds(r, rule)], [r for r in prune if not _holds(r, rule)]
    return rules


def as_column(rules: list[list[Condition]]) -> Column:
    """The number (from 1) of the first rule that rejects a row of statistics, else 0."""
    out = F.lit(0)
    for i in range(len(rules), 0, -1):
        test = F.lit(True)
        for m, op, x in rules[i - 1]:
            value = F.col(MEASURES[m][0]) / F.greatest(F.col(MEASURES[m][1]), F.lit(1))
            test = test & ((value >= x) if op == ">=" else (value < x))
        out = F.when(test, F.lit(i)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[list[Condition]]:
    known = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    own = docs.select(column(id_col).cast("bigint").alias("doc_id"), as_text(text_col).alias("text")).join(F.broadcast(known), "doc_id")  # at most SAMPLE rows are broadcast
    own = own.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # a repeated document counts once
    return learn(statistics(own, "doc_id", "text", "quality").collect())


def judged(docs: DataFrame, rules: list[list[Condition]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The statistics, base_failed, the rule that rejects (0: none) and kept."""
    out = statistics(spread(docs), id_col, text_col)
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    out = out.withColumn("rule", as_column(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
