"""The operators of the llm subpackage against brute force, the libraries and held-out labels."""

import collections
import fractions
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelmill.llm.common import written
from panelmill.llm import bpe, language, mixing, quality, queries, rules, similar, substrings, threads, token_counts, topk

SF = "/root/testdata/sf0.001"
WORD = "[^\x20\x09-\x0d]+"
ODD = ["", None, " \n", "a", "one two", "One  two", "it's 'll x's ''s", "<|endoftext|> a<|startoftext|>b", "é中²Ⅷ🙂 ΣΑΣ İ\x85x", "a\x00b", "x " * 3000, "ab" * 2000]


def key(t):
    return tuple((v is None, v if v is not None else 0) for v in t)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in all columns, empty and odd texts, repeated rows, and extra columns with clashing names."""
    rows = [(i if i % 5 else None, t, None, "s" if i % 2 else None, 1, 2, 3) for i, t in enumerate(ODD * 3)] + [(7, "a", "en", "s", 1, 2, 3)] * 3
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, block bigint, n_tokens bigint, size bigint")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def sha(s):
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def test_round_trip(odd, empty, docs):
    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    for df in (odd, docs):
        want = []
        for r in df.collect():
            ids = t.encode(r.text or "", add_special_tokens=False).ids
            want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
        assert rows_of(bpe.round_trip(df, path)) == sorted(want, key=key)
    kept = bpe.round_trip(odd, path, keep_ids=True, keep_text=True).where("doc_id = 7").collect()
    assert all(r.decoded == t.decode(r.token_ids, skip_special_tokens=False) for r in kept)
    assert bpe.round_trip(empty, path).count() == 0


def test_token_counts(odd, empty, docs):
    path = P.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    for df in (odd, docs):
        want = [(r.doc_id, len((r.text or "").encode()), n, n > 2048) for r in df.collect() for n in [len(t.encode(r.text or "", add_special_tokens=False).ids)]]
        assert rows_of(token_counts.token_counts(df, path)) == sorted(want, key=key)
    assert token_counts.token_counts(empty, path).count() == 0


def test_language(spark, odd, empty):
    found = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").where("held_out").select((F.col("lang_pred") == F.col("lang")).alias("x")).collect()
    assert sum(r.x for r in found) > 0.97 * len(found) > 0
    model = language.fit(odd, F.lit(True))
    out = language.identify(odd, model, F.lit(None).cast("boolean")).collect()
    assert len(out) == odd.count() and not any(r.held_out for r in out) and all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in out} == {"en", "und"}
    assert language.identify(empty, language.fit(empty, F.lit(True)), F.lit(False)).count() == 0


def brute_targets(sizes):
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    capped, budget = {}, 1.5 * sum(sizes.values())
    while True:
        free = [n for n in names if n not in capped]
        left, w = budget - sum(capped.values()), sum(weight[n] for n in free)
        over = {n: 2.0 * sizes[n] for n in free if left * weight[n] / w > 2.0 * sizes[n]}
        if not over:
            return capped | {n: left * weight[n] / w for n in free}
        capped |= over


def test_mix(spark, odd, empty, docs):
    for df in (odd, docs):
        out = mixing.taken(df).collect()
        assert len(out) == df.count() and all(0 <= r.taken <= 2 * r.size for r in out)
        sizes = collections.Counter()
        for r in df.collect():
            sizes[r.source] += len(re.findall(WORD, r.text or ""))
        want = brute_targets(sizes)
        got = {(r.source_size, round(r.target, 6)) for r in out}
        assert got == {(sizes[n], round(want[n], 6)) for n in sizes}
        assert sorted(map(tuple, out), key=key) == rows_of(mixing.taken(df))
    assert mixing.mixed_rows(docs).count() == sum(1 if r.taken <= r.size else 2 for r in mixing.taken(docs).collect() if r.taken or not r.size)
    assert mixing.mixed_rows(odd).columns == odd.columns
    assert mixing.taken(empty).count() == 0


def test_mix_positions(spark):
    """Sources come near their targets; a place is the words of the whole mix before it; weights change over time."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.plan(df).collect()
    most = max(r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= 2 * most
    placed = sorted((p, r.size, r.source) for r in rows for p in r.positions)
    before = 0
    for p, size, _ in placed:
        assert abs(p - before) <= 12 * most
        before += size
    assert abs(before - sum({r.source: r.target for r in rows}.values())) <= 12 * most
    heavy = sorted({r.source for r in rows if r.source is not None})[0]
    half = [sum(size for p, size, s in placed if s == heavy and (p < before / 2) == early) for early in (True, False)]
    assert half[0] > 1.1 * half[1]  # the schedule of the heaviest source falls
    df = df.repartition(7)
    assert sorted((r.doc_id, r.taken, r.position) for r in mixing.taken(df).collect()) == sorted((r.doc_id, r.size * r.copies, r.positions[0] if r.positions else None) for r in rows for _ in range(r.n_rows))


def test_quality(spark, odd, empty):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = queries.op4_quality_score(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in found) > 0.9 * len(found) > 0
    out = quality.score(odd, None, F.lit(None).cast("boolean")).collect()
    assert len(out) == odd.count() and {r.score for r in out} == {0.5}
    model = quality.fit(odd, labels.limit(5).unionAll(spark.createDataFrame([(7, 1, 0), (8, 0, 0), (None, 1, 1), (9, None, 0)], labels.schema)), F.lit(True))
    assert all(0 <= r.score <= 1 for r in quality.score(odd, model, F.lit(False)).collect())
    assert quality.accepted(odd, model).columns == odd.columns
    assert quality.score(empty, quality.fit(empty, labels, F.lit(True)), F.lit(False)).count() == 0


def marked(rows, length=50):
    """(id, bytes, which of them are covered by a string that an earlier document has)."""
    last, first = 2**63 - 1, {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, last), last if i is None else i)
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < (last if i is None else i):
                gone[p : p + length] = b"\1" * length
        yield i, b, gone


def left(b, gone):
    return bytes(x for x, g in zip(b, gone, strict=True) if not g)


def brute_removed(rows):
    for i, b, gone in marked(rows):
        yield i, len(b), sum(gone), sum(1 for j in range(len(b)) if gone[j] and (not j or not gone[j - 1])), sha(left(b, gone))


def brute_kept(rows):
    """Whole characters of what is left: those that a removal cuts in two go."""
    for i, b, gone in marked(rows):
        yield i, left(b, gone).decode(errors="ignore")


def similar_texts(spark):
    rng = random.Random(1)
    base = [[rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(60)] for _ in range(5)]

    def near():
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(60)] = rng.choice("xyz")
        return " ".join(words)

    rows = [(rng.choice([None, *range(60)]), rng.choice([None, "", " \n", "one two", "One  two", "a" * rng.randrange(200), near(), near(), near()])) for _ in range(300)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("hot", [5000, 2])
def test_repeats(spark, odd, empty, docs, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    for df in (odd, similar_texts(spark)) + ((docs,) if hot > 2 else ()):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        assert rows_of(substrings.remove_repeats(df)) == sorted(brute_removed(rows), key=key)
    kept = substrings.remove_repeats(odd, keep_rows=True)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert substrings.remove_repeats(empty).count() == 0


def brute_linked(rows):
    sets = []
    for _, t in rows:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 80 * (len(x) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, len(sets[k]), least.get(root(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("limit", [4096, 10])
def test_similar(spark, odd, empty, docs, monkeypatch, limit):
    monkeypatch.setattr(similar, "LIMIT", limit)
    for df in (odd, similar_texts(spark)) + ((docs,) if limit > 10 else ()):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        assert rows_of(similar.linked(df)) == sorted(brute_linked(rows), key=key)
    assert similar.linked(odd, keep_one=True).columns == odd.columns
    assert similar.linked(empty).count() == 0


def test_threads(spark):
    rows = [(1, 0, "user", "Hello there\nHow are you?"), (1, 1, "assistant", "I am fine.\n\nAnd you?"), (1, 2, "user", "> Hello  there\n> how are you?\nAlso good"), (1, 3, "user", "> > How are you?\n> I am fine.\nok\n> And you?\nyes"), (None, 2, None, ">x"), (2, None, "user", None), (2, 0, "user", ""), (2, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("message", F.lit(1))
    out = {(r.conv_id, r.turn): r for r in threads.threads(df).collect()}
    assert (out[1, 2].message, out[1, 2].answers, out[1, 2].n_linked) == ("Also good", 0, 1)
    assert (out[1, 3].message, out[1, 3].answers, out[1, 3].quote_level, out[1, 3].n_linked) == ("ok\nyes", 1, 2, 3)
    assert threads.threads(df).count() == len(rows)
    real = spark.read.parquet(f"{SF}/conversations.parquet")
    assert threads.threads(real).count() == real.count()
    assert threads.threads(df.limit(0)).count() == 0


def test_partial_quotes(spark):
    three = "A one\nA two\nA three"
    paragraphs = "P one\n\nP two\nand more\n\nP three"
    cases = [
        ([three, "other", "> A two\n> A three\nreply"], 0, 1),  # two of three lines
        ([paragraphs, "other", "> P two\n> and more\n>\n> P three\nreply"], 0, 1),  # two of three paragraphs
        ([three, paragraphs, "other", "> P one\n>\n> unknown\nreply"], 1, 1),  # a paragraph, the rest is new
        ([three, "the second message", "other", "> A one\n> the second message\nreply"], 1, 1),  # text of two messages
        ([three, "A two", "A three", "> A two\n> A three\nreply"], 0, 1),  # the whole run goes before later single lines
        (["a much longer line\nx", "short\ny", "other", "> a much longer line\n> new\n> short\nreply"], 0, 1),  # the longest
        ([three, "other", "> A two A three\n> new\nreply"], 1, 0),  # no line, paragraph or run
        ([three, "other", "> \nreply"], 1, 0),
        ([three, paragraphs, "> A two\n> A three\nso\n> P two\n> and more\nreply"], 1, 2),
    ]
    rows = [(c, turn, "user", text) for c, (texts, _, _) in enumerate(cases) for turn, text in enumerate(texts)]
    out = {(r.conv_id, r.turn): (r.answers, r.n_linked) for r in threads.threads(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert len(out) == len(rows)
    assert [out[c, len(texts) - 1] for c, (texts, _, _) in enumerate(cases)] == [x[1:] for x in cases]


def brute_threads(turns):
    """turns {turn: text} to {turn: (answers, place, depth)}: quotes of one whole line, the walk by recursion."""
    order, answers = sorted(turns), {}
    for n, t in enumerate(order):
        asked = [x[2:].lower() for x in turns[t].split("\n") if x.startswith("> ")]
        hits = [max([u for u in order[:n] if q in [x.lower() for x in turns[u].split("\n") if not x.startswith(">")]], default=None) for q in asked]
        answers[t] = max([h for h in hits if h is not None], default=order[n - 1] if n else None)
    out = {}

    def walk(t, depth):
        out[t] = (answers[t], len(out), depth)
        for u in order:
            if answers[u] == t:
                walk(u, depth + 1)

    if order:
        walk(order[0], 0)
    return out


@pytest.mark.parametrize("span", [4096, 3])
def test_reply_order(spark, monkeypatch, span):
    """Random quotes of single lines: links, places and depths against a recursion, in one range of turns and in many."""
    monkeypatch.setattr(threads, "SPAN", span)
    rng, rows = random.Random(5), []
    talks = {c: {} for c in range(12)}
    for c, talk in talks.items():
        for n in range(rng.choice((0, 1, 2, 30))):
            t = n * rng.choice((1, 2)) if c % 2 else n
            quoted = "".join(f"> line {rng.randrange(max(n, 1))}\n" for _ in range(rng.choice((0, 0, 1, 2)))) if c % 3 else ""
            talk[t] = talk.get(t) or f"{quoted}line {n}"
        rows += [(c, t, "user", text) for t, text in talk.items()]
    out = threads.threads(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = {(r.conv_id, r.turn): (r.answers, r.place, r.depth) for r in out.collect()}
    assert got == {(c, t): x for c, talk in talks.items() for t, x in brute_threads(talk).items()}
    assert [(r.conv_id, r.place) for r in out.collect()] == sorted((c, p) for (c, _), (_, p, _) in got.items())
    texts = collections.defaultdict(dict)
    for r in threads.conversations(out, 7).collect():
        texts[r.conv_id][r.part] = r.chat
    chats = {(r.conv_id, r.place): r.chat for r in out.collect()}
    for c, talk in talks.items():
        assert "\n".join(x for _, x in sorted(texts[c].items())) == "\n".join(chats[c, p] for p in range(len(talk)))


def brute_rules(t):
    t = t or ""
    w = re.findall(WORD, t)
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, lines = set(), 0
    for x in t.split("\n"):
        if re.search(WORD, x):
            lines += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), lines, len(again), len(w) < 10 or 100 * len(again) > 20 * len(w)


def test_rules(spark, odd, empty, docs):
    for df in (odd, docs):
        out = rules.judged(df, []).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert rows_of(out) == sorted(((r.doc_id, *brute_rules(r.text)) for r in df.collect()), key=key)
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = queries.op9_quality_rules(spark, sf).where("not base_failed").join(labels, "doc_id").collect()
    assert sum(r.kept == bool(r.quality) for r in found) > 0.95 * len(found) > 0
    assert rules.judged(empty, rules.fit(empty, labels)).count() == 0


def test_top_k(spark):
    c = duckdb.connect()
    c.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert rows_of(queries.op10_exact_topk(spark, SF)) == sorted(c.execute(queries.TOP_K).fetchall(), key=key)
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, None]), (3, None), (4, [nan, 1.0]), (5, [-1.0, 0.5, 3.0]), (None, [1.0, 1.0]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("id", F.lit(1))
    got = rows_of(topk.top_k(df, F.col("vec_id") % 50 == 0))
    assert got == [(0, 1, 1, 327680), (0, 2, 5, 0), (0, 3, 6, 0)]  # of equal scores the smaller id
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_repeated_ids(spark):
    """Many vectors under the query's id, and ids with several vectors of one score."""
    rows = [(0, [1.0, 0.0]), *[(0, [2.0 + i, 1.0]) for i in range(30)], *[(1, [0.75, float(i)]) for i in range(20)], *[(i, [i / 64, 0.0]) for i in range(2, 40)]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = rows_of(topk.top_k(df, (F.col("vec_id") == 0) & (F.get("embedding", F.lit(0)) == 1.0)))
    best = sorted({(-int(x * 256) * 256, i) for i, (x, _) in rows if i})[:5]
    assert got == [(0, n + 1, i, -s) for n, (s, i) in enumerate(best)]


def brute_top(rows, k=5):
    """rows (id, vector): the best k of each id divisible by 50, in whole numbers."""
    top = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    out = []
    for q in sorted({i for i, _ in rows if i % 50 == 0}):
        found = {(-sum(a * b for a, b in zip(map(math.floor, (256 * fractions.Fraction(c) for c in u)), map(math.floor, (256 * fractions.Fraction(c) for c in v)), strict=False)), j) for i, u in rows if i == q for j, v in rows if j != q}
        out += [(q, n + 1, j, top(-s)) for n, (s, j) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("block", [8192, 40])
def test_top_k_trees(spark, monkeypatch, block):
    """Clusters, copies, ties, and scores beyond floats and bigints, in one block and over cells and blocks."""
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", block // 8)
    monkeypatch.setattr(topk, "CELLS", 7)
    monkeypatch.setattr(topk, "LEAF", 8)
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(9)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centres[i % 9]]) for i in range(400)] + [(i, centres[0]) for i in range(400, 560)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert rows_of(topk.top_k(df, F.col("vec_id") % 50 == 0)) == sorted(brute_top(rows))
    large = [(i, [rng.choice((1, -1)) * 2.0 ** rng.choice((0, 20, 40, 60, 200)) for _ in range(3)]) for i in range(120)] + [(200, [1e308, -1e308, 3.0]), (201, [1.7e308] * 3), (202, [-1.7e308] * 3), (250, [2.0**60, 1.0, -1.0])]
    df = spark.createDataFrame(large, "vec_id bigint, embedding array<double>")
    assert rows_of(topk.top_k(df, F.col("vec_id") % 50 == 0)) == sorted(brute_top(large))


def test_cover_tree():
    """Children cover their parent's points within its radius over BASE, and their centres lie farther apart."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.01, (300, 3)) for c in range(12)])
    nodes, inner = [topk.cover_tree(x, 256)], 0
    while nodes:
        node = nodes.pop()
        assert np.linalg.norm(x[node.members] - x[node.centre], axis=1).max() <= node.radius + 1e-12
        if node.children:
            inner += 1
            centres = np.array([x[c.centre] for c in node.children])
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2) + 999 * np.eye(len(centres))
            assert apart.min() > node.separation and all(c.radius <= node.radius / topk.BASE for c in node.children)
            assert sorted(np.concatenate([c.members for c in node.children]).tolist()) == sorted(node.members.tolist())
        nodes += node.children
    assert inner > 3
    q = x[::50]
    search = topk.Search(q, np.arange(len(q)) * 50, x, np.arange(len(x)), 5)
    assert search.leaves < len(q) * len(x) / 2  # the rest is pruned


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    c = duckdb.connect()
    for table in ("documents", "embeddings", "clicks", "benchmark"):
        c.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    want = c.execute(queries.oracle_sql()[name])
    names = [x[0] for x in want.description]
    got = queries.queries()[name](spark, sf)
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.select(names)) == sorted(want.fetchall(), key=key)


def test_pipeline(spark):
    """Each stage against brute force on what its predecessor kept; the classifier against held-out labels."""
    import corpus_pipeline

    tables = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(written(stage(spark, tables[-1], SF), "test"))
    for df in tables[:-1]:
        assert df.columns == tables[0].columns
    docs, good, single, cut, mix, tokens = [df.collect() for df in tables]

    assert set(good) <= set(docs) and 0 < len(good) < len(docs)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held_out = {r.doc_id: labels[r.doc_id] for r in docs if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    kept = {r.doc_id for r in good}
    assert sum((i in kept) == bool(x) for i, x in held_out.items()) > 0.8 * len(held_out) > 0

    alike = brute_linked([(r.doc_id, r.text) for r in good])
    assert sorted(r.doc_id for r in single) == sorted(i for i, _, component in alike if i == component)

    want = {i: text for i, text in brute_kept([(r.doc_id, r.text) for r in single])}
    assert {r.doc_id: (r.text, r.n_chars) for r in cut} == {i: (t, len(t)) for i, t in want.items()}

    copies = {r.doc_id: r.copies for r in mixing.plan(tables[3]).collect()}
    assert collections.Counter(r.doc_id for r in mix) == collections.Counter({i: n for i, n in copies.items() if n})
    assert set(mix) <= set(cut)

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = []
    for r in mix:
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids)))))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in tokens) == sorted(want)
    order = sorted((p, r.key, r.doc_id) for r in mixing.plan(tables[3]).collect() for p in r.positions)
    assert [r.doc_id for r in sorted(tokens, key=lambda r: r.position)] == [i for _, _, i in order]
    assert len({r.position for r in tokens}) == len(tokens)


def test_pipeline_odd(spark, odd, empty, tmp_path):
    """Nulls, odd texts, repeated rows, no rows, and columns with the operators' names."""
    import corpus_pipeline

    labels = spark.createDataFrame([(7, 1, 0), (8, 0, 0), (None, 1, 1), (9, None, 0), (1, 0, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for df in (odd.withColumn("_id", F.lit(5)).withColumn("position", F.lit(6)), empty, odd.where("text is null"), odd.where("doc_id is null")):
        docs = written(df, "odd")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = written(stage(spark, docs, str(tmp_path)), "odd")
            assert after.columns == df.columns
            docs = after
            if "_id" in df.columns:
                assert {(r._id, r.position) for r in docs.collect()} <= {(5, 6)}
        tokens = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert tokens.count() == docs.count()
