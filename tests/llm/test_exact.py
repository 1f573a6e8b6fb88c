"""Words that collide under polynomial hashes, and columns named as the operators' own."""

import public_tokenizers as P
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelmill.llm import bpe, common, mixing, quality, similar, substrings, token_counts
from test_llm import brute_linked, brute_removed, key, rows_of, sha


def thue_morse(letters, length, flip=0):
    return "".join(letters[bin(i).count("1") % 2 ^ flip] for i in range(length))


@pytest.fixture(scope="module")
def colliding(spark):
    rows, i = [], 0
    for power in (10, 11, 12):
        for flip in (0, 1):
            rows += [(i := i + 1, "c " + thue_morse("ab", 2**power, flip)), (i := i + 1, thue_morse("ea", 2**power, flip) + " c")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("parts", [1, 5])
def test_thue_morse(colliding, parts):
    """In one block and worker, and in several."""
    df = colliding.repartition(parts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {i: t.encode(text, add_special_tokens=False).ids for i, text in rows}
    assert sorted(tuple(r)[:3] for r in bpe.round_trip(df, P.path("byte_bpe_50k.json")).collect()) == sorted((i, len(x), sha(",".join(map(str, x)))) for i, x in ids.items())
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    assert sorted((r.doc_id, r.n_tokens) for r in token_counts.token_counts(df, P.path("word_bpe_49k.json")).collect()) == sorted((i, len(t.encode(text, add_special_tokens=False).ids)) for i, text in rows)
    assert rows_of(similar.linked(df)) == sorted(brute_linked(rows), key=key)
    assert rows_of(substrings.remove_repeats(df)) == sorted(brute_removed(rows), key=key)


def test_grouped():
    """Hashes that are all equal: the symbols decide."""
    rng = np.random.default_rng(1)
    data = rng.integers(0, 2, 500).astype(np.uint8)
    first = rng.integers(0, 490, 300)
    last = first + rng.integers(0, 6, 300)
    codes, where = common.grouped(data, first, last, np.zeros(300, np.uint64))
    spelled = [data[x:y].tobytes() for x, y in zip(first, last, strict=True)]
    assert len({(c, s) for c, s in zip(codes.tolist(), spelled, strict=True)}) == len(set(spelled)) == len(where) == len(set(codes.tolist()))
    assert all(spelled[where[c]] == s for c, s in zip(codes.tolist(), spelled, strict=True))


def test_shingles_with_one_hash(monkeypatch):
    """Every word hash is equal: shingles still differ by their words."""
    monkeypatch.setattr(similar, "content_hashes", lambda data, first, last, seed: np.ones(len(first), np.uint64))
    texts = [b"a b c d e f g", b"a b c d e x y", b"p q", b"q p", b""]
    tokens, at = similar.shingles(np.frombuffer(b"".join(texts), np.uint8), common.ends([len(x) for x in texts]), across=True)
    sets = [set(tokens[x:y].tolist()) for x, y in zip(at, at[1:], strict=False)]
    assert [len(x) for x in sets] == [3, 3, 1, 1, 0] and len(sets[0] & sets[1]) == 1 and not sets[2] & sets[3]


def test_clashing_names(spark):
    names = ["_id", "_key", "_k", "_position", "_positions", "_source", "row", "others", "block", "first", "label", "sid", "weight", "digest", "a.b"]
    rows = [(i if i % 7 else None, "word " * (i % 3) + f"{'many words that are alike here ' * 4}{i % 4}" if i % 5 else None, "s", *range(100, 100 + len(names))) for i in range(30)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    odd = df.withColumnRenamed("text", "body")
    for out in (mixing.mixed_rows(df), similar.linked(df, keep_one=True), substrings.remove_repeats(df, keep_rows=True), quality.accepted(df, None)):
        assert out.columns == df.columns and out.count() > 0
        assert {tuple(r)[3:] for r in out.collect()} == {tuple(range(100, 100 + len(names)))}
    for out in (mixing.mixed_rows(odd, text_col="body"), similar.linked(odd, text_col="body", keep_one=True), substrings.remove_repeats(odd, text_col="body", keep_rows=True), quality.accepted(odd, None, text_col="body")):
        assert out.columns == odd.columns and out.count() > 0
    assert similar.linked(df).count() == substrings.remove_repeats(df).count() == mixing.taken(df).count() == len(rows)
    assert mixing.taken(df.where(F.lit(False))).count() == 0


def test_work_is_dropped(spark):
    """The pipeline leaves the last mix and the last stage's tables; what is dropped is gone from the shared folder."""
    import corpus_pipeline

    since = common.made()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    n = out.count()
    assert n > 0 and common.made() - since <= 3
    tables = [t.name for t in spark.catalog.listTables() if t.name.startswith("panelmill_")]
    common.drop_work(spark, since)
    assert common.made() == since and len([t for t in spark.catalog.listTables() if t.name.startswith("panelmill_")]) < len(tables)
