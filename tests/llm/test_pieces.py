"""SentencePiece encoding by backtracking against the library, and the rule that it rests on against merging."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from panelmill.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def _texts() -> list:
    rng = random.Random(7)
    known = list(pieces.vocabulary(PATH).id)
    short = [s for s in known if len(s) <= 3 and s.isascii()]
    letters = " ▁abcdehilnorst.\n0é́😀世\0"
    out = [None, "", " ", "  a", "a ", "\n", "a\0b", "▁x", "x ▁ y", "�", "😀é", "<s>", "<0x41>", "</s>a", "a　b", " " * 100, " " * 17 + "foo", "x" + " " * 33, "a" * 5000, "ab" * 3000, "▁▁", "😀" * 90, "́" * 9, "a " * 3000]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(1500)]
    out += ["".join(rng.choice(known) for _ in range(rng.randint(1, 20))) for _ in range(1500)]
    out += ["".join(rng.choice(short) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    return out


def test_ids_and_texts_are_the_librarys(spark, library):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in pieces.round_trip(docs, PATH, keep_ids=True, keep_text=True).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        shown = library.decode(ids)
        assert got[i].token_ids == ids, text
        assert got[i].decoded == shown
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(shown.encode()).hexdigest()


def test_every_document_as_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.token_ids for r in pieces.round_trip(docs, PATH, keep_ids=True).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == library.encode(r.text or "", add_bos=True, add_eos=True)


def test_the_check_of_neighbours_is_merging():
    owner = pieces.vocabulary(PATH)
    rng = random.Random(3)
    some = rng.sample(sorted(owner.id), 3000) + [s for s in owner.id if set(s) == {"▁"}] + list("é世😀")
    number = {s: owner.id.get(s, owner.size + ord(s[0])) for s in some}
    for _ in range(6000):
        a, b = rng.choice(some), rng.choice(some)
        if len(a) > 1 and owner.merges(a)[0] != [a] or len(b) > 1 and owner.merges(b)[0] != [b]:
            continue
        assert owner.may_follow(number[a] * pieces.WIDE + number[b]) == (owner.merges(a + b)[0] == [a, b]), (a, b)


def test_a_unit_alone_and_abreast():
    owner = pieces.vocabulary(PATH)
    rng = random.Random(5)
    units = ["▁" + "".join(rng.choice("abcdeinorst") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    edges = np.cumsum([0] + [len(u) + 1 for u in units])
    inside = np.ones(edges[-1], bool)
    inside[edges[1:] - 1] = False
    ids, first = owner.matches(owner.gap.join([*units, ""]), inside)
    length = np.where(ids < owner.size, owner.lengths[np.minimum(ids, owner.size - 1)], 1)
    flat, counts = owner.abreast(edges[:-1].copy(), edges[1:] - 1, ids, first, length)
    at = np.cumsum(np.concatenate([[0], counts]))
    for i, u in enumerate(units):
        alone = owner.backtrack(int(edges[i]), int(edges[i + 1]) - 1, ids, first, length)
        assert alone == flat[at[i] : at[i + 1]].tolist()
        assert [owner.letters(t) for t in alone] == owner.merges(u)[0]


def test_odd_tables(spark):
    rows = [(1, "b", 9), (1, "b", 9), (None, "c", 1), (2, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens bigint").withColumnRenamed("n_tokens", "ids_sha256")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in pieces.round_trip(docs, PATH).collect())
    assert got == [(False, 1, 3), (False, 1, 3), (False, 2, 2), (True, 0, 3)]
    assert pieces.round_trip(docs.limit(0), PATH).count() == 0
    empty = spark.createDataFrame([(1, None)], "doc_id int, text void")
    assert pieces.round_trip(empty, PATH).first().n_tokens == 2


def test_one_long_text(spark, library):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 9))) for _ in range(800_000))
    assert len(text) > pieces.LONG and len(text.encode()) > 4 << 20
    docs = spark.createDataFrame([(1, text), (2, "x" * 200_000)], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in pieces.round_trip(docs, PATH).collect()}
    assert got == {1: len(library.encode(text)) + 2, 2: len(library.encode("x" * 200_000)) + 2}
