"""BPE encoding and decoding through a table of distinct words.

1. Texts are split into pre-tokens, block by block (some megabytes of text). A block keeps its distinct
   words and, for each text, the positions' word numbers; blocks are written once, bucketed by block.
2. The words of all blocks are dealt out by hash; each distinct word of the corpus is encoded once, in the
   one group that holds it, and its ids go back to every block that has the word. A block sends a word once
   however often it occurs, so frequent words do not make large groups.
3. Each block finds its words' groups again, joins the ids back by position, and decodes them by a lookup in the id-to-piece
   table, a broadcast join whose small side has the vocabulary's size.

Rows: one for each input row, repeated rows included; any other columns are left out, whatever their names.
A null or empty text has 0 tokens and the hashes of empty strings. A null id stays null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import Rolling, as_text, bucketed, buckets, chunks, column, ends, pack, rows_of, tidy, unpack
from panelmill.llm.pretokens import splitter

#: Words (of blocks, repeats between blocks included) that one task encodes.
WORDS_A_GROUP = 400_000

BYTES = Rolling(256, 21)

_BLOCK = "block bigint, ids array<bigint>, places array<bigint>, offsets binary, codes binary, words binary, n_words bigint"


def _blocks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        split = splitter(path).split
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                s = split(data, offsets)
                often = np.argsort(-np.bincount(s.codes, minlength=len(s.words)), kind="stable")  # small codes for frequent words
                rank = np.empty(len(often), np.uint32)
                rank[often] = np.arange(len(often), dtype=np.uint32)
                words = [s.words[i].encode() for i in often.tolist()]
                sizes = np.array([len(w) for w in words], np.uint32)
                yield pa.RecordBatch.from_pydict({
                    "block": [block],
                    "ids": [rows.column(0).to_pylist()],
                    "places": [rows.column(2).to_pylist()],
                    "offsets": [pack(s.offsets)],
                    "codes": [pack(rank[s.codes])],
                    "words": [pack(sizes, b"".join(words))],
                    "n_words": [len(words)],
                }, pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("places", pa.list_(pa.int64())), ("offsets", pa.binary()), ("codes", pa.binary()), ("words", pa.binary()), ("n_words", pa.int64())]))
                block += 1

    return run


def _dealt(sizes: np.ndarray, raw: bytes, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each word, by a hash of its bytes, and the words' order by group."""
    at = ends(sizes)
    hashes = BYTES.slices(BYTES.sums(np.frombuffer(raw, np.uint8)), at[:-1], at[1:])
    group = ((hashes >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)
    return group, np.argsort(group, kind="stable")


def _deal(groups: int):
    """Each block's words by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sizes, raw = unpack(value)
                group, order = _dealt(sizes, raw, groups)
                bounds = ends(sizes).tolist()
                raw = b"".join([raw[bounds[i] : bounds[i + 1]] for i in order.tolist()])
                group, sizes = group[order], sizes[order]
                at = ends(sizes)
                has, first = np.unique(group, return_index=True)
                bounds = np.append(first, len(group))
                yield pa.RecordBatch.from_arrays([
                    pa.array(has.astype(np.int64)),
                    pa.array([block] * len(has), pa.int64()),
                    pa.array([pack(sizes[x:y], raw[at[x] : at[y]]) for x, y in zip(bounds, bounds[1:], strict=False)], pa.binary()),
                ], ["part", "block", "words"])

    return run


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for what follows U+00FF."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _encode(path: str):
    def run(table: pa.Table) -> pa.Table:
        owner = splitter(path)
        model, letters = owner.tokenizer.model, byte_letters()
        special = {s: owner.tokenizer.token_to_id(s) for s in owner.special}
        known: dict[bytes, list[int]] = {}
        out = []
        for value in table.column("words").to_pylist():
            sizes, raw = unpack(value)
            at = ends(sizes).tolist()
            found = []
            for x, y in zip(at, at[1:], strict=False):
                word = raw[x:y]
                ids = known.get(word)
                if ids is None:
                    text = word.decode()
                    ids = known[word] = [special[text]] if text in special else [t.id for t in model.tokenize(word.decode("latin-1").translate(letters))]
                found.append(ids)
            out.append(pack(np.array([len(x) for x in found], np.uint32), np.array([i for x in found for i in x], np.uint32)))
        return pa.table({"block": table.column("block"), "part": table.column("part"), "encoded": pa.array(out, pa.binary())})

    return run


def pieces(path: str) -> list[bytes]:
    """The id-to-piece table of a byte-level vocabulary."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    back = {c: b for b, c in byte_letters().items()}
    special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    out = [b""] * (max(tokenizer.get_vocab().values()) + 1)
    for piece, i in tokenizer.get_vocab().items():
        out[i] = special[i] if i in special else bytes(back[c] for c in piece)
    return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _finish(path: str, groups: int, keep_ids: bool, keep_text: bool, keep_place: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pieces(path)
        for row in rows_of(batches):
            parts = [unpack(x["encoded"]) for x in sorted(row["encoded"] or [], key=lambda x: x["part"])]
            sizes = np.concatenate([x[0] for x in parts] or [np.zeros(0, np.uint32)])
            flat = np.concatenate([x[1] for x in parts] or [np.zeros(0, np.uint32)]).tolist()
            if len(sizes) != row["n_words"]:
                raise ValueError(f"block {row['block']}: {len(sizes)} of {row['n_words']} words are encoded")
            at = ends(sizes).tolist()
            codes = unpack(row["codes"])[0]
            words: list[list[int]] = [[]] * len(sizes)
            for j, i in enumerate(_dealt(*unpack(row["words"]), groups)[1].tolist()):
                words[i] = flat[at[j] : at[j + 1]]
            shown = [",".join(map(str, w)) for w in words]
            offsets = unpack(row["offsets"])[0].tolist()
            counts, ids_hash, text_hash, all_ids, all_texts = [], [], [], [], []
            for x, y in zip(offsets, offsets[1:], strict=False):
                own = codes[x:y].tolist()
                ids = [i for c in own for i in words[c]]
                text = b"".join([piece[i] for i in ids]).decode("utf-8", "replace")
                counts.append(len(ids))
                ids_hash.append(hashlib.sha256(",".join([shown[c] for c in own]).encode()).hexdigest())
                text_hash.append(hashlib.sha256(text.encode()).hexdigest())
                all_ids.append(ids if keep_ids else None)
                all_texts.append(text if keep_text else None)
            out = [pa.array(row["ids"], pa.int64()), pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(text_hash)]
            schema = _SCHEMA
            if keep_ids:
                out.append(pa.array(all_ids, pa.list_(pa.int32())))
                schema = schema.append(pa.field("token_ids", pa.list_(pa.int32())))
            if keep_text:
                out.append(pa.array(all_texts, pa.string()))
                schema = schema.append(pa.field("decoded", pa.string()))
            if keep_place:
                out.append(pa.array(row["places"], pa.int64()))
                schema = schema.append(pa.field("position", pa.int64()))
            yield pa.RecordBatch.from_arrays(out, schema=schema)

    return run


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, keep_text: bool = False, position: Column | None = None) -> DataFrame:
    """Every text's tokens (token_ids, if kept), and the text that they decode to (decoded, if kept).

    path: a byte-level BPE file of the tokenizers library, there on every machine. position: a number that each row keeps,
    such as its place in the training order.
    """
    place = F.lit(None) if position is None else position
    docs = docs.select(column(id_col).cast("bigint").alias("doc_id"), as_text(text_col).alias("text"), place.cast("bigint").alias("place"))
    blocks = bucketed(docs.mapInArrow(tidy(_blocks(path)), _BLOCK), "bpe", "block", buckets(docs))
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    groups = max(1, -(-total // WORDS_A_GROUP))
    dealt = blocks.select("block", "words").mapInArrow(tidy(_deal(groups)), "part bigint, block bigint, words binary")
    encoded = dealt.groupBy("part").applyInArrow(tidy(_encode(path)), "block bigint, part bigint, encoded binary")
    encoded = encoded.groupBy("block").agg(F.collect_list(F.struct("part", "encoded")).alias("encoded"))
    columns = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * keep_ids + ", decoded string" * keep_text + ", position bigint" * (position is not None)
    joined = blocks.select("block", "ids", "places", "offsets", "codes", "words", "n_words").join(encoded, "block", "left")
    return joined.mapInArrow(tidy(_finish(path, groups, keep_ids, keep_text, position is not None)), columns)
