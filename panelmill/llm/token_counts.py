"""Token counts with a whole-token shortcut.

Offline, each vocabulary string that can end a word is encoded alone; those that give one token are proven.
A pre-token that is a proven string counts 1 without merging; only the rest is merged, each distinct word
once for a worker while its bounded memory of words lasts. Texts stay where they are: nothing is shuffled.

Rows: one for each input row, repeated rows included; other columns are left out. A null or empty text has
0 bytes and 0 tokens. Special strings inside a text count one token each, as is the library's default.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelmill.llm.bpe import byte_letters
from panelmill.llm.common import as_text, chunks, column, ends, spread, tidy
from panelmill.llm.pretokens import splitter

#: Merged words whose counts a task remembers, by the word itself.
REMEMBERED = 400_000


@functools.lru_cache(4)
def whole_tokens(path: str) -> frozenset[str]:
    """The proven strings, in the byte-level alphabet and without the mark of a word's end."""
    model = splitter(path).tokenizer.model
    suffix = model.end_of_word_suffix or ""
    found = (s.removesuffix(suffix) for s in splitter(path).tokenizer.get_vocab(with_added_tokens=False) if s.endswith(suffix))
    return frozenset(s for s in found if s and len(model.tokenize(s)) == 1)


def _count(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = splitter(path)
        model, special, letters, whole = owner.tokenizer.model, set(owner.special), byte_letters(), whole_tokens(path)
        merged: dict[str, int] = {}
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                s = owner.split(data, offsets)
                each = np.ones(len(s.words), np.int64)
                for i, word in enumerate(s.words):
                    text = word if word.isascii() and word.isprintable() and " " not in word else word.encode().decode("latin-1").translate(letters)
                    if text in whole or word in special:
                        continue
                    n = merged.get(word)
                    if n is None:
                        n = len(model.tokenize(text))
                        if len(merged) < REMEMBERED:
                            merged[word] = n
                    each[i] = n
                sums = ends(each[s.codes])
                counts = sums[s.offsets[1:]] - sums[s.offsets[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(counts), pa.array(counts > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every text."""
    docs = spread(docs).select(column(id_col).cast("bigint").alias("doc_id"), as_text(text_col).alias("text"))
    return docs.mapInArrow(tidy(_count(path, limit)), "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
