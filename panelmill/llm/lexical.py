"""Ranked lexical search over a bit-sliced impact index.

1. Statistics: N documents with a term, L terms in all; one row for each chunk of texts, added up.
2. Index: each block of documents (BLOCK bytes of text) makes a row for each of its terms. A document's impact for a term is an
   integer of SLICES bits; the row holds one bitmap of the block's documents for each bit. A term that few of the block's documents
   have is kept as places and impacts, which is smaller, and becomes bitmaps when it is read. No text is shuffled; the index is
   written once and serves any queries.
3. Search: the queries' terms are joined with the index; a block gets the rows of its terms, each with the items that ask for it
   and their multipliers. Impacts are multiplied and added up on bitmaps alone, by shifts and carries: 64 documents in one word.
   From the most significant slice down, each item's documents split into those that are surely in its top k and those that
   still may be. A block sends k documents of each item at most, and each task keeps the best before they meet.

Items go in blocks of ITEMS, so a task's work is one block of documents against one block of items, whatever the tables hold.

Documents: one for each row; repeated rows are documents of their own. A null or empty text, or one without a term, is never found
and not counted. A null doc_id ranks last among equal scores. Items: rows of one id, null included, are one item with the terms
of all; an item without a term has no rows. Other columns are left out, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelmill.llm.common import as_text, chunks, column, content_hashes, ends, grouped, spread, tidy, written

#: Bytes of text in a block of documents; documents in it.
BLOCK, MOST = 8 << 20, 1 << 16
#: Items that one task compares with a block; bitmaps' words that are added up at once.
ITEMS, WORDS = 256, 1 << 16
#: An impact is below 1,000,000, so below 2**20.
SLICES = 20
#: A term that at least one in so many documents of a block has is stored as bitmaps.
DENSE = 8
#: What a term is, in Java's regular expressions and DuckDB's; the bytes of its UTF-8 form are _INSIDE.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_INSIDE = np.ones(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _INSIDE[_low : _high + 1] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32

_ROWS = "block bigint, term string, size int, places array<int>, impacts array<int>, slices binary, doc_ids array<bigint>"


def _edges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where terms begin and end; a term ends with its text."""
    inside = _INSIDE[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begin[cuts] = inside[cuts]
    end[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, offsets in chunks(batch):
            n = np.diff(np.searchsorted(_edges(data, offsets)[0], offsets))
            yield pa.RecordBatch.from_pydict({"documents": [int((n > 0).sum())], "terms": [int(n.sum())]})


def norms(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """100 - 25 + ((25 * n * documents) div terms), exactly."""
    if len(n) and 25 * int(n.max()) * documents >= 1 << 63:
        return np.array([75 + 25 * x * documents // terms for x in n.tolist()], np.int64)
    return 75 + 25 * n * documents // max(terms, 1)


def bitmaps(places: np.ndarray, impacts: np.ndarray, words: int) -> np.ndarray:
    """SLICES bitmaps of words 64-bit words."""
    out = np.zeros((SLICES, words), np.uint64)
    bit = np.uint64(1) << (places & 63).astype(np.uint64)
    for k in range(SLICES):
        has = (impacts >> k & 1).astype(bool)
        np.bitwise_or.at(out[k], places[has] >> 6, bit[has])
    return out


def _index(documents: int, terms: int):
    schema = pa.schema([("block", pa.int64()), ("term", pa.string()), ("size", pa.int32()), ("places", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int32())), ("slices", pa.binary()), ("doc_ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for few in range(0, batch.num_rows, MOST):
                for rows, data, offsets in chunks(batch.slice(few, MOST), limit=BLOCK):
                    data = _FOLD[data]
                    first, last = _edges(data, offsets)
                    n = np.diff(np.searchsorted(first, offsets))
                    if not len(first):
                        continue
                    own = np.flatnonzero(n)
                    ids = rows.column(0).take(pa.array(own))
                    null = ids.is_null().to_numpy(zero_copy_only=False)
                    order = np.lexsort((ids.fill_null(0).to_numpy(), null))  # places follow the ids, so equal scores do
                    place = np.zeros(len(n), np.int64)
                    place[own[order]] = np.arange(len(own))
                    codes, where = grouped(data, first, last, content_hashes(data, first, last, 13))
                    pairs, tf = np.unique(codes * len(own) + np.repeat(place, n), return_counts=True)
                    code, at = np.divmod(pairs, len(own))
                    impact = 1_000_000_000 * tf // (1000 * tf + 12 * norms(n[own][order], documents, terms)[at])
                    size = np.bincount(code, minlength=len(where))
                    dense = size * DENSE >= len(own)
                    reach, words = ends(size), -(-len(own) // 64)
                    slices = [None] * len(where)
                    for i in np.flatnonzero(dense).tolist():
                        x = slice(reach[i], reach[i + 1])
                        slices[i] = bitmaps(at[x], impact[x], words).tobytes()
                    listed = ~dense[code]
                    cuts = pa.array(np.append(ends(np.where(dense, 0, size)), listed.sum()).astype(np.int32))
                    raw = data.tobytes()
                    names = [raw[x:y].decode() for x, y in zip(first[where].tolist(), last[where].tolist(), strict=True)]
                    count, nothing = len(names), pa.array([[]], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([  # the last row is the block's own, without a term
                        pa.array(np.full(count + 1, block)), pa.array([*names, None], pa.string()), pa.array(np.append(size, len(own)).astype(np.int32)),
                        pa.ListArray.from_arrays(cuts, pa.array(at[listed].astype(np.int32))), pa.ListArray.from_arrays(cuts, pa.array(impact[listed].astype(np.int32))),
                        pa.array([*slices, None], pa.binary()), pa.concat_arrays([nothing.take(pa.array(np.zeros(count, np.int64))), pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64()))]),
                    ], schema=schema)
                    block += 1

    return run


class Index:
    """rows: the written index; documents: those with a term; terms: of all documents, with repeats."""

    def __init__(self, rows: DataFrame, documents: int, terms: int):
        self.rows, self.documents, self.terms = rows, documents, terms


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Reads the texts twice: for the statistics, which every impact depends on, and for the index."""
    docs = spread(docs).select(column(id_col).cast("bigint").alias("doc_id"), as_text(text_col).alias("text"))
    sums = docs.select("text").mapInArrow(tidy(_sizes), "documents bigint, terms bigint").agg(F.sum("documents"), F.sum("terms")).first()
    documents, terms = sums[0] or 0, sums[1] or 0
    return Index(written(docs.mapInArrow(tidy(_index(documents, terms)), _ROWS), "lexical-index"), documents, terms)


def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sums of numbers whose bits are the rows of a and b, by carries."""
    out, carry = np.empty_like(a), np.zeros(a.shape[1], np.uint64)
    for k in range(len(a)):
        odd = a[k] ^ b[k]
        out[k] = odd ^ carry
        carry = (a[k] & b[k]) | (carry & odd)
    return out


def times(bits: np.ndarray, factor: np.ndarray, height: int) -> np.ndarray:
    """Each column's numbers, times the column's factor: one shifted sum for each bit of the factors."""
    out = np.zeros((height, bits.shape[1]), np.uint64)
    for j in range(int(factor.max(initial=0)).bit_length()):
        on = (factor >> j & 1).astype(np.uint64) * np.uint64(2**64 - 1)
        carry = np.zeros(bits.shape[1], np.uint64)
        for k in range(j, height):
            more = bits[k - j] & on if k - j < len(bits) else None
            if more is None:
                if not carry.any():
                    break
                out[k], carry = out[k] ^ carry, out[k] & carry
            else:
                odd = out[k] ^ more
                carry, out[k] = (out[k] & more) | (carry & odd), odd ^ carry
    return out


def added(bits: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, keys) of columns with equal keys, given in order of key: neighbours are added in pairs until each key has one."""
    while True:
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(fresh)
        rank = np.arange(len(key)) - np.repeat(start, np.diff(np.append(start, len(key))))
        left = np.flatnonzero(rank % 2 == 0)
        if len(left) == len(key):
            return bits, key
        paired = np.zeros(len(left), bool)
        paired[:-1] = rank[left[:-1] + 1] % 2 == 1
        paired[-1] = left[-1] + 1 < len(key)
        out = bits[:, left]
        out[:, paired] = plus(out[:, paired], bits[:, left[paired] + 1])
        bits, key = out, key[left]


def best(bits: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(column, bit) of the k greatest positive numbers of each group of columns, first: where each group begins; of equal ones
    those of the lowest columns and bits. Slices are taken from the most significant one down."""
    sizes = np.diff(np.append(first, bits.shape[1]))
    sure, maybe = np.zeros(bits.shape[1], np.uint64), np.bitwise_or.reduce(bits, axis=0)
    have = np.zeros(len(first), np.int64)
    for row in bits[::-1]:
        high = maybe & row
        total = have + np.add.reduceat(np.bitwise_count(high).astype(np.int64), first)
        over = np.repeat(total > k, sizes)
        sure |= np.where(over, np.uint64(0), high)
        maybe = np.where(over, high, maybe & ~row)
        have = np.where(total > k, have, total)
    out = []
    for words, room in ((sure, None), (maybe, k - have)):
        flat = np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))
        at, bit = flat >> 6, flat & 63
        if room is not None:  # the equal ones at the threshold
            group = np.repeat(np.arange(len(first)), sizes)[at]
            rank = np.arange(len(at)) - np.searchsorted(group, group)
            keep = rank < room[group]
            at, bit = at[keep], bit[keep]
        out.append((at, bit))
    return np.concatenate([out[0][0], out[1][0]]), np.concatenate([out[0][1], out[1][1]])


def _cells(table: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, SLICES bits) of every word of a row's bitmaps that is not 0, in order of row and word."""
    sizes = np.array([len(x) for x in table.column("places")], np.int64)
    flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy().astype(np.int64)
    row, places, impacts = np.repeat(np.arange(len(sizes)), sizes), flat("places"), flat("impacts")
    key = row * words + (places >> 6)
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(fresh)
    bits = np.zeros((SLICES, len(start)), np.uint64)
    one = np.uint64(1) << (places & 63).astype(np.uint64)
    for k in range(SLICES if len(start) else 0):
        bits[k] = np.bitwise_or.reduceat(np.where(impacts >> k & 1, one, np.uint64(0)), start)
    keys, parts = [key[start]], [bits]
    for i, raw in enumerate(table.column("slices").to_pylist()):
        if raw is not None:
            own = np.frombuffer(raw, np.uint64).reshape(SLICES, words)
            has = np.flatnonzero(np.bitwise_or.reduce(own, axis=0))
            keys.append(i * words + has)
            parts.append(own[:, has])
    key, bits = np.concatenate(keys), np.concatenate(parts, axis=1)
    order = np.argsort(key, kind="stable")
    return key[order] // words, key[order] % words, bits[:, order]


def _search(k: int, at_once: int):
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        head = table.filter(table.column("asked").is_null())
        table = table.filter(table.column("asked").is_valid())
        if not table.num_rows:
            return schema.empty_table()
        ids = head.column("doc_ids")[0].values
        words = -(-len(ids) // 64)
        row, word, bits = _cells(table, words)
        # one entry for each item and term
        asked = table.column("asked").combine_chunks()
        entry = asked.flatten()
        entry_row = np.repeat(np.arange(table.num_rows), [len(x) for x in asked])
        known, factor = entry.field("item_id"), entry.field("factor").to_numpy()
        item = known.dictionary_encode("encode").indices.to_numpy().astype(np.int64)
        order = np.argsort(item, kind="stable")
        item, entry_row, factor, known = item[order], entry_row[order], factor[order], known.take(pa.array(order))
        height = SLICES + int(factor.max()).bit_length() + int(np.bincount(item).max()).bit_length()
        start = np.searchsorted(row, np.arange(table.num_rows + 1))
        count = (start[1:] - start[:-1])[entry_row]
        out, low = [], 0
        reach = ends(count)
        while low < len(item):  # whole items, at_once words of bitmaps or one item
            high = int(np.searchsorted(reach, reach[low] + at_once, "right")) - 1
            high = int(np.searchsorted(item, item[min(high, len(item) - 1)])) if high < len(item) else high
            high = max(high, int(np.searchsorted(item, item[low], "right")))
            own = slice(low, high)
            cell = np.repeat(start[entry_row[own]] - (reach[low:high] - reach[low]), count[own]) + np.arange(reach[high] - reach[low])
            if len(cell):
                key = np.repeat(item[own], count[own]) * words + word[cell]
                order = np.argsort(key, kind="stable")
                cell = cell[order]
                sums, key = added(times(bits[:, cell], np.repeat(factor[own], count[own])[order], height), key[order])
                group = key // words
                first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
                at, bit = best(sums, first, k)
                score = np.zeros(len(at), np.int64)
                for s in range(height):
                    score += (sums[s, at] >> bit.astype(np.uint64) & np.uint64(1)).astype(np.int64) << s
                place = (key[at] % words) * 64 + bit
                named = known.take(pa.array(np.searchsorted(item, group[at])))
                out.append(pa.table({"item_id": named, "doc_id": ids.take(pa.array(place)), "score": score}, schema))
            low = high
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def asked_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, term and how often the item has it."""
    found = F.regexp_extract_all(F.translate(as_text(text_col), _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    terms = items.select(column(id_col).cast("bigint").alias("item_id"), F.explode(found).alias("term"))
    return terms.groupBy("item_id", "term").agg(F.count("*").alias("often"))


def weight(documents: int, df: Column) -> Column:
    return F.floor(1000 * F.log((2 * documents + 2) / (2 * df + 1).cast("double")))


def search(index: Index, items: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of each item with the highest scores above 0, equal ones by doc_id."""
    terms = written(asked_terms(items, id_col, text_col), "lexical-asked")
    blocks = max(1, -(-terms.select("item_id").distinct().count() // ITEMS))
    df = index.rows.select("term", "size").join(terms.select("term").distinct(), "term").groupBy("term").agg(F.sum("size").alias("df"))
    factors = terms.join(df, "term").select("term", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("part"), "item_id", (weight(index.documents, F.col("df")) * F.col("often")).alias("factor")).where("factor > 0")
    # written: its size is then known, and Spark broadcasts it if it is below the session's bound, else sorts and merges
    asked = written(factors.groupBy("term", "part").agg(F.collect_list(F.struct("item_id", "factor")).alias("asked")), "lexical-factors")
    fields = ("block", "part", "places", "impacts", "slices", "doc_ids", "asked")
    own = index.rows.where("term is not null").join(asked, "term").select(*fields)
    heads = index.rows.where("term is null").withColumns({"part": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))), "asked": F.lit(None).cast(asked.schema["asked"].dataType)}).select(*fields)
    found = own.unionByName(heads).groupBy("block", "part").applyInArrow(tidy(_search(k, WORDS)), "item_id bigint, doc_id bigint, score bigint")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
