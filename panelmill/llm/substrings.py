"""Removal of byte strings that an earlier document has, by prefix-free parsing.

Every window of LENGTH bytes takes as its trigger the GRAM-byte piece with the least rolling hash inside it;
consecutive windows with one trigger form a phrase (all the bytes they span), so equal windows always lie in
phrases of the same trigger at the same place. Three passes over the texts, which are written once in
blocks, bucketed by block:

1. Parse. Each block's distinct phrases (the dictionary) go, as pairs of hashes with the least and greatest
   document, to the group of their trigger. A trigger with one phrase is decided there: the phrase's windows
   repeat in every document after the least. A trigger in one document only has no repeats. What is left are
   triggers with several phrases, where repeated passages begin or end. Two phrases count as one by 128 bits:
   the trigger's hash and one of all their bytes (at most LENGTH + REACH - 1) that is no polynomial, so that
   10^13 phrases hold a false pair with a chance of about 10^-13.
2. Those phrases' bytes go to the group of their trigger, where the suffixes of the dictionary are sorted
   by their first LENGTH bytes; equal neighbours are the same window, and give its least document. A trigger
   with more than HOT phrases sends single windows instead, dealt out by the window's own hash, so that no
   group grows with one frequent trigger.
3. Through the parse the least documents come back to every phrase of every document, as spans of bytes.

A null or empty text has no bytes; a text under LENGTH bytes loses none. Rows that share an id are one document
in the order, so they take nothing from each other; null ids come after all others. One row for each input row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import Rolling, as_text, bucketed, buckets, chunks, column, content_hashes, ends, grouped, mixed, pack, release, rows_of, tidy, unpack

LENGTH, GRAM = 50, 16
REACH = LENGTH - GRAM + 1
#: Phrases of one trigger beyond which its windows are dealt out singly.
HOT = 5000
#: Bytes of text in a block, and of the text whose phrases (whose rest) one group takes.
BLOCK_TEXT, PHRASES_A_GROUP, REST_A_GROUP = 2 << 20, 8 << 20, 4 << 20
LAST = np.int64(2**63 - 1)
ROLLING = Rolling(256, 11)

_BLOCK = "block bigint, ids array<bigint>, sizes binary, body binary, others binary, n_bytes bigint"


def _blocks(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 20  # with a row's number a bigint still holds it
        for batch in batches:
            for rows, data, offsets in chunks(batch, limit=limit):
                sink = pa.BufferOutputStream()
                others = rows.select(["others"]) if "others" in rows.schema.names else rows.select([])
                with pa.ipc.new_stream(sink, others.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(others)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int64()),
                    pa.array([rows.column(rows.schema.get_field_index("_id")).to_pylist()], pa.list_(pa.int64())),
                    pa.array([pack(np.diff(offsets).astype(np.uint32))], pa.binary()),
                    pa.array([pack(data.tobytes(), level=6)], pa.binary()),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                    pa.array([len(data)], pa.int64()),
                ], ["block", "ids", "sizes", "body", "others", "n_bytes"])
                block += 1

    return run


class Parse:
    """The phrases of a block, and its dictionary: distinct phrases in the order of (trigger, content)."""

    def __init__(self, row: dict):
        self.ids = np.array([LAST if i is None else i for i in row["ids"]], np.int64)
        self.offsets = ends(unpack(row["sizes"])[0])
        self.data = np.frombuffer(unpack(row["body"])[0], np.uint8)
        self.low = self.high = self.doc = self.entry = np.zeros(0, np.int64)
        self.triggers = self.contents = np.zeros(0, np.uint64)
        self.least = self.most = np.zeros(0, np.int64)
        if len(self.data) >= LENGTH:
            self._parse()

    def _parse(self) -> None:
        n = len(self.data)
        grams = ROLLING.pieces(ROLLING.sums(self.data), GRAM)
        least = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)  # of equals the leftmost
        span = 1
        while 2 * span <= REACH:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if REACH > span:
            least = np.minimum(least[: span - REACH], least[REACH - span :])
        sizes = np.diff(self.offsets)
        doc = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
        p = np.flatnonzero(np.arange(len(least)) + LENGTH <= self.offsets[doc + 1])
        if not len(p):
            return
        owner = (least[p] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(p), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (p[1:] != p[:-1] + 1)
        first = np.flatnonzero(new)
        self.low, self.high = p[first], p[np.append(first[1:], len(p)) - 1]
        self.at, self.doc = owner[first], doc[self.low]
        triggers = mixed(grams[self.at])  # least hashes are small numbers; groups are ranges of evenly spread ones
        contents = content_hashes(self.data, self.low, self.high + LENGTH, 77) ^ mixed((self.at - self.low).astype(np.uint64) + np.uint64(77))
        order = np.lexsort((contents, triggers))
        a, x = triggers[order], contents[order]
        head = np.ones(len(a), bool)
        head[1:] = (a[1:] != a[:-1]) | (x[1:] != x[:-1])
        begin = np.flatnonzero(head)
        self.entry = np.empty(len(a), np.int64)
        self.entry[order] = np.cumsum(head) - 1
        self.triggers, self.contents = a[begin], x[begin]
        ids = self.ids[self.doc[order]]
        self.least, self.most = np.minimum.reduceat(ids, begin), np.maximum.reduceat(ids, begin)

    def rest(self, status: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows that pass 2 has to settle: (first window, last window, hot); if hot, single windows."""
        own = status[self.entry]
        pick = np.flatnonzero(own >= 2)
        hot = own[pick] == 3
        size = np.where(hot, self.high[pick] - self.low[pick] + 1, 1)
        low = np.repeat(self.low[pick] - ends(size)[:-1], size) + np.arange(size.sum())
        hot = np.repeat(hot, size)
        return low, np.where(hot, low, np.repeat(self.high[pick], size)), hot


class Rest:
    """The distinct runs of a block's rest, in the order in which they are dealt out."""

    def __init__(self, parse: Parse, status: np.ndarray, groups: int):
        self.low, self.high, hot = parse.rest(status)
        if not len(self.low):
            self.entry = np.zeros(0, np.int64)
            self.group = self.first = self.least = self.most = self.entry
            return
        which = np.searchsorted(parse.low, self.low, "right") - 1
        hashes = content_hashes(parse.data, self.low, self.high + LENGTH, 99)
        content = grouped(parse.data, self.low, self.high + LENGTH, hashes)[0]  # equal bytes, not hashes
        key = np.where(hot, mixed(hashes ^ np.uint64(0x51ED270B)), parse.triggers[parse.entry[which]])
        group = (key >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)
        order = np.lexsort((content, group))
        head = np.ones(len(order), bool)
        head[1:] = (group[order][1:] != group[order][:-1]) | (content[order][1:] != content[order][:-1])
        begin = np.flatnonzero(head)
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(head) - 1
        self.first, self.group = order[begin], group[order][begin].astype(np.int64)
        ids = parse.ids[parse.doc[which]][order]
        self.least, self.most = np.minimum.reduceat(ids, begin), np.maximum.reduceat(ids, begin)


def _by_group(group: np.ndarray) -> Iterator[tuple[int, int, int]]:
    has, first = np.unique(group, return_index=True)
    yield from zip(has.tolist(), first.tolist(), [*first.tolist(), len(group)][1:], strict=True)


def _sent(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["part", "block", "body"])


def _deal_phrases(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            p = Parse(row)
            group = ((p.triggers >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
            yield _sent([(g, row["block"], pack(np.diff(p.triggers[x:y], prepend=np.uint64(0)), p.contents[x:y], p.least[x:y], p.most[x:y] - p.least[x:y])) for g, x, y in _by_group(group)])
            del p, group  # before the next is made

    return run


def _decide(table: pa.Table) -> pa.Table:
    """For each entry sent: 0 in one document only, 1 decided, 2 to be settled, 3 the same and hot; for 1 the least document."""
    release()
    parts = [unpack(b) for b in table.column("body").to_pylist()]
    a = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts])
    x, least = np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts])
    most = least + np.concatenate([x[3] for x in parts])
    order = np.lexsort((x, a))
    a, x = a[order], x[order]
    new_a = np.ones(len(a), bool)
    new_a[1:] = a[1:] != a[:-1]
    new_x = new_a.copy()
    new_x[1:] |= x[1:] != x[:-1]
    begin = np.flatnonzero(new_a)
    own = np.cumsum(new_a) - 1
    phrases = np.add.reduceat(new_x.astype(np.int64), begin)
    low, high = np.minimum.reduceat(least[order], begin), np.maximum.reduceat(most[order], begin)
    kind = np.where(low == high, 0, np.where(phrases == 1, 1, np.where(phrases <= HOT, 2, 3))).astype(np.uint8)
    status, first = np.empty(len(a), np.uint8), np.empty(len(a), np.int64)
    status[order], first[order] = kind[own], low[own]
    at = ends([len(p[0]) for p in parts])
    body = [pack(status[i:j], first[i:j][status[i:j] == 1]) for i, j in zip(at, at[1:], strict=False)]
    return pa.table({"block": table.column("block"), "part": table.column("part"), "body": pa.array(body, pa.binary())})


def _joined(found: list[dict] | None, n: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The answers of all groups, in the order of the block's entries."""
    parts = [unpack(x["body"]) for x in sorted(found or [], key=lambda x: x["part"])]
    one = np.concatenate([x[0] for x in parts]) if parts else np.zeros(0, np.uint8)
    if len(one) != n:
        raise ValueError(f"block {block}: {len(one)} answers for {n} entries")
    return one, np.concatenate([x[1] for x in parts]) if parts else np.zeros(0, np.int64)


def _deal_rest(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            p = Parse(row)
            rest = Rest(p, _joined(row["decided"], len(p.triggers), row["block"])[0], groups)
            if not len(rest.first):
                continue
            low, size = rest.low[rest.first], rest.high[rest.first] + LENGTH - rest.low[rest.first]
            rows = []
            for g, x, y in _by_group(rest.group):
                at = np.repeat(low[x:y] - ends(size[x:y])[:-1], size[x:y]) + np.arange(size[x:y].sum())
                rows.append((g, row["block"], pack(size[x:y].astype(np.uint32), p.data[at].tobytes(), rest.least[x:y], rest.most[x:y] - rest.least[x:y])))
            yield _sent(rows)

    return run


def _settle(table: pa.Table) -> pa.Table:
    """For each window of each run sent: 1 and its least document if two documents have it, else 0."""
    release()
    parts = [unpack(b) for b in table.column("body").to_pylist()]
    size = np.concatenate([x[0] for x in parts]).astype(np.int64)
    text = np.frombuffer(b"".join([x[1] for x in parts]) + bytes(8), np.uint8)
    least = np.concatenate([x[2] for x in parts])
    most = least + np.concatenate([x[3] for x in parts])
    windows = size - LENGTH + 1
    run = np.repeat(np.arange(len(size)), windows)
    p = np.repeat(ends(size)[:-1] - ends(windows)[:-1], windows) + np.arange(windows.sum())
    # the sorted order of the dictionary's suffixes by their first LENGTH bytes, eight at a time
    words = np.lib.stride_tricks.as_strided(text, (len(text) - 7, 8), (1, 1))
    eight = lambda at: np.ascontiguousarray(words[at]).view(">u8").ravel().astype(np.uint64)
    keys = [eight(p + min(k, LENGTH - 8)) for k in range(0, LENGTH, 8)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(p), bool)
    new[0] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    begin = np.flatnonzero(new)
    own = np.cumsum(new) - 1
    low, high = np.minimum.reduceat(least[run[order]], begin), np.maximum.reduceat(most[run[order]], begin)
    status, first = np.empty(len(p), np.uint8), np.empty(len(p), np.int64)
    status[order], first[order] = (low < high)[own], low[own]
    runs = ends([len(x[0]) for x in parts])
    at = ends(windows)[runs]
    body = [pack(status[i:j], first[i:j][status[i:j] == 1]) for i, j in zip(at, at[1:], strict=False)]
    return pa.table({"block": table.column("block"), "part": table.column("part"), "body": pa.array(body, pa.binary())})


def other_column(row: dict, name: str) -> pa.Array:
    """A column of a block's rows, whatever its name."""
    others = pa.ipc.open_stream(row["others"]).read_all().column("others").combine_chunks()
    return others.field(others.type.get_field_index(name))


def _finish(groups: int, keep_rows: bool, names: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            p = Parse(row)
            status, first = _joined(row["decided"], len(p.triggers), row["block"])
            rest = Rest(p, status, groups)
            change = np.zeros(len(p.data) + LENGTH + 1, np.int32)

            def cover(low: np.ndarray, high: np.ndarray) -> None:
                np.add.at(change, low, 1)
                np.add.at(change, high + LENGTH, -1)

            if len(p.low):
                known = np.full(len(status), LAST, np.int64)
                known[status == 1] = first
                gone = known[p.entry] < p.ids[p.doc]
                cover(p.low[gone], p.high[gone])
            if len(rest.first):
                each = rest.high[rest.first] - rest.low[rest.first] + 1
                status, first = _joined(row["settled"], int(each.sum()), row["block"])
                known = np.full(len(status), LAST, np.int64)
                known[status == 1] = first
                size = rest.high - rest.low + 1
                at = np.repeat(rest.low - ends(size)[:-1], size) + np.arange(size.sum())
                slot = np.repeat(ends(each)[rest.entry] - ends(size)[:-1], size) + np.arange(size.sum())
                doc = p.ids[np.searchsorted(p.offsets, at, "right") - 1]
                at = at[known[slot] < doc]
                cover(at, at)
            gone = np.cumsum(change)[: len(p.data)] > 0
            sizes = np.diff(p.offsets)
            total = ends(gone)
            own = np.repeat(np.arange(len(sizes)), sizes)
            start = gone.copy()
            start[1:] &= ~gone[:-1] | (own[1:] != own[:-1])
            removed = total[p.offsets[1:]] - total[p.offsets[:-1]]
            spans = np.bincount(own[start], minlength=len(sizes))
            kept = p.data[~gone].tobytes()
            at = (p.offsets - total[p.offsets]).tolist()
            left = [kept[x:y] for x, y in zip(at, at[1:], strict=False)]
            if keep_rows:
                text = pa.array([x.decode("utf-8", "ignore") for x in left], pa.string())
                yield pa.RecordBatch.from_arrays([text if n == text_col else other_column(row, n) for n in names], names)
            else:
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["ids"], pa.int64()), pa.array(sizes.astype(np.int64)), pa.array(removed), pa.array(spans),
                    pa.array([hashlib.sha256(x).hexdigest() for x in left]),
                ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_rows: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every text; with keep_rows instead all columns of
    docs, the text without what is removed (and without characters that a removal cuts in two)."""
    names = docs.columns
    others = [F.struct(*[column(n) for n in names if n != text_col]).alias("others")] if keep_rows and len(names) > 1 else []
    rows = docs.select(column(id_col).cast("bigint").alias("_id"), as_text(text_col).alias("text"), *others)
    n = buckets(docs)
    blocks = bucketed(rows.mapInArrow(tidy(_blocks(BLOCK_TEXT)), _BLOCK), "substrings", "block", n)
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    groups, rest = max(1, -(-total // PHRASES_A_GROUP)), max(1, -(-total // REST_A_GROUP))
    gather = lambda df, name: df.groupBy("block").agg(F.collect_list(F.struct("part", "body")).alias(name))
    deal, answer = "part bigint, block bigint, body binary", "block bigint, part bigint, body binary"
    texts = blocks.select("block", "ids", "sizes", "body")
    decided = texts.mapInArrow(tidy(_deal_phrases(groups)), deal).groupBy("part").applyInArrow(tidy(_decide), answer)
    decided = bucketed(gather(decided, "decided"), "decided", "block", n)
    settled = texts.join(decided, "block", "left").mapInArrow(tidy(_deal_rest(rest)), deal).groupBy("part").applyInArrow(tidy(_settle), answer)
    every = blocks.join(decided, "block", "left").join(gather(settled, "settled"), "block", "left")
    if keep_rows:
        return every.mapInArrow(tidy(_finish(rest, True, names, text_col)), docs.withColumn(text_col, as_text(text_col)).schema)
    return every.mapInArrow(tidy(_finish(rest, False, names, text_col)), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
