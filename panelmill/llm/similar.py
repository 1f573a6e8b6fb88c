"""Joins of texts whose word-shingle sets are alike (Jaccard similarity of at least SHARE / 100), exactly.

1. Texts are written once in blocks. Texts of equal words (by a 128-bit digest of the words themselves) become
   one class, so copies are never paired. Other equal sets meet as the similar ones do.
2. Each shingle's frequency over classes decides the order of a set's shingles, rarest first. Two sets that
   link share a shingle among the rarest (100 - SHARE) % of each; only there candidates meet, and common
   passages, whose shingles are frequent, bring nothing together.
3. Candidates that meet form groups (connected components, by alternating stars over the edges of spanning
   forests; nothing is collected). A group of up to LIMIT sets is joined by a signature tree: nodes hold the
   OR of their sets' bitmaps and the range of their sizes; a dual traversal drops pairs of nodes whose largest
   possible overlap is too small, or whose sets are all linked already. Shingles are compared by their words
   there, so hashes choose candidates but never make a link.
4. A larger group is dealt out in cells; each cell is joined together with the group's pivot. Sets that
   reach the pivot are one component; every other set of the group is then joined with all cells. So a group of
   near copies of any size takes one comparison with the pivot for each set, and no link is lost.

A null or empty text, or one without words, has an empty set, is linked with nothing and is its own
component. Rows with the same id are separate rows, with one result each. component_id is the least
non-null id of the component; null if there is none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import CHUNK, as_text, bucketed, buckets, column, content_hashes, ends, joined_by_hot, mixed, pack, release, rows_of, tidy, unequal, unpack, written
from panelmill.llm.substrings import _BLOCK, _blocks, _by_group, _sent, other_column

WIDTH, SHARE = 5, 80
LIMIT = 1024
#: Bytes of text whose shingles, or whose sets, one group takes.
TEXT_A_GROUP = 16 << 20
BITS, LEAF, FAN = 2048, 8, 8
_STEP = np.uint64(0x2545F4914F6CDD1D)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends."""
    word = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    stop = word.copy()
    stop[:-1] &= ~word[1:] | edge[1:-1]
    return np.flatnonzero(start), np.flatnonzero(stop) + 1


def digests(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """blake2b of each text's words, lower-cased, with single spaces: equal for texts of equal words only."""
    first, _ = word_bounds(data, offsets)
    keep = ~_BLANK[data]
    head = np.searchsorted(first, offsets[:-1])  # each text's first word takes no space before it
    inner = np.ones(len(first), bool)
    inner[head[head < len(first)]] = False
    keep[first[inner] - 1] = True
    at = ends(keep)[offsets].tolist()
    low = np.where(_BLANK[data], np.uint8(32), _LOWER[data])[keep].tobytes()
    return [hashlib.blake2b(low[x:y], digest_size=16).digest() for x, y in zip(at, at[1:], strict=False)]


def shingles(data: np.ndarray, offsets: np.ndarray, across: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, as sorted 64-bit hashes, and where each text's begin and end.

    Two shingles of one text with the same hash are compared, so each text's number of shingles is exact; with
    across those of different texts are compared too, and equal numbers mean equal words. A shingle whose
    hash is another's as well takes a hash of its words instead.
    """
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    data = _LOWER[data]
    first, last = word_bounds(data, offsets)
    words = content_hashes(data, first, last, 6)
    own = np.searchsorted(offsets, first, "right") - 1
    total = np.bincount(own, minlength=n)
    bounds = ends(total)
    many = np.minimum(np.maximum(total - WIDTH + 1, 0), total)
    at = np.repeat(bounds[:-1] - ends(many)[:-1], many) + np.arange(many.sum())
    few = np.flatnonzero((total > 0) & (total < WIDTH))
    at, docs = np.concatenate([at, bounds[few]]), np.concatenate([own[at], few])
    size = np.minimum(total[docs], WIDTH)
    out = mixed(size.astype(np.uint64))
    for k in range(WIDTH):
        has = slice(None) if not len(few) else np.flatnonzero(size > k)
        out[has] = mixed((out[has] ^ words[at[has] + k]) * _STEP + np.uint64(k))

    def differ(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        bad = size[i] != size[j]
        for k in range(WIDTH):
            both = np.flatnonzero(~bad & (size[i] > k))
            bad[both] = unequal(data, first, last, at[i[both]] + k, at[j[both]] + k)
        return bad

    def clashes(order: np.ndarray, texts: bool) -> np.ndarray:
        same = np.flatnonzero((out[order][1:] == out[order][:-1]) & (True if texts else docs[order][1:] == docs[order][:-1]))
        return np.unique(out[order[same][differ(order[same], order[same + 1])]]) if len(same) else out[:0]

    order = np.lexsort((out, docs))
    bad = clashes(np.argsort(out, kind="stable") if across else order, across)
    if len(bad):
        for i in np.flatnonzero(np.isin(out, bad)).tolist():
            spelled = b" ".join(data[first[w] : last[w]].tobytes() for w in range(at[i], at[i] + size[i]))
            out[i] = np.frombuffer(hashlib.blake2b(spelled, digest_size=8).digest(), np.uint64)[0]
        order = np.lexsort((out, docs))
    out, docs = out[order], docs[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (docs[1:] != docs[:-1])
    return out[new], np.searchsorted(docs[new], np.arange(n + 1))


def _of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = np.frombuffer(unpack(row["body"])[0], np.uint8), ends(unpack(row["sizes"])[0])
    return data, offsets, *shingles(data, offsets)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        data, offsets, _, at = _of(row)
        n = len(at) - 1
        yield pa.RecordBatch.from_arrays([
            pa.array([row["block"]] * n, pa.int64()), pa.array((row["block"] << 22) + np.arange(n)), pa.array(row["ids"], pa.int64()), pa.array(np.diff(at)),
            pa.array(digests(data, offsets), pa.binary()),
        ], ["block", "sid", "doc_id", "n", "digest"])


def _own_tokens(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, set number of each) of the block's classes, and the block's distinct tokens. Copies of other texts are
    left out before anything is made of them."""
    data, sizes = np.frombuffer(unpack(row["body"])[0], np.uint8), unpack(row["sizes"])[0].astype(np.int64)
    which = np.array(sorted(row["sets"] or []), np.int64)
    listed = np.zeros(len(sizes), bool)
    listed[which] = True
    tokens, at = shingles(data[np.repeat(listed, sizes)], ends(sizes[which]))
    return tokens, np.repeat(which, np.diff(at)), np.unique(tokens)


def _deal_tokens(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            tokens, _, distinct = _own_tokens(row)
            count = np.bincount(np.searchsorted(distinct, tokens), minlength=len(distinct)).astype(np.uint32)
            group = ((distinct >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
            yield _sent([(g, row["block"], pack(np.diff(distinct[x:y], prepend=np.uint64(0)), count[x:y])) for g, x, y in _by_group(group)])

    return run


def _frequencies(table: pa.Table) -> pa.Table:
    release()
    parts = [unpack(b) for b in table.column("body").to_pylist()]
    tokens = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts])
    distinct, back = np.unique(tokens, return_inverse=True)
    total = np.bincount(back, np.concatenate([x[1] for x in parts])).astype(np.uint32)[back]
    at = ends([len(x[0]) for x in parts])
    return pa.table({"block": table.column("block"), "part": table.column("part"), "body": pa.array([pack(total[i:j]) for i, j in zip(at, at[1:], strict=False)], pa.binary())})


def _deal_prefixes(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            tokens, sets, distinct = _own_tokens(row)
            total = np.concatenate([unpack(x["body"])[0] for x in sorted(row["found"] or [], key=lambda x: x["part"])] or [np.zeros(0, np.uint32)])
            if len(total) != len(distinct):
                raise ValueError(f"block {row['block']}: {len(total)} of {len(distinct)} frequencies")
            seen = total[np.searchsorted(distinct, tokens)]
            order = np.lexsort((tokens, seen, sets))
            tokens, sets, seen = tokens[order], sets[order], seen[order]
            _, first, size = np.unique(sets, return_index=True, return_counts=True)
            rank = np.arange(len(sets)) - np.repeat(first, size)
            keep = (rank < np.repeat(size - -(-SHARE * size // 100) + 1, size)) & (seen > 1)
            tokens, sets = tokens[keep], sets[keep]
            order = np.argsort(tokens)
            tokens, sets = tokens[order], sets[order]
            group = ((tokens >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
            yield _sent([(g, row["block"], pack(np.diff(tokens[x:y], prepend=np.uint64(0)), sets[x:y])) for g, x, y in _by_group(group)] if len(tokens) else [])

    return run


class Forest:
    """Union-find; the root of a tree is its least member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = sorted((self.root(i), self.root(j)))
        self.up[j] = i
        return i != j


def _forest(table: pa.Table) -> pa.Table:
    """The edges of a spanning forest of the sets that meet in this group's shingles."""
    release()
    parts = [unpack(b) for b in table.column("body").to_pylist()]
    tokens = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts])
    sets = np.concatenate([x[1] + (b << 22) for x, b in zip(parts, table.column("block").to_pylist(), strict=True)])
    names, sets = np.unique(sets, return_inverse=True)
    order = np.lexsort((sets, tokens))
    tokens, sets = tokens[order], sets[order]
    meet = np.flatnonzero((tokens[1:] == tokens[:-1]) & (sets[1:] != sets[:-1]))
    pairs = np.unique(np.stack([sets[meet], sets[meet + 1]], 1), axis=0) if len(meet) else np.zeros((0, 2), np.int64)
    forest = Forest(len(names))
    for i, j in pairs.tolist():
        forest.join(i, j)
    roots = np.array([forest.root(i) for i in range(len(names))], np.int64)
    keep = roots != np.arange(len(names))
    return pa.table({"a": pa.array(names[roots[keep]], pa.int64()), "b": pa.array(names[keep], pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """(sid, label) of every vertex of edges (a, b): the least vertex it reaches. Alternating large and small
    stars; each round is written to the shared folder. The number of rounds is about the logarithm of a
    component's size."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = written(small.where("u <> v").distinct(), "edges")
        sums = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums(after) == sums(edges):
            break
        edges = after
    return edges.select(F.col("u").alias("sid"), F.col("v").alias("label")).unionAll(edges.select(F.col("v").alias("sid"), F.col("v").alias("label")).distinct())


def _deal_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(6).compress
    for row in rows_of(batches):
        data, offsets = np.frombuffer(unpack(row["body"])[0], np.uint8), ends(unpack(row["sizes"])[0])
        own = [(x["label"], x["sid"], squeeze(data[offsets[i] : offsets[i + 1]].tobytes())) for x in row["sets"] for i in [x["sid"] - (row["block"] << 22)]]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in own], pa.int64()), pa.array([x[1] for x in own], pa.int64()), pa.array([x[2] for x in own], pa.binary())], ["label", "sid", "body"])


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, True))
    return 100 * both >= SHARE * (len(x) + len(y) - both)


class Tree:
    """A signature tree over sets; sets that begin alike (by their least shingles) stand together."""

    def __init__(self, sets: list[np.ndarray], members: list[int]):
        order = sorted(members, key=lambda i: (tuple(sets[i][:2].tolist()), len(sets[i])))
        self.bits, self.excess = {}, {}
        for i in order:
            own = np.zeros(BITS, bool)
            own[(sets[i] % np.uint64(BITS)).astype(np.int64)] = True
            self.bits[i] = np.packbits(own).view(np.uint64)
            self.excess[i] = len(sets[i]) - int(own.sum())
        level = [self._node([], order[k : k + LEAF], sets) for k in range(0, len(order), LEAF)]
        while len(level) > 1:
            level = [self._node(level[k : k + FAN], sum((x["of"] for x in level[k : k + FAN]), []), sets) for k in range(0, len(level), FAN)]
        self.root = level[0]

    def _node(self, children: list, of: list[int], sets: list[np.ndarray]) -> dict:
        bits = np.bitwise_or.reduce([c["bits"] for c in children] if children else [self.bits[i] for i in of])
        sizes = [len(sets[i]) for i in of]
        return {"children": children, "of": of, "bits": bits, "least": min(sizes), "most": max(sizes), "excess": max(self.excess[i] for i in of), "one": None}


def _apart(a: dict, b: dict) -> bool:
    """No pair of sets from the two nodes can link: sizes too different, or too few bits in common."""
    if 100 * a["most"] < SHARE * b["least"] or 100 * b["most"] < SHARE * a["least"]:
        return True
    need = math.ceil(SHARE * max(a["least"], b["least"]) / 100)
    return int(np.bitwise_count(a["bits"] & b["bits"]).sum()) + min(a["excess"], b["excess"]) < need


def _one(node: dict, forest: Forest) -> int | None:
    """The tree that all the node's sets are in, if it is one; once it is, it stays."""
    if node["one"] is None:
        roots = {_one(c, forest) for c in node["children"]} if node["children"] else {forest.root(i) for i in node["of"]}
        if None in roots or len(roots) > 1:
            return None
        node["one"] = node["of"][0]
    return forest.root(node["one"])


def _dual(a: dict, b: dict, sets: list[np.ndarray], trees: tuple[Tree, Tree], forest: Forest) -> None:
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if (x := _one(a, forest)) is not None and x == _one(b, forest) or a is not b and _apart(a, b):
            continue
        if not a["children"] and not b["children"]:
            for i in a["of"]:
                for j in b["of"]:
                    if (a is not b or i < j) and forest.root(i) != forest.root(j):
                        n, m = sorted((len(sets[i]), len(sets[j])))
                        if 100 * n >= SHARE * m and 100 * (int(np.bitwise_count(trees[0].bits[i] & trees[1].bits[j]).sum()) + min(trees[0].excess[i], trees[1].excess[j])) >= SHARE * m and _linked(sets[i], sets[j]):
                            forest.join(i, j)
        elif a is b:
            c = a["children"]
            todo += [(c[i], c[j]) for i in range(len(c)) for j in range(i + 1, len(c))] + [(x, x) for x in c]
        elif not a["children"] or b["children"] and len(b["of"]) > len(a["of"]):
            todo += [(a, c) for c in b["children"]]
        else:
            todo += [(c, b) for c in a["children"]]


def _join_groups(table: pa.Table) -> pa.Table:
    """Joins the sets of each group in the table. side: 0 sets of a cell, 1 its pivot or sets that come to it;
    two sets of side 1 are joined elsewhere. Edges (a, b): the least set of each tree, and each other one."""
    rows: dict[tuple, list] = {}
    release()
    for label, cell, sid, side, body in zip(*[table.column(n).to_pylist() for n in ("label", "cell", "sid", "side", "body")], strict=True):
        rows.setdefault((label, cell), []).append((sid, side, body))
    a, b = [], []
    for own in rows.values():
        own.sort(key=lambda r: r[:2])
        raw = [zstandard.ZstdDecompressor().decompress(r[2]) for r in own]
        tokens, at = shingles(np.frombuffer(b"".join(raw), np.uint8), ends([len(x) for x in raw]), across=True)
        sets = [tokens[x:y] for x, y in zip(at, at[1:], strict=False)]
        forest = Forest(len(own))
        sides = [[i for i, r in enumerate(own) if r[1] == k] for k in (0, 1)]
        trees = [Tree(sets, s) if s else None for s in sides]
        if trees[0] and trees[1]:
            _dual(trees[0].root, trees[1].root, sets, (trees[0], trees[1]), forest)
        if trees[0] and not (own and any(r[1] == 1 for r in own) and len(sides[1]) > 1):
            _dual(trees[0].root, trees[0].root, sets, (trees[0], trees[0]), forest)
        roots = [forest.root(i) for i in range(len(own))]
        a += [own[r][0] for r in roots]
        b += [r[0] for r in own]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _large(sets: DataFrame, sizes: DataFrame, parts: int) -> DataFrame:
    """The links of groups with more than LIMIT sets, cell by cell."""
    cells = sizes.withColumn("cells", F.ceil(F.col("n") * 2 / LIMIT).cast("bigint"))
    own = written(sets.join(cells, "label").withColumn("cell", F.pmod(F.xxhash64("sid"), F.col("cells"))).select("label", "cell", "cells", "sid", "body"), "cells")
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cells") - 1)).alias("cell")
    pivots = own.where("sid = label")  # a group's label is its least set
    columns = ["label", "cell", "sid", "side", "body"]
    first = own.withColumn("side", F.lit(0)).select(columns).unionByName(pivots.select("label", "sid", "body", F.lit(1).alias("side"), each).select(columns))

    def joined(rows: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("label", "cell"), F.lit(parts))
        return rows.withColumn("part", part).groupBy("part", "label", "cell").applyInArrow(tidy(_join_groups), "a bigint, b bigint")

    # the pivot is the least set of its group, so whatever reaches it has it as the root
    edges = written(joined(first), "links")
    reached = edges.join(pivots.select(F.col("sid").alias("a")), "a", "left_semi").select(F.col("b").alias("sid")).distinct()
    rest = own.join(reached, "sid", "left_anti").select("label", "cells", "sid", "body")
    if rest.isEmpty():
        return edges
    # what did not reach the pivot meets every cell, in lots of at most about LIMIT sets
    lots = own.withColumn("side", F.lit(0)).select(columns)
    come = rest.withColumn("lot", F.pmod(F.xxhash64("sid", F.lit(7)), F.col("cells"))).select("label", "sid", "body", "lot", F.col("cells").alias("lots"), F.lit(1).alias("side"), each)
    has = come.select("label", "cell", "lot").distinct()
    met = come.select("label", "cell", "lot", "sid", "side", "body").unionByName(lots.join(has, ["label", "cell"]).select("label", "cell", "lot", "sid", "side", "body"))
    met = met.groupBy("label", "cell", "lot").applyInArrow(tidy(_join_groups), "a bigint, b bigint")
    return edges.unionAll(met)


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_one: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; with keep_one instead the rows of docs, with all columns,
    that stand first (by id, nulls last) in their component; rows without words all stay."""
    others = [F.struct(*[column(n) for n in docs.columns if n != text_col]).alias("others")] if keep_one and len(docs.columns) > 1 else []
    rows = docs.select(column(id_col).cast("bigint").alias("_id"), as_text(text_col).alias("text"), *others)
    blocks = bucketed(rows.mapInArrow(tidy(_blocks(CHUNK)), _BLOCK), "similar", "block", buckets(docs))
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    groups = max(1, -(-total // TEXT_A_GROUP))
    tasks = max(groups, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = blocks.select("block", "ids", "sizes", "body")
    keys = written(texts.mapInArrow(tidy(_keys), "block bigint, sid bigint, doc_id bigint, n bigint, digest binary"), "keys")
    classes = keys.where("n > 0").groupBy("digest").agg(F.min("sid").alias("class"))
    block_of = F.shiftright("class", 22)
    listed = classes.groupBy(block_of.alias("block")).agg(F.collect_list((F.col("class") - F.shiftleft(block_of, 22)).cast("bigint")).alias("sets"))
    own = texts.join(listed, "block")
    answers = own.mapInArrow(tidy(_deal_tokens(groups)), "part bigint, block bigint, body binary").groupBy("part").applyInArrow(tidy(_frequencies), "block bigint, part bigint, body binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("part", "body")).alias("found"))
    edges = own.join(answers, "block").mapInArrow(tidy(_deal_prefixes(groups)), "part bigint, block bigint, body binary").groupBy("part").applyInArrow(tidy(_forest), "a bigint, b bigint")
    meet = written(components(edges), "meet")
    listed = meet.groupBy(F.shiftright("sid", 22).alias("block")).agg(F.collect_list(F.struct("sid", "label")).alias("sets"))
    sets = written(texts.join(listed, "block").mapInArrow(tidy(_deal_sets), "label bigint, sid bigint, body binary"), "sets")
    sizes = written(meet.groupBy("label").agg(F.count("*").alias("n")), "sizes")
    small = sets.join(sizes.where(F.col("n") > LIMIT).select("label"), "label", "left_anti")
    part = F.pmod(F.xxhash64("label"), F.lit(tasks)).alias("part")
    links = small.select(part, "label", F.lit(0).cast("bigint").alias("cell"), "sid", F.lit(0).alias("side"), "body").groupBy("part").applyInArrow(tidy(_join_groups), "a bigint, b bigint")
    links = written(links, "links")
    big = sizes.where(F.col("n") > LIMIT)
    if not big.isEmpty():
        links = components(links.unionAll(_large(sets, big, tasks))).select(F.col("label").alias("a"), F.col("sid").alias("b"))
        links = written(links, "links")
    # one row for each class, then for each component; hot classes and components meet their rows by broadcast
    first = lambda: F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "sid"))
    own = written(keys.where("n > 0").groupBy("digest").agg(F.min("sid").alias("class"), F.min("doc_id").alias("least"), first().alias("first"), F.count("*").alias("weight")), "classes")
    labels = links.select(F.col("b").alias("class"), F.col("a").alias("label"))
    found = labels.join(own, "class").groupBy("label").agg(F.min("least").alias("least"), F.min("first").alias("first"), F.count("*").alias("weight"))
    found = written(found, "components")
    met = joined_by_hot(labels, found, "label").select("class", F.col("least").alias("_least"), F.col("first").alias("_first"))
    every = own.join(met, "class", "left").select("digest", F.coalesce("_first", "first").alias("first"), F.when(F.col("_first").isNull(), F.col("least")).otherwise(F.col("_least")).alias("least"), "weight")
    members = joined_by_hot(keys.where("n > 0"), written(every, "answers"), "digest")
    none = keys.where("n = 0")
    if not keep_one:
        out = members.select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))
        return out.unionAll(none.select("doc_id", "n", "doc_id"))
    stay = members.where(F.col("sid") == F.col("first.sid")).select("block", "sid").unionAll(none.select("block", "sid"))
    stay = stay.groupBy("block").agg(F.collect_list((F.col("sid") - F.shiftleft("block", 22)).cast("bigint")).alias("stay"))
    return blocks.join(stay, "block").mapInArrow(tidy(_kept(docs.columns, text_col)), docs.withColumn(text_col, as_text(text_col)).schema)


def _kept(names: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            offsets, raw = ends(unpack(row["sizes"])[0]).tolist(), unpack(row["body"])[0]
            stay = sorted(row["stay"])
            text = pa.array([raw[offsets[i] : offsets[i + 1]].decode() for i in stay], pa.string())
            yield pa.RecordBatch.from_arrays([text if n == text_col else other_column(row, n).take(pa.array(stay, pa.int64())) for n in names], names)

    return run
