"""Exact top-k search by inner product with cover trees over data and queries.

The root of the search is flat: up to CELLS pivots, chosen farthest-first from a bounded sample (SAMPLE vectors by a
hash of the id), split all vectors into cells; a cell knows its covering radius, and is cut into blocks of about BLOCK
vectors by a hash of the id, so that a cell of any size makes no large task. Below it, each block is indexed as a cover tree
by the task that searches it: a node of covering radius R has children whose centres lie more than R / BASE apart
(separation) and cover all its points within R / BASE (covering); a node that FAN centres do not cover so is a leaf,
as are nodes of up to LEAF points. Queries have blocks and trees of their own.

For a pair of nodes, or of cells, no inner product exceeds q.c + |q| r + s |c| + s r (centres q and c, radii s and r); a pair
is dropped if that lies below the worst k-th score among its queries. A first pass takes each block of queries to
one block of the cell with the best centre; its k-th scores travel with the queries from then on, so cells are dropped before
their blocks are sent, and trees prune from the start. A window takes the best k of what all passes found.

Components become floor(256 x) with x as double. Scores are exact integers: float64 products while all sums stay
below 2^53; beyond, products with a bound on their error choose the candidates, and Python integers decide. A score
beyond a bigint is ranked by its exact value and given as the nearest bigint. Vectors that are null or hold null
or non-finite components, and rows without an id, take no part; vectors of other lengths count as filled with zeros. Rows equal
in id and vector count once; a query's candidates are all rows with another id, and each id counts once with one score. Ties
go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.common import column, pack, rows_of, tidy, unpack, written

BLOCK, QUERIES, FAN, BASE = 8192, 2048, 64, 2.0
#: Points of a leaf, of the data and of the queries.
LEAF, QUERY_LEAF = 256, 16
CELLS, SAMPLE = 64, 4096
#: Queries whose products are made at once.
TILE = 128
_TOP = 2**63


def _far(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances from c; what floats cannot hold is infinitely far."""
    with np.errstate(all="ignore"):
        return np.nan_to_num(np.linalg.norm(x - c, axis=1), nan=np.inf, posinf=np.inf)


def net(x: np.ndarray, first: int, far: np.ndarray, cover: float, most: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres farthest-first, until all of x lies within cover of one or there are `most`; each row's centre and
    distance. Centres lie more than cover apart."""
    centres, near, own = [first], far, np.zeros(len(x), np.int64)
    while len(centres) < most and near.max() > cover:
        c = int(np.argmax(near))
        distance = _far(x, x[c])
        own[distance < near] = len(centres)
        near = np.minimum(near, distance)
        centres.append(c)
    return centres, own, near


class Node:
    """A node of a cover tree: its centre (a row of x), rows, covering radius, and its children's separation."""

    __slots__ = ("centre", "children", "length", "members", "radius", "separation")

    def __init__(self, x: np.ndarray, centre: int, members: np.ndarray, far: np.ndarray, leaf: int):
        """far: the members' distances from the centre."""
        self.centre, self.members, self.radius, self.separation = centre, members, float(far.max()), 0.0
        with np.errstate(all="ignore"):
            self.length = float(np.linalg.norm(x[centre]))
        self.children: list[Node] = []
        if len(members) <= leaf or not 0 < self.radius < math.inf:
            return
        own_x = x[members]
        self.separation = self.radius / BASE
        centres, own, near = net(own_x, int(np.flatnonzero(members == centre)[0]), far, self.separation, FAN)
        if near.max() <= self.separation:
            self.children = [Node(x, int(members[c]), members[own == i], near[own == i], leaf) for i, c in enumerate(centres)]


def cover_tree(x: np.ndarray, leaf: int) -> Node:
    return Node(x, 0, np.arange(len(x)), _far(x, x[0]), leaf)


def whole_numbers(row: np.ndarray) -> list[int]:
    """floor(256 x) of doubles, of any size."""
    return [math.floor(256 * c) if abs(c) < 2.0**900 else int(c) << 8 for c in row.tolist()]


class Search:
    """The best k of one block for each query of another; floors are scores that k others of the query reach already."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, floors: np.ndarray | None = None):
        self.k, self.q_ids, self.ids, self.raw, self.leaves = k, q_ids, ids, (q, x), 0
        with np.errstate(all="ignore"):
            self.q, self.x = np.floor(256 * q), np.floor(256 * x)
            most = float(np.abs(self.q).max(initial=1)) * float(np.abs(self.x).max(initial=1)) * max(q.shape[1], 1)
            self.exact = most < 2**53
            lengths = [np.linalg.norm(a, axis=1) for a in (self.q, self.x)]
            self.slack = None if self.exact else [lengths[0] * (max(q.shape[1], 1) * 2.0**-50), lengths[1]]
        self.numbers: dict[tuple, list[int]] = {}
        self.best: list[list[tuple]] = [[] for _ in q_ids]  # (-score, id), ascending
        self.worst = np.full(len(q_ids), -np.inf) if floors is None else floors.copy()
        todo = [(cover_tree(self.q, QUERY_LEAF), cover_tree(self.x, LEAF))]
        while todo:
            a, b = todo.pop()
            if self._bound(a, b) < self.worst[a.members].min():
                continue
            if not a.children and not b.children:
                self._leaves(a.members, b.members)
            elif a.children and (not b.children or a.radius > b.radius):
                todo += [(c, b) for c in a.children]
            else:
                todo += sorted(((a, c) for c in b.children), key=lambda p: self._bound(*p))  # the best comes first

    def _bound(self, a: Node, b: Node) -> float:
        with np.errstate(all="ignore"):
            return above(float(self.q[a.centre] @ self.x[b.centre]), a.length, a.radius, b.length, b.radius)

    def _exact(self, i: int, j: int) -> int:
        u, v = (self.numbers.setdefault((side, n), []) or self.numbers[side, n].extend(whole_numbers(self.raw[side][n])) or self.numbers[side, n] for side, n in ((0, i), (1, j)))
        return sum(map(int.__mul__, u, v))

    def _leaves(self, rows: np.ndarray, cols: np.ndarray) -> None:
        self.leaves += len(rows) * len(cols)
        x, ids = self.x[cols], self.ids[cols]
        for low in range(0, len(rows), TILE):
            own = rows[low : low + TILE]
            with np.errstate(all="ignore"):
                score = self.q[own] @ x.T
                least = most = score
                if not self.exact:
                    slack = self.slack[0][own][:, None] * self.slack[1][cols][None, :] + 1
                    unknown = ~np.isfinite(score) | ~np.isfinite(slack)
                    least, most = np.where(unknown, -np.inf, score - slack), np.where(unknown, np.inf, score + slack)
            other = ids[None, :] != self.q_ids[own][:, None]
            cut = self.worst[own]
            if len(cols) > self.k:  # no more than the k best and their ties can count, if they are k without repeats
                cut = np.maximum(cut, np.partition(np.where(other, least, -np.inf), -self.k, axis=1)[:, -self.k])
            at, where = np.nonzero(other & (most >= cut[:, None]))
            bounds = np.searchsorted(at, np.arange(len(own) + 1))
            for r in np.flatnonzero(np.diff(bounds)).tolist():
                i, picked = int(own[r]), where[bounds[r] : bounds[r + 1]]
                found = self._pairs(i, cols, ids, picked, score[r])
                if len(found) < self.k and len(picked) < len(cols):
                    found = self._pairs(i, cols, ids, np.flatnonzero(other[r] & (most[r] >= self.worst[i])), score[r])
                self.best[i] = sorted(found.union(self.best[i]))[: self.k]
                if len(self.best[i]) == self.k:
                    self.worst[i] = max(self.worst[i], below(-self.best[i][-1][0]))

    def _pairs(self, i: int, cols: np.ndarray, ids: np.ndarray, picked: np.ndarray, score: np.ndarray) -> set[tuple]:
        if self.exact:
            return set(zip((-score[picked]).astype(np.int64).tolist(), ids[picked].tolist(), strict=True))
        return {(-self._exact(i, int(cols[j])), int(ids[j])) for j in picked.tolist()}


def above(product: float, q_length: float, q_radius: float, length: float, radius: float) -> float:
    """What no inner product of two balls exceeds, with room for rounding; infinite where floats do not tell."""
    bound = product + q_length * radius + q_radius * length + q_radius * radius
    bound += 1e-9 * (abs(product) + q_length * (length + radius) + q_radius * (length + radius)) + 1e-6
    return bound if bound == bound else math.inf


def below(score: int) -> float:
    """A float that is not above a score."""
    try:
        f = float(score)
    except OverflowError:
        return 1.7e308 if score > 0 else -math.inf
    return f if abs(score) < 2**53 else math.nextafter(f, -math.inf)


def rank_key(score: int) -> str:
    """A text whose falling order, after the score's nearest bigint, is that of the scores."""
    if -_TOP <= score < _TOP:
        return "1"
    size = f"{abs(score):0560x}"
    return "2" + size if score > 0 else "0" + size.translate(str.maketrans("0123456789abcdef", "fedcba9876543210"))


def _packed(table: pa.Table) -> pa.Table:
    rows = sorted(zip(table.column("id").to_pylist(), table.column("v").to_pylist(), table.column("floor").to_pylist(), strict=True), key=lambda r: r[:2])
    wide = max(len(r[1]) for r in rows)
    x = np.array([r[1] + [0.0] * (wide - len(r[1])) for r in rows], np.float64).reshape(len(rows), wide)
    floors = np.array([-np.inf if r[2] is None else r[2] for r in rows])
    body = pack(np.array([r[0] for r in rows], np.int64), np.array([wide], np.int64), x.ravel(), floors)
    return pa.table({"block": table.column("block").slice(0, 1), "body": pa.array([body], pa.binary())})


def _opened(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, wide, x, floors = unpack(body)
    return ids, x.reshape(len(ids), int(wide[0])), floors


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            (q_ids, q, floors), (ids, x, _) = _opened(row["queries"]), _opened(row["body"])
            wide = max(q.shape[1], x.shape[1])
            q, x = (np.pad(a, ((0, 0), (0, wide - a.shape[1]))) for a in (q, x))
            found = Search(q, q_ids, x, ids, k, floors).best
            rows = [(int(i), j, -s) for i, own in zip(q_ids, found, strict=True) for s, j in own]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([min(max(r[2], -_TOP), _TOP - 1) for r in rows], pa.int64()),
                pa.array([rank_key(r[2]) for r in rows], pa.string()), pa.array([below(r[2]) for r in rows], pa.float64()),
            ], ["query_id", "vec_id", "score", "rank_key", "floor"])

    return run


_FOUND = "query_id bigint, vec_id bigint, score bigint, rank_key string, floor double"


def _filled(x: list[list[float]], wide: int) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.floor(256 * np.array([v + [0.0] * (wide - len(v)) for v in x], np.float64).reshape(len(x), wide))


def _cells(pivots: np.ndarray, n_asked: int):
    """Each vector's cell and its distance from the pivot, among all pivots and, for queries, among the first n_asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(low, BLOCK)
                x = _filled(rows.column("v").to_pylist(), pivots.shape[1])
                far = np.stack([_far(x, p) for p in pivots], 1)
                own, asked, each = far.argmin(1), far[:, :n_asked].argmin(1), np.arange(len(far))
                found = [pa.array(own.astype(np.int32)), pa.array(far[each, own]), pa.array(asked.astype(np.int32)), pa.array(far[each, asked])]
                yield pa.RecordBatch.from_arrays([*rows.columns, *found], [*rows.schema.names, "cell", "far", "lot", "lot_far"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each row for which is_query holds."""
    spark = vectors.sparkSession
    v = column(vector_col).cast("array<double>")
    sound = v.isNotNull() & column(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(sound).select(column(id_col).cast("bigint").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).distinct()
    rows = written(rows, "vectors")
    n, m, wide = rows.agg(F.count("*"), F.count_if("asks"), F.max(F.size("v"))).first()
    wide, many = max(wide or 0, 1), lambda of, size: max(1, min(CELLS, -(-of // size)))
    sample = _filled([list(r.v) for r in rows.orderBy(F.xxhash64("id", F.lit(5)), "id", "v").limit(SAMPLE).select("v").collect()], wide) if n > BLOCK else np.zeros((1, wide))
    pivots = sample[net(sample, 0, _far(sample, sample[0]), 0.0, many(n, BLOCK))[0]]  # the first of them are a net as well
    rows = written(rows.mapInArrow(tidy(_cells(pivots, many(m, QUERIES))), "id bigint, v array<double>, asks boolean, cell int, far double, lot int, lot_far double"), "cells")
    cells = {r.cell: r for r in rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("r")).collect()}  # at most CELLS rows
    lots = {r.cell: r for r in rows.where("asks").groupBy(F.col("lot").alias("cell")).agg(F.count("*").alias("n"), F.max("lot_far").alias("r")).collect()}

    def blocks(df: DataFrame, cell: str, sizes: dict, size: int) -> DataFrame:
        count = F.lit(1).cast("bigint")
        for c, r in sizes.items():
            count = F.when(F.col(cell) == c, F.lit(max(1, -(-r.n // size))).cast("bigint")).otherwise(count)
        block = F.col(cell).cast("bigint") * (1 << 32) + F.pmod(F.xxhash64("id", F.lit(3)), count)
        return df.select(block.alias("block"), "id", "v", "floor").groupBy("block").applyInArrow(tidy(_packed), "block bigint, body binary")

    unknown = F.lit(None).cast("double")
    asks = rows.where("asks")
    data = written(blocks(rows.withColumn("floor", unknown), "cell", cells, BLOCK), "blocks")

    def search(pairs: DataFrame, asked: DataFrame, tasks: int) -> DataFrame:
        both = pairs.join(data, "block").join(asked.select(F.col("block").alias("lot"), F.col("body").alias("queries")), "lot")
        return both.select("queries", "body").repartition(max(1, min(4096, tasks))).mapInArrow(tidy(_search(k)), _FOUND)

    # for a cell of queries and one of data: the bound on their inner products, and the number of blocks
    lengths = [float(np.linalg.norm(p)) for p in pivots]
    parts = lambda r, size: max(1, -(-r.n // size))
    product = {(c, j): float(pivots[c] @ pivots[j]) for c in lots for j in cells}
    home = {c: max(cells, key=lambda j, c=c: (product[c, j], j)) for c in lots}
    meet = [(c, j, above(product[c, j], lengths[c], lots[c].r, lengths[j], cells[j].r), parts(cells[j], BLOCK)) for c, j in product]
    n_lots, n_blocks = sum(parts(r, QUERIES) for r in lots.values()), sum(parts(r, BLOCK) for r in cells.values())
    meets = spark.createDataFrame(meet, "cell int, other int, bound double, blocks bigint")
    asked = written(blocks(asks.withColumn("floor", unknown), "lot", lots, QUERIES), "asked")
    first = F.lit(None).cast("bigint")
    for c, j in home.items():
        first = F.when(F.shiftright("lot", 32) == c, F.lit(j << 32).cast("bigint")).otherwise(first)
    found = written(search(asked.select(F.col("block").alias("lot")).withColumn("block", first), asked, n_lots), "first")
    if n_blocks > 1:
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("rank_key"), "vec_id")
        known = found.distinct().withColumn("place", F.row_number().over(best)).where(F.col("place") == k).select(F.col("query_id").alias("id"), "floor")
        floored = written(blocks(asks.join(known, "id", "left"), "lot", lots, QUERIES), "floored")
        least = asks.join(known, "id", "left").groupBy("lot").agg(F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("least")).withColumnRenamed("lot", "cell")
        pairs = floored.select(F.col("block").alias("lot"), F.shiftright("block", 32).cast("int").alias("cell")).join(F.broadcast(least), "cell")  # CELLS rows at most
        pairs = pairs.join(F.broadcast(meets), "cell").where(F.col("bound") >= F.col("least"))  # CELLS squared rows at most
        pairs = pairs.select("lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("i"), "other").select("lot", (F.col("other").cast("bigint") * (1 << 32) + F.col("i")).alias("block"))
        found = found.unionAll(search(pairs.where(F.col("block") != first), floored, n_lots * n_blocks))
    found = found.drop("floor").distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("rank_key"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
