"""Joins of boxes within a figure: an equi join on the figure with a geometric condition; pairs of near hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, product
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.functions.boxes import iou, overlap
from panelmill.sources.scratch import folder

BLOCK, ROWS = 4096, 256
#: Hashes that may share a band's value before it is split; partitions that blocks are dealt to; values
#: that a hash may ask for in one band; bands and flips of one level; pairs that leave a task at once.
HOT, TASKS, PROBES, DEALS, PAIRS = 2048, 10_000, 600, 4096, 1 << 20


def touches(parent: Column, child: Column, least_iou: float = 0.3, least_overlap: float = 0.7) -> Column:
    return (iou(parent, child) >= least_iou) | (overlap(child, parent) >= least_overlap)


def spatial_join(parents: DataFrame, children: DataFrame, figure: str = "fig", condition: Callable[[Column, Column], Column] = touches, how: str = "inner") -> DataFrame:
    """parents (fig, id, box) and children (fig, id, box): fig, parent_id, parent, child_id, child. Left: every child."""
    p = parents.select(figure, F.col("id").alias("parent_id"), F.col("box").alias("parent"))
    c = children.select(F.col(figure).alias("_fig"), F.col("id").alias("child_id"), F.col("box").alias("child"))
    out = c.join(p, (F.col(figure) == F.col("_fig")) & condition(F.col("parent"), F.col("child")), how)
    return out.withColumn(figure, F.coalesce(figure, "_fig")).drop("_fig")


def hierarchy(panels: DataFrame, labels: DataFrame, images: DataFrame, figure: str = "fig") -> DataFrame:
    """For each panel the ids of its labels and images, and the box that spans it and its images. Ids may repeat between figures."""
    child = lambda df, kind: df.select(figure, F.struct(F.lit(kind).alias("kind"), F.col("id").alias("id")).alias("id"), "box")
    kids = spatial_join(panels, child(labels, "label").unionByName(child(images, "image")), figure).select(figure, "parent_id", F.col("child_id.id").alias("child_id"), F.col("child_id.kind").alias("kind"), "child")
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("child_id")))).alias(f"{kind}_ids")
    image = F.when(F.col("kind") == "image", F.col("child"))
    found = kids.groupBy(figure, "parent_id").agg(of("label"), of("image"), F.min(image["x0"]).alias("_x0"), F.min(image["y0"]).alias("_y0"), F.max(image["x1"]).alias("_x1"), F.max(image["y1"]).alias("_y1"))
    out = panels.join(found.withColumnRenamed("parent_id", "id"), [figure, "id"], "left")
    none = F.array().cast("array<bigint>")
    return out.select(
        figure, F.col("id").alias("panel_id"), F.coalesce("label_ids", none).alias("label_ids"), F.coalesce("image_ids", none).alias("image_ids"),
        F.least(F.col("box.x0"), F.col("_x0")).alias("x0"), F.least(F.col("box.y0"), F.col("_y0")).alias("y0"), F.greatest(F.col("box.x1"), F.col("_x1")).alias("x1"), F.greatest(F.col("box.y1"), F.col("_y1")).alias("y1"),
    )


def first_parent(parents: DataFrame, children: DataFrame, figure: str = "fig") -> DataFrame:
    """Each child with the first panel (by id) that it touches; null if there is none. Ids may repeat between figures."""
    w = Window.partitionBy(figure, "child_id").orderBy(F.col("parent_id").asc_nulls_last())
    return spatial_join(parents, children, figure, how="left").withColumn("_n", F.row_number().over(w)).where("_n = 1").select(figure, "child_id", "parent_id")


def overlaps_of(parents: DataFrame, children: DataFrame, figure: str = "fig", least: float = 0.05) -> DataFrame:
    """child_id and a map from panel to the share of the child that lies in it."""
    hits = spatial_join(parents, children, figure, lambda p, c: overlap(c, p) > least)
    return hits.groupBy(figure, "child_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("parent_id", overlap(F.col("child"), F.col("parent")))))).alias("overlaps"))


def _sign_blocks(rows: DataFrame, key: str, value: str, size: int) -> tuple[DataFrame, int]:
    """Blocks of about `size` rows (block, ids, hs), dealt by a hash of the key, and their number."""
    rows = rows.select(F.col(key).cast("bigint").alias("id"), F.col(value).cast("bigint").alias("h")).where("id is not null and h is not null")
    n = max(1, -(-rows.count() // size))
    return rows.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("block")).agg(F.collect_list("id").alias("ids"), F.collect_list("h").alias("hs")), n


def _near(most: int):
    """Pairs of two blocks of each row within `most` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, hs, other_ids, other_hs = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("ids", "hs", "other_ids", "other_hs"))
                for i in range(0, len(ids), ROWS):
                    distance = np.bitwise_count((hs[i : i + ROWS, None] ^ other_hs[None, :]).view(np.uint64))
                    x, y = np.nonzero(distance <= most)
                    a, b, d = ids[i + x], other_ids[y], distance[x, y].astype(np.int32)
                    keep = a != b
                    yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep]), pa.array(d[keep])], ["a", "b", "distance"])

    return run


_PAIR = "a bigint, b bigint, distance int"


def band_plan(n: int, most: int) -> int:
    """The number of bands that makes the fewest candidates among n hashes at random; 0 if comparing all is as good.

    Of two hashes within `most` bits, some band of m differs in most // m bits or fewer (pigeonhole).
    """

    def cost(m: int) -> float:
        width, r = 64 // m, most // m
        probes = sum(comb(width, i) for i in range(r + 1))
        return m * probes * (1 + n / 2.0**width)

    fits = [m for m in range(1, most + 2) if sum(comb(64 // m + 1, i) for i in range(most // m + 1)) <= PROBES]
    best = min(fits, key=cost)
    return best if cost(best) < n / 4 else 0


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _dealt(path: tuple[int, ...], m: int) -> tuple[int, list[int]]:
    """(the bits that the bands of path have taken, the m bands that the others are dealt to). Bits are dealt in turn, so that a run of
    bits which all hashes share is spread over all bands."""
    left = list(range(64))
    for n, i in enumerate((*path, None)):
        bands = [sum(1 << b for b in left[k::m]) for k in range(m)]
        if i is not None:
            left = [b for b in left if not bands[i] >> b & 1]
    return sum(1 << b for b in range(64) if b not in left), bands


def _paths(m: int, level: int) -> list[tuple[int, ...]]:
    """The bands taken before a level, in the order of their numbers: the digits to base m."""
    return list(product(range(m), repeat=level))


def _flips(mask: int, r: int) -> list[int]:
    """All numbers with at most r bits set, each within mask: what a band's value is flipped by."""
    bits = [b for b in range(64) if mask >> b & 1]
    return [sum(1 << b for b in some) for n in range(r + 1) for some in combinations(bits, n)]


def _deals(m: int, r: int, level: int) -> list[tuple[int, int, int, int]]:
    """(path, next, mask, flip): how the rows of each path go on to its m bands."""
    return [(p, p * m + i, _signed(mask), _signed(flip)) for p, path in enumerate(_paths(m, level)) for i, mask in enumerate(_dealt(path, m)[1]) for flip in _flips(mask, r)]


def _levels(m: int, r: int) -> int:
    """How often a crowded value is split: until a level's bands and flips are too many, or no bits are left to deal."""
    n, probes = 1, sum(comb(64 // m + 1, i) for i in range(r + 1))
    while m ** (n + 1) * probes <= DEALS and bin(_dealt((0,) * n, m)[0]).count("1") < 64:
        n += 1
    return n


def _keyed(rows: DataFrame, deals: DataFrame) -> DataFrame:
    """h, path and value (the bits taken so far, with those flipped that may differ) of rows at the next level."""
    value = F.col("value").bitwiseOR(F.col("h").bitwiseAND(F.col("mask")).bitwiseXOR(F.col("flip")))
    return rows.join(F.broadcast(deals), "path").select("h", F.col("next").alias("path"), value.alias("value"))


def _close(most: int, m: int, r: int, level: int, same: bool):
    """h, g and distance of the pairs within `most` bits of each row's lists hs and gs (same: of hs alone, h < g). A pair counts
    where each of the bands taken is the first of its level that is within r bits."""

    def counts_here(path: int, far: np.ndarray) -> np.ndarray:
        digits = tuple(path // m ** (level - i) % m for i in range(level + 1))
        out = np.ones(len(far), bool)
        for i, digit in enumerate(digits):
            for band in _dealt(digits[:i], m)[1][:digit]:
                out &= np.bitwise_count(far & np.uint64(band)) > r
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0

        def given() -> pa.RecordBatch:
            h, g, far, path = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = np.zeros(len(h), bool)
            for p in np.unique(path):
                keep[path == p] = counts_here(int(p), far[path == p])
            h, g, far = h[keep], g[keep], far[keep]
            if same:
                h, g = np.minimum(h, g), np.maximum(h, g)
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(g), pa.array(np.bitwise_count(far).astype(np.int32))], ["h", "g", "distance"])

        for batch in batches:
            paths = batch.column("path").to_numpy()
            lists = [(c.values.to_numpy(), c.offsets.to_numpy()) for c in (batch.column("hs"), batch.column("hs" if same else "gs"))]
            for k in range(batch.num_rows):
                hs, gs = (values[at[k] : at[k + 1]] for values, at in lists)
                for i in range(0, len(hs), ROWS):
                    ours, theirs = hs[i : i + ROWS], gs[i:] if same else gs
                    far = (ours[:, None] ^ theirs[None, :]).view(np.uint64)
                    x, y = np.nonzero(np.bitwise_count(far) <= most)
                    if same:
                        x, y = x[y > x], y[y > x]
                    if len(x):
                        found.append((ours[x], theirs[y], far[x, y], np.full(len(x), paths[k])))
                        n += len(x)
                if n >= PAIRS:
                    yield given()
                    found, n = [], 0
        if found:
            yield given()

    return run


_LINK, _ON = "h bigint, g bigint, distance int", ["path", "value"]


def _written(df: DataFrame, at: str) -> DataFrame:
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def _blocks(asked: DataFrame, have: DataFrame, sizes: DataFrame | None, hot: int) -> DataFrame:
    """path, hs and gs: what is asked and there under one value. By sizes (asked and have of each value) both are dealt to blocks
    of about `hot` hashes, and each block of the one meets each of the other."""
    if sizes is None:
        return asked.groupBy(*_ON).agg(F.collect_list("h").alias("hs")).join(have.groupBy(*_ON).agg(F.collect_list("h").alias("gs")), _ON)
    number = lambda c: F.ceil(F.col(c) / hot).cast("int")
    sizes = sizes.select(*_ON, number("asked").alias("_x"), number("have").alias("_y"))
    listed = lambda df, n, block, name: df.join(sizes, _ON).groupBy(*_ON, "_x", "_y", F.pmod(F.xxhash64("h"), n).cast("int").alias(block)).agg(F.collect_list("h").alias(name))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    ours = listed(asked, F.col("_x"), "_a", "hs").select(*_ON, "_a", every("_y").alias("_b"), "hs")
    return ours.join(listed(have, F.col("_y"), "_b", "gs").select(*_ON, every("_x").alias("_a"), "_b", "gs"), [*_ON, "_a", "_b"])


def band_join(left: DataFrame, right: DataFrame, most: int, m: int, hot: int = HOT, once: bool = False) -> DataFrame:
    """h, g and distance: hashes of left and right (h each, distinct) within `most` bits, by m bands.

    Rows meet where a band's value is equal up to most // m bits, and are compared block by block. A value that more than `hot` hashes
    share is split by m bands of the bits that are left, of which one again differs in most // m bits or fewer; and so on until a value is
    not crowded or bands run out: then blocks of about `hot` hashes meet blocks. once: left is right, and each pair is given once, h < g.
    Values that are crowded are written to the shared folder when this is called.
    """
    spark, r = left.sparkSession, most // m
    same, at, levels = once and r == 0, folder(spark, "bands"), _levels(m, r)
    start = lambda df: df.select("h", F.lit(0).alias("path"), F.lit(0).cast("bigint").alias("value"))
    asked, have, out = start(left), start(right), None
    for level in range(levels):
        deals = spark.createDataFrame(_deals(m, r, level), "path int, next int, mask bigint, flip bigint")
        have = _keyed(have, deals.where("flip = 0"))
        asked = have if same else _keyed(asked, deals)
        if same:
            sizes = have.groupBy(*_ON).agg(F.count("*").alias("have")).withColumn("asked", F.col("have"))
        else:
            both = have.select(*_ON, F.lit(0).alias("a"), F.lit(1).alias("b")).unionByName(asked.select(*_ON, F.lit(1).alias("a"), F.lit(0).alias("b")))
            sizes = both.groupBy(*_ON).agg(F.sum("a").alias("asked"), F.sum("b").alias("have")).where("asked > 0 and have > 0")
        crowded = _written(sizes.where(F.greatest("asked", "have") > hot), f"{at}/crowded-{level}")
        rest = lambda df: df.join(crowded, _ON, "left_anti")  # noqa: B023, E731
        groups = [rest(have).groupBy(*_ON).agg(F.collect_list("h").alias("hs")).where("size(hs) > 1") if same else _blocks(rest(asked), rest(have), None, hot)]
        done = crowded.isEmpty()
        have = have.join(crowded.select(*_ON), _ON, "left_semi")
        asked = have if same else asked.join(crowded.select(*_ON), _ON, "left_semi")
        parts = [groups[0].mapInArrow(_close(most, m, r, level, same), _LINK)]
        if level == levels - 1 and not done:
            parts.append(_blocks(asked, have, crowded, hot).mapInArrow(_close(most, m, r, level, False), _LINK))
        for part in parts:
            out = part if out is None else out.unionByName(part)
        if done:
            break
    return out.where("h < g") if once else out


def _members(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.select(F.col(key).cast("bigint").alias("id"), F.col(value).cast("bigint").alias("h")).where("id is not null and h is not null")


def hash_classes(hashes: DataFrame, key: str, value: str, most: int, bands: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(classes: h and its least id and size; links: h, g, distance with h < g). Rows of one hash are one class, so copies are
    never paired with each other; the links say which classes are near."""
    rows = _members(hashes, key, value)
    classes = _written(rows.groupBy("h").agg(F.min("id").alias("id"), F.count("*").alias("n")), folder(rows.sparkSession, "classes"))
    m = band_plan(classes.count(), most) if bands is None else bands
    distinct = classes.select("h")
    links = band_join(distinct, distinct, most, m, once=True) if m else _scanned(distinct, distinct, most)
    return classes, links.where("h < g")


def _scanned(left: DataFrame, right: DataFrame, most: int) -> DataFrame:
    """As band_join, by blocks: where no band prunes."""
    own = lambda df: df.select(F.col("h").alias("id"), "h")
    return _block_search(own(left), own(right), "id", "h", most).select(F.col("a").alias("h"), F.col("b").alias("g"), "distance")


def hamming_pairs(hashes: DataFrame, key: str, value: str, most: int, bands: int | None = None) -> DataFrame:
    """a, b and distance: all rows a < b by key whose 64-bit hashes differ in at most `most` bits.

    Distinct hashes are joined by bands (band_plan chooses how many, 0: block by block), then rows of near hashes, and of one
    hash, are paired. Rows without key or hash take no part.
    """
    rows = _members(hashes, key, value)
    _, links = hash_classes(hashes, key, value, most, bands)
    near = links.join(rows.withColumnRenamed("id", "_x"), "h").join(rows.select(F.col("id").alias("_y"), F.col("h").alias("g")), "g").select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), "distance").where("a <> b")
    same = rows.withColumnRenamed("id", "a").join(rows.withColumnRenamed("id", "b"), "h").where("a < b").select("a", "b", F.lit(0).alias("distance"))
    return near.unionByName(same)


def hamming_search(queries: DataFrame, hashes: DataFrame, key: str, value: str, most: int, bands: int | None = None) -> DataFrame:
    """a (a query), b and distance: all rows with another key within `most` bits of each query, by bands as in hamming_pairs. Rows
    without key or hash take no part."""
    asked, rows = _members(queries, key, value), _members(hashes, key, value)
    m = band_plan(rows.count(), most) if bands is None else bands
    if not m:
        return _block_search(queries, hashes, key, value, most)
    links = band_join(asked.select("h").distinct(), rows.select("h").distinct(), most, m)
    found = links.join(asked.withColumnRenamed("id", "a"), "h").join(rows.select(F.col("id").alias("b"), F.col("h").alias("g")), "g")
    return found.where("a <> b").select("a", "b", "distance")


def _block_search(queries: DataFrame, hashes: DataFrame, key: str, value: str, most: int) -> DataFrame:
    """As hamming_search; blocks of queries meet blocks of rows."""
    blocks, n = _sign_blocks(hashes, key, value, BLOCK)
    asked, m = _sign_blocks(queries, key, value, BLOCK)
    each = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("block"), F.col("block").alias("other"), F.col("ids").alias("other_ids"), F.col("hs").alias("other_hs"))
    return asked.join(each, "block").repartition(min(n * m, TASKS), "block", "other").mapInArrow(_near(most), _PAIR)
