"""Columns over boxes. A box is a struct or four columns x0, y0, x1, y1 in one coordinate system."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGES = ("x0", "y0", "x1", "y1")


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(*[c.cast("double").alias(n) for c, n in zip((x0, y0, x1, y1), EDGES, strict=True)])


def area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def intersection(a: Column, b: Column) -> Column:
    wide = F.greatest(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.lit(0.0))
    return wide * F.greatest(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the union has no area."""
    both = intersection(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def overlap(a: Column, b: Column) -> Column:
    """The share of a that lies in b; 0 where a has no area."""
    return F.when(area(a) > 0, intersection(a, b) / area(a)).otherwise(0.0)


def union_of(boxes: Callable[[str], Column]) -> Column:
    """The aggregate that spans a group's boxes; boxes gives the column of an edge."""
    return F.struct(F.min(boxes("x0")).alias("x0"), F.min(boxes("y0")).alias("y0"), F.max(boxes("x1")).alias("x1"), F.max(boxes("y1")).alias("y1"))


def span(a: Column, b: Column) -> Column:
    return F.struct(F.least(a["x0"], b["x0"]).alias("x0"), F.least(a["y0"], b["y0"]).alias("y0"), F.greatest(a["x1"], b["x1"]).alias("x1"), F.greatest(a["y1"], b["y1"]).alias("y1"))


def clip(b: Column, width: Column, height: Column, least: float = 0.01) -> Column:
    """The box inside its image; null if less than a share of the image is left of either side."""
    inside = lambda v, top: F.greatest(F.lit(0.0), F.least(v, top))
    out = box(inside(b["x0"], width), inside(b["y0"], height), inside(b["x1"], width), inside(b["y1"], height))
    return F.when((out["x1"] - out["x0"] > least * width) & (out["y1"] - out["y0"] > least * height), out)


def within(b: Column, width: Column, height: Column) -> Column:
    return (b["x0"] >= 0) & (b["y0"] >= 0) & (b["x1"] > 0) & (b["y1"] > 0) & (b["x1"] <= width) & (b["y1"] <= height) & (b["x0"] < b["x1"]) & (b["y0"] < b["y1"])


def expand(b: Column, share: float = 0.02) -> Column:
    by = share * F.greatest(b["x1"] - b["x0"], b["y1"] - b["y0"])
    return box(b["x0"] - by, b["y0"] - by, b["x1"] + by, b["y1"] + by)


def from_percent(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Percent of the image, as corner and size, to pixels."""
    return box(x * width / 100, y * height / 100, (x + w) * width / 100, (y + h) * height / 100)


def to_thousandths(b: Column, width: Column, height: Column) -> Column:
    """0 to 1000 as integers, halves to even."""
    at = lambda v, whole: F.bround(v / whole * 1000).cast("int")
    return F.struct(at(b["x0"], width).alias("x0"), at(b["y0"], height).alias("y0"), at(b["x1"], width).alias("x1"), at(b["y1"], height).alias("y1"))


def from_thousandths(b: Column, width: Column, height: Column) -> Column:
    at = lambda v, whole: F.bround(v * whole / 1000)
    return box(at(b["x0"], width), at(b["y0"], height), at(b["x1"], width), at(b["y1"], height))


def to_shares(b: Column, width: Column, height: Column) -> Column:
    return box(b["x0"] / width, b["y0"] / height, b["x1"] / width, b["y1"] / height)


def to_coco(b: Column) -> Column:
    return F.struct(b["x0"].alias("x"), b["y0"].alias("y"), (b["x1"] - b["x0"]).alias("w"), (b["y1"] - b["y0"]).alias("h"), area(b).alias("area"))


def from_coco(x: Column, y: Column, w: Column, h: Column) -> Column:
    return box(x, y, x + w, y + h)


def to_yolo(b: Column, width: Column, height: Column) -> Column:
    return F.struct(((b["x0"] + b["x1"]) / 2 / width).alias("cx"), ((b["y0"] + b["y1"]) / 2 / height).alias("cy"), ((b["x1"] - b["x0"]) / width).alias("w"), ((b["y1"] - b["y0"]) / height).alias("h"))


def from_points(points: Column) -> Column:
    """The box of an array of four points (x, y); null for any other number of them."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.when(F.size(points) == 4, box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))


def page_of(b: Column, pages: Column, width: Column) -> Column:
    """Pages side by side, all of one width: the page on which a box begins, and its edges on it."""
    at = F.least(F.floor(b["x0"] / (width / F.size(pages))), F.size(pages) - 1).cast("int")
    left = at * (width / F.size(pages))
    return F.struct(F.get(pages, at).alias("page"), (b["x0"] - left).alias("x0"), (b["x1"] - left).alias("x1"))


def hamming(a: Column, b: Column) -> Column:
    """Bits in which two 64-bit hashes differ."""
    return F.bit_count(a.bitwiseXOR(b))


def gap(a: Column, b: Column) -> Column:
    """The distance between two boxes; 0 where they touch."""
    apart = lambda low, high: F.greatest(F.lit(0.0), a[low] - b[high], b[low] - a[high])
    return F.sqrt(F.pow(apart("x0", "x1"), 2) + F.pow(apart("y0", "y1"), 2))


def polygon(b: Column) -> Column:
    """The corners of a box in one list, from the upper left, clockwise."""
    return F.array(b["x0"], b["y0"], b["x1"], b["y0"], b["x1"], b["y1"], b["x0"], b["y1"])


def checked(b: Column, width: Column, height: Column) -> Column:
    """The box; reading one that does not lie within its image fails."""
    return F.when(within(b, width, height), b).otherwise(F.raise_error(F.concat(F.lit("box outside its image: "), F.to_json(b))))
