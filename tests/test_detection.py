"""Detection quality against a walk over the ranked boxes."""

import random
import statistics

import pytest

from panelmill.operators import detection


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    i = max(w, 0) * max(h, 0)
    u = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i
    return i / u if u > 0 else 0.0


def walk(found, truth, least):
    out = {}
    for cls in {t[2] for t in truth}:
        own, taken, flags = [t for t in truth if t[2] == cls], set(), []
        for f in sorted((f for f in found if f[2] == cls), key=lambda f: (-f[3], f[0], f[1])):
            near = sorted((-iou(t[3], f[4]), t[1]) for t in own if t[0] == f[0] and (t[0], t[1]) not in taken and iou(t[3], f[4]) >= least)
            if near:
                taken.add((f[0], near[0][1]))
            flags.append((f[3], bool(near)))
        steps, n, h = [], 0, 0
        for s in sorted({s for s, _ in flags}, reverse=True):
            n += sum(x == s for x, _ in flags)
            h += sum(ok for x, ok in flags if x == s)
            steps.append((h / len(own), h / n))
        best = lambda r: max((p for q, p in steps if q >= r - 1e-12), default=0.0)
        area, last = 0.0, 0.0
        for r, _ in steps:
            area += (r - last) * best(r)
            last = r
        points = sum(best(k / 100) for k in range(101)) / 101 if steps else 0.0
        out[cls] = (len(own), area, points)
    return out


def boxes(rng, n, figs, classes, ids):
    out = []
    for _ in range(n):
        x, y = rng.choice([0, 1, 2, 3]), rng.choice([0, 1, 2])
        out.append((rng.randrange(figs), next(ids), rng.choice(classes), (x, y, x + rng.choice([2, 3]), y + 2)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_walk(spark, seed):
    rng, ids = random.Random(seed), iter(range(10**6))
    truth = boxes(rng, 60, 8, "abd", ids)  # d is never found, c is never true
    found = [(*f[:3], rng.choice([0.0, 0.1, 0.5, 0.5, 0.9, 1.0, rng.random()]), f[3]) for f in boxes(rng, 120, 8, "abc", ids)]
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    f = spark.createDataFrame([(*x[:4], tuple(map(float, x[4]))) for x in found], f"fig bigint, id bigint, cls string, score double, box {box}")
    t = spark.createDataFrame([(*x[:3], tuple(map(float, x[3]))) for x in truth], f"fig bigint, id bigint, cls string, box {box}")
    got = {r.cls: (r.n_truths, r.area, r.points) for r in detection.detection_quality(f, t).collect()}
    want = walk(found, truth, 0.5)
    assert got.keys() == want.keys() and got["d"] == (want["d"][0], 0.0, 0.0)
    for cls, x in want.items():
        assert got[cls] == pytest.approx(x)
    mean = detection.mean_precision(detection.detection_quality(f, t)).first()
    assert mean.n_classes == len(want) and mean.area == pytest.approx(statistics.mean(x[1] for x in want.values()))
    best = {(r.fig, r.id): r.best for r in detection.best_overlaps(t, f).collect()}
    assert best == pytest.approx({(x[0], x[1]): max((iou(x[3], y[4]) for y in found if y[0] == x[0]), default=0.0) for x in truth})
    assert detection.median_overlap(t, f).first().median == pytest.approx(statistics.median(best.values()))


def test_nothing(spark):
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    t = spark.createDataFrame([(1, 1, "a", (0.0, 0.0, 1.0, 1.0))], f"fig bigint, id bigint, cls string, box {box}")
    f = spark.createDataFrame([], f"fig bigint, id bigint, cls string, score double, box {box}")
    assert [tuple(r) for r in detection.detection_quality(f, t).collect()] == [("a", 1, 0.0, 0.0)]
    assert detection.detection_quality(t.withColumn("score", t.box.x0), t.limit(0)).count() == 0
