"""Near hashes by bands against brute force: random, clustered, hot bands, copies."""

import random

import pytest

from panelmill.operators import spatial


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def rows_near(n, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(n // 4)]
    out = []
    for i in range(n):
        h = rng.choice(base)
        for _ in range(rng.randint(0, 9)):
            h ^= 1 << rng.randrange(64)
        out.append((i, signed(h)))
    # a hot band: the upper half is 0; and copies
    out += [(n + i, rng.getrandbits(20)) for i in range(60)] + [(n + 60 + i, 7) for i in range(30)]
    return out + [(None, 1), (n + 100, None)]


def brute(queries, rows, most):
    return sorted((a, b, d) for a, x in queries for b, y in rows if None not in (a, b, x, y) and a != b and (d := bin((x ^ y) & (2**64 - 1)).count("1")) <= most)


@pytest.mark.parametrize("most,bands", [(3, 4), (6, 4), (8, 8), (5, 1), (6, None), (20, None)])
def test_pairs(spark, monkeypatch, most, bands):
    rows = rows_near(300, most)
    df = spark.createDataFrame(rows, "id bigint, h bigint")
    if most == 5:
        rows = rows[:200] + rows[-2:]
        df = spark.createDataFrame([(i, None if h is None else h) for i, h in rows], "id bigint, h bigint")
        most = 2
    got = sorted(map(tuple, spatial.hamming_pairs(df, "id", "h", most, bands).collect()))
    assert got == [x for x in brute(rows, rows, most) if x[0] < x[1]]
    asked = df.where("id % 7 = 0")
    own = [r for r in rows if r[0] is not None and r[0] % 7 == 0]
    assert sorted(map(tuple, spatial.hamming_search(asked, df, "id", "h", most, bands).collect())) == brute(own, rows, most)


@pytest.mark.parametrize("hot", [10])
def test_hot_bands_are_split(spark, hot):
    rows = rows_near(200, 11)
    df = spark.createDataFrame(rows, "id bigint, h bigint").where("id is not null and h is not null").select("h").distinct()
    values = sorted({h for i, h in rows if i is not None and h is not None})
    want = sorted((x, y, bin((x ^ y) & (2**64 - 1)).count("1")) for x in values for y in values if bin((x ^ y) & (2**64 - 1)).count("1") <= 6)
    assert sorted(map(tuple, spatial.band_join(df, df, 6, 4, hot).collect())) == want


def near_values(df, most):
    values = sorted(r.h for r in df.collect())
    return sorted((x, y, d) for x in values for y in values if (d := bin((x ^ y) & (2**64 - 1)).count("1")) <= most)


@pytest.mark.parametrize("most,deals", [(3, 4096), (3, 4), (6, 4096), (6, 4)])
def test_crowded_values_meet_in_blocks_when_bands_run_out(spark, monkeypatch, most, deals):
    monkeypatch.setattr(spatial, "DEALS", deals)
    df = spark.createDataFrame(rows_near(200, 5), "id bigint, h bigint").where("id is not null and h is not null").select("h").distinct()
    want = near_values(df, most)
    assert sorted(map(tuple, spatial.band_join(df, df, most, 4, 10).collect())) == want
    assert sorted(map(tuple, spatial.band_join(df, df, most, 4, 10, once=True).collect())) == [x for x in want if x[0] < x[1]]


def test_a_half_that_all_share_leaves_no_band_crowded(spark):
    rng = random.Random(3)
    values = list({rng.getrandbits(32) for _ in range(4000)})
    for level in (0, 1):
        for path in spatial._paths(4, level):
            for band in spatial._dealt(path, 4)[1]:  # bands side by side had all 4,000 under one value
                assert bin(band & (2**32 - 1)).count("1") >= 6
    df = spark.createDataFrame([(h,) for h in values], "h bigint")
    assert sorted(map(tuple, spatial.band_join(df, df, 3, 4, 100, once=True).collect())) == sorted((x, y, d) for i, x in enumerate(sorted(values)) for y in sorted(values)[i + 1 :] if (d := (x ^ y).bit_count()) <= 3)


def test_plan():
    assert spatial.band_plan(10**9, 3) and spatial.band_plan(10**9, 10) and spatial.band_plan(1000, 24) == 0
