"""Panes with revisions against a plain walk over the rows, batch by batch."""

import datetime as dt
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from panelmill.llm import panes, queries

SF = "/root/testdata/sf0.001"


def walk(rows, batches, due_after, closed_after):
    """rows: (batch, id, hour as a float since 1970, kind, cents)."""
    out, state, bound = [], {}, None
    for b in range(batches):
        own, touched = [r for r in rows if r[0] == b], {}
        for _, i, at, kind, cents in own:
            pane = (kind or "none", int(at // 1))
            if bound is not None and bound >= pane[1] + 1 + closed_after:
                out.append((b, pane[1], i, 1, cents or 0, "late", pane[0]))
                continue
            x = state.setdefault(pane, [0, 0, False])
            touched.setdefault(pane, tuple(x))
            x[0] += 1
            x[1] += cents or 0
        for pane in list(state):
            n, c, sent = state[pane]
            if sent and pane in touched:
                out.append((b, pane[1], -1, *touched[pane][:2], "retract", pane[0]))
                out.append((b, pane[1], -1, n, c, "replace", pane[0]))
            elif not sent and bound is not None and bound >= pane[1] + 1 + due_after:
                out.append((b, pane[1], -1, n, c, "emit", pane[0]))
                state[pane][2] = True
            elif not sent and b == batches - 1:
                out.append((b, pane[1], -1, n, c, "final", pane[0]))
            if bound is not None and bound >= pane[1] + 1 + closed_after:
                del state[pane]
        bound = max([bound] * (bound is not None) + [r[2] for r in own], default=None)
    return out


def as_events(spark, rows):
    start = dt.datetime(1970, 1, 1)
    return spark.createDataFrame([(b, i, None if at is None else start + dt.timedelta(hours=at), k, c) for b, i, at, k, c in rows], "batch int, id bigint, at timestamp_ntz, kind string, cents bigint")


def random_rows(seed, n, batches, far):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        b = rng.choice([x for x in range(batches) if x != 2])  # one batch has no rows
        at = b * 24 + rng.uniform(-70, 24) + (rng.choice([-1, 1]) * rng.randint(100, 4000) if rng.random() < far else 0)
        rows.append((b, i, round(at * 16) / 16, rng.choice(["a", "a", "a", "b", None, ""]), rng.choice([None, -5, 7, 123456789012])))
    return rows


def test_shards_alone():
    """Ring, list and thresholds without a stream: many short runs, hours far ahead and before the start."""
    for seed in range(40):
        batches = 6
        rows = random_rows(seed, 120, batches, 0.1 if seed % 2 else 0)
        shards, got, bound = {}, Counter(), None
        for b in range(batches):
            due, closed = (None, None) if bound is None else (int((bound - 12) // 1), int((bound - 48) // 1))
            sums: dict = {}
            for r in rows:
                h = int(r[2] // 1)
                if r[0] == b and (closed is None or h >= closed):
                    x = sums.setdefault((r[3] or "none" if r[3] is None else r[3], h), [0, 0])
                    x[0] += 1
                    x[1] += r[4] or 0
            for s in range(3):
                own = [k for k in sums if (len(k[0]) + k[1] % panes.STRIPES) % 3 == s]
                shard = panes.Shard.load(shards[s]) if s in shards else panes.Shard()
                ints = lambda x: np.array(list(x), np.int64)
                for record, hour, kind, n, c in shard.step([k for k, _ in own], ints(h for _, h in own), ints(sums[k][0] for k in own), ints(sums[k][1] for k in own), due, closed, b == batches - 1):
                    got.update((b, int(h), -1, int(x), int(y), record, k) for h, k, x, y in zip(hour, kind, n, c, strict=True))
                shards.pop(s, None)
                if shard.lanes:
                    shards[s] = shard.dump()
            bound = max([bound] * (bound is not None) + [r[2] for r in rows if r[0] == b], default=None)
        named = [(b, i, at, "none" if k is None else k, c) for b, i, at, k, c in rows]
        want = Counter(r for r in walk_named(named, batches) if r[5] != "late")
        assert got == want, seed


def walk_named(rows, batches):
    """walk() takes an empty kind for none; here kinds are named already."""
    tagged = walk([(b, i, at, "k" + k, c) for b, i, at, k, c in rows], batches, 12, 48)
    return [(*r[:6], r[6][1:]) for r in tagged]


def test_sums_are_exact():
    rng = np.random.default_rng(1)
    cents = rng.integers(-(2**52), 2**52, 1000)
    codes = rng.integers(0, 3, 1000)
    n, c = panes.added(codes, None, cents, 4)
    assert n.tolist() == [int((codes == i).sum()) for i in range(4)]
    assert c.tolist() == [sum(cents[codes == i].tolist()) for i in range(4)]


def test_stream_as_walk(spark):
    rows = random_rows(99, 900, 4, 0.03)
    odd = [(None, 1, 0.0, "a", 1), (0, 2, None, "a", 1), (4, 3, 1.0, "a", 1), (-1, 4, 1.0, "a", 1)]
    events = as_events(spark, rows + odd + [(3, None, -900.0, "a", 2)])
    got = Counter(tuple(r) for r in panes.revised(events.withColumn("hour", events.cents).withColumn("tick", events.kind), 4, shards=5).collect())
    named = [(b, i, at, "none" if k is None else k, c) for b, i, at, k, c in rows + [(3, None, -900.0, "a", 2)]]
    assert got == Counter(walk_named(named, 4))


def test_empty(spark):
    assert panes.revised(as_events(spark, [(0, 1, 1.0, "a", 1)]).limit(0), 2, shards=2).count() == 0


def test_query_as_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view clicks as select * from '{os.path.join(SF, 'clicks.parquet')}'")
    want = sorted(c.execute(queries.PANES).fetchall())
    assert sorted(tuple(r) for r in queries.op12_pane_revisions(spark, SF).collect()) == want
