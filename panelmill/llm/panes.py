"""Window panes with revisions: hourly totals by kind that are sent when due, taken back when more rows come, and closed.

A stateful stream takes batches of rows in order. It is started anew for each batch, on one checkpoint:

1. stage() writes all batches once, by number. Each batch also has one tick row for each shard, so that a batch without rows,
   too, reaches every shard's state. Before a batch's start its folder is moved to where the stream reads.
2. The bound W is the greatest event time of all earlier batches: one number for each batch, from one aggregation.
3. Each task adds up its rows by kind and hour with bincount before anything is shuffled, so a kind that holds most rows sends
   one row for each hour and task. Rows of closed panes are late; they go on one by one, dealt out by their ids.
4. A kind's hours are dealt out over shards (kind, hour modulo STRIPES). transformWithState keeps, for each shard, ring arrays by
   hour for each of its kinds, and beside them a sparse list of the hours that lie outside the ring: far ahead, or before its
   start. Thresholds on the hours choose what is due, what has changed after it was sent, and what is closed.

The shards' number is fixed when a stream begins. State holds open panes only: those whose hour ended less than closed ago.

Defined results: an event without a batch, or outside 0 to batches - 1, or without a time takes no part. A null kind is `none`. A
null id stays null on a late row. Repeated rows count as often as they come: the caller drops repeats. A null amount is 0. An
empty table gives an empty result. Columns of other names are left out. Lost executors cost their tasks only: state and
results are committed batch by batch in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from panelmill.llm.common import keep_folder, shared_dir, tidy

HOUR = 3_600_000_000
#: A kind's hours are dealt out to so many of its shards; a ring has SLOTS hours of each, so 128 in a row.
STRIPES, SLOTS = 8, 16
#: A shard's state is some kilobytes: small buffers, no disk set aside before it is needed, changes written instead of whole stores.
STREAM = {
    "stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "stateStore.rocksdb.allowFAllocate": "false",
    "stateStore.rocksdb.writeBufferSizeMB": "2",
    "stateStore.rocksdb.blockCacheSizeMB": "2",
    "noDataMicroBatches.enabled": "false",
}
#: Totals that a task holds before it hands them on.
HELD = 50_000
_ROUND, _LOW = 1 << 64, 24

_STAGED = "id bigint, at bigint, hour bigint, kind string, cents bigint, tick int"
_RESULT = "batch bigint, hour bigint, click_id bigint, n_rows bigint, cents bigint, record string, kind string"


def _wrapped(x: int) -> int:
    """As 64-bit arithmetic has it."""
    return (x + (_ROUND >> 1)) % _ROUND - (_ROUND >> 1)


def added(codes: np.ndarray, n: np.ndarray | None, cents: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums by code. bincount adds doubles: both halves of a sum stay below 2**53, so they are exact."""
    count = np.bincount(codes, n, size).astype(np.int64)
    low = np.bincount(codes, cents & ((1 << _LOW) - 1), size).astype(np.int64)
    return count, low + (np.bincount(codes, cents >> _LOW, size).astype(np.int64) << _LOW)


def _partial(closed: int | None):
    """A task's totals by kind and hour; late rows and ticks as they are."""
    schema = pa.schema([("tick", pa.int32()), ("late", pa.bool_()), ("id", pa.int64()), ("kind", pa.string()), ("hour", pa.int64()), ("n", pa.int64()), ("cents", pa.int64())])

    def totals(held: dict) -> pa.RecordBatch:
        n = len(held)
        return pa.RecordBatch.from_arrays([
            pa.nulls(n, pa.int32()), pa.array([False] * n), pa.nulls(n, pa.int64()), pa.array([k for k, _ in held], pa.string()), pa.array([h for _, h in held], pa.int64()),
            pa.array([x[0] for x in held.values()], pa.int64()), pa.array([_wrapped(x[1]) for x in held.values()], pa.int64()),
        ], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            tick = table.column("tick").is_valid().to_numpy(zero_copy_only=False)
            hour = table.column("hour").fill_null(0).to_numpy()
            late = ~tick & (hour < closed) if closed is not None else np.zeros(len(hour), bool)
            alone = tick | late
            if alone.any():
                own = table.filter(pa.array(alone))
                count = pa.array(late[alone].astype(np.int64))
                yield pa.RecordBatch.from_arrays([own.column("tick").combine_chunks(), pa.array(late[alone]), *(own.column(c).combine_chunks() for c in ("id", "kind", "hour")), count, own.column("cents").combine_chunks()], schema=schema)
            rest = ~alone
            if rest.any():
                kinds = table.column("kind").filter(pa.array(rest)).combine_chunks().dictionary_encode()
                own = hour[rest]
                first = int(own.min())
                span = int(own.max()) - first + 1
                which = kinds.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                cents = table.column("cents").to_numpy()[rest]
                names = kinds.dictionary.to_pylist()
                code, places = (which * span + own - first), None
                if span * len(names) > 1 << 20:  # hours far apart
                    places, code = np.unique(code, return_inverse=True)
                n, c = added(code, None, cents, len(places) if places is not None else span * len(names))
                for i in np.flatnonzero(n).tolist():
                    k, h = divmod(i if places is None else int(places[i]), span)
                    x = held.setdefault((names[k], h + first), [0, 0])
                    x[0] += int(n[i])
                    x[1] += int(c[i])
                if len(held) > HELD:
                    yield totals(held)
                    held = {}
        if held:
            yield totals(held)

    return run


class Shard:
    """Open panes of one shard. A lane is a kind and a stripe of hours (hour modulo STRIPES); its place t is hour // STRIPES.

    Ring: n, cents and sent of each lane at place t modulo SLOTS, for base <= t < base + SLOTS. Over: the same, lane and place
    named, for all other places.
    """

    def __init__(self) -> None:
        self.base: int | None = None
        self.lanes: dict[tuple[str, int], int] = {}
        self.ring = np.zeros((3, 0, SLOTS), np.int64)
        self.over = np.zeros((5, 0), np.int64)  # lane, place, n, cents, sent

    @classmethod
    def load(cls, raw: bytes) -> Shard:
        row, out = pa.ipc.open_stream(raw).read_next_batch(), cls()
        array = lambda c: row.column(c).values.to_numpy()
        out.base = row.column("base")[0].as_py()
        out.lanes = {x: i for i, x in enumerate(zip(row.column("kind").values.to_pylist(), array("stripe").tolist(), strict=True))}
        out.ring = array("ring").reshape(3, len(out.lanes), SLOTS).copy()
        out.over = array("over").reshape(5, -1).copy()
        return out

    def dump(self) -> bytes:
        of = lambda x, kind: pa.array([x], pa.list_(kind))
        row = pa.RecordBatch.from_pydict({
            "base": pa.array([self.base], pa.int64()), "kind": of([k for k, _ in self.lanes], pa.string()), "stripe": of([s for _, s in self.lanes], pa.int64()),
            "ring": of(self.ring.ravel(), pa.int64()), "over": of(self.over.ravel(), pa.int64()),
        })
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(row)
        return sink.getvalue().to_pybytes()

    def _cells(self, place: np.ndarray) -> np.ndarray:
        """Which places are in the ring."""
        return (place >= self.base) & (place < self.base + SLOTS)

    def step(self, kinds: list[str], hours: np.ndarray, n: np.ndarray, cents: np.ndarray, due: int | None, closed: int | None, last: bool) -> list[tuple[str, np.ndarray, list[str], np.ndarray, np.ndarray]]:
        """Adds totals and returns (record, hours, kinds, n, cents) of what is to be written; then forgets closed panes."""
        stripe, place = hours % STRIPES, hours // STRIPES
        lane = np.array([self.lanes.setdefault(x, len(self.lanes)) for x in zip(kinds, stripe.tolist(), strict=True)], np.int64)
        fresh = len(self.lanes) - self.ring.shape[1]
        if fresh:
            self.ring = np.concatenate([self.ring, np.zeros((3, fresh, SLOTS), np.int64)], axis=1)
        if self.base is None and len(place):
            self.base = int(place.min())
        if self.base is None:
            return []
        # the panes before and after, those of the ring first
        before = self._flat()
        inside = self._cells(place)
        more_n, more_c = added(lane[inside] * SLOTS + place[inside] % SLOTS, n[inside], cents[inside], self.ring[0].size)
        self.ring[0] += more_n.reshape(-1, SLOTS)
        self.ring[1] += more_c.reshape(-1, SLOTS)
        self._add_over(lane[~inside], place[~inside], n[~inside], cents[~inside])
        lane, place, new_n, new_c, sent = after = self._flat()
        # a pane that was there before is found by its lane and place
        old = {x: i for i, x in enumerate(zip(before[0].tolist(), before[1].tolist(), strict=True))}
        was = np.array([old.get(x, -1) for x in zip(lane.tolist(), place.tolist(), strict=True)], np.int64)
        old_n, old_c = np.where(was >= 0, before[2][was], 0) if len(before[2]) else np.zeros(len(was), np.int64), np.where(was >= 0, before[3][was], 0) if len(before[3]) else np.zeros(len(was), np.int64)
        names = list(self.lanes)
        stripes = np.array([s for _, s in names], np.int64)
        hour = place * STRIPES + stripes[lane] if len(lane) else place
        dirty = (sent > 0) & (new_n != old_n)
        is_due = (sent == 0) & (hour < due) if due is not None else np.zeros(len(hour), bool)
        rest = (sent == 0) & ~is_due & last
        out = []
        for record, chosen, a, b in (("retract", dirty, old_n, old_c), ("replace", dirty, new_n, new_c), ("emit", is_due, new_n, new_c), ("final", rest, new_n, new_c)):
            if chosen.any():
                out.append((record, hour[chosen], [names[i][0] for i in lane[chosen].tolist()], a[chosen], b[chosen]))
        after[4] = sent | is_due | rest
        open_ = hour >= closed if closed is not None else np.ones(len(hour), bool)
        self._keep([x[open_] for x in after], closed)
        return out

    def _flat(self) -> list[np.ndarray]:
        """lane, place, n, cents and sent of each pane, ring and list."""
        lane, slot = np.nonzero(self.ring[0])
        place = self.base + (slot - self.base) % SLOTS
        return [np.concatenate([a, b]) for a, b in zip([lane, place, *(x[lane, slot] for x in self.ring)], self.over, strict=True)]

    def _add_over(self, lane: np.ndarray, place: np.ndarray, n: np.ndarray, cents: np.ndarray) -> None:
        if not len(lane):
            return
        rows = np.concatenate([self.over, np.stack([lane, place, n, cents, np.zeros(len(lane), np.int64)])], axis=1)
        panes, which = np.unique(rows[:2], axis=1, return_inverse=True)
        count, total = added(which.ravel(), rows[2], rows[3], panes.shape[1])
        sent = np.bincount(which.ravel(), rows[4], panes.shape[1]).astype(np.int64)
        self.over = np.concatenate([panes, np.stack([count, total, sent])])

    def _keep(self, panes: list[np.ndarray], closed: int | None) -> None:
        """The panes that stay, in a ring that begins with the first open hour; lanes without panes go."""
        if closed is not None:
            self.base = max(self.base, closed // STRIPES)
        lane, place, n, cents, sent = panes
        names, used = list(self.lanes), np.unique(lane)
        self.lanes = {names[i]: j for j, i in enumerate(used.tolist())}
        lane = np.searchsorted(used, lane)
        inside = self._cells(place)
        self.ring = np.zeros((3, len(used), SLOTS), np.int64)
        for k, x in enumerate((n, cents, sent)):
            self.ring[k, lane[inside], place[inside] % SLOTS] = x[inside]
        self.over = np.stack([x[~inside] for x in (lane, place, n, cents, sent)])


class Revisions(StatefulProcessor):
    """One shard's panes through one batch."""

    def __init__(self, batch: int, due: int | None, closed: int | None, last: bool):
        self.batch, self.due, self.closed, self.last = batch, due, closed, last

    def init(self, handle) -> None:
        self.kept = handle.getValueState("panes", "raw binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        had = self.kept.exists()
        shard = Shard.load(bytes(self.kept.get()[0])) if had else Shard()
        kinds, hours, n, cents = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for frame in rows:
            late = frame["late"].fillna(False).to_numpy(bool)
            if late.any():
                own = frame[late]
                yield self._rows("late", own["hour"], own["kind"], own["n"], own["cents"], own["id"])
            own = frame[~late & (frame["n"] > 0).to_numpy(bool)]
            kinds += own["kind"].tolist()
            for to, c in ((hours, "hour"), (n, "n"), (cents, "cents")):
                to.append(own[c].to_numpy(np.int64))
        for record, hour, kind, count, total in shard.step(kinds, np.concatenate(hours), np.concatenate(n), np.concatenate(cents), self.due, self.closed, self.last):
            yield self._rows(record, hour, kind, count, total, -1)
        if shard.lanes:
            self.kept.update((shard.dump(),))
        elif had:
            self.kept.clear()

    def _rows(self, record: str, hour, kind, n, cents, ids) -> pd.DataFrame:
        out = pd.DataFrame({"batch": self.batch, "hour": np.asarray(hour, np.int64), "click_id": ids, "n_rows": np.asarray(n, np.int64), "cents": np.asarray(cents, np.int64), "record": record, "kind": list(kind)})
        return out.reset_index(drop=True)

    def close(self) -> None:
        pass


def _move(spark: SparkSession, old: str, new: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(old).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path(old)):
        files.mkdirs(path(new).getParent())
        if not files.rename(path(old), path(new)):
            raise OSError(f"{old} cannot be moved to {new}")


def stage(events: DataFrame, root: str, batches: int, shards: int) -> dict[int, int]:
    """Writes the batches and their ticks; returns the greatest event time of each batch that has rows."""
    spark = events.sparkSession
    micros = F.expr("timestampdiff(microsecond, timestamp_ntz'1970-01-01 00:00:00', at)")
    rows = events.select(F.col("batch").cast("int").alias("batch"), F.col("id").cast("bigint").alias("id"), F.col("at").cast("timestamp_ntz").alias("at"), F.coalesce(F.col("kind").cast("string"), F.lit("none")).alias("kind"), F.coalesce(F.col("cents").cast("bigint"), F.lit(0)).alias("cents"))
    rows = rows.where(F.col("at").isNotNull() & F.col("batch").between(0, batches - 1)).withColumn("at", micros)
    rows = rows.select("id", "at", F.expr(f"(at - pmod(at, {HOUR}L)) div {HOUR}L").alias("hour"), "kind", "cents", F.lit(None).cast("int").alias("tick"), "batch")
    none = F.lit(None).cast("bigint")
    ticks = spark.range(batches).select(none.alias("id"), none.alias("at"), none.alias("hour"), F.lit(None).cast("string").alias("kind"), F.lit(0).cast("bigint").alias("cents"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("tick"), F.col("id").cast("int").alias("batch"))
    rows.unionByName(ticks).write.option("compression", "zstd").partitionBy("batch").parquet(f"{root}/staged")
    staged = spark.read.schema(f"{_STAGED}, batch int").parquet(f"{root}/staged")
    return {r.batch: r.most for r in staged.groupBy("batch").agg(F.max("at").alias("most")).collect() if r.most is not None}  # one row a batch


def revised(events: DataFrame, batches: int, due_after: int = 12 * HOUR, closed_after: int = 48 * HOUR, shards: int = 64) -> DataFrame:
    """events: batch (int), id, at (timestamp), kind, cents. Runs the stream over all batches and returns what it wrote.

    due_after, closed_after: microseconds from a pane's end until it is due, and closed. One row for each late row (its id as
    click_id), and for each emit, retract, replace and final of a pane (click_id -1).
    """
    spark = events.sparkSession
    root = f"{shared_dir(spark)}/panelmill/panes-{uuid.uuid4().hex}"
    keep_folder(root)
    most = stage(events, root, batches, shards)
    session = spark.newSession()  # its settings are its own
    for name, value in STREAM.items():
        session.conf.set(f"spark.sql.streaming.{name}", value)
    session.conf.set("spark.sql.shuffle.partitions", str(min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    bound: int | None = None
    for batch in range(batches):
        _move(spark, f"{root}/staged/batch={batch}", f"{root}/in/batch={batch}")
        due, closed = ((bound - x) // HOUR if bound is not None else None for x in (due_after, closed_after))
        rows = session.readStream.schema(f"{_STAGED}, batch int").parquet(f"{root}/in")
        sums = rows.drop("batch", "at").mapInArrow(tidy(_partial(closed)), "tick int, late boolean, id bigint, kind string, hour bigint, n bigint, cents bigint")
        dealt = F.pmod(F.when(F.col("late"), F.xxhash64("id")).otherwise(F.xxhash64("kind", F.pmod("hour", F.lit(STRIPES)))), F.lit(shards)).cast("int")
        keyed = sums.withColumn("shard", F.coalesce("tick", dealt)).drop("tick")
        out = keyed.groupBy("shard").transformWithStateInPandas(Revisions(batch, due, closed, batch == batches - 1), _RESULT, "Append", "None")
        query = out.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{root}/out")
        query.awaitTermination()
        if batch in most:
            bound = most[batch] if bound is None else max(bound, most[batch])
    return spark.read.schema(_RESULT).parquet(f"{root}/out")
