"""What the operators of this subpackage share: working tables, text batches as arrays, packed columns."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are handled as arrays at once; one longer text is handled alone.
CHUNK = 4 << 20
#: Bytes of a source's files for each bucket of a table made from it.
BUCKET = 256 << 20
#: A key with more than this part of all rows is hot.
HOT_SHARE = 1000
#: Symbols, and pairs of slices, that are compared at once.
_SLAB, _PAIRS = 1 << 18, 1 << 16

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, set here only where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="panelmill-")
        spark.sparkContext.setCheckpointDir(found)
    return found


#: What operators left in the shared folder and the warehouse since this process began: paths and table names.
_MADE: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: df as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/panelmill/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_folder(path: str) -> None:
    """Notes a folder that an operator fills, so that drop_work finds it."""
    _MADE.append(path)


def made() -> int:
    """How many working tables there are; what comes later can be dropped by number."""
    return len(_MADE)


def drop_work(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Drops the working tables made since then, but for the last one (a result that was written) if keep is given. DataFrames
    that were built on them cannot be read any more."""
    last = _MADE[-1:] if keep is not None else []
    for name in set(_MADE[since:]) - set(last):
        if "/" in name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        else:
            spark.sql(f"drop table if exists {name}")
    _MADE[since:] = last


def buckets(source: DataFrame) -> int:
    """Buckets for a table made from source: one for each BUCKET bytes that its files hold, and at least the
    session's number of shuffle partitions."""
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    grown = -(-size // BUCKET) if size < 1 << 60 else 0  # beyond that Spark knows no size
    return min(max(int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")), 16, grown), 100_000)


def bucketed(df: DataFrame, name: str, key: str, n: int) -> DataFrame:
    """df as a table of n buckets by key, so that joins by key move only the other side."""
    table = f"panelmill_{name}_{uuid.uuid4().hex}"
    _MADE.append(table)
    df.write.option("compression", "zstd").bucketBy(n, key).saveAsTable(table)
    return df.sparkSession.table(table)


def joined_by_hot(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """rows joined with found (one row for each key, weight: its rows). Keys that hold over a HOT_SHARE-th of all
    rows, so fewer than HOT_SHARE keys, are broadcast; no other key makes a large task."""
    total = found.agg(F.sum("weight")).first()[0] or 0
    hot = F.col("weight") * HOT_SHARE > total
    few = F.broadcast(found.where(hot))
    return rows.join(few, key).unionByName(rows.join(few.select(key), key, "left_anti").join(found.where(~hot), key))


def column(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_text(name: str) -> Column:
    """A text column, whatever its type (an all-null column may have none)."""
    return column(name).cast("string")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores: a table of fewer files than the cluster has cores is dealt out by rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df._jdf.inputFiles()) < cores else df  # only their number leaves the JVM


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, their UTF-8 bytes, offsets of each text in them); a null text is an empty one."""
    if not batch.num_rows:
        return
    release()
    texts = batch.column(batch.schema.get_field_index(column))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    every = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(every, every[low] + limit, "right")) - 1)
        yield batch.slice(low, high - low), data[every[low] : every[high]], every[low : high + 1] - every[low]
        low = high


def release() -> None:
    """Give free memory back to the system: workers live on, and stages that follow need it."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def tidy(run: Callable) -> Callable:
    """A worker's function that gives its memory back when it is done: workers stay, with the next stage beside them."""

    @functools.wraps(run)
    def wrapped(given):
        if isinstance(given, pa.Table):
            out = run(given)
            release()
            return out
        return flow(given)

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Large rows, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            release()
            yield batch.slice(i, 1).to_pylist()[0]


def pack(*arrays: np.ndarray | bytes, level: int = 3) -> bytes:
    """Arrays as one compressed value; numbers go byte plane by byte plane, as high bytes repeat."""
    out = []
    for a in arrays:
        if isinstance(a, bytes):
            out.append((b"S", len(a), a))
        else:
            a = np.ascontiguousarray(a)
            planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else a.view(np.uint8)
            out.append((a.dtype.char.encode(), len(a), planes.tobytes()))
    head = b"".join(k + n.to_bytes(8, "little") for k, n, _ in out)
    body = head + b"".join(x for _, _, x in out)
    return len(out).to_bytes(1, "little") + zstandard.ZstdCompressor(level).compress(body)


def unpack(value: bytes) -> list:
    body = zstandard.ZstdDecompressor().decompress(value[1:])
    out, at = [], 9 * value[0]
    for i in range(value[0]):
        kind, n = body[9 * i : 9 * i + 1], int.from_bytes(body[9 * i + 1 : 9 * i + 9], "little")
        if kind == b"S":
            out.append(body[at : at + n])
            at += n
        else:
            width = np.dtype(kind.decode()).itemsize
            planes = np.frombuffer(body, np.uint8, n * width, at).reshape(width, n)
            out.append(np.ascontiguousarray(planes.T).view(kind.decode()).reshape(n))
            at += n * width
    return out


def ends(sizes: np.ndarray) -> np.ndarray:
    """Where pieces of these sizes begin and end: 0 and the running sums."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer over an array."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


_CHAIN, _LONG = np.uint64(0x9FB21C651E98DF25), 128
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


def content_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of the slices [first, last) of an array of bytes. Each eight bytes go through a finalizer
    that depends on all before, so no family of strings collides as it does for polynomials modulo 2**64.
    Slices beyond _LONG bytes go through blake2b."""
    size = (last - first).astype(np.int64)
    out = mixed(size.astype(np.uint64) * _CHAIN + np.uint64(seed))
    whole = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data) + 1, "<u8", whole, strides=(1,))
    live, k = np.flatnonzero((size > 0) & (size <= _LONG)), 0
    while len(live):
        left = size[live] - k
        out[live] = mixed((out[live] ^ (words[first[live] + k] & _FIRST[np.minimum(left, 8)])) * _CHAIN)
        live, k = live[left > 8], k + 8
    for i in np.flatnonzero(size > _LONG).tolist():
        digest = hashlib.blake2b(data[first[i] : last[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        out[i] = np.frombuffer(digest, np.uint64)[0]
    return out


def unequal(symbols: np.ndarray, first: np.ndarray, last: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether slices i and j of [first, last), pair by pair, differ, symbol by symbol."""
    out = np.zeros(len(i), bool)
    for few in range(0, len(i), _PAIRS):  # all arrays stay small
        x, y = i[few : few + _PAIRS], j[few : few + _PAIRS]
        a, b = first[x], first[y]
        n = last[x] - a
        differs = n != last[y] - b
        n[differs] = 0
        reach, low = np.cumsum(n), 0
        while low < len(x):
            high = max(low + 1, int(np.searchsorted(reach, (reach[low - 1] if low else 0) + _SLAB, "right")))
            at = ends(n[low:high])
            p = np.repeat(a[low:high] - at[:-1], n[low:high]) + np.arange(at[-1])
            bad = np.flatnonzero(symbols[p] != symbols[p + np.repeat((b - a)[low:high], n[low:high])])
            differs[low + np.searchsorted(at, bad, "right") - 1] = True
            low = high
        out[few : few + _PAIRS] = differs
    return out


def grouped(symbols: np.ndarray, first: np.ndarray, last: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each slice [first, last), a slice of each number): equal numbers for equal slices only.

    Slices are grouped by hash; each is then compared, symbol by symbol, with the first of its group. Those
    that differ from it are grouped by their symbols.
    """
    codes, distinct = pd.factorize(hashes)
    where = np.empty(len(distinct), np.int64)
    where[codes[::-1]] = np.arange(len(codes))[::-1]
    rest = np.flatnonzero(where[codes] != np.arange(len(codes)))
    wrong = rest[unequal(symbols, first, last, rest, where[codes[rest]])].tolist()
    if wrong:
        named: dict[bytes, int] = {}
        for i in wrong:
            codes[i] = named.setdefault(symbols[first[i] : last[i]].tobytes(), len(where) + len(named))
        found = np.full(len(named), -1, np.int64)
        found[codes[wrong[::-1]] - len(where)] = wrong[::-1]
        where = np.concatenate([where, found])
    return codes, where


class Rolling:
    """Polynomial hashes modulo 2**64 of any slice of an array of symbols, from random symbol values. Long
    words of few letters can collide, so they choose groups and triggers; equality is settled otherwise.

    One base serves all instances, so that a worker holds its powers once.
    """

    base = 0x5851F42D4C957F2D
    inverse = pow(base, -1, 2**64)
    powers = inverses = np.ones(1, np.uint64)

    def __init__(self, symbols: int, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 2**63, symbols, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            n = 1 << (n - 1).bit_length()

            def series(x: int) -> np.ndarray:
                out = np.ones(n, np.uint64)
                done = 1
                while done < n:
                    more = min(done, n - done)
                    out[done : done + more] = out[:more] * np.uint64(pow(x, done, 2**64))
                    done += more
                return out

            Rolling.powers, Rolling.inverses = series(self.base), series(self.inverse)

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        self._reach(len(symbols) + 1)
        out = np.zeros(len(symbols) + 1, np.uint64)
        terms = self.values[symbols]
        terms *= self.powers[: len(symbols)]
        np.cumsum(terms, out=out[1:])
        return out

    def pieces(self, sums: np.ndarray, size: int) -> np.ndarray:
        """The hashes of all slices of one size."""
        out = sums[size:] - sums[:-size]
        out *= self.inverses[: len(out)]
        return mixed(out)

    def slices(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverses[start])
