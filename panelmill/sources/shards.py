"""Archives as a data source: spark.read.format("tar_shards"). One partition for each archive.

Rows: path, key (a member's name without folders and ending), member, kind (its ending), size, content. Filters on path keep whole
archives from being opened; those on key and kind, and a Bloom filter of wanted keys, decide from a member's header, before
its bytes are read: in a plain archive they are passed over, in a compressed one not kept. Options: path (a folder), wanted (from
wanted_filter), content=false (names and sizes only), counts=true (a last row for each archive, kind `#read`, whose size is the
number of members' bytes that were read).
"""

from __future__ import annotations

import base64
import re
import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

#: Bits of a filter of wanted keys (a megabyte), and how many of them each key sets.
BITS, HASHES = 1 << 23, 4
_FIELDS = pa.schema([("path", pa.string()), ("key", pa.string()), ("member", pa.string()), ("kind", pa.string()), ("size", pa.int64()), ("content", pa.binary())])
_NAME = re.compile(r"([^/]+?)(\.[^./]*)?$")


def _places(key: str) -> list[int]:
    one, two = zlib.crc32(key.encode()), zlib.crc32(key[::-1].encode()) | 1
    return [(one + i * two) % BITS for i in range(HASHES)]


def wanted_filter(wanted: DataFrame, key: str) -> str:
    """A Bloom filter of the keys, as text. Its size does not depend on their number: BITS bits reach the driver, in words."""
    k = F.col(key).cast("string")
    one, two = F.crc32(k), F.crc32(F.reverse(k)).bitwiseOR(F.lit(1).cast("bigint"))
    place = F.explode(F.array(*[(one + i * two) % BITS for i in range(HASHES)]))
    words = wanted.where(k.isNotNull()).select(place.alias("p")).groupBy(F.floor(F.col("p") / 8).alias("byte")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), (F.col("p") % 8).cast("int"))).alias("bits"))
    out = bytearray(BITS // 8)
    for r in words.toLocalIterator():
        out[r.byte] = r.bits
    return base64.b64encode(zlib.compress(bytes(out))).decode()


class _Shard(InputPartition):
    def __init__(self, uri: str):
        super().__init__(uri)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.equal = options, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = ".".join(f.attribute) if isinstance(f, EqualTo | In) else None
            if column in ("path", "key", "kind"):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.equal[column] = self.equal.get(column, values) & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, at = pa.fs.FileSystem.from_uri(self.options["path"])
        start = self.options["path"].removesuffix("/")
        names = sorted(f.path for f in system.get_file_info(pa.fs.FileSelector(at, recursive=True)) if f.is_file and re.search(r"\.(tar|tgz|tar\.gz)$", f.path))
        uris = [start + n[len(at.removesuffix("/")) :] for n in names]
        return [_Shard(u) for u in uris if u in self.equal.get("path", {u})]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, at = pa.fs.FileSystem.from_uri(partition.value)
        bits = zlib.decompress(base64.b64decode(self.options["wanted"])) if "wanted" in self.options else None
        whole, taken = self.options.get("content", "true") == "true", 0
        plain = at.endswith(".tar")
        with (system.open_input_file(at) if plain else system.open_input_stream(at, compression=None)) as file, tarfile.open(fileobj=file, mode="r:" if plain else "r|gz") as archive:
            for m in archive:
                found = _NAME.search(m.name)
                if not m.isfile() or not found:
                    continue
                key, kind = found[1], found[2] or ""
                if key not in self.equal.get("key", {key}) or kind not in self.equal.get("kind", {kind}):
                    continue
                if bits is not None and not all(bits[p >> 3] >> (p & 7) & 1 for p in _places(key)):
                    continue
                content = archive.extractfile(m).read() if whole else None
                taken += len(content or b"")
                yield self._row(partition.value, key, m.name, kind, m.size, content)
        if self.options.get("counts") == "true":
            yield self._row(partition.value, None, None, "#read", taken, None)

    @staticmethod
    def _row(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _FIELDS.types, strict=True)], schema=_FIELDS)


class TarShards(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def schema(self) -> str:
        return "path string, key string, member string, kind string, size bigint, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def shards(spark: SparkSession, path: str, wanted: DataFrame | None = None, key: str = "key", **options: str) -> DataFrame:
    """Members of the archives under path; with wanted, those whose key is one of its keys: the Bloom filter goes with the scan, a
    join takes out what it lets through by chance."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TarShards)
    reader = spark.read.format("tar_shards").options(**options)
    if wanted is None:
        return reader.load(path)
    found = reader.option("wanted", wanted_filter(wanted, key)).load(path)
    known = wanted.select(F.col(key).cast("string").alias("key")).distinct()
    return found.join(known, "key", "left_semi").select("path", "key", "member", "kind", "size", "content")


def write_shards(rows: DataFrame, path: str, shard: str, member: str, content: str) -> DataFrame:
    """One plain archive for each value of shard, with a member for each row, in order of the names; the paths and numbers of
    members. A shard is written by one task, batch by batch: its size is no matter of memory, but of that task's time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        now, at, count, file, archive = None, None, 0, None, None

        def close() -> pa.RecordBatch:
            archive.close()
            file.close()
            return pa.RecordBatch.from_pydict({"path": [at], "members": [count]}, pa.schema([("path", pa.string()), ("members", pa.int64())]))

        for batch in batches:
            for number, name, body in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                number, body = number.as_py(), body.as_py() or b""
                if archive is None or number != now:
                    if archive is not None:
                        yield close()
                    now, at, count = number, f"{path}/shard-{number:06d}.tar", 0
                    system, place = pa.fs.FileSystem.from_uri(at)
                    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    file = system.open_output_stream(place)
                    archive = tarfile.open(fileobj=file, mode="w|")
                info = tarfile.TarInfo(name.as_py())
                info.size = len(body)
                archive.addfile(info, io.BytesIO(body))
                archive.members = []  # the list of what was written, which no one reads
                count += 1
        if archive is not None:
            yield close()

    named = rows.select(F.col(shard).cast("bigint").alias("shard"), F.col(member).cast("string").alias("member"), F.col(content).cast("binary").alias("content"))
    return named.repartition("shard").sortWithinPartitions("shard", "member").mapInArrow(run, "path string, members bigint")
