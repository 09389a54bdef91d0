"""A log kept as segment files on shared storage, read as a batch or a stream from any offset.

Segments are published like any table's files (``manifest``): each document of
the manifest names the files of one append and the offsets that they hold. The
Spark source below plans over the manifest alone. Its own position is the
manifest's version and, per topic and partition, the next offset; a stream reads
the segments that were published since. Keys that the starting offsets do not
name begin at their earliest offset, so nobody has to know which partitions
exist. Segments that lie below the starting offsets, or belong to other topics,
are never opened; of the others, rows below are left out while reading.

Planning and reading run in Python processes without a Spark session, so they
reach the storage through Arrow's file systems. Rows come back as Arrow batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..schemas import KEY, LOG_RECORD
from .manifest import PublishedTable
from .versions import name_of

FORMAT = "tidemark_segments"
_COLUMNS = pa.schema([
    ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")),
    ("key", pa.string()), ("value", pa.string()),
])

#: {topic: {partition as text: offset}}
Offsets = dict[str, dict[str, int]]


def append_segments(records: DataFrame, path: str, run_id: str | None = None, batch_id: int = 0) -> None:
    """Publish ``LOG_RECORD`` rows as segments, each a narrow range of offsets; a hot partition is split by offset.

    The same ``run_id`` and ``batch_id`` again replace their first attempt.
    """
    rows = records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LOG_RECORD.fields])
    ordered = rows.repartitionByRange(*KEY, "offset").sortWithinPartitions(*KEY, "offset")
    PublishedTable(records.sparkSession, path, run_id or uuid.uuid4().hex).write(ordered, batch_id)


def read_segments(
    spark: SparkSession, path: str, streaming: bool = False, floors: DataFrame | None = None, topics: tuple[str, ...] = (),
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The log from ``floors`` (``topic, partition, next_offset``) on; without any, from the beginning.

    Option ``maxVersionsPerTrigger`` bounds what a micro-batch of a stream takes, but for the first one after a
    restart, which takes all there is. The floors pass through the driver as the source's starting offsets: one number per log partition.
    """
    spark.dataSource.register(SegmentLog)
    starting: Offsets = {}
    if floors is not None:
        for r in floors.select(*KEY, "next_offset").toLocalIterator():
            starting.setdefault(r.topic, {})[str(r.partition)] = r.next_offset
    reader = spark.readStream if streaming else spark.read
    return reader.format(FORMAT).options(**(options or {})).option("startingOffsets", json.dumps(starting)).option("topics", json.dumps(list(topics))).load(path)


def _storage(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(quote(path, safe="/:@=&?,;+$!*'()~"))


class Index:
    """What the manifest of a segment log says."""

    def __init__(self, path: str):
        self.fs, self.root = _storage(path.rstrip("/"))

    def _text(self, name: str) -> str | None:
        at = f"{self.root}/_manifest/versions/{name}"
        if self.fs.get_file_info(at).type != fs.FileType.File:
            return None
        with self.fs.open_input_stream(at) as stream:
            return stream.read().decode()

    def latest(self) -> int:
        hint = (self._text("_latest") or "").strip()
        n = int(hint) if hint.isdigit() else -1
        while self._text(name_of(n + 1)) is not None:
            n += 1
        return n

    def _entries(self, document: dict) -> list[dict]:
        held = ds.dataset(f"{self.root}/{document['entries']}", filesystem=self.fs, format="parquet")
        return [e for e in held.to_table().to_pylist() if e["topic"] is not None]

    def between(self, after: int, upto: int) -> list[dict]:
        """Entries published in the versions ``after + 1 .. upto``; from the beginning, those summed up for it."""
        documents = []
        for n in range(upto, after, -1):
            documents.append(json.loads(self._text(name_of(n))))
            if documents[-1].get("whole"):
                if after < 0:
                    break
                documents.pop()
        latest: dict[tuple, list[dict]] = {}
        for document in reversed(documents):
            found = self._entries(document)
            if not document.get("whole"):
                latest[(document["run_id"], document["batch_id"])] = found
                continue
            for e in found:
                latest.setdefault((e["run_id"], e["batch_id"]), []).append(e)
        return [e for found in latest.values() for e in found]


@dataclass
class Segment(InputPartition):
    """One file and, per topic and partition, the first offset wanted from it."""

    file: str
    wanted: Offsets


def segments_of(entries: list[dict], starting: Offsets, topics: list[str]) -> list[Segment]:
    """The files that hold something wanted."""
    files: dict[str, Offsets] = {}
    for e in entries:
        low = starting.get(e["topic"], {}).get(str(e["partition"]), 0)
        if (not topics or e["topic"] in topics) and e["end_offset"] >= low:
            files.setdefault(e["file"], {}).setdefault(e["topic"], {})[str(e["partition"])] = low
    return [Segment(file, wanted) for file, wanted in sorted(files.items())]


def _rows(segment: Segment) -> Iterator[pa.RecordBatch]:
    storage, path = _storage(segment.file)
    with storage.open_input_file(path) as source:
        for batch in pq.ParquetFile(source).iter_batches(batch_size=16_384, columns=_COLUMNS.names):
            keep = pa.nulls(batch.num_rows, pa.bool_())
            for topic, partitions in segment.wanted.items():
                for partition, low in partitions.items():
                    mine = pc.and_(pc.equal(batch["topic"], topic), pc.equal(batch["partition"], int(partition)))
                    keep = pc.or_(pc.fill_null(keep, False), pc.and_(mine, pc.greater_equal(batch["offset"], low)))
            kept = batch.filter(pc.fill_null(keep, False))
            if kept.num_rows:
                yield pa.RecordBatch.from_arrays([kept[f.name].cast(f.type, safe=False) for f in _COLUMNS], schema=_COLUMNS)


class _Options:
    """Spark gives option names in lower case."""

    def __init__(self, options: dict[str, str]):
        self.index = Index(options["path"])
        self.starting: Offsets = json.loads(options.get("startingoffsets", "{}"))
        self.topics: list[str] = json.loads(options.get("topics", "[]"))
        self.at_once = int(options.get("maxversionspertrigger", 0))


class SegmentReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[Segment]:
        o = _Options(self.options)
        return segments_of(o.index.between(-1, o.index.latest()), o.starting, o.topics) or [Segment("", {})]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _rows(partition) if partition.file else iter(())


class SegmentStreamReader(DataSourceStreamReader):
    """Position: ``{"version": of the manifest, "next": next offset per topic and partition}``."""

    def __init__(self, options: dict[str, str]):
        self.options = options
        self.known: dict | None = None

    def initialOffset(self) -> dict:
        self.known = {"version": -1, "next": _Options(self.options).starting}
        return self.known

    def latestOffset(self) -> dict:
        o = _Options(self.options)
        bounded = self.known is not None and o.at_once > 0
        at = self.known or {"version": -1, "next": o.starting}
        version = min(o.index.latest(), at["version"] + o.at_once) if bounded else o.index.latest()
        reached: Offsets = {t: dict(p) for t, p in at["next"].items()}
        for e in o.index.between(at["version"], version):
            mine, key = reached.setdefault(e["topic"], {}), str(e["partition"])
            mine[key] = max(mine.get(key, 0), e["end_offset"] + 1)
        self.known = {"version": version, "next": {t: dict(sorted(p.items())) for t, p in sorted(reached.items())}}
        return self.known

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        self.known = self.known if self.known and self.known["version"] >= end["version"] else end
        # What a segment brings is new by its version, whatever its offsets: one that is published late is read too.
        o = _Options(self.options)
        return segments_of(o.index.between(start["version"], end["version"]), o.starting, o.topics) or [Segment("", {})]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _rows(partition) if partition.file else iter(())


class SegmentLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return LOG_RECORD

    def reader(self, schema: StructType) -> SegmentReader:
        return SegmentReader({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema: StructType) -> SegmentStreamReader:
        return SegmentStreamReader({k.lower(): v for k, v in self.options.items()})
