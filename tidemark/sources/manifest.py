"""Tables whose batches are published: files count once a manifest names them.

A batch writes its files into a folder of its own and describes them: for each
file the offsets it holds, as ranges per topic and partition, read back from the
files themselves. Publishing is one document (``versions``) that points to this
description. So

* readers see a batch whole or not at all, and list no directories: they take
  the files that the manifest names;
* a repeated batch publishes again, which replaces its first attempt;
* what was written, and what was refused, is known from the manifest alone,
  without reading the rows again;
* a range of offsets leads to the few files that hold some of it;
* compaction publishes fewer files in place of those of many batches.

Every ``SNAPSHOT_EVERY`` versions the live descriptions are summed up in one, so
reading the manifest does not depend on how many batches there ever were.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranges import pack_offsets, unpack_ranges
from ..schemas import KEY, META_OFFSET, META_PARTITION, META_TOPIC, OFFSET_RANGE, RAW_METADATA
from .versions import Versions

#: Where a row's offset stands: in columns of its own, or in the raw table's metadata, flat in older tables.
RECORD_ADDRESS = ("topic", "partition", "offset")
FLAT_ADDRESS = (META_TOPIC, META_PARTITION, META_OFFSET)
RAW_ADDRESS = tuple(f"{RAW_METADATA}.{f}" for f in FLAT_ADDRESS)

ENTRY = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    *OFFSET_RANGE.fields,
])
SNAPSHOT_EVERY = 16


def _file() -> Column:
    """The path of the file that a row was read from; Spark gives it percent-encoded and takes it plain."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file")


def file_ranges(rows: DataFrame, address: tuple[str, str, str] = RECORD_ADDRESS) -> DataFrame:
    """``file, topic, partition, start_offset, end_offset``: the runs of offsets that each file of ``rows`` holds.

    ``rows`` is read from files. A file without a readable address has one row without a range. Offsets are packed
    on the map side; runs are joined per file, which is as much as one task wrote.
    """
    topic, partition, offset = address
    found = rows.select(
        _file(), F.col(topic).alias("topic"),
        F.col(partition).cast("int").alias("partition"), F.col(offset).cast("bigint").alias("offset"),
    )
    pieces = unpack_ranges(pack_offsets(found, by=("file",)), by=("file",))
    inside = Window.partitionBy("file", *KEY).orderBy("start_offset")
    opens = F.col("start_offset") > F.coalesce(F.lag("end_offset").over(inside) + 1, F.lit(-1))
    runs = pieces.withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(inside))
    ranges = runs.groupBy("file", *KEY, "run").agg(F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset"))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in OFFSET_RANGE.fields]
    unread = found.where("topic is null or partition is null or offset is null").select("file").distinct().select("file", *none)
    return ranges.select("file", *OFFSET_RANGE.fieldNames()).unionByName(unread)


class PublishedTable:
    """One run's view of a table at ``path``; it writes batches of its run and reads all runs."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, address: tuple[str, str, str] | None = RECORD_ADDRESS):
        self.spark, self.path, self.run_id, self.address = spark, path.rstrip("/"), run_id, address
        self.versions = Versions(spark, f"{self.path}/_manifest/versions")

    # Writing

    def write(self, df: DataFrame, batch_id: int, partition_by: tuple[str, ...] = (), floors: DataFrame | None = None) -> DataFrame:
        """Write and publish the batch; returns its entries. The same ``batch_id`` again replaces it.

        Summaries leave out what ends below the ``floors`` (``topic, partition, next_offset``): it is not read again.
        """
        folder = f"{self.path}/run_id={self.run_id}/batch_id={batch_id}/attempt={uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(folder)
        return self._publish(folder, df.schema, batch_id, {}, floors)

    def _publish(self, folder: str, schema: T.StructType, batch_id: int, more: dict, floors: DataFrame | None = None) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(folder)
        if self.address is not None:
            found = file_ranges(rows, self.address)
        else:
            none = [F.lit(None).cast(f.dataType).alias(f.name) for f in OFFSET_RANGE.fields]
            found = rows.select(_file()).distinct().select("file", *none)
        name = self._described(found.select(
            "file", F.lit(self.run_id).alias("run_id"), F.lit(batch_id).cast("bigint").alias("batch_id"), *OFFSET_RANGE.fieldNames()
        ))
        n = self.versions.append({"run_id": self.run_id, "batch_id": batch_id, "entries": name, **more})
        if (n + 1) % SNAPSHOT_EVERY == 0:
            self.summed_up(floors)
        return self._entries_at(name)

    def _described(self, entries: DataFrame) -> str:
        name = f"_manifest/entries/{uuid.uuid4().hex}"
        entries.select(*ENTRY.fieldNames()).write.parquet(f"{self.path}/{name}")
        return name

    def summed_up(self, floors: DataFrame | None = None) -> bool:
        """Offer all live entries as one version; False if a batch was published in between."""
        tail = self.versions.tail()
        if not tail:
            return False
        live = self._live(tail)
        if floors is not None:
            low = floors.select(*KEY, F.col("next_offset").alias("_floor"))
            live = live.join(low, KEY, "left").where((F.col("run_id") != self.run_id) | F.col("_floor").isNull() | (F.col("end_offset") >= F.col("_floor")))
        name = self._described(live)
        return self.versions.put(tail[-1][0] + 1, {"entries": name, "whole": True, "compacted": _compacted(tail)})

    def compact(self, schema: T.StructType, upto: int, partition_by: tuple[str, ...] = ()) -> int:
        """Rewrite the batches up to ``upto`` of this run, since the last compaction, into fewer files.

        Only batches that cannot be repeated any more may be given. Returns the number of files replaced. The
        rows then count to batch ``upto``. A rebalance sizes the files and splits a partition that is too large.
        """
        done = _compacted(self.versions.tail()).get(self.run_id, -1)
        since = (F.col("run_id") == self.run_id) & F.col("batch_id").between(done + 1, upto)
        files = self._files(self.entries().where(since))
        if len(files) < 2:
            return 0
        rows = self._read_files(files, schema, partition_by).select(*schema.fieldNames(), *partition_by)
        folder = f"{self.path}/run_id={self.run_id}/batch_id={upto}/attempt={uuid.uuid4().hex}"
        rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(folder)
        self._publish(folder, rows.schema, upto, {"since": done + 1, "upto": upto})
        return len(files)

    # Reading

    def _entries_at(self, *names: str) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(*[f"{self.path}/{n}" for n in names])

    def _live(self, tail: list[tuple[int, dict]]) -> DataFrame:
        """Entries of the last summary and of the batches since, without what was replaced."""
        whole = [d["entries"] for _, d in tail if d.get("whole")]
        since = [d for _, d in tail if not d.get("whole")]
        live: list[dict] = []
        for d in since:
            live = [x for x in live if not _replaces(d, x)] + [d]
        found = self._entries_at(*[d["entries"] for d in live])
        if not whole:
            return found
        old = self._entries_at(*whole)
        gone = [_replaced(d) for d in since]
        if gone:
            old = old.where(~reduce(lambda a, b: a | b, gone))
        return old.unionByName(found)

    def entries(self) -> DataFrame:
        """The live files of all runs with the offsets that they hold."""
        return self._live(self.versions.tail())

    def batch(self, batch_id: int) -> DataFrame:
        """The entries of one batch of this run."""
        return self.entries().where((F.col("run_id") == self.run_id) & (F.col("batch_id") == batch_id))

    def _files(self, entries: DataFrame) -> list[str]:
        # Paths pass through the driver, as for any scan: it plans over them.
        return sorted(r.file for r in entries.select("file").distinct().toLocalIterator())

    def _layout(self, schema: T.StructType, partition_by: tuple[str, ...]) -> T.StructType:
        known = set(schema.fieldNames())
        more = [T.StructField(c, T.DateType() if c.endswith("_date") else T.StringType()) for c in partition_by if c not in known]
        own = [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())]
        return T.StructType(schema.fields + more + [f for f in own if f.name not in known])

    def _read_files(self, files: list[str], schema: T.StructType, partition_by: tuple[str, ...] = ()) -> DataFrame:
        layout = self._layout(schema, partition_by)
        if not files:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).option("basePath", self.path).parquet(*files).select(*layout.fieldNames())

    def read(self, schema: T.StructType, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """The rows of all live files, with ``run_id`` and ``batch_id``."""
        return self._read_files(self._files(self.entries()), schema, partition_by)

    def read_overlapping(self, ranges: DataFrame, schema: T.StructType) -> DataFrame:
        """Rows of this run's files that may hold offsets in ``ranges`` (topic, partition, start_offset, end_offset).

        The manifest, one row per run of offsets, is joined with the ranges; no other file is opened.
        """
        wanted = ranges.select(*KEY, F.col("start_offset").alias("_low"), F.col("end_offset").alias("_high"))
        held = self.entries().where(F.col("run_id") == self.run_id).join(wanted, KEY)
        return self._read_files(self._files(held.where("start_offset <= _high and end_offset >= _low")), schema)


def _replaces(newer: dict, older: dict) -> bool:
    if newer["run_id"] != older["run_id"]:
        return False
    return newer.get("since", newer["batch_id"]) <= older["batch_id"] <= newer["batch_id"]


def _compacted(tail: list[tuple[int, dict]]) -> dict[str, int]:
    """The last compacted batch of each run."""
    found: dict[str, int] = {}
    for _, d in tail:
        found |= d.get("compacted", {})
        if "upto" in d:
            found[d["run_id"]] = d["upto"]
    return found


def _replaced(newer: dict) -> Column:
    return (F.col("run_id") == newer["run_id"]) & F.col("batch_id").between(newer.get("since", newer["batch_id"]), newer["batch_id"])
