"""Measure the range core, the generator and the streaming paths on larger logs.

Usage: python scale_check.py [number of offsets, default 10000000]
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import bench
from tidemark.operators.envelope import to_envelope
from tidemark.operators.ranges import frontier_of, gaps_in, offsets_to_ranges
from tidemark.plans import fixtures as fx
from tidemark.schemas import KEY
from tidemark.sources.generator import random_records
from tidemark.sources.log import LogSpec, read_log
from tidemark.sources.shared import scratch_path
from tidemark.streaming.gap_processor import order_stream
from tidemark.streaming.ingest import Ingest


#: Micro-batches in the test of a flow behind an open gap.
BATCHES = 50


def scratch() -> str:
    """A fresh folder below the shared one that the session names; of this machine only where it names none."""
    return scratch_path(SparkSession.getActiveSession(), "scale")


def timed(label: str, rows: int, action) -> None:
    start = time.perf_counter()
    result = action()
    took = time.perf_counter() - start
    print(f"{label:55s} {took:7.2f} s {rows / took:14,.0f} rows/s  {result if result is not None else ''}", flush=True)


def plain_gaps(df: DataFrame) -> DataFrame:
    """One window per log partition, for comparison: one task for a hot key."""
    order = Window.partitionBy(*KEY).orderBy("offset")
    marked = df.select(*KEY, "offset").distinct().withColumn("prev", F.lag("offset", 1, -1).over(order))
    return marked.where("offset > prev + 1")


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
    spark = bench.session("8")
    one_key = spark.range(n).selectExpr("'t' as topic", "0 as partition", "id as offset")
    logs = {
        "sparse gaps": one_key.where("offset % 100003 <> 500"),
        "dense gaps (1 in 50)": one_key.where("offset % 50 <> 7"),
        "every other offset": one_key.where("offset % 2 = 0"),
        "a third of all rows are copies of one offset": one_key.selectExpr(
            "topic", "partition", "if(offset % 3 = 0, 42L, offset) as offset"
        ),
    }
    gaps_in(offsets_to_ranges(one_key.limit(1000))).count()
    for name, log in logs.items():
        timed(f"gaps, one key, {name}: two-level", n, lambda: gaps_in(offsets_to_ranges(log), disjoint=True).count())
        timed(f"gaps, one key, {name}: plain", n, lambda: plain_gaps(log).count())
    timed("frontier, one key, no gaps", n, lambda: frontier_of(offsets_to_ranges(one_key), disjoint=True).first().next_offset)
    timed("generator, batch form", n, lambda: bench.run(random_records(spark.range(n // 10), 10)))

    folder = "/root/testdata/sf0.1"
    whole = fx.log_records(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    records = fx.observed(whole)
    rows = records.count()
    flow = Ingest(spark, scratch(), "scale", gap_timeout_s=0, commit_interval_s=0)
    timed("ingest, one micro-batch, all gaps declared", rows, lambda: flow.process(records, 0))
    flow = Ingest(spark, scratch(), "open", gap_timeout_s=10_000, commit_interval_s=0)
    spans = []
    for i in range(BATCHES):
        part = whole.where(f"offset % {BATCHES} = {i} and offset <> 3")
        start = time.perf_counter()
        flow.process(part, i)
        spans.append(time.perf_counter() - start)
    fifths = [sum(spans[i : i + BATCHES // 5]) / (BATCHES // 5) for i in range(0, BATCHES, BATCHES // 5)]
    print(f"ingest, {BATCHES} micro-batches behind open gaps: mean seconds by fifth {[round(f, 2) for f in fifths]}", flush=True)

    big = spark.range(2_000_000).selectExpr(
        "'t' as topic", "if(id % 3 = 0, 0, 1) as partition", "if(id % 3 = 0, id div 3, id - id div 3 - 1) as offset",
        "timestamp_seconds(id) as timestamp", "cast(id as string) as key", "repeat(md5(cast(id as string)), 8) as value",
    )
    flow = Ingest(spark, scratch(), "big", commit_interval_s=0)
    timed("ingest, one micro-batch of 2 million rows", 2_000_000, lambda: flow.process(big, 0))

    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    for name, log in {"in order": whole, "behind open gaps": records}.items():
        source = scratch()
        log.repartitionByRange(8, "offset").sortWithinPartitions("offset").write.mode("overwrite").json(source)
        timed(f"order_stream, file log, {name}", log.count(), lambda: drain(spark, source, log.count()))


def drain(spark, source: str, rows: int) -> None:
    """Run ``order_stream`` over a file log until it has read all rows."""
    stream = read_log(spark, LogSpec("json", source), streaming=True)
    ordered = order_stream(to_envelope(stream, keep=("timestamp",)), timeout_s=10_000)
    query = ordered.writeStream.format("noop").option("checkpointLocation", scratch()).start()
    deadline = time.time() + 120
    # Each row is read twice, for its offset and for its payload.
    while sum(p["numInputRows"] for p in query.recentProgress) < 2 * rows and time.time() < deadline:
        time.sleep(0.1)
    query.stop()


if __name__ == "__main__":
    main()
