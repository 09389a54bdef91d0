"""What running queries report about their micro-batches, as rows."""

from __future__ import annotations

import uuid
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.metrics import distribution, merged, sketched
from ..sources.shared import read_or_empty

#: One row per micro-batch. ``observed`` holds the metrics that the query names with ``observe``, as ``name.metric``.
PROGRESS = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("input_rows", T.LongType()),
    T.StructField("duration_ms", T.MapType(T.StringType(), T.LongType())),
    T.StructField("observed", T.MapType(T.StringType(), T.LongType())),
    T.StructField("state_rows", T.LongType()),
    T.StructField("rows_dropped_by_watermark", T.LongType()),
])


class ProgressLog(StreamingQueryListener):
    """Collects the progress of the session's queries; ``flush`` appends it to a table.

    Use as ``spark.streams.addListener(log)``. At most ``keep`` rows are held between two flushes, the oldest go first;
    ``lost`` counts those.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 10_000):
        super().__init__()
        self.spark, self.path, self.lost = spark, path, 0
        self._held: deque = deque()
        self._keep = keep
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {f"{name}.{field}": value for name, row in p.observedMetrics.items() for field, value in row.asDict().items() if isinstance(value, int)}
        state = sum(o.numRowsTotal for o in p.stateOperators), sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        self._held.append((str(p.id), p.batchId, p.numInputRows, dict(p.durationMs), observed, *state))
        if len(self._held) > self._keep:
            self._held.popleft()
            self.lost += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.add(str(event.id))

    def flush(self) -> int:
        """Append what was collected since the last call; returns the number of rows."""
        rows = [self._held.popleft() for _ in range(len(self._held))]
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).write.parquet(f"{self.path}/part={uuid.uuid4().hex}")
        return len(rows)

    def rows(self, query: StreamingQuery | None = None) -> DataFrame:
        """All flushed rows, of one query or of all; a micro-batch that was repeated counts once."""
        found = read_or_empty(self.spark, self.path, PROGRESS).select(*PROGRESS.fieldNames())
        return found if query is None else found.where(F.col("query_id") == str(query.id))

    def latencies(self, query: StreamingQuery | None = None) -> DataFrame:
        """Per query and phase: how long micro-batches took, as ``ms_count, ms_min, …, ms_p99``."""
        phases = self.rows(query).select("query_id", F.explode("duration_ms").alias("phase", "ms"))
        by = ("query_id", "phase")
        return distribution(merged(sketched(phases, "ms", by), by), "ms", by)
