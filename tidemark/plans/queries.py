"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import epoch_millis, normalise_name, utc_instant
from ..operators import conform as cf
from ..operators import envelope as env
from ..operators import evolution as ev
from ..operators import frontier as fr
from ..operators import handled as hd
from ..operators import metrics as mt
from ..operators import ordering as od
from ..operators import routing as rt
from ..operators import schema_defs as sd
from ..operators.ranges import explode_ranges, merge_ranges, offsets_to_ranges
from ..operators.sizes import Cached, with_known_size
from ..schemas import KEY, META_OFFSET, META_PARTITION, META_TOPIC, RAW_METADATA
from ..sources import checkpoint as cp
from ..sources.generator import seeded_records
from ..sources.log import LogSpec, read_log, write_log
from ..sources.manifest import RAW_ADDRESS, PublishedTable
from ..sources.shared import scratch_path
from ..sources.tables import with_ingest_date
from ..streaming import micro_order as mo
from ..streaming.commit_flow import CommitFlow
from . import fixtures as fx
from .replay import account, classify, replay_rows, sink_rows

Query = Callable[[SparkSession, str], DataFrame]


def _refused() -> dict:
    """A table rule that some rows break."""
    return {"refused by table": F.expr("offset % 53 = 7")}


def _flat(rows: DataFrame, *more: str) -> DataFrame:
    """Raw rows with the metadata struct spread out."""
    meta = [F.col(RAW_METADATA)[f].alias(f.removeprefix("_")) for f in (META_TOPIC, META_PARTITION, META_OFFSET)]
    return rows.select("raw_message", "kafka_topic", *meta, "version", *more)


def _envelopes(spark: SparkSession, sf: str) -> DataFrame:
    return env.to_envelope(fx.arrivals(fx.log_records(spark, sf)), keep=("timestamp",))


def _whole(spark: SparkSession, sf: str) -> DataFrame:
    return env.to_envelope(fx.redelivered(fx.log_records(spark, sf)), keep=("timestamp",))


def _seed(spark: SparkSession, sf: str) -> DataFrame:
    return fx.checkpoint_seed(fx.log_records(spark, sf))


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    return od.gap_ranges(_envelopes(spark, sf), _seed(spark, sf))


# Sources and sinks

def _logged(spark, records, format_="segments"):
    """The records written as a log."""
    spec = LogSpec(format_, scratch_path(spark, "log"), topics=("events",))
    write_log(records.withColumn("timestamp", utc_instant("timestamp")), spec)
    return spec


def _in_utc(log):
    zone = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("timestamp").cast("timestamp_ntz"))
    return log.withColumn("timestamp", zone)


def log_scan(spark, sf):
    return _in_utc(read_log(spark, _logged(spark, fx.log_records(spark, sf))))


def log_sink_roundtrip(spark, sf):
    return _in_utc(read_log(spark, _logged(spark, fx.log_records(spark, sf), "parquet")))


def _replayed(spark, sf):
    return replay_rows(fx.redelivered(fx.log_records(spark, sf)), _seed(spark, sf), fx.VERSION_MS, _refused())


def raw_table_write(spark, sf):
    table = PublishedTable(spark, scratch_path(spark, "raw"), "run", RAW_ADDRESS)
    dated = with_ingest_date(_replayed(spark, sf)[0], fx.VERSION_MS)
    for _ in range(2):  # a retried batch replaces its first attempt
        table.write(dated, 0, ("ingest_date",))
    return _flat(table.read(dated.schema), "ingest_date")


def sink_success_offsets(spark, sf):
    """What the manifest of the published rows says, no row is read again."""
    table = PublishedTable(spark, scratch_path(spark, "raw"), "run", RAW_ADDRESS)
    written = table.write(_replayed(spark, sf)[0], 0)
    return explode_ranges(written.select(*KEY, "start_offset", "end_offset"))


def sink_failed_rows(spark, sf):
    _, failed = _replayed(spark, sf)
    return _flat(failed, "error")


def checkpoint_lookup(spark, sf):
    log = fx.log_records(spark, sf)
    keys = log.select("topic", F.expr("partition + 10 * cast(offset % 2 as int)").alias("partition")).distinct()
    return cp.lookup(cp.current_of(fx.commit_entries(log)), keys)


def checkpoint_topic_offsets(spark, sf):
    return cp.topic_offsets(cp.current_of(fx.commit_entries(fx.log_records(spark, sf))), "events")


def checkpoint_upsert(spark, sf):
    entries = fx.commit_entries(fx.log_records(spark, sf))
    log = cp.CheckpointLog(spark, scratch_path(spark, "checkpoint"))
    log.append(entries.select(*KEY, "last_acked"), "job-b", fx.VERSION_MS)
    # An older writer comes second and must not move anything back.
    behind = entries.where("last_acked % 2 = 1").select(*KEY, F.expr("last_acked - 5").alias("last_acked"))
    log.append(behind, "job-a", fx.VERSION_MS + 1)
    return log.current()


def resume_scan(spark, sf):
    """The log is read from the checkpoint on; partition 4 has none and starts at its beginning."""
    spec = _logged(spark, fx.redelivered(fx.log_records(spark, sf)))
    return _in_utc(read_log(spark, spec, floors=_seed(spark, sf)))


def generate_records(spark, sf):
    ticks = fx.table(spark, sf, "events").select(
        F.col("event_id").alias("tick"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("instant")
    )
    return seeded_records(ticks, per_tick=3)


def routing_scan(spark, sf):
    routes = rt.routing_scan(fx.document_routes(spark, sf), "src1, src3,src10,absent")
    return routes.select("topic", "dataset", "table", "commit_interval_seconds", F.col("extra")["owner"].alias("owner"))


def routing_lookup(spark, sf):
    return rt.routing_lookup(fx.document_routes(spark, sf), "src17-eu", substring=True).select("topic", "dataset")


def route_destination(spark, sf):
    return fx.document_routes(spark, sf).select("topic", rt.destination().alias("destination"))


def route_commit_interval(spark, sf):
    return fx.document_routes(spark, sf).select("topic", rt.commit_interval("sixty").alias("interval_seconds"))


def route_records(spark, sf):
    routes = fx.document_routes(spark, sf).where("dataset <> 'set3'")
    return rt.route_records(fx.document_records(spark, sf), routes).select(*KEY, "offset", "destination")


# Row-wise steps

def envelope(spark, sf):
    return env.to_envelope(fx.log_records(spark, sf), topic="configured")


def partition_key(spark, sf):
    return env.with_partition_key(env.to_envelope(fx.log_records(spark, sf))).select("partition_key", "offset")


def valid_payloads(spark, sf):
    return env.split_valid(env.to_envelope(fx.log_records(spark, sf)))[0]


def dropped_offsets(spark, sf):
    return env.split_valid(env.to_envelope(fx.log_records(spark, sf)))[1]


def raw_message_rows(spark, sf):
    return _flat(env.to_raw_rows(env.to_envelope(fx.log_records(spark, sf)), fx.VERSION_MS))


def raw_rows_versioned_by_record(spark, sf):
    """The version of a row is its record's own time in milliseconds."""
    records = env.to_envelope(fx.log_records(spark, sf), keep=("timestamp",))
    return _flat(env.to_raw_rows(records, epoch_millis(utc_instant("timestamp"))))


def handled_from_rows(spark, sf):
    return hd.extract_handled(fx.raw_row_variants(fx.log_records(spark, sf)))


def handled_valid(spark, sf):
    return hd.drop_invalid_handled(handled_from_rows(spark, sf))


def partition_key_parse(spark, sf):
    return hd.parse_keyed(fx.keyed_variants(fx.log_records(spark, sf)))


def conform_ok(spark, sf):
    ok, _ = cf.conform(fx.loose_rows(spark, sf), sd.struct_type(fx.LOOSE_FIELDS, with_version=False))
    return ok.select("id", "kind", "amount", "day", "seen", "absent", F.col("meta.k").alias("meta_k"))


def conform_failed(spark, sf):
    _, failed = cf.conform(fx.loose_rows(spark, sf), sd.struct_type(fx.LOOSE_FIELDS, with_version=False))
    return failed.select(F.col("_row").alias("row_id"), "error")


def _evolved(spark, sf):
    rows = env.to_raw_rows(env.to_envelope(fx.log_records(spark, sf)), fx.VERSION_MS)
    return ev.fit_existing(rows, sd.struct_type(fx.OLDER_FIELDS), {"refused by table": F.expr("__metadata._meta_kafka_offset % 53 = 7")})


def older_table_rows(spark, sf):
    """Rows as a table with flat metadata takes them."""
    return _evolved(spark, sf)[0].withColumnsRenamed({f: f.removeprefix("_") for f in (META_TOPIC, META_PARTITION, META_OFFSET)})


def older_table_handled(spark, sf):
    """Handled offsets of both paths into the older table: none is lost."""
    return hd.handled_from_sink(*_evolved(spark, sf))


# Ordering and gaps

def contiguous_prefix(spark, sf):
    return od.contiguous_prefix(_envelopes(spark, sf), _seed(spark, sf))


def contiguous_records(spark, sf):
    return od.contiguous_records(_envelopes(spark, sf), _seed(spark, sf))


def gap_ranges(spark, sf):
    return _gaps(spark, sf)


def gap_missing_offsets(spark, sf):
    return od.gap_missing_offsets(_gaps(spark, sf))


def gap_first_missing(spark, sf):
    return od.gap_first_missing(_gaps(spark, sf))


def gap_audit(spark, sf):
    return od.gap_audit(_gaps(spark, sf))


def late_records(spark, sf):
    return od.late_records(_whole(spark, sf), _seed(spark, sf)).select(*KEY, "offset", "timestamp", "expected")


def contiguous_run_lengths(spark, sf):
    return od.contiguous_runs(_envelopes(spark, sf))


def many_key_runs(spark, sf):
    return od.contiguous_runs(fx.conversation_records(spark, sf))


# Handled offsets and the frontier

def _sink(spark, sf):
    checked = sink_rows(_whole(spark, sf), fx.VERSION_MS, _refused())
    return checked.where("error is null"), checked.where("error is not null")


def handled_from_sink(spark, sf):
    return hd.handled_from_sink(*_sink(spark, sf))


def _handled_points(spark, sf):
    return hd.point_ranges(classify(_envelopes(spark, sf), _refused()))


def handled_all(spark, sf):
    return hd.merge_handled(_handled_points(spark, sf), hd.gap_ranges_handled(_gaps(spark, sf)))


def _account(spark, sf, **kw):
    return account(fx.arrivals(fx.log_records(spark, sf)), _seed(spark, sf), _refused(), **kw)


def commit_frontier(spark, sf):
    return _account(spark, sf).frontier


def commit_frontier_stalled(spark, sf):
    return _account(spark, sf, declare_gaps=False).frontier


def many_key_frontier(spark, sf):
    return account(fx.conversation_records(spark, sf).withColumnRenamed("payload", "value")).frontier


def stale_handled(spark, sf):
    return fr.stale_handled(hd.point_ranges(classify(_whole(spark, sf), _refused())), _seed(spark, sf))


def wide_range_frontier(spark, sf):
    """Frontiers over many buckets of offsets, so that what one bucket hands to the next decides."""
    log = fx.log_records(spark, sf)
    return fr.commit_frontier(fx.wide_ranges(log), fx.wide_seed(log))


def wide_range_runs(spark, sf):
    return merge_ranges(fx.wide_ranges(fx.log_records(spark, sf)))


def buffered_handled(spark, sf):
    stalled = _account(spark, sf, declare_gaps=False)
    return fr.buffered_offsets(stalled.handled, stalled.frontier, disjoint=True)


def commit_pending(spark, sf):
    previous = _seed(spark, sf).where("partition <> 2").select(
        *KEY, F.col("next_offset").alias("committed_next"), F.lit(fx.VERSION_MS).alias("pending_since_ms")
    )
    now = fx.VERSION_MS + 60_000
    pending = fr.pending_acks(commit_frontier(spark, sf), previous, now)
    interval_ms = F.expr("if(partition = 1, 90000, 30000)")
    return pending.where(fr.is_due(now, interval_ms)).select(*KEY, "next_offset", "last_acked", "committed_next")


# Windows and metrics

def tumbling_counts(spark, sf):
    return mt.tumbling_counts(fx.log_records(spark, sf), keys=("partition",))


def tumbling_handled_counts(spark, sf):
    return mt.tumbling_counts(classify(_whole(spark, sf), _refused()), keys=("reason",))


def stream_window_counts(spark, sf):
    """The same counts from a stream that reads the log in four appends, each window given once it is complete."""
    path, log = scratch_path(spark, "windows"), fx.redelivered(fx.log_records(spark, sf))
    spec = LogSpec("segments", f"{path}/log", topics=("events",), options={"maxVersionsPerTrigger": "1"})
    times = log.withColumn("timestamp", utc_instant("timestamp"))
    first, last = times.agg(F.unix_seconds(F.min("timestamp")), F.unix_seconds(F.max("timestamp"))).first()
    slot = F.floor((F.unix_seconds("timestamp") - first) * 4 / F.lit(last - first + 1))
    for n in range(4):
        write_log(times.where(slot == n), spec)
    # A record of the day after completes the last windows; its own stays open.
    write_log(times.limit(1).withColumns({"timestamp": F.timestamp_seconds(F.lit(last + 86_400)), "partition": F.lit(-1)}), spec)
    counts = mt.event_time_counts(read_log(spark, spec, streaming=True), keys=("partition",), lateness="1 hour")
    query = counts.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    zone = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("window_start").cast("timestamp_ntz"))
    return spark.read.schema(counts.schema).parquet(f"{path}/out").withColumn("window_start", zone)


def gap_outcome_steps(spark, sf):
    """Gaps opened and closed as the log comes in steps, with a timeout that none of them reaches."""
    log, waiting = fx.log_records(spark, sf), None
    steps = with_known_size(fx.handled_steps(log).select("step", *KEY, F.col("start_offset").alias("offset")))
    state = with_known_size(_seed(spark, sf).withColumn("gap_since_ms", F.lit(None).cast("bigint")))
    told = []
    with Cached() as cached:
        for n in range(fx.STEPS + 2):
            fresh = cached(offsets_to_ranges(steps.where(F.col("step") == n)))
            decided, _ = mo.decide(fresh, waiting, state, fx.VERSION_MS + n * fx.STEP_MS, 10**9, cached)
            decided = with_known_size(decided)
            held = with_known_size(mo.still_waiting(fresh, fresh.where("false") if waiting is None else waiting, decided))
            waiting = None if held.isEmpty() else held
            state = decided.select(*KEY, F.col("expected").alias("next_offset"), "gap_since_ms")
            told.append(mt.gap_outcomes(decided).withColumn("step", F.lit(n).cast("bigint")))
    return hd.merge_handled(*told)


def gap_metrics(spark, sf):
    """A record counts as released once, however often it was delivered."""
    arrived, floors = _envelopes(spark, sf).select(*KEY, "offset"), _seed(spark, sf)

    def tagged(rows, kind, end="offset"):
        return rows.select(*KEY, F.col("offset"), F.col(end).alias("end_offset"), F.lit(kind).alias("kind"))

    gaps = od.gap_ranges(arrived, floors).withColumnRenamed("start_offset", "offset")
    records = tagged(od.contiguous_records(arrived, floors), "record")
    return mt.gap_metrics(records.unionByName(tagged(od.late_records(arrived, floors), "late")).unionByName(tagged(gaps, "gap", "end_offset")))


def commit_metrics(spark, sf):
    handled = handled_all(spark, sf)
    return mt.commit_metrics(handled, _seed(spark, sf), commit_frontier(spark, sf))


def key_metrics(spark, sf):
    return mt.key_validity(partition_key_parse(spark, sf))


def checkpoint_metrics(spark, sf):
    """How far commits moved their keys: sketched per day, then merged, as a running flow does per batch."""
    moved = mt.advances(fx.commit_entries(fx.log_records(spark, sf)), "hour")
    days = mt.sketched(moved.withColumn("day", F.to_date("hour")), "advance", (*KEY, "day"))
    return mt.distribution(mt.merged(days), "advance")


def commit_step_metrics(spark, sf):
    """The commit stage over the whole log in steps; another writer has moved one key far ahead in the store."""
    log, root = fx.log_records(spark, sf), scratch_path(spark, "commit")
    seed = with_known_size(fx.checkpoint_seed(log))
    store = cp.CheckpointLog(spark, f"{root}/checkpoint")
    store.append(seed.where("partition = 3").select(*KEY, F.lit(10**9).alias("last_acked")), "other", fx.VERSION_MS)
    flow = CommitFlow(spark, root, "run", store)
    flow.begin(seed)
    steps = with_known_size(fx.handled_steps(log))
    for n in range(fx.STEPS + 2):
        flow.process(steps.where(F.col("step") == n), n, fx.VERSION_MS + n * fx.STEP_MS, 60_000)
    return flow.metrics()


# Schemas

def typed_cast(spark, sf):
    fields = [
        {"name": "event_id", "type": "INTEGER", "mode": "NULLABLE"},
        {"name": "ts", "type": "DATETIME", "mode": "NULLABLE"},
        {"name": "value", "type": "FLOAT", "mode": "NULLABLE"},
        {"name": "event_type", "type": "STRING", "mode": "NULLABLE"},
    ]
    text = sd.raw_projection(fx.table(spark, sf, "events"), fields, with_version=False)
    return cf.fit(text, sd.struct_type(fields, with_version=False))


def raw_string_projection(spark, sf):
    fields = sd.default_fields(["event_id", "user_id", "event_type", "props", "absent"])
    return sd.raw_projection(fx.table(spark, sf, "events").withColumn("version", F.lit(fx.VERSION_MS)), fields)


def normalise_names(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", normalise_name(F.col("text")).alias("name"))


def default_string_schema(spark, sf):
    return sd.fields_of_json(fx.log_records(spark, sf), "value")


def schema_field_stats(spark, sf):
    fields = fx.table(spark, sf, "events").select(
        F.col("event_type").alias("owner"), F.col("props").alias("name"), F.expr("user_id % 3 = 0").alias("isDerived")
    )
    return sd.field_stats(fields, ("owner",))


ALL: dict[str, Query] = {
    f.__name__: f
    for f in (
        log_scan, log_sink_roundtrip, raw_table_write, sink_success_offsets, sink_failed_rows,
        checkpoint_lookup, checkpoint_topic_offsets, checkpoint_upsert, resume_scan, generate_records,
        routing_scan, routing_lookup, route_destination, route_commit_interval, route_records,
        envelope, partition_key, valid_payloads, dropped_offsets, raw_message_rows, raw_rows_versioned_by_record,
        handled_from_rows, handled_valid, partition_key_parse, conform_ok, conform_failed, older_table_rows, older_table_handled,
        contiguous_prefix, contiguous_records, gap_ranges, gap_missing_offsets, gap_first_missing,
        gap_audit, late_records, contiguous_run_lengths, many_key_runs,
        handled_from_sink, handled_all, commit_frontier, commit_frontier_stalled, many_key_frontier,
        stale_handled, buffered_handled, commit_pending, wide_range_frontier, wide_range_runs,
        tumbling_counts, tumbling_handled_counts, gap_metrics, commit_metrics, key_metrics, checkpoint_metrics,
        commit_step_metrics, gap_outcome_steps, stream_window_counts,
        typed_cast, raw_string_projection, normalise_names, default_string_schema, schema_field_stats,
    )
}
