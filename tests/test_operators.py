"""Operators on literal inputs."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import functions as fn
from tidemark.operators import conform as cf
from tidemark.operators import envelope as env
from tidemark.operators import evolution as ev
from tidemark.operators import frontier as fr
from tidemark.operators import handled as hd
from tidemark.operators import metrics as mt
from tidemark.operators import ordering as od
from tidemark.operators import routing as rt
from tidemark.operators import schema_defs as sd
from tidemark.operators.ranges import floor_ranges
from tidemark.schemas import ENVELOPE, HANDLED_RANGE, LOG_RECORD
from tidemark.sources import checkpoint as cp
from tidemark.sources import log as lg
from tidemark.sources.generator import (
    random_records,
    records_per_tick,
    seeded_records,
    tick_stream,
    ticks_per_second,
)
from tidemark.sources.routes import read_routes
from tidemark.sources.tables import BatchTable, compact, read_table, with_ingest_date


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def envelopes(spark, *rows):
    return spark.createDataFrame(list(rows), ENVELOPE)


# Row-wise steps

def test_envelope_takes_the_configured_topic(spark):
    log = spark.createDataFrame([("other", 2, 17, None, "k", "payload")], LOG_RECORD)
    assert tuple(one(env.to_envelope(log, topic="test_df"))) == ("test_df", 2, 17, "payload")
    assert one(env.to_envelope(log)).topic == "other"


def test_valid_filter_keeps_null_and_reports_dropped(spark):
    df = envelopes(spark, ("t", 0, 10, "ok-payload"), ("t", 0, 11, '{"errorMessage":"bad"}'), ("t", 0, 12, None),
                   ("t", 0, 13, "errormessage"))
    valid, dropped = env.split_valid(df)
    assert [r.offset for r in valid.collect()] == [10, 12, 13]
    assert tuple(one(dropped)) == ("t", 0, 11)


def test_raw_rows_are_a_pure_map(spark):
    df = envelopes(spark, ("t", 0, 1, "a"), ("t", 1, 2, '{"errorMessage":"x"}'))
    rows = env.to_raw_rows(df, 42).collect()
    assert [(r.raw_message, r.kafka_topic, r.version) for r in rows] == [("a", "t", 42), ('{"errorMessage":"x"}', "t", 42)]
    assert rows[1]["__metadata"].asDict() == {"_meta_kafka_topic": "t", "_meta_kafka_partition": 1, "_meta_kafka_offset": 2}


def test_handled_extraction_and_flat_fallback(spark):
    meta = "struct<_meta_kafka_topic:string,_meta_kafka_partition:string,_meta_kafka_offset:string>"
    schema = f"__metadata {meta}, _meta_kafka_topic string, _meta_kafka_partition string, _meta_kafka_offset string"
    rows = [
        (("t", "1", "9"), "flat", "7", "7"),       # nested wins
        (None, "flat", "2", "5"),                  # older row
        (("t", None, "9"), "flat", "7", "7"),      # incomplete struct is not completed
        (None, "flat", " 2", "5"), (None, "flat", "2", "x"), (None, None, None, None), (None, " ", "1", "1"),
    ]
    handled = hd.drop_invalid_handled(hd.extract_handled(spark.createDataFrame(rows, schema)))
    assert [tuple(r) for r in handled.collect()] == [("t", 1, 9), ("flat", 2, 5)]
    flat_only = spark.createDataFrame([("f", 3, 4)], "_meta_kafka_topic string, _meta_kafka_partition int, _meta_kafka_offset long")
    assert tuple(one(hd.extract_handled(flat_only))) == ("f", 3, 4)


@pytest.mark.parametrize("key, expected", [
    ("t:0", ("t", 0)), ("t:+3", ("t", 3)), ("t:-1", ("t", -1)), ("t", None), ("t:1:2", None), (":1", None), (" :1", None),
    ("t:", None), ("t: 1", None), ("t:1x", None), ("t:2147483648", None), ("", None), (None, None), ("t:1\n", None),
])
def test_partition_key_parsing(spark, key, expected):
    df = spark.createDataFrame([(key,)], "k string")
    got = one(df.select(fn.parse_partition_key("k").alias("p"))).p
    assert (tuple(got) if got else None) == expected


def test_handled_ranges_keep_reasons_apart(spark):
    df = spark.createDataFrame([("t", 0, o, "written") for o in range(130)] + [("t", 0, 130, "dropped")],
                               "topic string, partition int, offset long, reason string")
    got = sorted(tuple(r)[2:] for r in hd.handled_ranges(df).collect())
    assert got == [(0, 63, "written"), (64, 127, "written"), (128, 129, "written"), (130, 130, "dropped")]


# Frontier

HANDLED = [("t", 0, 1, 1, "written"), ("t", 0, 0, 0, "dropped"), ("t", 0, 2, 2, "gap"), ("t", 1, 5, 9, "written")]


def test_frontier_stale_and_buffered(spark):
    handled = spark.createDataFrame(HANDLED, HANDLED_RANGE)
    assert {(r.partition, r.next_offset, r.last_acked) for r in fr.commit_frontier(handled).collect()} == {(0, 3, 2), (1, 0, -1)}
    seed = spark.createDataFrame([("t", 0, 2), ("t", 1, 7)], "topic string, partition int, next_offset long")
    assert {(r.partition, r.next_offset) for r in fr.commit_frontier(handled, seed).collect()} == {(0, 3), (1, 10)}
    stale = {(r.partition, r.start_offset, r.end_offset) for r in fr.stale_handled(handled, seed).collect()}
    assert stale == {(0, 1, 1), (0, 0, 0), (1, 5, 6)}
    waiting = fr.buffered_offsets(handled, fr.commit_frontier(handled)).collect()
    assert sorted((r.partition, r.offset) for r in waiting) == [(1, o) for o in range(5, 10)]


def test_pending_ack_waits_once_per_interval(spark):
    frontier = spark.createDataFrame([("t", 0, 5), ("t", 1, 3), ("t", 2, 4)], "topic string, partition int, next_offset long")
    previous = spark.createDataFrame(
        [("t", 0, 2, 1000), ("t", 1, 3, None)],
        "topic string, partition int, committed_next long, pending_since_ms long",
    )
    pending = fr.pending_acks(frontier, previous, 5000)
    assert {r.partition: r.pending_since_ms for r in pending.collect()} == {0: 1000, 1: None, 2: 5000}
    assert [r.partition for r in pending.where(fr.is_due(5000, F.lit(4000))).collect()] == [0]


def test_floor_ranges(spark):
    seed = spark.createDataFrame([("t", 0, 5)], "topic string, partition int, next_offset long")
    assert tuple(one(floor_ranges(seed))) == ("t", 0, 0, 4)


# Checkpoint

def test_checkpoint_moves_forward_only(spark, tmp_path):
    log = cp.CheckpointLog(spark, str(tmp_path / "cp"))
    keys = spark.createDataFrame([("t", 0), ("t", 1)], "topic string, partition int")
    assert {r.next_offset for r in log.lookup(keys).collect()} == {0} and log.topic_offsets("t").count() == 0

    def acked(offset):
        return spark.createDataFrame([("t", 0, offset)], "topic string, partition int, last_acked long")

    log.append(acked(8), "job", 1)
    log.append(acked(3), "older", 2)
    assert tuple(one(log.current())) == ("t", 0, 9, 8, 1, "job")
    assert {(r.partition, r.next_offset) for r in log.lookup(keys).collect()} == {(0, 9), (1, 0)}
    log.append(acked(10), "job", 3, tag="r-1")
    log.append(acked(10), "job", 3, tag="r-1")  # the same commit again
    assert log.entries().count() == 3 and one(log.topic_offsets("t")).next_offset == 11
    assert log.compacted(str(tmp_path / "cp2")).entries().count() == 1


def test_checkpoint_write_failure_is_raised(spark):
    log = cp.CheckpointLog(spark, "/proc/no-such-place")
    with pytest.raises(Exception):
        log.append(spark.createDataFrame([("t", 0, 1)], "topic string, partition int, last_acked long"), "job", 1)


def test_starting_offsets(spark):
    current = spark.createDataFrame([("a", 0, 5), ("b", 1, 7)], "topic string, partition int, next_offset long")
    assert json.loads(lg.starting_offsets(current, ("a",), {"a": 2})) == {"a": {"0": 5, "1": -2}}
    assert lg.starting_offsets(current, ("c",)) == "earliest"
    with pytest.raises(ValueError, match="b"):
        lg.starting_offsets(current, ("a", "b"), {"a": 2})


def test_interrupted_batch_counts_as_not_written(spark, tmp_path):
    table = BatchTable(str(tmp_path), "r")
    rows = spark.range(3)
    table.write(rows, -1)
    assert table.read_batch(spark, -1, rows.schema).count() == 3
    (tmp_path / "run_id=r" / "batch_id=0" / "_temporary").mkdir(parents=True)
    assert table.read_batch(spark, 0, rows.schema) is None


# Log options

def test_broker_list_and_protocol():
    mixed = "ssl://log-east:19092 ,  log-west , PLAINTEXT://10.0.0.7:29092/"
    assert lg.bootstrap_servers(mixed) == "log-east:19092,log-west,10.0.0.7:29092"
    for blank in ("", "   "):
        with pytest.raises(ValueError):
            lg.bootstrap_servers(blank)
    assert lg.security_protocol(mixed) == "SSL"
    assert lg.security_protocol("log-west, sasl_plaintext://log-east") == "SASL_PLAINTEXT"
    assert lg.security_protocol("log-west:1") == lg.security_protocol(None) == "SASL_SSL"


def test_kafka_options_carry_the_connection():
    spec = lg.LogSpec("kafka", brokers="SASL_SSL://b:9092", topics=("a", "b"), username="u", password="p", group_id="g")
    read = lg.kafka_read_options(spec, "earliest")
    assert read["subscribe"] == "a,b" and read["failOnDataLoss"] == "false" and read["kafka.bootstrap.servers"] == "b:9092"
    assert 'username="u" password="p"' in read["kafka.sasl.jaas.config"] and read["kafka.group.id"] == "g"
    assert read["maxOffsetsPerTrigger"] == "50000000"
    odd = lg.kafka_connection(lg.LogSpec("kafka", brokers="b:1", username="u", password='a"; b\\c'))
    assert odd["kafka.sasl.jaas.config"].endswith('password="a\\"; b\\\\c";')
    assert "kafka.sasl.mechanism" not in lg.kafka_connection(lg.LogSpec("kafka", brokers="PLAINTEXT://b:1"))


# Routing

def test_routes_from_json(spark, tmp_path):
    path = tmp_path / "routes.json"
    path.write_text(json.dumps({"topicConfigs": [
        {"topicName": "a", "datasetName": "d", "tableName": "t", "checkpointCommitIntervalSeconds": 15, "owner": "x"},
        {"topicName": "b", "datasetName": "d", "tableName": "  "},
        {"topicName": "c", "datasetName": "d", "checkpointCommitIntervalSeconds": 0},
    ]}))
    routes = rt.with_route(read_routes(spark, str(path)), "60")
    got = {r.topic: (r.destination, r.interval_seconds, r.extra) for r in routes.collect()}
    assert got == {"a": ("d.t", 15, {"owner": "x"}), "b": ("d.KAFKA_RAW_MESSAGE", 60, {}), "c": ("d.KAFKA_RAW_MESSAGE", 60, {})}
    assert sorted(r.topic for r in rt.routing_scan(routes, "a, c,ab").collect()) == ["a", "c"]
    assert [r.topic for r in rt.routing_lookup(routes, "a").collect()] == ["a"]
    assert [r.topic for r in rt.routing_lookup(routes, "cab", substring=True).collect()] == ["a"]  # the first in the file
    assert [r.topic for r in rt.routing_lookup(routes, "xcb", substring=True).collect()] == ["b"]
    assert rt.routing_lookup(routes, "none").count() == 0
    assert one(routes.where("topic = 'b'").select(rt.commit_interval("x").alias("i"))).i == 60


def test_topics_with_two_routes_are_refused(spark):
    routes = spark.createDataFrame([("a", "d", "x"), ("a", "d", "y"), ("b", "d", "z")], "topic string, dataset string, table string")
    records = spark.createDataFrame([("a", 0, 1)], "topic string, partition int, offset long")
    with pytest.raises(ValueError, match="a"):
        rt.route_records(records, routes)
    assert rt.route_records(records, routes.where("table <> 'y'")).count() == 1


# Schemas

def test_struct_types():
    nested = sd.struct_type(sd.RAW_MESSAGE_FIELDS)
    assert nested.fieldNames() == ["raw_message", "kafka_topic", "__metadata", "version"]
    assert nested["__metadata"].dataType["_meta_kafka_offset"].dataType == T.LongType() and not nested["version"].nullable
    flat = sd.struct_type(sd.RAW_MESSAGE_FIELDS, with_version=False, recursive=False)
    assert flat["__metadata"].dataType == T.StringType() and len(flat) == 3
    assert sd.spark_type(" numeric ") == T.DecimalType(38, 9) and sd.spark_type(None) == sd.spark_type("odd") == T.StringType()
    assert sd.spark_type("DATE", "REPEATED") == T.ArrayType(T.DateType())
    assert sd.spark_type("DATETIME") == T.TimestampNTZType() and sd.spark_type("BYTES") == T.BinaryType()


def test_schema_files(spark, tmp_path):
    path = tmp_path / "s.txt"
    path.write_text(json.dumps(sd.RAW_MESSAGE_FIELDS))
    assert sd.load_fields(spark, str(path)) == sd.RAW_MESSAGE_FIELDS
    assert sd.load_fields(spark, str(tmp_path / "none")) == []
    fields = [{"name": "a"}, {"name": "b", "isDerived": True}]
    assert sd.actual_field_count(fields) == 1 and sd.field_names(fields) == ["a", "b"]


def test_names(spark):
    assert fn.normalise_name("Prix €/Net-$ (A)") == "prix_euro_net_dollar__a_"
    df = spark.createDataFrame([("Prix €/Net-$ (A)",)], ["n"])
    assert one(df.select(fn.normalise_name(F.col("n")).alias("n"))).n == "prix_euro_net_dollar__a_"
    odd = spark.createDataFrame([(1, 2)], ["Some Name", "x$"])
    assert sd.normalise_columns(odd).columns == ["some_name", "xdollar"]
    assert sd.default_string_schema(odd.columns).simpleString() == "struct<some_name:string,xdollar:string>"


FIELDS = [
    {"name": "id", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "tags", "type": "INTEGER", "mode": "REPEATED"},
    {"name": "at", "type": "TIME"},
    {"name": "inner", "type": "RECORD", "fields": [{"name": "x", "type": "DATE", "mode": "REQUIRED"}]},
]


def test_conform(spark):
    rows = [
        ("1", ["1", "2"], "10:00:00", ("2024-01-01",), "extra"),
        ("2", None, None, None, "extra"),
        (None, None, None, None, None),
        ("3", ["x"], "25:00:00", ("never",), None),
        ("4.5", [None], None, (None,), None),
    ]
    df = spark.createDataFrame(rows, "id string, tags array<string>, at string, inner struct<x:string>, unknown string")
    ok, failed = cf.conform(df, sd.struct_type(FIELDS, with_version=False), {"too big": F.col("id") == "9"})
    assert ok.columns == ["id", "tags", "at", "inner"]
    assert [(r.id, r.tags, r.at, r.inner and str(r.inner.x)) for r in ok.collect()] == [
        (1, [1, 2], "10:00:00", "2024-01-01"), (2, None, None, None),
    ]
    assert [r.error for r in failed.collect()] == [
        "missing required field id",
        "cannot read field tags as array<bigint>; cannot read field at as time; cannot read field inner.x as date",
        "cannot read field id as bigint; missing required field inner.x",
    ]
    assert failed.columns[-2:] == ["unknown", "error"]


def reject(spark, schema, fields, *rows):
    """Errors of each row, None for those that fit; and the rows as they fit."""
    layout = sd.struct_type(fields, with_version=False)
    df = spark.createDataFrame(list(rows), schema)
    return [r.error for r in cf.check(df, layout).collect()], cf.fit(df, layout).collect()


def test_required_fields_inside_arrays(spark):
    fields = [{"name": "items", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "k", "type": "INTEGER", "mode": "REQUIRED"}, {"name": "s", "type": "STRING"}]}]
    errors, rows = reject(spark, "items array<struct<k:string,s:int>>", fields, ([("1", 5), ("2", None)],), ([("x", 5)],), ([("1", 5), (None, 6)],), ([None],), (None,), ([],))
    assert errors == [None, "cannot read field items.k as bigint", "missing required field items.k", None, None, None]
    assert rows[0]["items"] == [(1, "5"), (2, None)]
    errors, _ = reject(spark, "items array<struct<s:string>>", fields, ([("a",)],), ([],))
    assert errors == ["missing required field items.k", None]


def test_values_that_would_lose_something_are_refused(spark):
    whole = [{"name": "v", "type": "INTEGER"}]
    assert reject(spark, "v double", whole, (2.0,), (1.7,), (None,), (float("nan"),))[0] == [None, "cannot read field v as bigint", None, "cannot read field v as bigint"]
    assert reject(spark, "v decimal(5,2)", whole, (Decimal("3.00"),), (Decimal("3.10"),))[0] == [None, "cannot read field v as bigint"]
    day = [{"name": "v", "type": "DATE"}]
    assert reject(spark, "v string", day, ("2024-02-29",), ("2024-02-29 10:00:00",), ("2023-02-29",))[0] == [None] + ["cannot read field v as date"] * 2
    assert reject(spark, "v timestamp", day, (datetime(2024, 2, 29),), (datetime(2024, 2, 29, 10),))[0] == [None, "cannot read field v as date"]
    number = [{"name": "v", "type": "NUMERIC"}]
    assert reject(spark, "v string", number, ("1.123456789",), ("1.1234567891",), ("1.1234567890",))[0] == [None, "cannot read field v as decimal(38,9)", None]


def test_shapes_that_do_not_fit_are_refused_row_by_row(spark):
    for type_ in ("INTEGER", "TIMESTAMP", "BOOLEAN", "TIME", "BYTES"):
        errors, rows = reject(spark, "v struct<a:int>", [{"name": "v", "type": type_}], ((1,),), (None,))
        assert errors[0].startswith("cannot read field v as") and errors[1] is None and rows[1].v is None
    errors, rows = reject(spark, "v struct<a:int>", [{"name": "v", "type": "STRING"}], ((1,),))
    assert errors == [None] and rows[0].v == '{"a":1}'
    assert reject(spark, "v string", [{"name": "v", "type": "INTEGER", "mode": "REPEATED"}], ("1",), (None,))[0] == ["cannot read field v as array<bigint>", None]
    assert reject(spark, "v array<int>", [{"name": "v", "type": "INTEGER"}], ([1],))[0] == ["cannot read field v as bigint"]


def test_an_older_table_decides_field_by_field(spark):
    declared = sd.struct_type(sd.RAW_MESSAGE_FIELDS + [{"name": "extra", "type": "INTEGER"}])
    flat = [{"name": "raw_message", "type": "STRING"}, {"name": "_meta_kafka_topic", "type": "STRING"}, {"name": "_meta_kafka_partition", "type": "STRING"}, {"name": "_meta_kafka_offset", "type": "INTEGER"}]
    told = {d.field: d.decision for d in ev.compare(declared, sd.struct_type(flat + [{"name": "day", "type": "DATE"}, {"name": "must", "type": "DATE", "mode": "REQUIRED"}]))}
    assert told == {"raw_message": "kept", "kafka_topic": "dropped", "__metadata": "moved", "extra": "dropped", "version": "kept", "day": "null", "must": "refused"}
    part = sd.struct_type([{"name": "__metadata", "type": "RECORD", "fields": [{"name": "_meta_kafka_offset", "type": "STRING"}]}], with_version=False)
    told = {d.field: d.decision for d in ev.compare(declared, part)}
    assert told["__metadata._meta_kafka_offset"] == "cast" and told["__metadata._meta_kafka_topic"] == "dropped" and told["version"] == "dropped"
    rows = env.to_raw_rows(envelopes(spark, ("t", 3, 17, "a"), ("t", 3, 18, None)), 1)
    ok, failed = ev.fit_existing(rows, sd.struct_type(flat[1:] + [flat[0] | {"mode": "REQUIRED"}]))
    assert tuple(one(ok)) == ("t", "3", 17, "a", 1) and one(failed).error == "missing required field raw_message"
    assert sorted(r.offset for r in hd.handled_from_sink(ok, failed).collect()) == [17, 18]


def test_the_first_schema_of_a_table_stays(spark, tmp_path):
    first, second = sd.struct_type(FIELDS), sd.struct_type(sd.RAW_MESSAGE_FIELDS)
    table = ev.RecordedSchema(spark, str(tmp_path))
    assert table.of(first) == first and table.of(second) == first and ev.RecordedSchema(spark, str(tmp_path)).of(second) == first


def test_raw_projection(spark):
    df = spark.createDataFrame([(1, (2,), 5)], "a int, b struct<c:int>, version long")
    row = one(sd.raw_projection(df, [{"name": "a"}, {"name": "b"}, {"name": "z"}]))
    assert tuple(row) == ("1", '{"c":2}', None, 5)


# Generator

def test_message_shape(spark):
    df = spark.createDataFrame([("m-7", "2031-11-02T17:45:10Z", 0.1234567)], "i string, t string, v double")
    message = one(df.select(fn.format_message("i", "t", "v").alias("m"))).m
    assert message == '{"id":"m-7","timestamp":"2031-11-02T17:45:10Z","value":0.123457}'


def test_generator_counts_and_limits(spark):
    ticks = spark.range(4).withColumnRenamed("id", "tick")
    assert random_records(ticks, 25).count() == 100 and random_records(ticks).count() == 40
    assert (ticks_per_second(), records_per_tick()) == (100, 10)
    for bad in (0, -1):
        with pytest.raises(ValueError):
            tick_stream(spark, bad)
        with pytest.raises(ValueError):
            random_records(ticks, bad)
    stamped = ticks.withColumn("instant", F.lit("2024-01-01T00:00:00Z"))
    assert seeded_records(stamped, 3).collect() == seeded_records(stamped, 3).collect()


# Tables and metrics

def test_batch_table_replaces_and_compacts(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), "r")
    df = spark.createDataFrame([(1,), (2,)], "a int")
    table.write(with_ingest_date(df, 0), 0, ("ingest_date",))
    table.write(with_ingest_date(df.where("a = 1"), 86_400_000), 0, ("ingest_date",))  # retried after midnight
    table.write(with_ingest_date(df, 86_400_000), 1, ("ingest_date",))
    layout = T.StructType.fromDDL("a int, ingest_date date")
    assert sorted((r.a, r.batch_id) for r in read_table(spark, table.path, layout).collect()) == [(1, 0), (1, 1), (2, 1)]
    assert table.read_batch(spark, 7, layout) is None
    assert compact(spark, table, layout, 1, str(tmp_path / "c")).count() == 3


def test_gap_metrics_and_outcomes(spark):
    rows = [("t", 0, "record", 0, 0), ("t", 0, "gap", 1, 3), ("t", 0, "late", 2, 2), ("t", 0, "record", 4, 4)]
    df = spark.createDataFrame(rows, "topic string, partition int, kind string, offset long, end_offset long")
    assert tuple(one(mt.gap_metrics(df))) == ("t", 0, 2, 1, 3, 1)
    decisions = spark.createDataFrame(
        [("t", 0, None, 9, 0, 0, 1), ("t", 1, 5, None, 0, 1, 5), ("t", 2, 5, None, 1, 1, 9)],
        "topic string, partition int, gap_since_before long, gap_since_ms long, skipped long, "
        "expected_before long, expected long",
    )
    assert {tuple(r)[1:] for r in mt.gap_outcomes(decisions).collect()} == {(0, 1, 0, 0, 1), (1, 0, 1, 0, 4), (2, 0, 0, 1, 8)}


def test_windows_of_a_stream_close_and_late_rows_are_counted(spark, tmp_path):
    spec = lg.LogSpec("segments", str(tmp_path / "log"))
    counts = mt.event_time_counts(lg.read_log(spark, spec, streaming=True), lateness="5 seconds")
    query = counts.writeStream.format("memory").queryName("tumbling").outputMode("append").start()

    def feed(*stamps):
        rows = [("t", 0, i, f"2024-01-01 {s}", "k", "v") for i, s in enumerate(stamps)]
        df = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp string, key string, value string")
        lg.write_log(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")), spec)
        query.processAllAvailable()
        last = [p for p in query.recentProgress if p["stateOperators"]]
        dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in last)
        return sorted((r.window_start.second, r.n) for r in spark.table("tumbling").collect()), last[-1]["stateOperators"][0]["numRowsTotal"], dropped

    try:
        assert feed("00:00:01", "00:00:09", "00:00:10") == ([], 2, 0)
        assert feed("00:00:04", "00:00:16") == ([(0, 3)], 1, 0)
        assert feed("00:00:02", "00:00:12", "00:00:58") == ([(0, 3), (10, 3)], 1, 1)  # the first comes too late
    finally:
        query.stop()


def test_latest_per_offset_moves_only_what_repeats(spark):
    rows = [("t", 0, o, f"p{o}") for o in range(200)]
    once = envelopes(spark, *rows)
    plan = od.latest_per_offset(once)
    assert sorted(map(tuple, plan.collect())) == rows
    final = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Exchange hashpartitioning" not in final
    odd = [("t", 0, 5, "z"), ("t", 0, 5, None), (None, 0, 1, "x"), (None, 0, 1, "x"), ("t", None, 1, "x"), ("t", 0, None, "x")]
    got = sorted(map(tuple, od.latest_per_offset(envelopes(spark, *rows, *odd)).collect()))
    assert got == sorted(rows[:5] + [("t", 0, 5, "z")] + rows[6:])


def test_epoch_millis(spark):
    df = spark.createDataFrame([("2024-02-29 12:30:01.25",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert one(df.select(fn.epoch_millis(fn.utc_instant("t")).alias("m"))).m == 1709209801250
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_distributions_merge(spark):
    df = spark.range(1, 1001).selectExpr("'t' as topic", "0 as partition", "id as v", "id % 10 as batch")
    merged = mt.merged(mt.sketched(df, "v", ("topic", "partition", "batch")))
    assert tuple(one(mt.distribution(merged, "v"))) == ("t", 0, 1000, 1, 1000, 500500, 500, 990)


def test_batch_order(spark):
    df = envelopes(spark, ("t", 0, 2, "c"), ("t", 0, 0, "a"), ("s", 0, 5, "z"))
    assert [(r.topic, r.offset) for r in od.in_offset_order(df).collect()] == [("s", 5), ("t", 0), ("t", 2)]
