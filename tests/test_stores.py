"""Versions, checkpoint, published tables and segment logs: concurrent writers, replays, summaries, pruning."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.schemas import ENVELOPE, LOG_RECORD
from tidemark.sources import checkpoint as cp
from tidemark.sources import log as lg
from tidemark.sources import manifest as mf
from tidemark.sources import segments as sg
from tidemark.sources.versions import Versions

ROWS = ENVELOPE


def records(spark, *ranges):
    """Rows of ``(topic, partition, start, end)``."""
    rows = [(t, p, o, f"{t}{p}-{o}") for t, p, s, e in ranges for o in range(s, e + 1)]
    return spark.createDataFrame(rows, ROWS)


def offsets(df):
    return sorted((r.topic, r.partition, r.offset) for r in df.select("topic", "partition", "offset").collect())


def entries(df):
    return sorted((r.topic, r.partition, r.start_offset, r.end_offset) for r in df.collect())


# Versions and checkpoint

def test_a_number_goes_to_one_writer(spark, tmp_path):
    a, b = Versions(spark, str(tmp_path / "v")), Versions(spark, str(tmp_path / "v"))
    assert a.latest() == -1 and a.tail() == []
    assert a.put(0, {"by": "a"}) and not b.put(0, {"by": "b"}) and a.get(0) == {"by": "a"}
    assert b.append({"by": "b"}) == 1 and a.append({"by": "a", "whole": True}) == 2 and b.append({"by": "b"}) == 3
    assert [n for n, _ in a.tail()] == [2, 3] and [n for n, _ in a.tail(1)] == [0, 1]
    a._hint(0)  # a stale hint
    assert b.latest() == 3
    (tmp_path / "v" / "_latest").unlink()
    assert b.latest() == 3
    assert not [p for p in (tmp_path / "v").iterdir() if p.name.startswith("_draft")]


def acked(spark, *rows):
    return spark.createDataFrame(list(rows), "topic string, partition int, last_acked long")


def test_interleaved_writers_never_move_a_key_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cp, "SNAPSHOT_EVERY", 3)
    one, two = cp.CheckpointLog(spark, str(tmp_path)), cp.CheckpointLog(spark, str(tmp_path))
    seen = 0
    for n in range(10):
        writer, value = (one, n * 10) if n % 2 else (two, 90 - n * 10)
        writer.append(acked(spark, ("t", 0, value), ("t", n, 1)), "job", n)
        now = {r.partition: r.next_offset for r in writer.current().collect()}
        assert now[0] >= seen and set(now) == set(range(n + 1))
        seen = now[0]
    assert seen == 91
    # What a reader meets does not grow with the number of commits.
    assert len(one.versions.tail()) <= 4 and one.versions.latest() >= 10


def test_a_snapshot_that_comes_too_late_is_void(spark, tmp_path, monkeypatch):
    log, other = cp.CheckpointLog(spark, str(tmp_path)), cp.CheckpointLog(spark, str(tmp_path))
    log.append(acked(spark, ("t", 0, 5)), "a", 1)
    write = log._written

    def and_meanwhile(rows):
        name = write(rows)
        other.append(acked(spark, ("t", 0, 9)), "b", 2)
        return name

    monkeypatch.setattr(log, "_written", and_meanwhile)
    assert not log.summed_up() and log.current().first().next_offset == 10


# Published tables

def test_batches_count_once_they_are_published(spark, tmp_path):
    table = mf.PublishedTable(spark, str(tmp_path), "r")
    assert table.read(ROWS).count() == 0 and table.entries().count() == 0
    first = table.write(records(spark, ("t", 0, 0, 130), ("t", 0, 140, 150), ("u", 1, 7, 7)).coalesce(1), 0)
    assert entries(first) == [("t", 0, 0, 130), ("t", 0, 140, 150), ("u", 1, 7, 7)]
    # An attempt that ended before it was published left files that nobody sees.
    records(spark, ("t", 0, 999, 999)).write.parquet(str(tmp_path / "run_id=r" / "batch_id=1" / "attempt=x"))
    assert table.read(ROWS).count() == 143
    table.write(records(spark, ("t", 0, 0, 9)), 0)  # the same batch again
    table.write(records(spark, ("t", 0, 10, 19)), 1)
    other = mf.PublishedTable(spark, str(tmp_path), "s")
    other.write(records(spark, ("t", 0, 5, 6)), 0)
    got = table.read(ROWS)
    assert offsets(got.where("run_id = 'r'")) == [("t", 0, o) for o in range(20)] and got.where("run_id = 's'").count() == 2
    assert {(r.run_id, r.batch_id) for r in got.select("run_id", "batch_id").collect()} == {("r", 0), ("r", 1), ("s", 0)}


def test_odd_names_and_rows_without_offsets(spark, tmp_path):
    table = mf.PublishedTable(spark, str(tmp_path / "a b+c%20"), "r", mf.RECORD_ADDRESS)
    odd = spark.createDataFrame([(None, 0, 1, "x y+z"), ("t", 0, 3, "x y+z"), ("t", None, 4, "ü")], ROWS)
    kept = table.write(odd, 0, ("payload",)).collect()
    assert sorted((r.topic, r.start_offset) for r in kept if r.topic) == [("t", 3)] and sum(r.topic is None for r in kept) == 2
    assert table.read(ROWS).count() == 3 and table.read(ROWS).where("payload = 'x y+z'").count() == 2


def test_compaction_and_summaries_bound_files_and_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mf, "SNAPSHOT_EVERY", 5)
    table = mf.PublishedTable(spark, str(tmp_path), "r")
    layout = ROWS
    for n in range(12):
        rows = records(spark, ("t", 0, n * 4, n * 4 + 3)).withColumn("destination", F.lit("d"))
        table.write(rows.repartition(3), n, ("destination",))
        if n in (5, 9):
            table.compact(layout, n - 1, ("destination",))
        assert len(table.versions.tail()) <= 7
    assert offsets(table.read(layout)) == [("t", 0, o) for o in range(48)]
    assert entries(table.batch(8)) == [("t", 0, 20, 35)]  # batches 5 to 8 in one
    assert table.entries().select("file").distinct().count() <= 2 + 3 * 3
    assert table.read(layout, ("destination",)).select("destination").distinct().count() == 1
    table.write(records(spark, ("t", 0, 44, 50)).withColumn("destination", F.lit("d")), 11, ("destination",))
    assert offsets(table.read(layout)) == [("t", 0, o) for o in range(51)]


def test_only_files_with_wanted_offsets_are_opened(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mf, "SNAPSHOT_EVERY", 4)
    table = mf.PublishedTable(spark, str(tmp_path), "r")
    for n in range(10):
        floors = spark.createDataFrame([("t", 0, n * 10 - 20)], "topic string, partition int, next_offset long")
        table.write(records(spark, ("t", 0, n * 10, n * 10 + 9), ("u", 0, n, n)).coalesce(1), n, floors=floors)
    wanted = spark.createDataFrame([("t", 0, 85, 92)], "topic string, partition int, start_offset long, end_offset long")
    found = table.read_overlapping(wanted, ROWS)
    assert len(found.inputFiles()) == 2 and {r.batch_id for r in found.collect()} == {8, 9}
    assert table.read_overlapping(wanted.where("false"), ROWS).count() == 0
    # What lies below the floors is forgotten when entries are summed up, other keys are not.
    held = entries(table.entries())
    assert ("t", 0, 0, 9) not in held and ("u", 0, 0, 0) in held and ("t", 0, 90, 99) in held


# Segment logs

def log_rows(spark, *ranges):
    return records(spark, *ranges).select("topic", "partition", "offset", F.timestamp_seconds("offset").alias("timestamp"), F.col("payload").alias("key"), F.when(F.col("offset") % 3 > 0, F.col("payload")).alias("value"))


def test_segments_are_read_from_a_checkpoint_without_partition_counts(spark, tmp_path):
    spec = lg.LogSpec("segments", str(tmp_path / "log"))
    assert spark.createDataFrame([], LOG_RECORD).schema == lg.read_log(spark, lg.LogSpec("segments", str(tmp_path / "none"))).schema
    written = log_rows(spark, ("a", 0, 0, 99), ("a", 1, 0, 49), ("b", 0, 10, 19))
    lg.write_log(written, spec)
    lg.write_log(log_rows(spark, ("a", 0, 100, 199)), spec)
    back = lg.read_log(spark, spec)
    assert back.schema == LOG_RECORD and back.exceptAll(written).count() == 100 and written.exceptAll(back).count() == 0
    floors = spark.createDataFrame([("a", 0, 120), ("b", 0, 15)], "topic string, partition int, next_offset long")
    kept = offsets(lg.read_log(spark, spec, floors=floors))
    assert kept == sorted([("a", 0, o) for o in range(120, 200)] + [("a", 1, o) for o in range(50)] + [("b", 0, o) for o in range(15, 20)])
    only = lg.LogSpec("segments", str(tmp_path / "log"), topics=("b",))
    assert offsets(lg.read_log(spark, only)) == [("b", 0, o) for o in range(10, 20)]


def test_segments_below_the_start_are_not_opened(spark, tmp_path):
    for n in range(6):
        sg.append_segments(log_rows(spark, ("a", 0, n * 10, n * 10 + 9)), str(tmp_path))
    plan = lambda starting, topics=(): sg.SegmentReader({"path": str(tmp_path), "startingoffsets": json.dumps(starting), "topics": json.dumps(topics)}).partitions()
    assert sum(len(s.wanted) for s in plan({})) == 6 and len(plan({"a": {"0": 45}})) == 2
    assert [s.file for s in plan({"a": {"0": 60}})] == [""] and [s.file for s in plan({}, ["z"])] == [""]


def test_a_stream_of_segments_starts_at_the_checkpoint_and_goes_on(spark, tmp_path):
    spec = lg.LogSpec("segments", str(tmp_path / "log"))
    lg.write_log(log_rows(spark, ("a", 0, 0, 9), ("a", 1, 0, 4)), spec)
    floors = spark.createDataFrame([("a", 0, 7)], "topic string, partition int, next_offset long")

    def run(name):
        """One run of the query with a checkpoint location of its own name; returns its source's position."""
        query = lg.read_log(spark, spec, streaming=True, floors=floors).writeStream.format("parquet")
        query = query.option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-state")).start()
        try:
            query.processAllAvailable()
            return json.loads(query.lastProgress["sources"][0]["endOffset"].replace("'", '"')) if isinstance(query.lastProgress["sources"][0]["endOffset"], str) else query.lastProgress["sources"][0]["endOffset"]
        finally:
            query.stop()

    assert run("q")["next"] == {"a": {"0": 10, "1": 5}}
    lg.write_log(log_rows(spark, ("a", 0, 10, 11), ("a", 2, 0, 0)), spec)
    sg.append_segments(log_rows(spark, ("a", 1, 3, 5)), spec.path, "late")  # published late, with offsets that were read already
    run("q")
    got = offsets(spark.read.schema(LOG_RECORD).parquet(str(tmp_path / "q")))
    assert got == sorted([("a", 0, o) for o in range(7, 12)] + [("a", 1, o) for o in range(5)] + [("a", 1, o) for o in (3, 4, 5)] + [("a", 2, 0)])
    run("fresh")
    assert len(offsets(spark.read.schema(LOG_RECORD).parquet(str(tmp_path / "fresh")))) == len(got)


def test_a_stream_writes_segments_once_per_batch(spark, tmp_path):
    source, spec = str(tmp_path / "in"), lg.LogSpec("segments", str(tmp_path / "log"))
    lg.write_log(log_rows(spark, ("a", 0, 0, 29)), lg.LogSpec("parquet", source))
    for _ in range(2):
        query = lg.write_log(lg.read_log(spark, lg.LogSpec("parquet", source), streaming=True), spec, str(tmp_path / "state"))
        query.processAllAvailable()
        query.stop()
    assert offsets(lg.read_log(spark, spec)) == [("a", 0, o) for o in range(30)]
    with pytest.raises(Exception):
        lg.read_log(spark, lg.LogSpec("segments", None)).count()
