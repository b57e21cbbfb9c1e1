"""Sinks that a replay does not change, the log of offsets, and the kept latest records."""

import random

import pytest
from pyspark.sql import functions as F

from areakit.operators.latest import latest
from areakit.streaming import batches, messages, upkeep
from areakit.workloads import modelling

SCHEMA = "code string, day int, tie int, price double"


def arrive(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def kept(spark, path, df):
    return sorted(map(tuple, upkeep.read_state(spark, path, df.schema).select(*df.columns).collect()))


def test_latest_over_many_runs(spark, tmp_path):
    """After each run the state is the latest of all that has arrived, late records included."""
    draw = random.Random(5)
    inbox, state, log = (str(tmp_path / n) for n in ("in", "state", "log"))
    everything = []
    for run in range(4):
        rows = [(f"c{draw.randrange(40)}", draw.randrange(9), i + 100 * run, draw.random()) for i in range(60 if run < 3 else 1)]
        everything += rows
        arrive(spark, inbox, rows)
        stream = spark.readStream.schema(SCHEMA).parquet(inbox)
        upkeep.keep_latest(stream, state, log, ["code"], ["day", "tie"], buckets=8)
        df = spark.createDataFrame(everything, SCHEMA)
        assert kept(spark, state, df) == sorted(map(tuple, latest(df, ["code"], ["day", "tie"]).collect()))
    upkeep.keep_latest(spark.readStream.schema(SCHEMA).parquet(inbox), state, log, ["code"], ["day", "tie"], buckets=8)
    assert kept(spark, state, df) == sorted(map(tuple, latest(df, ["code"], ["day", "tie"]).collect()))


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    inbox, state, log = (str(tmp_path / n) for n in ("in", "state", "log"))

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(inbox)
        upkeep.keep_latest(stream, state, log, ["code"], ["day", "tie"], buckets=8)
        return {p.parent.name: p.name for p in (tmp_path / "state").glob("bucket=*/*.parquet")}

    arrive(spark, inbox, [(f"c{i}", 1, i, 1.0) for i in range(40)])
    before = run()
    arrive(spark, inbox, [("c7", 2, 0, 9.0)])
    after = run()
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1


def test_a_batch_merged_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "state")
    df = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 2, 1, 2.0), (None, 1, 1, 3.0)], SCHEMA)
    merge = upkeep.merge_latest(path, df.schema, ["code"], ["day", "tie"], 4)
    merge(df, 0)
    once = kept_with_null(spark, path, df)
    merge(df, 0)
    merge(df.limit(0), 1)
    assert kept_with_null(spark, path, df) == once == sorted([("a", 2, 1, 2.0), (None, 1, 1, 3.0)], key=repr)
    assert upkeep.read_state(spark, str(tmp_path / "none"), df.schema).count() == 0


def kept_with_null(spark, path, df):
    return sorted(map(tuple, upkeep.read_state(spark, path, df.schema).select(*df.columns).collect()), key=repr)


@pytest.fixture
def routed(spark, tmp_path):
    inbox, log = tmp_path / "in", str(tmp_path / "log")
    inbox.mkdir()
    targets = {"good": str(tmp_path / "good"), "bad": str(tmp_path / "bad")}

    def run(**options):
        stream = messages.message_stream(spark, "text", str(inbox), **options)
        sided = stream.withColumn("route", F.when(F.col("value").startswith("x"), "bad").otherwise("good"))
        messages.run_for(batches.start_batches(sided, log, batches.split_targets(targets)), 60)

    def found():
        return {n: sorted(tuple(r) for r in spark.read.parquet(p).collect()) for n, p in targets.items()}

    return inbox, log, run, found


def test_a_replayed_batch_changes_nothing(spark, routed):
    inbox, log, run, found = routed
    (inbox / "a.txt").write_text("one\nxtwo\nthree\n")
    run()
    (inbox / "b.txt").write_text("four\n")
    run()
    before = found()
    assert before == {"good": [("four", 1), ("one", 0), ("three", 0)], "bad": [("xtwo", 0)]}
    batches.forget_commit(spark, log, 1)
    state = {r["batch"]: r["committed"] for r in batches.offset_log(spark, log).collect()}
    assert state == {0: True, 1: False}
    run()
    assert found() == before
    assert all(r["committed"] for r in batches.offset_log(spark, log).collect())


def test_a_batch_that_failed_between_its_targets_is_made_whole(spark, routed, tmp_path, monkeypatch):
    inbox, log, run, found = routed
    (inbox / "a.txt").write_text("one\nxtwo\n")
    whole = batches.split_targets

    def torn(targets):
        write = whole(targets)

        def half(batch, number):
            write(batch.filter("route = 'good'").limit(0), number)
            raise RuntimeError("lost")

        return half

    monkeypatch.setattr(batches, "split_targets", torn)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(batches, "split_targets", whole)
    run()
    assert found() == {"good": [("one", 0)], "bad": [("xtwo", 0)]}


def test_offsets_have_no_gap(spark, routed):
    inbox, log, run, _ = routed
    for number in range(5):
        (inbox / f"{number}.txt").write_text(f"{number}\n")
    run(maxFilesPerTrigger="2")
    (inbox / "late.txt").write_text("late\n")
    run(maxFilesPerTrigger="2")
    found = batches.offset_log(spark, log).orderBy("batch").collect()
    assert [r["batch"] for r in found] == [0, 1, 2, 3]
    assert [r["start_offset"] for r in found[1:]] == [r["end_offset"] for r in found[:-1]]
    assert found[0]["start_offset"] is None and len({r["end_offset"] for r in found}) == 4


def test_the_log_of_many_batches_stays_whole(spark, tmp_path):
    """Spark forgets the offsets of all but the last 100 batches unless it is told not to."""
    files = [*range(0, 302, 2), *range(1, 161, 2)]  # 51 batches, then 27 of three files each
    rows = [(modelling.EVENTS_A_FILE * f + i, None, 1, "click", 1.0, None) for f in files for i in (0, 1)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    retained, kept = "spark.sql.streaming.minBatchesToRetain", spark.conf.getAll
    spark.conf.set(retained, "20")
    try:
        found = modelling.stream_offsets(spark, str(tmp_path)).orderBy("batch").collect()
        assert spark.conf.getAll == {**kept, retained: "20"}  # nothing is left in the caller's session
    finally:
        spark.conf.unset(retained)
    assert [tuple(r) for r in found] == [(b, b - 1 if b else None, b, True, 462, 462) for b in range(78)]


def test_a_trimmed_sink_log_loses_nothing(spark, tmp_path):
    inbox, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    inbox.mkdir()
    session = batches.many_batches(spark, log)
    session.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "3")

    def run(first, last):
        for number in range(first, last):
            (inbox / f"{number}.txt").write_text(f"{number}\n")
        stream = messages.message_stream(session, "text", str(inbox), maxFilesPerTrigger="1")
        messages.run_for(messages.append_to(stream, log, path=out))
        return sorted(int(r["value"]) for r in session.read.schema("value string").parquet(out).collect())

    def entries():
        return sorted(p.name for p in (tmp_path / "out" / "_spark_metadata").glob("[0-9]*"))

    batches.trim_sink_log(spark, out)  # nothing is there yet
    assert run(0, 10) == [*range(10)]
    assert "0" in entries()
    batches.trim_sink_log(spark, out)
    assert entries() == ["5.compact", "6", "7", "8.compact", "9"]
    assert run(10, 14) == [*range(14)]
    batches.trim_sink_log(spark, out)
    assert entries() == ["10", "11.compact", "12", "13", "8.compact", "9"]
    assert session.read.schema("value string").parquet(out).count() == 14
    assert batches.offset_log(spark, log).filter("committed").count() == 14


def test_meanwhile_is_called_until_the_time_is_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(messages, "MEANWHILE_SECONDS", 0.1)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\n")
    calls = []
    for seconds, once in ((2, False), (60, True), (None, True)):
        stream = messages.message_stream(spark, "text", str(tmp_path / "in"))
        place = str(tmp_path / f"{seconds}")
        query = messages.append_to(stream, f"{place}-log", path=place, once=once)
        messages.run_for(query, seconds, meanwhile=lambda: calls.append(seconds))
        assert not query.isActive
        assert [r["value"] for r in spark.read.schema("value string").parquet(place).collect()] == ["one"]
    assert calls.count(2) > 3
