"""Streams played back from staged files: late rows, output modes, restarts, triggers."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.decode import parse_events, watch_quality, with_event_time
from tidegauge.operators.encode import encode_event, to_event
from tidegauge.operators.windows import window_stats
from tidegauge.plans.feeds import EVENTS, events, ticks
from tidegauge.schema import STATS_SCHEMA
from tidegauge.session import ROCKSDB, scratch_dir, stream_options
from tidegauge.sources.replay import replay_stream
from tidegauge.streaming.run import (
    Reports,
    consume,
    finish,
    message_stats,
    progress,
    quarantine,
    read_bad,
    read_good,
    read_reports,
    run_stream,
)
from tidegauge.streaming.sinks import (
    latest_results,
    process_then_commit,
    read_batches,
    read_stats,
    replace_batch,
    run_mark,
    trigger,
    write_raw,
    write_stream,
)
from tidegauge.streaming.state import read_open_windows

TICKS = "indicator string, value double, event_time timestamp"
DAY = "2024-01-01 00:"

LINES = T.StructType([T.StructField("line", T.StringType())])


def put(spark, folder, order, rows):
    """One file; its age decides its place in the replay."""
    df = spark.createDataFrame(rows, "indicator string, value double, t string")
    df = df.select("indicator", "value", F.col("t").cast("timestamp").alias("event_time"))
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    df.coalesce(1).write.mode("append").parquet(folder)
    for name in set(os.listdir(folder)) - before:
        if name.endswith(".parquet"):
            os.utime(f"{folder}/{name}", (1_700_000_000 + order, 1_700_000_000 + order))


def stats_of(spark, folder, max_files=1):
    return window_stats(replay_stream(spark, f"{folder}/in", TICKS, max_files=max_files))


def drain(spark, folder, **more):
    return finish(
        write_stream(
            stats_of(spark, folder), "parquet", f"{folder}/out", f"{folder}/ck", drain=True, **more
        )
    )


def stored(spark, folder):
    rows = read_stats(spark, f"{folder}/out").select(
        F.date_format("start", "mm:ss"), "indicator", "avg_value", "max_value", "cnt"
    )
    return sorted(tuple(r) for r in rows.collect())


def test_late_rows_one_batch_behind(spark):
    """A batch drops by the watermark of the batch before: late rows of the second file count."""
    folder = scratch_dir(spark, "t")
    put(spark, f"{folder}/in", 0, [("a", 1.0, DAY + "00:10"), ("a", 2.0, DAY + "05:00")])
    put(spark, f"{folder}/in", 1,
        [("a", 10.0, DAY + "02:15"), ("a", 20.0, DAY + "02:45"), ("a", 3.0, DAY + "09:00")])
    drain(spark, folder)
    assert stored(spark, folder) == sorted([
        ("59:30", "a", 1.0, 1.0, 1), ("00:00", "a", 1.0, 1.0, 1), ("01:30", "a", 10.0, 10.0, 1),
        ("02:00", "a", 15.0, 20.0, 2), ("02:30", "a", 20.0, 20.0, 1), ("04:30", "a", 2.0, 2.0, 1),
        ("05:00", "a", 2.0, 2.0, 1),
    ])


def test_late_rows_per_window(spark):
    """At watermark 03:00 a row of 02:45 is lost to [02:00, 03:00) and counts in [02:30, 03:30)."""
    folder = scratch_dir(spark, "t")
    put(spark, f"{folder}/in", 0, [("a", 2.0, DAY + "05:00")])
    put(spark, f"{folder}/in", 1, [("a", 3.0, DAY + "05:05")])
    put(spark, f"{folder}/in", 2,
        [("a", 10.0, DAY + "02:15"), ("a", 20.0, DAY + "02:45"), ("a", 30.0, DAY + "03:00")])
    put(spark, f"{folder}/in", 3, [("a", 99.0, DAY + "02:50"), ("a", 1.0, DAY + "20:00")])
    query = drain(spark, folder)
    assert stored(spark, folder) == sorted([
        ("02:30", "a", round(149 / 3, 4), 99.0, 3), ("03:00", "a", 30.0, 30.0, 1),
        ("04:30", "a", 2.5, 3.0, 2), ("05:00", "a", 2.5, 3.0, 2),
    ])
    report = progress(query)
    assert sum(r["rows_in"] for r in report) == 7
    assert sum(r["late_groups"] for r in report) == 3
    assert report[-1]["watermark"].startswith("2024-01-01T00:18")
    assert all(r["millis"] > 0 for r in report)


def simulated(batches):
    """What append mode stores, window by window, from the two watermarks of a micro-batch: rows are
    dropped by the older one, windows are closed by the newer one."""
    minute, half, lateness = timedelta(minutes=1), timedelta(seconds=30), timedelta(minutes=2)
    epoch = latest = datetime(1970, 1, 1)
    late = close = epoch
    state, out = {}, []
    for batch in [*batches, []]:
        for indicator, value, at in batch:
            start = at - (at - epoch) % half
            for begin in (start, start - half):
                if begin + minute > late:
                    state.setdefault((begin, indicator), []).append(value)
        for key in [k for k in state if k[0] + minute <= close]:
            values = state.pop(key)
            out.append((key[0], key[1], max(values), len(values)))
        latest = max([latest, *(r[2] for r in batch)])
        late, close = close, max(close, latest - lateness)
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_shuffled_arrival(spark, seed):
    """Rows up to eight minutes out of order, over six micro-batches."""
    dice = random.Random(seed)
    folder = scratch_dir(spark, "t")
    batches = []
    for i in range(6):
        late = [dice.randint(0, 480) for _ in range(25)]
        batches.append([
            (dice.choice("ab"), float(dice.randint(1, 99)),
             datetime(2024, 1, 1, 1) + timedelta(seconds=150 * i - s)) for s in late
        ])
        put(spark, f"{folder}/in", i, [(k, v, str(at)) for k, v, at in batches[-1]])
    query = drain(spark, folder)
    assert sum(r["late_groups"] for r in progress(query)) > 0
    got = read_stats(spark, f"{folder}/out").select(
        F.col("start").cast("timestamp_ntz"), "indicator", "max_value", "cnt")
    assert sorted(tuple(r) for r in got.collect()) == simulated(batches)


def test_restart_goes_on(spark):
    folder = scratch_dir(spark, "t")
    put(spark, f"{folder}/in", 0, [("a", 1.0, DAY + "00:10"), ("b", 1.0, DAY + "05:20")])
    drain(spark, folder)
    first = stored(spark, folder)
    assert first == [("00:00", "a", 1.0, 1.0, 1), ("59:30", "a", 1.0, 1.0, 1)]
    drain(spark, folder)
    assert stored(spark, folder) == first  # nothing new: nothing twice
    put(spark, f"{folder}/in", 1, [("b", 2.0, DAY + "05:25"), ("b", 2.0, DAY + "10:00")])
    drain(spark, folder)
    assert stored(spark, folder) == sorted(
        [*first, ("04:30", "b", 1.5, 2.0, 2), ("05:00", "b", 1.5, 2.0, 2)]
    )


def test_update_mode_tells_every_change(spark):
    folder = scratch_dir(spark, "t")
    put(spark, f"{folder}/in", 0, [("a", 1.0, DAY + "00:40")])
    put(spark, f"{folder}/in", 1, [("a", 2.0, DAY + "00:50"), ("a", 5.0, DAY + "01:10")])
    finish(process_then_commit(
        stats_of(spark, folder), replace_batch(f"{folder}/out"), f"{folder}/ck", "update", drain=True
    ))
    log = read_batches(spark, f"{folder}/out", STATS_SCHEMA)
    changes = log.select(F.date_format("start", "mm:ss"), "cnt", "batch_id").collect()
    assert sorted(map(tuple, changes)) == [
        ("00:00", 1, 0), ("00:00", 2, 1), ("00:30", 1, 0), ("00:30", 3, 1), ("01:00", 1, 1),
    ]
    newest = latest_results(log).select(F.date_format("start", "mm:ss"), "avg_value", "cnt")
    assert sorted(map(tuple, newest.collect())) == [
        ("00:00", 1.5, 2), ("00:30", round(8 / 3, 4), 3), ("01:00", 5.0, 1),
    ]


def test_repeated_batch_replaces_itself(spark):
    folder = scratch_dir(spark, "t")
    write = replace_batch(folder)
    at = datetime(2024, 1, 1)
    row = [(at, at + timedelta(minutes=1), "a", 1.0, 1.0, 1)]
    for _ in range(2):
        write(spark.createDataFrame(row, STATS_SCHEMA), 4, 1)
    assert read_batches(spark, folder, STATS_SCHEMA).count() == 1


def test_appended_copies_fall_together(spark):
    at = datetime(2024, 1, 1)
    end = at + timedelta(minutes=1)
    rows = [(at, end, "a", 1.0, 1.0, 1, 1, 0), (at, end, "a", 2.0, 3.0, 2, 1, 7), (at, end, "a", 2.0, 3.0, 2, 1, 7),
            (at, end, "b", None, None, 1, 1, 3)]
    df = spark.createDataFrame(
        rows, "start timestamp_ntz, end timestamp_ntz, indicator string, avg_value double, "
        "max_value double, cnt bigint, run bigint, batch_id bigint",
    )
    assert sorted(tuple(r) for r in latest_results(df).collect()) == [
        (at, end, "a", 2.0, 3.0, 2), (at, end, "b", None, None, 1),
    ]


def test_results_of_a_new_checkpoint_win(spark):
    """Its batch ids begin at 0 again, in the same place, where an earlier run has higher ones."""
    folder = scratch_dir(spark, "t")
    for i, minute in enumerate(("00:40", "00:45", "00:50")):
        put(spark, f"{folder}/in", i, [("a", 1.0, DAY + minute)])
    write = replace_batch(f"{folder}/out")
    finish(process_then_commit(stats_of(spark, folder), write, f"{folder}/ck", "update", drain=True))
    put(spark, f"{folder}/in", 3, [("a", 9.0, DAY + "00:55")])
    ticks = replay_stream(spark, f"{folder}/in", TICKS)
    finish(process_then_commit(window_stats(ticks), write, f"{folder}/ck2", "update", drain=True))
    log = read_batches(spark, f"{folder}/out", STATS_SCHEMA)
    runs = log.groupBy("run").agg(F.max("batch_id").alias("last")).orderBy("run").collect()
    assert [r["last"] for r in runs] == [2, 0]
    assert {(r["cnt"], r["avg_value"]) for r in latest_results(log).collect()} == {(4, 3.0)}
    assert run_mark(spark, f"{folder}/ck") == runs[0]["run"] < run_mark(spark, f"{folder}/ck2")


def messages(spark, folder):
    """A topic of three messages, one of them broken, as files."""
    at = F.col("t").cast("timestamp")
    rows = spark.createDataFrame(
        [("cpi", 114.0, DAY + "00:10"), ("cpi", 116.0, DAY + "00:20")], "c string, v double, t string"
    )
    good = encode_event(to_event(rows, F.col("c"), F.lit("물가"), F.col("v"), at)).select("key", "value")
    bad = spark.createDataFrame([("cpi", "cut sho")], "key string, value string")
    log = good.unionByName(bad).coalesce(1).select(
        "key", F.col("value").cast("binary"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
    )
    log.write.parquet(f"{folder}/in")
    return replay_stream(
        spark, f"{folder}/in", "key string, value binary, partition int, offset bigint"
    )


def test_files_are_replayed_in_bounded_batches(spark, sf_dir):
    """A table of several files, replayed in place: several micro-batches, and the same windows."""
    folder = scratch_dir(spark, "t")
    table = events(spark, sf_dir)
    for day in range(3):
        table.filter(f"(day(ts) - 1) DIV 10 = {day}").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = replay_stream(spark, f"{folder}/in", EVENTS, max_bytes="1")
    query = finish(write_stream(
        window_stats(ticks(stream)), "parquet", f"{folder}/out", f"{folder}/ck", drain=True, shuffle_partitions=2))
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 3
    last = table.agg(F.max("ts")).first()[0]
    closed = window_stats(ticks(table)).filter(F.col("end") <= F.lit(last - timedelta(minutes=2)))
    assert read_stats(spark, f"{folder}/out").count() == closed.count()


def test_messages_to_console(spark):
    query = finish(run_stream(messages(spark, scratch_dir(spark, "t")), "console", drain=True))
    first = progress(query)[0]
    assert first["rows_in"] == 3 and first["state_rows"] == 2
    assert "Console" in query.recentProgress[0]["sink"]["description"]
    # The running job counts what no window sees.
    assert first["observed"]["quality"].asDict() == {"rows": 3, "no_event_time": 1, "no_value": 1}


def test_consume_skips_or_stops(spark):
    folder = scratch_dir(spark, "t")
    topic = messages(spark, folder)
    query = finish(consume(topic, replace_batch(f"{folder}/out"), f"{folder}/ck", drain=True))
    got = read_batches(spark, f"{folder}/out", LINES).collect()
    assert sorted(r["line"] for r in got) == ["[0@0] 물가=114.0", "[0@1] 물가=116.0"]
    assert progress(query)[0]["observed"]["messages"].asDict() == {"good": 2, "bad": 1}
    strict = consume(topic, replace_batch(f"{folder}/o2"), f"{folder}/ck2", strict=True, drain=True)
    with pytest.raises(Exception, match="cannot be read"):
        finish(strict)
    assert not os.path.exists(f"{folder}/ck2/commits/0")  # progress is not stored


def test_batch_is_handled_again_if_its_position_was_not_stored(spark):
    folder = scratch_dir(spark, "t")
    topic = messages(spark, folder)
    calls = []

    def fails_after_writing(batch, batch_id, run):
        replace_batch(f"{folder}/out")(batch, batch_id, run)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost before the commit")

    with pytest.raises(Exception, match="lost before the commit"):
        finish(consume(topic, fails_after_writing, f"{folder}/ck", drain=True))
    finish(consume(topic, fails_after_writing, f"{folder}/ck", drain=True))
    assert calls == [0, 0]
    assert read_batches(spark, f"{folder}/out", LINES).count() == 2


def test_table_and_stream_of_messages_agree(spark):
    folder = scratch_dir(spark, "t")
    messages(spark, folder)
    table = message_stats(spark.read.parquet(f"{folder}/in"))
    assert {(r["cnt"], r["avg_value"]) for r in table.collect()} == {(2, 115.0)}


def test_unknown_sink(spark):
    with pytest.raises(ValueError, match="unknown sink"):
        write_stream(spark.readStream.format("rate").load(), "parquett")


def test_parquet_needs_paths(spark):
    with pytest.raises(ValueError, match="needs a path"):
        write_stream(spark.readStream.format("rate").load(), "parquet", path="x")


class Writer:
    def trigger(self, **how):
        return how


def test_triggers():
    assert trigger(Writer(), "30 seconds", False) == {"processingTime": "30 seconds"}
    assert trigger(Writer(), "30 seconds", True) == {"availableNow": True}


def test_options_come_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")
    with stream_options(spark, 3):
        assert (spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")) == (ROCKSDB, "3")
    assert (spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")) == before


def test_processing_time_query_runs_until_stopped(spark):
    folder = scratch_dir(spark, "t")
    put(spark, f"{folder}/in", 0, [("a", 1.0, DAY + "00:10"), ("a", 2.0, DAY + "09:00")])
    query = write_stream(
        stats_of(spark, folder), "parquet", f"{folder}/out", f"{folder}/ck", every="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert [r[0] for r in stored(spark, folder)] == ["00:00", "59:30"]


def test_failed_batch_leaves_nothing_behind(spark):
    """The second file breaks the job after the first is stored; the repaired job goes on."""
    folder = scratch_dir(spark, "t")
    put(spark, f"{folder}/in", 0, [("a", 1.0, DAY + "00:10"), ("a", 2.0, DAY + "05:00")])
    put(spark, f"{folder}/in", 1, [("a", -1.0, DAY + "05:10"), ("a", 3.0, DAY + "09:00")])

    def query(value):
        ticks = replay_stream(spark, f"{folder}/in", TICKS, max_files=1).withColumn("value", value)
        return write_stream(
            window_stats(ticks), "parquet", f"{folder}/out", f"{folder}/ck", drain=True
        )

    breaks = F.when(F.col("value") < 0, F.raise_error(F.lit("bad reading")).cast("double"))
    with pytest.raises(Exception, match="bad reading"):
        finish(query(breaks.otherwise(F.col("value"))))
    finish(query(F.abs("value")))
    assert stored(spark, folder) == [
        ("00:00", "a", 1.0, 1.0, 1), ("04:30", "a", 1.5, 2.0, 2), ("05:00", "a", 1.5, 2.0, 2),
        ("59:30", "a", 1.0, 1.0, 1),
    ]


def test_quality_of_a_stream(spark):
    folder = scratch_dir(spark, "t")
    events = watch_quality(with_event_time(parse_events(messages(spark, folder))))
    query = finish(process_then_commit(
        events, replace_batch(f"{folder}/out"), f"{folder}/ck", drain=True))
    counts = progress(query)[0]["observed"]["quality"]
    assert counts.asDict() == {"rows": 3, "no_event_time": 1, "no_value": 1}


def test_readers_see_committed_batches_only(spark, monkeypatch):
    """Between writing and the record the old batch stands; a crash there leaves it, and a repeat replaces it."""
    from tidegauge.streaming import sinks

    folder = scratch_dir(spark, "t")
    assert read_batches(spark, folder, LINES).count() == 0
    write, lines = replace_batch(folder), lambda *texts: spark.createDataFrame([(t,) for t in texts], LINES)

    def content():
        return sorted((r["batch_id"], r["line"]) for r in read_batches(spark, folder, LINES).collect())

    write(lines("a", "b"), 0, 1)
    write(lines("c"), 1, 1)
    before = [(0, "a"), (0, "b"), (1, "c")]
    seen = []
    commit = sinks.commit_batch

    def crash(*_):
        seen.append(content())
        raise RuntimeError("ended before the record")

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "commit_batch", crash)
        with pytest.raises(RuntimeError):
            write(lines("d", "e"), 1, 1)
    assert seen == [before] and content() == before
    # Ended behind the record, before the position was stored: the batch comes again.
    monkeypatch.setattr(sinks, "commit_batch", lambda *a: seen.append(content()) or commit(*a))
    for _ in range(2):
        write(lines("d", "e"), 1, 1)
    after = [(0, "a"), (0, "b"), (1, "d"), (1, "e")]
    assert seen == [before, before, after] and content() == after
    write(lines(), 0, 1)
    assert content() == after[2:]


def test_quarantine_keeps_both_kinds_once(spark):
    """A crash behind the record of a batch: it comes again, and neither kind is there twice."""
    from tidegauge.streaming import run, sinks

    folder = scratch_dir(spark, "t")
    topic = messages(spark, folder)
    with pytest.MonkeyPatch.context() as broken:
        write = sinks.replace_batch(f"{folder}/out", ("bad",))

        def fails(path, partition_by):
            def again(*batch):
                write(*batch)
                raise RuntimeError("lost before the commit")

            return again

        broken.setattr(run, "replace_batch", fails)
        with pytest.raises(Exception, match="lost before the commit"):
            finish(quarantine(topic, f"{folder}/out", f"{folder}/ck", drain=True))
    query = finish(quarantine(topic, f"{folder}/out", f"{folder}/ck", drain=True))
    assert sorted(r["value"] for r in read_good(spark, f"{folder}/out").collect()) == [114.0, 116.0]
    (bad,) = read_bad(spark, f"{folder}/out").collect()
    assert bad["raw"] and bad["batch_id"] == 0
    assert progress(query)[0]["observed"]["messages"].asDict() == {"good": 2, "bad": 1}
    plan = read_bad(spark, f"{folder}/out")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bad" in plan  # the good ones' files are not opened


def test_every_micro_batch_is_reported(spark):
    """150 micro-batches: the query itself remembers 100."""
    folder = scratch_dir(spark, "t")
    rows = spark.range(150).selectExpr("'a' AS indicator", "CAST(id AS double) AS value", "timestamp_seconds(1704067200 + id) AS event_time")
    rows.repartition(150, "value").write.option("maxRecordsPerFile", 1).parquet(f"{folder}/in")
    reports = Reports(spark, f"{folder}/reports", together=64)
    spark.streams.addListener(reports)
    try:
        stream = replay_stream(spark, f"{folder}/in", "indicator string, value double, event_time timestamp", max_files=1)
        query = finish(write_raw(stream, f"{folder}/out", f"{folder}/ck", drain=True))
        reports.wait(query)
    finally:
        spark.streams.removeListener(reports)
    kept = read_reports(spark, f"{folder}/reports").filter(F.col("query") == str(query.id)).collect()
    assert len(query.recentProgress) <= 100
    fed = [r for r in kept if r["rows_in"]]
    assert sorted(r["batch_id"] for r in fed) == list(range(150)) and {r["rows_in"] for r in fed} == {1}
    assert len(os.listdir(f"{folder}/reports")) < 20


def test_open_windows_are_those_not_stored(spark):
    """Readings of all kinds, also as of an earlier batch; stored and open windows are all windows."""
    folder = scratch_dir(spark, "t")
    kinds = [1.5, None, 0.123456789, 300_000.25, 2e18, float("inf"), -7.0]
    for order in range(4):
        put(spark, f"{folder}/in", order, [(k, v, f"{DAY}{order:02d}:{10 * i:02d}") for i, v in enumerate(kinds[:6]) for k in "ab"])
    drain(spark, folder)
    table = spark.read.schema(TICKS).parquet(f"{folder}/in")
    every = {tuple(map(str, r)) for r in window_stats(table).collect()}
    done = {tuple(map(str, r)) for r in read_stats(spark, f"{folder}/out").collect()}
    held = {tuple(map(str, r)) for r in read_open_windows(spark, f"{folder}/ck").collect()}
    assert done and held and not done & held and done | held == every
    first = read_open_windows(spark, f"{folder}/ck", 0)
    assert {r["start"].minute for r in first.collect()} <= {59, 0}
