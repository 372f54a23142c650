"""Scheduled runs against one aggregate over everything."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.decode import parse_events, with_event_time
from tidegauge.operators.encode import encode_event, to_event
from tidegauge.operators.windows import window_stats
from tidegauge.plans.interval import (
    aggregate,
    backfill,
    covering_range,
    events_received,
    ingest,
    land_late,
    read_interval_stats,
    read_landed,
    read_offsets,
    run_interval,
    topic_events,
)
from tidegauge.schema import RAW_SCHEMA
from tidegauge.session import scratch_dir
from test_sources import Recorder

START = datetime(2024, 1, 1, 10)
HOUR = timedelta(hours=1)


def events(spark, *rows):
    df = spark.createDataFrame(rows, "indicator string, value double, t string")
    at = F.col("t").cast("timestamp")
    return df.select(
        "indicator", F.lit("n").alias("name"), "value", F.unix_millis(at).alias("ts"),
        F.lit("s").alias("source"), at.alias("event_time"),
    )


@pytest.fixture
def three_hours(spark):
    return events(
        spark,
        ("a", 1.0, "2024-01-01 10:00:05"), ("a", 2.0, "2024-01-01 10:59:50"),
        ("a", 4.0, "2024-01-01 11:00:10"), ("b", 8.0, "2024-01-01 11:30:00"),
        ("a", 16.0, "2024-01-01 11:59:59.999"), ("b", 32.0, "2024-01-01 12:00:00"),
    )


def content(df):
    return sorted((tuple(r) for r in df.drop("dt", "slot").collect()), key=str)


def test_covering_range(three_hours):
    assert covering_range(three_hours) == (START, START + 3 * HOUR)
    assert covering_range(three_hours, "1 day") == (datetime(2024, 1, 1), datetime(2024, 1, 2))


def test_hourly_runs_give_every_window_once(spark, three_hours):
    store = scratch_dir(spark, "t")
    for i in range(3):
        run_interval(three_hours, store, START + i * HOUR)
    assert content(read_landed(spark, store)) == content(three_hours)
    assert content(read_interval_stats(spark, store)) == content(window_stats(three_hours))
    # The window over the edge belongs to the hour that closes it, whole.
    edge = read_interval_stats(spark, store).filter("start = '2024-01-01 10:59:30' and indicator = 'a'")
    assert [(r["slot"], r["cnt"], r["avg_value"]) for r in edge.collect()] == [("11-00", 2, 3.0)]


def test_backfill_is_the_same_and_repeatable(spark, three_hours):
    store = scratch_dir(spark, "t")
    for _ in range(2):
        backfill(three_hours, store, START, START + 3 * HOUR)
        assert content(read_interval_stats(spark, store)) == content(window_stats(three_hours))
        assert read_landed(spark, store).count() == 6
    backfill(three_hours, store, START, START + 2 * HOUR)  # a part again leaves the rest alone
    run_interval(three_hours, store, START + HOUR)
    assert content(read_interval_stats(spark, store)) == content(window_stats(three_hours))


def test_late_row_counts_after_a_new_run(spark, three_hours):
    store = scratch_dir(spark, "t")
    backfill(three_hours, store, START, START + 3 * HOUR)
    more = three_hours.unionByName(events(spark, ("a", 100.0, "2024-01-01 10:00:06")))
    run_interval(more, store, START)
    assert content(read_interval_stats(spark, store)) == content(window_stats(more))


def test_late_row_at_the_edge_counts_in_the_next_interval_too(spark, three_hours):
    store = scratch_dir(spark, "t")
    backfill(three_hours, store, START, START + 3 * HOUR)
    more = three_hours.unionByName(events(spark, ("a", 100.0, "2024-01-01 10:59:40")))
    run_interval(more, store, START)
    assert content(read_interval_stats(spark, store)) == content(window_stats(more))


def test_windows_do_not_reach_into_intervals_that_were_not_run(spark, three_hours):
    store = scratch_dir(spark, "t")
    run_interval(three_hours, store, START)
    assert {r["slot"] for r in read_interval_stats(spark, store).collect()} == {"10-00"}
    run_interval(three_hours, store, START + 2 * HOUR)
    run_interval(three_hours, store, START)
    assert {r["slot"] for r in read_interval_stats(spark, store).collect()} == {"10-00", "12-00"}


def test_a_run_does_not_lose_rows_unless_told(spark, three_hours):
    store = scratch_dir(spark, "t")
    backfill(three_hours, store, START, START + 3 * HOUR)
    before = content(read_landed(spark, store)), content(read_interval_stats(spark, store))
    for gone in (three_hours.filter("false"), three_hours.filter("value <> 2.0")):
        with pytest.raises(ValueError, match="2024-01-01 10-00 has 2 landed rows"):
            run_interval(gone, store, START)
    assert (content(read_landed(spark, store)), content(read_interval_stats(spark, store))) == before
    run_interval(three_hours.filter("false"), store, START, may_lose=True)
    left = three_hours.filter("event_time >= '2024-01-01 11:00'")
    assert content(read_landed(spark, store)) == content(left)
    assert content(read_interval_stats(spark, store)) == content(window_stats(left))


def test_a_backfill_replaces_by_nothing_if_told(spark, three_hours):
    store = scratch_dir(spark, "t")
    backfill(three_hours, store, START - HOUR, START + 4 * HOUR)
    # The hour after 11:00 is gone from the source; the run does not reach the hour after 12:00.
    left = three_hours.filter("hour(event_time) <> 11")
    backfill(left.filter("hour(event_time) < 12"), store, START, START + 2 * HOUR, may_lose=True)
    assert content(read_landed(spark, store)) == content(left)
    assert content(read_interval_stats(spark, store)) == content(window_stats(left))
    backfill(left.filter("false"), store, START - HOUR, START + 4 * HOUR, may_lose=True)
    assert read_landed(spark, store).count() == read_interval_stats(spark, store).count() == 0


@pytest.mark.parametrize("first, then", [("1 hour", "1 day"), ("1 day", "1 hour")])
def test_a_store_keeps_the_length_of_its_intervals(spark, three_hours, first, then):
    store, day = scratch_dir(spark, "t"), datetime(2024, 1, 1)
    backfill(three_hours, store, day, day + timedelta(days=1), first)
    before = content(read_landed(spark, store)), content(read_interval_stats(spark, store))
    with pytest.raises(ValueError, match="the store has intervals of"):
        run_interval(three_hours, store, day, then)
    assert (content(read_landed(spark, store)), content(read_interval_stats(spark, store))) == before


def test_a_failed_run_leaves_what_was_there(spark, three_hours):
    store = scratch_dir(spark, "t")
    run_interval(three_hours, store, START)
    broken = three_hours.withColumn("name", F.raise_error(F.lit("source gone")).cast("string"))
    with pytest.raises(Exception, match="source gone"):
        run_interval(broken, store, START, may_lose=True)
    assert read_landed(spark, store).count() == 2


def test_one_file_per_interval(spark, three_hours):
    store = scratch_dir(spark, "t")
    run_interval(three_hours.repartition(7), store, START)
    files = read_landed(spark, store).select("_metadata.file_path").distinct()
    assert files.count() == 1


def received(spark, *rows):
    """Topic rows of (reading, event time, time of receipt)."""
    df = spark.createDataFrame(rows, "v double, t string, r string")
    made = encode_event(to_event(df, F.lit("a"), F.lit("n"), F.col("v"), F.col("t").cast("timestamp"), keep=("r",)), keep=("r",))
    return made.select(F.col("value").cast("binary").alias("value"), F.col("r").cast("timestamp").alias("timestamp"))


def test_what_came_late_is_counted_and_a_longer_wait_lands_it(spark):
    day = "2024-01-01 "
    topic = received(
        spark, (1.0, day + "10:10:00", day + "10:10:01"), (2.0, day + "10:59:59", day + "11:01:30"),
        (3.0, day + "10:59:58", day + "11:05:00"), (4.0, day + "11:10:00", day + "11:10:00"), (5.0, day + "11:00:30", day + "10:59:00"),
    )
    store = scratch_dir(spark, "t")

    def run(start, wait):
        return run_interval(events_received(topic, start, start + HOUR, wait), store, start, wait=wait)

    # Senders' clocks may run ahead: the event of 11:00:30 came at 10:59.
    assert run(START, "2 minutes") == {"landed": 2, "earlier": 0, "later": 1, "no_time": 0, "missed": 0}
    assert run(START + HOUR, "2 minutes") == {"landed": 2, "earlier": 2, "later": 0, "no_time": 0, "missed": 1}
    assert read_landed(spark, store).count() == 4
    assert run(START, "10 minutes")["landed"] == 3
    every = with_event_time(parse_events(topic))
    assert content(read_landed(spark, store)) == content(every)
    assert content(read_interval_stats(spark, store)) == content(window_stats(every))


def test_failed_landing_keeps_the_aggregate_from_running(spark, three_hours):
    store = scratch_dir(spark, "t")
    broken = three_hours.withColumn("name", F.raise_error(F.lit("source gone")).cast("string"))
    with pytest.raises(Exception, match="source gone"):
        run_interval(broken.select(*RAW_SCHEMA.fieldNames()), store, START)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_interval_stats(spark, store)


def test_wide_windows_reach_back(spark, three_hours):
    store = scratch_dir(spark, "t")
    shape = {"width": "2 hours", "slide": "1 hour"}
    for i in range(4):
        ingest(three_hours, store, START + i * HOUR, START + (i + 1) * HOUR)
        aggregate(spark, store, START + i * HOUR, START + (i + 1) * HOUR, **shape)
    closed = window_stats(three_hours, **shape).filter("end <= '2024-01-01 14:00'")
    assert content(read_interval_stats(spark, store)) == content(closed)


@pytest.mark.parametrize(
    "start, end, every",
    [(START, START, "1 hour"), (START + timedelta(minutes=1), START + HOUR, "1 hour"),
     (START, START + 7 * HOUR, "7 hours"), (START, START + HOUR, "30 seconds")],
)
def test_ranges_must_fit(spark, three_hours, start, end, every):
    with pytest.raises(ValueError):
        backfill(three_hours, scratch_dir(spark, "t"), start, end, every)


def test_only_needed_folders_are_read(spark, three_hours):
    from tidegauge.plans.interval import _slots

    store = scratch_dir(spark, "t")
    backfill(three_hours, store, START - 12 * HOUR, START + 24 * HOUR)

    def read(first, end):
        chosen = read_landed(spark, store).filter(_slots(first, end, "1 hour"))
        assert "PartitionFilters: [((dt" in chosen._jdf.queryExecution().executedPlan().toString()
        return sorted({r["slot"] for r in chosen.select("slot").distinct().collect()})

    minute = timedelta(minutes=1)
    assert read(START + HOUR, START + 2 * HOUR) == ["11-00"]
    assert read(START + HOUR - minute, START + 2 * HOUR) == ["10-00", "11-00"]
    assert read(START, START + 14 * HOUR) == ["10-00", "11-00", "12-00"]
    assert read(START + 2 * HOUR + minute, START + 24 * HOUR) == ["12-00"]
    assert read(START - 24 * HOUR, START) == []


def test_source_of_a_run(monkeypatch):
    from tidegauge.plans import interval

    monkeypatch.setattr(interval, "events_received", lambda df, *range: df)
    told = topic_events(Recorder(), "b:1", "t", START, START + HOUR, min_partitions=9)
    assert told["options"]["startingTimestamp"] == str(1704103200000 - 120_000)
    assert told["options"]["endingTimestamp"] == str(1704103200000 + 3_600_000 + 120_000)
    assert told["options"]["minPartitions"] == "9"
    told = topic_events(Recorder(), "b:1", "t", START, START + HOUR, "1 hour")
    assert told["options"]["startingTimestamp"] == str(1704103200000 - 3_600_000)


def test_other_zones_are_refused(spark, three_hours):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        with pytest.raises(ValueError, match="has to be UTC"):
            run_interval(three_hours, scratch_dir(spark, "t"), START)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def placed(spark, *rows):
    """Events with a partition and an offset: (reading, time, partition, offset)."""
    df = spark.createDataFrame(rows, "value double, t string, partition int, offset bigint")
    at = F.col("t").cast("timestamp")
    return df.select(
        F.lit("a").alias("indicator"), F.lit("n").alias("name"), "value", F.unix_millis(at).alias("ts"),
        F.lit("s").alias("source"), at.alias("event_time"), "partition", "offset",
    )


DAY = "2024-01-01 "
PLACED = [
    (1.0, DAY + "10:00:05", 0, 10), (2.0, DAY + "10:59:50", 0, 11), (3.0, DAY + "10:59:59", 1, 5),
    (4.0, DAY + "11:00:10", 0, 12), (8.0, DAY + "11:30:00", 1, 6), (16.0, DAY + "11:59:59.999", 0, 14),
    (32.0, DAY + "12:00:00", 1, 8), (64.0, DAY + "12:10:00", 0, 15),
]


def ledger(spark, store):
    return sorted((r["slot"], r["partition"], r["first_offset"], r["next_offset"]) for r in read_offsets(spark, store).collect())


def test_ledger_of_landed_offsets(spark):
    store = scratch_dir(spark, "t")
    backfill(placed(spark, *PLACED), store, START, START + 3 * HOUR)
    assert ledger(spark, store) == [
        ("10-00", 0, 10, 12), ("10-00", 1, 5, 6), ("11-00", 0, 12, 13), ("11-00", 0, 14, 15), ("11-00", 1, 6, 7),
        ("12-00", 0, 15, 16), ("12-00", 1, 8, 9),
    ]
    assert [f.name for f in read_landed(spark, store, positions=True).schema][6:8] == ["partition", "offset"]


@pytest.mark.parametrize("with_places", [True, False])
def test_as_many_other_rows_are_refused(spark, with_places):
    """Three rows landed, and three others come: nothing is replaced, and the lost ones are named."""
    landed = placed(spark, *PLACED[3:6])
    others = placed(spark, PLACED[3], (5.0, DAY + "11:20:00", 0, 13), PLACED[5])
    if not with_places:
        landed, others = (df.drop("partition", "offset") for df in (landed, others))
    store = scratch_dir(spark, "t")
    run_interval(landed, store, START + HOUR)
    before = content(read_landed(spark, store)), content(read_interval_stats(spark, store))
    told = "11-00 has landed offsets 6 to 6 of partition 1" if with_places else "11-00 has 3 landed rows, and the source lacks 1"
    with pytest.raises(ValueError, match=told):
        run_interval(others, store, START + HOUR)
    assert (content(read_landed(spark, store)), content(read_interval_stats(spark, store))) == before
    run_interval(others, store, START + HOUR, may_lose=True)
    closed = window_stats(others).filter("end <= '2024-01-01 12:00'")
    assert content(read_interval_stats(spark, store)) == content(closed)
    assert sorted(r["value"] for r in read_landed(spark, store).collect()) == [4.0, 5.0, 16.0]


def test_rows_that_come_twice_are_not_lost_once(spark, three_hours):
    """Without positions, equal rows count: two landed, one comes."""
    store = scratch_dir(spark, "t")
    twice = three_hours.unionAll(three_hours.filter("value = 1.0"))
    run_interval(twice, store, START)
    with pytest.raises(ValueError, match="lacks 1 of them"):
        run_interval(three_hours, store, START)
    run_interval(twice, store, START)
    assert read_landed(spark, store).count() == 3


@pytest.mark.parametrize("with_places", [True, False])
def test_the_source_is_read_once(spark, with_places):
    """On a first run, on one that has to be compared, and on one that lands late rows."""
    reads = spark.sparkContext.accumulator(0)

    def count(name):
        reads.add(1)
        return name

    seen = F.udf(count, "string").asNondeterministic()
    rows = placed(spark, *PLACED[:6])
    rows = rows if with_places else rows.drop("partition", "offset")
    rows = rows.withColumn("name", seen("name"))
    store = scratch_dir(spark, "t")
    for run in range(1, 3):
        backfill(rows, store, START, START + 2 * HOUR)
        assert reads.value == run * 6
    if with_places:
        land_late(rows, store, START, START + 2 * HOUR, "late")
        assert reads.value == 18


def test_a_run_that_ended_before_its_ledger_is_compared_all_the_same(spark, monkeypatch):
    from tidegauge.plans import interval

    store, rows = scratch_dir(spark, "t"), placed(spark, *PLACED)

    def ended(*_):
        raise RuntimeError("ended here")

    with monkeypatch.context() as broken:
        broken.setattr(interval, "_write_offsets", ended)
        with pytest.raises(RuntimeError):
            backfill(rows, store, START, START + 3 * HOUR)
    assert read_landed(spark, store).count() == 8
    with pytest.raises(ValueError, match="11-00 has landed offsets 12 to 12 of partition 0"):
        run_interval(rows.filter("offset <> 12"), store, START + HOUR)
    backfill(rows, store, START, START + 3 * HOUR)
    assert len(ledger(spark, store)) == 7
    # A repeated run that ends behind its ledger: what it promises is still asked for.
    with monkeypatch.context() as broken:
        broken.setattr(interval, "pane_partials", ended)
        more = rows.unionByName(placed(spark, (7.0, DAY + "11:10:00", 0, 13)))
        with pytest.raises(RuntimeError):
            run_interval(more, store, START + HOUR)
    with pytest.raises(ValueError, match="11-00 has landed offsets 13 to 13 of partition 0"):
        run_interval(rows, store, START + HOUR)
    backfill(more, store, START, START + 3 * HOUR)
    assert content(read_interval_stats(spark, store)) == content(window_stats(more))


def test_a_store_keeps_its_kind(spark, three_hours):
    store = scratch_dir(spark, "t")
    run_interval(three_hours, store, START)
    with pytest.raises(ValueError, match="rows without partition and offset"):
        run_interval(placed(spark, *PLACED), store, START)
    with pytest.raises(ValueError, match="need a store and events with partition and offset"):
        land_late(placed(spark, *PLACED), store, START, START + HOUR, "x")
    with pytest.raises(ValueError, match="do not consist of the store's panes"):
        aggregate(spark, store, START, START + HOUR, width="50 seconds", slide="20 seconds")
    with pytest.raises(ValueError, match="nothing is landed"):
        aggregate(spark, scratch_dir(spark, "t"), START, START + HOUR)


def test_late_rows_add_panes(spark):
    """Late rows of two intervals, one at an edge; landed rows aren't read, and a batch may come again."""
    store = scratch_dir(spark, "t")
    every = placed(spark, *PLACED, (100.0, DAY + "10:59:40", 1, 7), (200.0, DAY + "11:30:10", 0, 13), (300.0, DAY + "10:00:06", 1, 9))
    early = every.filter("value < 100")
    backfill(early, store, START, START + 3 * HOUR)

    def same(rows):
        assert content(read_interval_stats(spark, store)) == content(window_stats(rows.drop("partition", "offset")))
        assert content(read_landed(spark, store, positions=True)) == content(rows)

    two = every.filter("value < 300")
    # The whole topic may come: what the ledger has is skipped.
    for _ in range(2):
        assert land_late(two, store, START, START + 3 * HOUR, "x") == {"landed": 2, "known": 8}
        same(two)
    assert land_late(every, store, START, START + HOUR, "y") == {"landed": 1, "known": 4}
    same(every)
    assert land_late(every, store, START, START + 3 * HOUR, "z") == {"landed": 0, "known": 11}
    same(every)
    # A batch that now brings less takes back what it no longer has.
    land_late(every.filter("value <> 200"), store, START, START + 3 * HOUR, "x")
    same(every.filter("value <> 200"))
    land_late(every, store, START, START + 3 * HOUR, "x")
    # The interval run again holds all: its late batches are gone, and the windows the same.
    with pytest.raises(ValueError, match="10-00 has landed offsets 7 to 7 of partition 1"):
        run_interval(every.filter("offset <> 7"), store, START)
    run_interval(every, store, START)
    same(every)
    backfill(every, store, START, START + 3 * HOUR)
    same(every)
    assert sum(r[3] - r[2] for r in ledger(spark, store)) == 11


def test_late_windows_are_merged_without_raw_rows(spark, monkeypatch):
    from tidegauge.plans import interval

    store = scratch_dir(spark, "t")
    backfill(placed(spark, *PLACED), store, START, START + 3 * HOUR)
    read = []
    table = interval._table

    def told(spark, store, name, schema, known):
        read.append(name)
        return table(spark, store, name, schema, known)

    monkeypatch.setattr(interval, "_table", told)
    land_late(placed(spark, (100.0, DAY + "10:59:40", 1, 7)), store, START, START + HOUR, "x")
    assert read == ["panes"]


def test_events_received_keep_their_place(spark):
    topic = received(spark, (1.0, DAY + "10:10:00", DAY + "10:10:01")).selectExpr("*", "3 AS partition", "9L AS offset")
    (row,) = events_received(topic, START, START + HOUR).collect()
    assert (row["partition"], row["offset"], row["value"]) == (3, 9, 1.0)
