"""What Catalyst makes of the queries: the properties that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.decode import parse_events, split_bad, with_event_time
from tidegauge.operators.lookup import attach_name
from tidegauge.operators.windows import window_stats
from tidegauge.plans.feeds import events, messages, ticks
from tidegauge.plans.interval import backfill, covering_range, read_landed
from tidegauge.plans.feeds import landed_events
from tidegauge.plans.queries import QUERIES
from tidegauge.session import scratch_dir
from tidegauge.sources.catalogue import catalogue
from tidegauge.sources.responses import explode_response
from tidegauge.streaming.sinks import read_raw, read_stats, write_raw, write_stats

LAZY = [k for k in QUERIES if not k.startswith("stream_")
        and k not in ("parquet_partitioned", "raw_by_date", "results_latest", "interval_ingest_agg", "backfill", "interval_late")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def topic(spark, sf_dir):
    """Messages as a file, so that the plan holds no encoding."""
    path = f"{scratch_dir(spark, 'topic')}/in"
    messages(events(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("key", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, key):
    text = plan(QUERIES[key](spark, sf_dir))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window ["):
        # Ranges of one series are put in order; there are as many as it has gaps and pages.
        assert node not in text or (node, key) == ("Window [", "missing_pages")


def test_rows_shrink_to_panes_before_they_are_copied(spark, sf_dir):
    text = plan(window_stats(ticks(events(spark, sf_dir)), "1 hour", "5 minutes"))
    steps = re.findall(r"(HashAggregate|Exchange|Expand|FileScan)\b", text)
    # Read upwards from the scan: partial, shuffle, panes, copies, partial, shuffle, windows.
    assert steps[::-1] == ["FileScan", "HashAggregate", "Exchange", "HashAggregate", "Expand",
                           "HashAggregate", "Exchange", "HashAggregate"]
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>", text)
    assert "PushedFilters: [IsNotNull(ts)]" in text


def test_each_message_is_parsed_once(topic):
    parsed = with_event_time(parse_events(topic))
    assert plan(window_stats(parsed)).count("from_json(") == 1
    good, bad = split_bad(topic)
    assert plan(good).count("from_json(") == plan(bad).count("from_json(") == 1


def test_only_the_body_is_read(topic):
    text = plan(window_stats(with_event_time(parse_events(topic))))
    assert "ReadSchema: struct<value:binary>" in text


def test_each_response_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "body string")
    rows = explode_response(df, "body", "TIME string, DATA_VALUE double").filter("DATA_VALUE > 1")
    assert plan(rows).count("from_json(") == 1


def test_small_catalogue_is_broadcast_by_its_size(spark, sf_dir):
    ev = events(spark, sf_dir).select(F.col("event_type").alias("indicator"), "value")
    assert "BroadcastHashJoin" in plan(attach_name(ev, catalogue(spark)))
    # A catalogue of unknown, possibly large size is not.
    large = events(spark, sf_dir).groupBy(F.col("event_type").alias("indicator")).agg(
        F.max("props").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        assert "SortMergeJoin" in plan(attach_name(ev, large))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("entries, join", [(4, "BroadcastHashJoin"), (1000, "SortMergeJoin")])
def test_catalogue_over_the_threshold_is_shuffled(spark, sf_dir, entries, join):
    ev = events(spark, sf_dir).select(F.col("event_type").alias("indicator"), "value")
    names = catalogue(spark, [(f"code{i}", f"name of {i}", float(i)) for i in range(entries)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10000")
    try:
        assert join in plan(attach_name(ev, names))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert attach_name(ev, names).count() == ev.count()


def test_folders_are_pruned(spark, sf_dir):
    folder = scratch_dir(spark, "t")
    rows = landed_events(events(spark, sf_dir))
    write_stats(window_stats(rows, "1 day", "12 hours"), f"{folder}/stats")
    one = read_stats(spark, f"{folder}/stats").filter("indicator = 'view'")
    assert re.search(r"PartitionFilters: \[[^\]]*indicator#\d+ = view", plan(one))
    write_raw(rows, f"{folder}/raw")
    day = read_raw(spark, f"{folder}/raw").filter("dt = '2024-01-05'")
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ = 2024-01-05", plan(day))
    assert day.count() == rows.filter("to_date(event_time) = '2024-01-05'").count()
    start, end = covering_range(rows, "1 day")
    backfill(rows, f"{folder}/store", start, end, "1 day")
    assert "PartitionFilters: [isnotnull(dt" in plan(
        read_landed(spark, f"{folder}/store").filter("dt = '2024-01-05'"))


def test_writes_are_rebalanced(spark, sf_dir):
    rows = landed_events(events(spark, sf_dir)).withColumn("dt", F.to_date("event_time"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(rows.hint("rebalance", "dt"))
