"""The registered queries: (spark, sf_dir) -> DataFrame, each over the whole `events` table.

Timestamps leave without a zone, to compare with engines that have none.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.decode import (
    drop_no_event_time,
    parse_events,
    parse_strict,
    tag_bad,
    with_event_time,
)
from tidegauge.operators.encode import encode_event, to_event
from tidegauge.operators.lookup import attach_name
from tidegauge.operators.positions import (
    commit_progress,
    delivery_report,
    lag_report,
    log_bounds,
)
from tidegauge.operators.windows import window_stats
from tidegauge.plans.feeds import (
    SERIES_ROW,
    Stages,
    before,
    display_name,
    events,
    events_stream,
    landed_events,
    messages,
    middle,
    paged_responses,
    placed_events,
    responses,
    series,
    ticks,
)
from tidegauge.plans.interval import (
    backfill as run_backfill,
    covering_range,
    land_late,
    read_interval_stats,
    read_landed,
    read_offsets,
    run_interval,
)
from tidegauge.schema import CORRUPT, READING_SCHEMA, STATS_SCHEMA
from tidegauge.session import scratch_dir
from tidegauge.sources.catalogue import catalogue
from tidegauge.sources.providers import union_sources
from tidegauge.sources.responses import (
    explode_response,
    missing_entries,
    response_page as page_of,
    response_pages as pages_of,
    select_series,
)
from tidegauge.streaming.generations import compact, latest_changes
from tidegauge.streaming.run import (
    consume,
    consumed_lines,
    finish,
    message_stats,
    quarantine,
    read_bad,
    read_good,
    run_stream,
)
from tidegauge.streaming.sinks import (
    latest_results,
    process_then_commit,
    read_batches,
    read_raw,
    read_stats,
    replace_batch,
    write_raw,
    write_stats,
    write_stream,
)
from tidegauge.streaming.state import read_open_windows

Query = Callable[[SparkSession, str], DataFrame]
DAY = "1 day"
STATS_NO_ZONE = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType() if f.name in ("start", "end") else f.dataType)
        for f in STATS_SCHEMA
    ]
)


def without_zone(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def state_partitions(spark: SparkSession) -> int:
    """One state partition per core: fixed for the life of a checkpoint, so not left to a default
    made for batch jobs, which adaptive execution would correct."""
    return spark.sparkContext.defaultParallelism


# --- windows over a table ---------------------------------------------------------------------


def sliding_agg_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_stats(ticks(events(spark, sf_dir)))


def sliding_agg_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_stats(ticks(events(spark, sf_dir)), "1 hour", "30 minutes")


def null_value_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings under 5 are unknown: skipped by mean and maximum, still counted."""
    known = F.when(F.col("value") >= 5, F.col("value"))
    rows = ticks(events(spark, sf_dir)).withColumn("value", known)
    return window_stats(rows, "1 hour", "30 minutes")


# --- messages ---------------------------------------------------------------------------------


def parse_events_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = messages(events(spark, sf_dir))
    return without_zone(with_event_time(parse_events(topic, keep=("partition", "offset"))))


def message_agg_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from message bytes to window results."""
    return without_zone(message_stats(messages(events(spark, sf_dir))))


def envelope_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded, then decoded again: a seventh of each reading, rounded on the way."""
    ev = events(spark, sf_dir)
    made = to_event(
        ev, F.col("event_type"), display_name(), F.col("value") / 7, F.col("ts").cast("timestamp"),
        source="replay", keep=("event_id",),
    )
    return parse_events(encode_event(made, keep=("event_id",)), keep=("event_id", "key"))


def null_time_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three kinds of rows without event time: `ts` as text, no `ts`, no JSON at all."""
    text, reading = F.col("value"), F.col("reading")
    damage = (
        F.when(reading < 1, F.lit("not json"))
        .when(reading < 10, F.regexp_replace(text, '"ts":([0-9]+)', '"ts":"$1"'))
        .when(reading >= 200, F.regexp_replace(text, '"ts":[0-9]+,', ""))
        .otherwise(text)
    )
    topic = messages(events(spark, sf_dir), damage)
    timed = drop_no_event_time(with_event_time(parse_events(topic, READING_SCHEMA)))
    return without_zone(window_stats(timed, "1 hour", "30 minutes"))


def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad messages told from the good ones in one pass, their text kept: cut short, with a reading
    that is no number, without text, blank, without fields, two in one, with text behind."""
    text, reading = F.col("value"), F.col("reading")
    damage = (
        F.when(reading >= 100, F.expr("left(value, length(value) - 10)"))
        .when(reading < 2, F.regexp_replace(text, '"value":[0-9.]+', '"value":"none"'))
        .when(reading < 4, F.lit(None).cast("string"))
        .when(reading < 6, F.lit(" "))
        .when(reading < 8, F.lit("{}"))
        .when(reading < 10, F.concat(text, text))
        .when(reading < 12, F.concat(text, F.lit("xyz")))
        .otherwise(text)
    )
    topic = messages(events(spark, sf_dir), damage)
    tagged = tag_bad(topic, keep=("offset",), required=("name", "value"))
    fine = F.col(CORRUPT).isNull()
    return tagged.select(
        F.when(fine, "good").otherwise("bad").alias("verdict"),
        "offset",
        F.when(fine, F.col("indicator")).alias("indicator"),
        F.when(fine, F.col("value")).alias("value"),
        F.col(CORRUPT).alias("raw"),
    )


def strict_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is whole, so the strict reading ends well and gives them all."""
    topic = messages(events(spark, sf_dir))
    return parse_strict(topic, keep=("offset",)).select("offset", "name", "value", "ts")


# --- API responses, series, providers, names --------------------------------------------------


def response_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = responses(events(spark, sf_dir))
    return explode_response(bodies, "body", SERIES_ROW, keep=("stat_code",))


def response_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries 1 to 100 of every body."""
    bodies = responses(events(spark, sf_dir))
    return page_of(bodies, "body", SERIES_ROW, 1, 100, keep=("stat_code",))


def response_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry of every body, with the number of its page of 100."""
    return pages_of(responses(events(spark, sf_dir)), "body", SERIES_ROW, keep=("stat_code",))


def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that no landed page holds, of series with pages left out, failed, overlapping and repeated."""
    pages = paged_responses(events(spark, sf_dir))
    return missing_entries(pages, "body", SERIES_ROW, ("stat_code", "block"), total="total")


def series_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items of one table by day, and one item of another by month."""
    rows = series(events(spark, sf_dir))
    every_item = select_series(rows, "view", "D", "20240105", "20240120")
    one_item = select_series(rows, "error", "M", "202401", "202401", item="8")
    return every_item.unionByName(one_item)


def provider_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", F.col("event_type").alias("indicator"), "value")
    value = F.col("value")
    return union_sources(
        {
            "ecos": ev.filter(value < 10),
            "kosis": ev.filter((value >= 10) & (value < 50)),
            "fiscal": ev.filter(value >= 50),
        }
    )


def catalogue_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from a catalogue that lacks one indicator."""
    entries = [
        ("click", "클릭", 1.0),
        ("view", "조회", 2.0),
        ("purchase", "구매", 3.0),
        ("signup", "가입", 4.0),
    ]
    ev = events(spark, sf_dir).select("event_id", F.col("event_type").alias("indicator"), "value")
    return attach_name(ev, catalogue(spark, entries))


# --- log positions ----------------------------------------------------------------------------


def consumer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumed_lines(messages(events(spark, sf_dir)))


def commit_progress_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commit_progress(messages(events(spark, sf_dir)))


def lag_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group that handled readings up to the 20th, and never touched partition 2."""
    ev = events(spark, sf_dir)
    handled = ev.filter(before(datetime(2024, 1, 21)))
    committed = commit_progress(messages(handled).filter(F.col("partition") != 2))
    return lag_report(log_bounds(messages(ev)), committed)


def delivery_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages(events(spark, sf_dir))
    return delivery_report(
        sent.withColumn("error", F.when(F.col("reading") > 100, F.lit("message timed out")))
    )


# --- streams ----------------------------------------------------------------------------------


def _drain(spark: SparkSession, stream: DataFrame, folder: str) -> None:
    finish(
        write_stream(
            window_stats(ticks(stream)), "parquet", f"{folder}/out", f"{folder}/checkpoint",
            drain=True, shuffle_partitions=state_partitions(spark),
        )
    )


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream, each window stored once when the watermark has passed it."""
    folder = scratch_dir(spark, "append")
    _drain(spark, events_stream(spark, sf_dir), folder)
    return without_zone(read_stats(spark, f"{folder}/out"))


def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of a drained stream: those it has stored, and those still open, from its state."""
    folder = scratch_dir(spark, "open")
    _drain(spark, events_stream(spark, sf_dir), folder)
    stored = read_stats(spark, f"{folder}/out").withColumn("open", F.lit(0))
    held = read_open_windows(spark, f"{folder}/checkpoint").withColumn("open", F.lit(1))
    return without_zone(stored.unionByName(held))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad messages of a stream in two runs, both kept from one parse."""
    folder = scratch_dir(spark, "quarantine")
    text, reading = F.col("value"), F.col("reading")
    damage = (
        F.when(reading >= 100, F.expr("left(value, length(value) - 10)"))
        .when(reading < 8, F.lit("{}"))
        .otherwise(text)
    )

    def run(stream: DataFrame) -> None:
        finish(quarantine(messages(stream, damage), f"{folder}/out", f"{folder}/checkpoint", drain=True))

    _in_two_runs(spark, sf_dir, folder, run)
    good = read_good(spark, f"{folder}/out").select("offset", "indicator", "value", F.lit(None).cast("string").alias("raw"))
    bad = read_bad(spark, f"{folder}/out").select(
        "offset", F.lit(None).cast("string").alias("indicator"), F.lit(None).cast("double").alias("value"), "raw"
    )
    return good.unionByName(bad)


def stream_message_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from message bytes to stored window results, as a stream."""
    folder = scratch_dir(spark, "messages")
    topic = messages(events_stream(spark, sf_dir))
    finish(
        run_stream(
            topic, "parquet", path=f"{folder}/out", checkpoint=f"{folder}/checkpoint", drain=True,
            shuffle_partitions=state_partitions(spark),
        )
    )
    return without_zone(read_stats(spark, f"{folder}/out"))


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed comes a second time with other readings: too late for every stored window."""
    folder = scratch_dir(spark, "late")
    stages = Stages(spark, folder, sf_dir)
    _drain(spark, stages.stream(), folder)
    stages.add(events(spark, sf_dir).withColumn("value", F.col("value") + 1000))
    _drain(spark, stages.stream(), folder)
    return without_zone(read_stats(spark, f"{folder}/out"))


def _in_two_runs(spark: SparkSession, sf_dir: str, folder: str, run: Callable[[DataFrame], None]) -> None:
    """`run` drains the first half of the feed, then, on the same checkpoint, the second."""
    ev = events(spark, sf_dir)
    first = before(middle(ev))
    stages = Stages(spark, folder, sf_dir, first)
    run(stages.stream())
    stages.add(ev.filter(~first))
    run(stages.stream())


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped halfway, started again on the same checkpoint: the state of open windows and the
    position are found again."""
    folder = scratch_dir(spark, "restart")
    _in_two_runs(spark, sf_dir, folder, lambda stream: _drain(spark, stream, folder))
    return without_zone(read_stats(spark, f"{folder}/out"))


def stream_update_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of every window, by batch; the latest one counts."""
    folder = scratch_dir(spark, "update")

    def run(stream: DataFrame) -> None:
        finish(
            process_then_commit(
                window_stats(ticks(stream)), replace_batch(f"{folder}/out"),
                f"{folder}/checkpoint", "update", drain=True,
                shuffle_partitions=state_partitions(spark),
            )
        )

    _in_two_runs(spark, sf_dir, folder, run)
    return without_zone(latest_results(read_batches(spark, f"{folder}/out", STATS_SCHEMA)))


def results_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `stream_update_latest`, from a store whose changes are merged between the runs and after them."""
    folder = scratch_dir(spark, "merged")
    path = f"{folder}/out"

    def run(stream: DataFrame) -> None:
        results = window_stats(ticks(stream))
        finish(
            process_then_commit(
                results, replace_batch(path), f"{folder}/checkpoint", "update", drain=True,
                shuffle_partitions=state_partitions(spark),
            )
        )
        compact(spark, path, STATS_SCHEMA, merge=latest_changes)

    _in_two_runs(spark, sf_dir, folder, run)
    return without_zone(latest_results(read_batches(spark, path, STATS_SCHEMA)))


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows stored once each, by indicator, whose files are gathered in place between the runs and after them."""
    folder = scratch_dir(spark, "gathered")
    path, by = f"{folder}/out", ("indicator",)

    def run(stream: DataFrame) -> None:
        results = window_stats(ticks(stream))
        finish(
            process_then_commit(
                results, replace_batch(path, by), f"{folder}/checkpoint", drain=True,
                shuffle_partitions=state_partitions(spark),
            )
        )
        compact(spark, path, STATS_SCHEMA, partition_by=by)

    _in_two_runs(spark, sf_dir, folder, run)
    return without_zone(read_batches(spark, path, STATS_SCHEMA).drop("run", "batch_id"))


def stream_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumed lines, handled batch by batch before the position is stored."""
    folder = scratch_dir(spark, "lines")

    def run(stream: DataFrame) -> None:
        write = replace_batch(f"{folder}/out")
        finish(consume(messages(stream), write, f"{folder}/checkpoint", drain=True))

    _in_two_runs(spark, sf_dir, folder, run)
    schema = T.StructType([T.StructField("line", T.StringType())])
    return read_batches(spark, f"{folder}/out", schema).select("line")


def stream_raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages landed by date as they come; rows per date and indicator."""
    folder = scratch_dir(spark, "landing")
    rows = with_event_time(parse_events(messages(events_stream(spark, sf_dir))))
    finish(write_raw(rows, f"{folder}/out", f"{folder}/checkpoint", drain=True))
    return _per_date(read_raw(spark, f"{folder}/out"))


# --- tables written and read back -------------------------------------------------------------


def _per_date(raw: DataFrame) -> DataFrame:
    return raw.groupBy("dt", "indicator").agg(
        F.count("*").alias("n"), F.max("value").alias("max_value"), F.min("ts").alias("first_ts")
    )


def parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'stats')}/out"
    write_stats(window_stats(landed_events(events(spark, sf_dir)), "1 hour", "30 minutes"), path)
    return without_zone(read_stats(spark, path))


def raw_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'raw')}/out"
    write_raw(landed_events(events(spark, sf_dir)), path)
    return _per_date(read_raw(spark, path))


def results_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's results at half time, twice; then, from a new checkpoint whose batch ids begin at 0
    again, those of windows that end later, complete: the newer run wins, and what it lacks stays."""
    ev = events(spark, sf_dir)
    cut = middle(ev)
    path = f"{scratch_dir(spark, 'results')}/out"
    write = replace_batch(path)
    rows = ticks(ev)
    width, slide = "1 hour", "30 minutes"
    half = window_stats(rows.filter(F.col("event_time") < cut), width, slide)
    for batch_id in (0, 1):
        write(half, batch_id, run=1)
    reach = F.col("event_time") >= cut - timedelta(hours=1)
    write(window_stats(rows.filter(reach), width, slide).filter(F.col("end") > cut), 0, run=2)
    return latest_results(read_batches(spark, path, STATS_NO_ZONE))


def interval_ingest_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive runs, each landing its events and closing its windows; the last one twice."""
    rows = landed_events(events(spark, sf_dir))
    store = scratch_dir(spark, "interval")
    start, end = covering_range(rows, DAY)
    third = start + (end - start) // 3
    third = third.replace(hour=0, minute=0, second=0, microsecond=0)
    last = end - timedelta(days=1)
    for first, until in pairwise(sorted({start, third, last})):
        run_backfill(rows, store, first, until, DAY)
    run_interval(rows, store, last, DAY)
    run_interval(rows, store, last, DAY)
    return without_zone(read_interval_stats(spark, store).drop("dt", "slot"))


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole range, then its first third again: rows and windows per day as after one run."""
    rows = landed_events(events(spark, sf_dir))
    store = scratch_dir(spark, "backfill")
    start, end = covering_range(rows, DAY)
    run_backfill(rows, store, start, end, DAY)
    run_backfill(rows, store, start, start + timedelta(days=max(2, (end - start).days // 3)), DAY)
    one, none = F.lit(1), F.lit(0)
    landed = read_landed(spark, store)
    landed = landed.select("dt", one.alias("event"), none.alias("window"))
    stored = read_interval_stats(spark, store)
    stored = stored.select("dt", none.alias("event"), one.alias("window"))
    return landed.unionByName(stored).groupBy("dt").agg(
        F.sum("event").alias("events"), F.sum("window").alias("windows")
    )


def interval_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days landed without their late rows, among them those of the last 30 s of a day; then run
    again with them, the second half first: its first windows get late rows of the day before."""
    rows = landed_events(events(spark, sf_dir))
    at = F.col("event_time")
    last_seconds = F.date_trunc("day", at) != F.date_trunc("day", at + F.expr("INTERVAL 30 SECONDS"))
    store = scratch_dir(spark, "late-rows")
    start, end = covering_range(rows, DAY)
    half = start + timedelta(days=max(1, (end - start).days // 2))
    run_backfill(rows.filter(~last_seconds & (F.col("value") < 100)), store, start, end, DAY)
    for first, until in ((half, end), (start, half)):
        if first < until:
            run_backfill(rows, store, first, until, DAY)
    return without_zone(read_interval_stats(spark, store).drop("dt", "slot"))


def _halves(rows: DataFrame) -> tuple[datetime, datetime, datetime]:
    """The days around all events, and one in the middle."""
    start, end = covering_range(rows, DAY)
    return start, start + timedelta(days=max(1, (end - start).days // 2)), end


def interval_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after days were landed with readings below 100, and their first half again with all:
    gaps close where the run was repeated."""
    rows = placed_events(events(spark, sf_dir))
    store = scratch_dir(spark, "offsets")
    start, half, end = _halves(rows)
    run_backfill(rows.filter(F.col("value") < 100), store, start, end, DAY)
    run_backfill(rows, store, start, half, DAY)
    return read_offsets(spark, store).drop("slot")


def interval_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days landed without readings of 100 and more; these come late, in two batches, of which one comes
    twice and brings the whole topic: windows are merged from stored panes, landed rows are not read."""
    rows = placed_events(events(spark, sf_dir))
    store = scratch_dir(spark, "panes")
    start, half, end = _halves(rows)
    late = F.col("value") >= 100
    run_backfill(rows.filter(~late), store, start, end, DAY)
    if half < end:
        land_late(rows.filter(late), store, half, end, "second", DAY)
    for come in (rows.filter(late), rows):
        land_late(come, store, start, half, "first", DAY)
    return without_zone(read_interval_stats(spark, store).drop("dt", "slot"))


QUERIES: dict[str, Query] = {
    "sliding_agg_1m": sliding_agg_1m,
    "sliding_agg_1h": sliding_agg_1h,
    "null_value_count": null_value_count,
    "parse_events": parse_events_query,
    "message_agg_1m": message_agg_1m,
    "envelope_build": envelope_build,
    "null_time_drop": null_time_drop,
    "json_quarantine": json_quarantine,
    "strict_events": strict_events,
    "response_explode": response_explode,
    "response_page": response_page,
    "response_pages": response_pages,
    "missing_pages": missing_pages,
    "series_select": series_select,
    "provider_union": provider_union,
    "catalogue_join": catalogue_join,
    "consumer_lines": consumer_lines,
    "commit_progress": commit_progress_query,
    "lag_report": lag_report_query,
    "delivery_report": delivery_report_query,
    "stream_append": stream_append,
    "stream_open_windows": stream_open_windows,
    "stream_quarantine": stream_quarantine,
    "stream_message_agg": stream_message_agg,
    "stream_late_drop": stream_late_drop,
    "stream_restart": stream_restart,
    "stream_update_latest": stream_update_latest,
    "results_compacted": results_compacted,
    "stream_compacted": stream_compacted,
    "stream_foreach_batch": stream_foreach_batch,
    "stream_raw_landing": stream_raw_landing,
    "parquet_partitioned": parquet_partitioned,
    "raw_by_date": raw_by_date,
    "results_latest": results_latest,
    "interval_ingest_agg": interval_ingest_agg,
    "backfill": backfill,
    "interval_late": interval_late,
    "interval_offsets": interval_offsets,
    "interval_panes": interval_panes,
}
