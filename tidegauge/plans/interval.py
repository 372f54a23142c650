"""Scheduled runs: land the events of an interval, then aggregate the windows it closes.

A store is one folder of tables. `raw`, `panes` and `stats` are partitioned by (dt, slot): the UTC date
and the start time of the interval a row belongs to. A raw row belongs to the interval of its event
time, a window to the interval its last moment falls into. So each window belongs to exactly one
interval, and all its rows are landed when that interval is: it needs rows back to one width before the
interval, and none after it. The store keeps the length of its intervals and refuses another: folders of
two lengths would hold rows twice.

- `raw`: landed rows, with their topic partition and offset where the source tells them.
- `panes`: mergeable partial results of the raw rows, per interval, pane and indicator. Windows are
  merged from them; raw rows are not read again. Averages are never averaged.
- `stats`: the windows.
- `ledger`: a log of the ranges of offsets that runs landed, per interval and topic partition. The newest
  run of an interval counts.
- `late`: rows that came after their interval was run, by the batch that brought them. They are few, and
  their panes are made when windows are merged. They count until their interval is run again.

Late rows count in two ways. `land_late` adds those of a batch that are new, and stores anew the windows
they belong to. Or their intervals are run again, which replaces them, late batches included. Windows
that reach from such an interval into the next ones are stored there, so a run stores anew the next
intervals that windows of its rows end in, where these have been run before.

A run replaces its intervals, each folder as a whole when the job ends. One that a run has no rows for
gets a single row of NULLs, which readers skip: it says that the interval was run, and takes the place
of what was there. A run that would lose a landed row is refused unless told that it may: the source may
have let go of it. With positions, landed ranges of offsets are held against those that come; without,
rows themselves. Where rows are landed already, those that come are put aside first, in `incoming`, so
the source is read once in any case, and nothing is replaced before the comparison. A run that fails has
to be repeated; until then the ledger may promise rows that are not there, but it forgets none.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.decode import parse_events, with_event_time
from tidegauge.operators.ranges import difference, merged as ranges_merged, outside, ranges_of
from tidegauge.operators.windows import pane_of, pane_partials, span, windows_of_panes
from tidegauge.schema import PANE_SCHEMA, POSITION_SCHEMA, RAW_SCHEMA, STATS_SCHEMA, with_fields
from tidegauge.session import exists, require_utc
from tidegauge.settings import LATENESS, WINDOW_SLIDE, WINDOW_WIDTH
from tidegauge.sources.topic import read_topic_batch
from tidegauge.sources.values import value_table

EPOCH = datetime(1970, 1, 1)
EVERY = "1 hour"
SLOT = ["dt", "slot"]
SLOT_TYPES = {"dt": T.DateType(), "slot": T.StringType()}
SLOT_NAMES = {name: kind.simpleString() for name, kind in SLOT_TYPES.items()}
SLOT_SCHEMA = T.StructType([T.StructField(n, t) for n, t in SLOT_TYPES.items()])
POSITION = POSITION_SCHEMA.fieldNames()
PLACED_SCHEMA = T.StructType(RAW_SCHEMA.fields + POSITION_SCHEMA.fields)
RANGE = ("first_offset", "next_offset")
RUN = {"run": T.LongType()}
LEDGER_SCHEMA = with_fields(
    T.StructType([T.StructField("partition", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in RANGE]]),
    **SLOT_TYPES, **RUN,
)
LEDGER_KEYS = (*SLOT, "partition")
LATE_SCHEMA = with_fields(PLACED_SCHEMA, **SLOT_TYPES, **RUN, batch=T.StringType())


def _slot_of(at: Column, every: str) -> list[Column]:
    begin = F.window(at, every)["start"]
    return [F.to_date(begin).alias("dt"), F.date_format(begin, "HH-mm").alias("slot")]


def _slot_name(at: datetime) -> str:
    return f"{at:%H-%M}"


def _slots(first: datetime, end: datetime, every: str) -> Column:
    """The intervals that hold moments of [first, end): folders outside are not even listed."""
    first -= (first - EPOCH) % span(every)
    dt, slot = (F.col(c) for c in SLOT)
    from_first = (dt > first.date()) | ((dt == first.date()) & (slot >= _slot_name(first)))
    to_end = (dt < end.date()) | ((dt == end.date()) & (slot < _slot_name(end)))
    return from_first & to_end


def _moment(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def _within(column: str, first: datetime, end: datetime) -> Column:
    return (F.col(column) >= _moment(first)) & (F.col(column) < _moment(end))


def _check(spark: SparkSession, start: datetime, end: datetime, every: str) -> None:
    require_utc(spark)
    if timedelta(days=1) % span(every) or span(every) % timedelta(minutes=1):
        raise ValueError("an interval has to be whole minutes, and to divide a day")
    for at in (start, end):
        if (at - EPOCH) % span(every):
            raise ValueError(f"{at} is no edge of an interval of {every}")
    if end <= start:
        raise ValueError("the range is empty")


class Claim(NamedTuple):
    """What a store keeps from its first run on: length of intervals and panes in microseconds, and
    whether rows have positions."""

    micros: int
    pane: int
    placed: bool


def _micros(interval: str) -> int:
    return span(interval) // timedelta(microseconds=1)


def _claimed(spark: SparkSession, store: str) -> Claim | None:
    path = f"{store}/every"
    if not exists(spark, path):
        return None
    row = spark.read.schema("micros bigint, pane bigint, placed boolean").parquet(path).first()
    if row["pane"] is None:
        raise ValueError("the store has no panes: an earlier version made it; backfill a new one")
    return Claim(*row)


def _claim(spark: SparkSession, store: str, every: str, pane: str, placed: bool) -> Claim:
    """Notes at the first run what the store keeps, and refuses other intervals and rows later. Panes
    stay as short as they were."""
    wanted = Claim(_micros(every), _micros(pane), placed)
    kept = _claimed(spark, store)
    if kept is None:
        spark.createDataFrame([wanted], "micros bigint, pane bigint, placed boolean").coalesce(1).write.parquet(f"{store}/every")
        return wanted
    if kept.micros != wanted.micros:
        raise ValueError(f"the store has intervals of {timedelta(microseconds=kept.micros)}, not of {every}")
    if kept.placed != placed:
        raise ValueError(f"the store has rows {'with' if kept.placed else 'without'} partition and offset")
    return kept


def _run_slots(spark: SparkSession, start: datetime, end: datetime, every: str) -> DataFrame:
    """(dt, slot) of every interval of [start, end)."""
    step = span(every)
    micro = timedelta(microseconds=1)
    at = F.timestamp_micros(F.lit((start - EPOCH) // micro) + F.col("id") * (step // micro))
    return spark.range((end - start) // step).select(*_slot_of(at, every))


def _write(rows: DataFrame, slots: DataFrame, path: str, keys: tuple[str, ...] = tuple(SLOT)) -> None:
    """Replaces what the table holds for `slots`, all of them in one job.

    Folders are swapped when the job ends, so a failed one changes nothing. `rebalance` makes few
    files per folder and splits a hot interval.
    """
    (
        rows.unionByName(slots, allowMissingColumns=True)
        .hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def _table(spark: SparkSession, store: str, name: str, schema: T.StructType, known: str) -> DataFrame:
    """A table of the store without its marks, which lack the `known` column."""
    schema = with_fields(schema, **SLOT_TYPES)
    return spark.read.schema(schema).parquet(f"{store}/{name}").filter(F.col(known).isNotNull())


def _log(spark: SparkSession, store: str) -> DataFrame:
    """All that runs have written to the ledger, marks included."""
    path = f"{store}/ledger"
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def _newest(log: DataFrame) -> DataFrame:
    """(dt, slot, run) of the newest run of each interval."""
    return log.groupBy(*SLOT).agg(F.max("run").alias("run"))


def _late(spark: SparkSession, store: str) -> DataFrame | None:
    """Late rows that count, with their `batch`; None if there never were any. `run` is the newest run
    there was when they came: a later one of their interval has brought them itself."""
    path = f"{store}/late"
    if not exists(spark, path):
        return None
    rows = spark.read.schema(LATE_SCHEMA).parquet(path).filter(F.col("event_time").isNotNull())
    newest = _newest(_log(spark, store)).withColumnRenamed("run", "newest")
    return rows.join(newest, SLOT, "left").filter("newest IS NULL OR newest <= run").drop("newest")


def read_landed(spark: SparkSession, store: str, positions: bool = False) -> DataFrame:
    """Landed rows, late ones included, with their (dt, slot) and, if asked for, partition and offset."""
    rows, late = _table(spark, store, "raw", PLACED_SCHEMA, "event_time"), _late(spark, store)
    if late is not None:
        rows = rows.unionByName(late.drop("run", "batch"))
    return rows if positions else rows.drop(*POSITION)


def read_offsets(spark: SparkSession, store: str) -> DataFrame:
    """The ledger: ranges of landed offsets per interval and topic partition; `next_offset` is the first
    one not in the range. Those of late rows stand by themselves."""
    log, late = _log(spark, store), _late(spark, store)
    now = log.join(_newest(log), [*SLOT, "run"], "left_semi").filter("partition IS NOT NULL").drop("run")
    return now if late is None else now.unionByName(_offsets(late))


def read_interval_stats(spark: SparkSession, store: str) -> DataFrame:
    """Window results with their (dt, slot)."""
    return _table(spark, store, "stats", STATS_SCHEMA, "start")


def _offsets(rows: DataFrame) -> DataFrame:
    return ranges_of(rows, LEDGER_KEYS, "offset", *RANGE)


def _folders(spark: SparkSession, store: str, name: str) -> DataFrame:
    """(dt, slot) of a table's folders, marks included: no column is read."""
    return spark.read.schema(SLOT_SCHEMA).parquet(f"{store}/{name}")


def _refuse_lost_offsets(come: DataFrame, store: str, inside: Column) -> None:
    """Holds landed ranges of offsets against those that come. An interval landed by a run that ended
    before it had written its ledger is read from its rows."""
    spark = come.sparkSession
    held = read_offsets(spark, store).filter(inside)
    told = _log(spark, store).filter(inside).select(*SLOT).distinct()
    slots = [tuple(r) for r in _folders(spark, store, "raw").filter(inside).distinct().exceptAll(told).collect()]
    if slots:
        landed = read_landed(spark, store, positions=True).filter(inside)
        held = held.unionByName(_offsets(landed.join(value_table(spark, SLOT_NAMES, slots), SLOT, "left_semi")))
    lost = difference(held, _offsets(come), LEDGER_KEYS, *RANGE).orderBy(*LEDGER_KEYS, RANGE[0]).first()
    if lost:
        raise ValueError(
            f"interval {lost['dt']} {lost['slot']} has landed offsets {lost[RANGE[0]]} to {lost[RANGE[1]] - 1} of "
            f"partition {lost['partition']}, which the source does not give; a run that may lose rows has to say so"
        )


def _refuse_lost_rows(come: DataFrame, store: str, inside: Column) -> None:
    """Without positions a row is known by what it holds: none may come less often than it is landed."""
    landed = read_landed(come.sparkSession, store).filter(inside)
    row = F.xxhash64(*RAW_SCHEMA.fieldNames()).alias("row")
    both = landed.select(*SLOT, row, F.lit(1).alias("held"), F.lit(0).alias("come")).unionByName(
        come.select(*SLOT, row, F.lit(0).alias("held"), F.lit(1).alias("come"))
    )
    counted = both.groupBy(*SLOT, "row").agg(F.sum("held").alias("held"), F.sum("come").alias("come"))
    slots = counted.groupBy(*SLOT).agg(
        F.sum("held").alias("held"), F.sum(F.greatest(F.col("held") - F.col("come"), F.lit(0))).alias("lost")
    )
    first = slots.filter("lost > 0").orderBy(*SLOT).first()
    if first:
        raise ValueError(
            f"interval {first['dt']} {first['slot']} has {first['held']} landed rows, and the source lacks "
            f"{first['lost']} of them; a run that may lose rows has to say so"
        )


def _put_aside(rows: DataFrame, store: str, start: datetime, end: datetime) -> DataFrame:
    path = f"{store}/incoming/{start:%Y-%m-%dT%H-%M}--{end:%Y-%m-%dT%H-%M}"
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _cleared(aside: DataFrame, store: str, start: datetime, end: datetime) -> None:
    _put_aside(aside.limit(0), store, start, end)


def _placed(events: DataFrame) -> bool:
    return set(POSITION) <= set(events.columns)


def ingest(
    events: DataFrame, store: str, start: datetime, end: datetime, every: str = EVERY,
    wait: str = LATENESS, may_lose: bool = False, pane: str | None = None,
) -> dict[str, int]:
    """Lands the events of [start, end), with panes and, where they have `partition` and `offset`, the
    ledger of offsets.

    Returns counts of what was read: `landed`; `earlier` and `later`, outside the range; `no_time`;
    and, where `events` tell when they were `received`, `missed`: those of earlier intervals that came
    when the run before had stopped reading, `wait` after its end. These count once their intervals
    are run again with a longer wait, or once `land_late` brings them. `pane` sets the length of the
    panes at the first run of a store.
    """
    spark = events.sparkSession
    _check(spark, start, end, every)
    placed = _placed(events)
    claim = _claim(spark, store, every, pane or pane_of(WINDOW_WIDTH, WINDOW_SLIDE), placed)
    time = F.col("event_time")
    known = "received" in events.columns
    missed = (time < _moment(start)) & (F.col("received") >= _moment(start + span(wait))) if known else F.lit(False)
    seen = Observation("landing")
    counted = events.observe(
        seen,
        F.count_if(_within("event_time", start, end)).alias("landed"),
        F.count_if(time < _moment(start)).alias("earlier"),
        F.count_if(time >= _moment(end)).alias("later"),
        F.count_if(time.isNull()).alias("no_time"),
        F.count_if(missed).alias("missed"),
    )
    places = [F.col("partition").cast("int"), F.col("offset").cast("long")] if placed else []
    rows = counted.filter(_within("event_time", start, end)).select(
        *RAW_SCHEMA.fieldNames(), *places, *_slot_of(time, every)
    )
    inside = _slots(start, end, every)
    held = not may_lose and exists(spark, f"{store}/raw") and not read_landed(spark, store).filter(inside).isEmpty()
    if held:
        rows = _put_aside(rows, store, start, end)
        (_refuse_lost_offsets if placed else _refuse_lost_rows)(rows, store, inside)
    slots = _run_slots(spark, start, end, every)
    if placed and held:
        # First: a run that ends in between may promise rows too many, but forget none.
        _write_offsets(rows, slots, store)
    _write(rows, slots, f"{store}/raw")
    landed = _table(spark, store, "raw", PLACED_SCHEMA, "event_time").filter(inside)
    panes = pane_partials(landed, f"{claim.pane} microseconds", "event_time", SLOT)
    _write(panes, slots, f"{store}/panes")
    if placed and not held:
        _write_offsets(landed, slots, store)
    if held:
        _cleared(rows, store, start, end)
    return dict(seen.get)


def _newest_run(spark: SparkSession, store: str) -> int:
    return _log(spark, store).agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]


def _write_offsets(rows: DataFrame, slots: DataFrame, store: str) -> None:
    """Adds a run to the ledger: the ranges of its rows, and a mark for each of its intervals."""
    run = F.lit(_newest_run(rows.sparkSession, store) + 1)
    told = _offsets(rows).unionByName(slots, allowMissingColumns=True).withColumn("run", run)
    told.hint("rebalance").write.mode("append").parquet(f"{store}/ledger")


def land_late(
    events: DataFrame, store: str, start: datetime, end: datetime, batch: str, every: str = EVERY,
    width: str = WINDOW_WIDTH, slide: str = WINDOW_SLIDE,
) -> dict[str, int]:
    """Adds those events of [start, end) that are not landed yet, and stores anew the windows they belong
    to, from stored panes and their own: no landed row is read.

    Rows are known by partition and offset; those the ledger has are skipped, so `events` may hold any
    part of the topic. `batch` names the run: a second run under a name replaces the first. Windows of
    intervals that were never run are left to their own run, which brings these rows again. Returns
    counts: `landed` and `known`.
    """
    spark = events.sparkSession
    _check(spark, start, end, every)
    claim = _claimed(spark, store)
    if claim is None or not claim.placed or not _placed(events):
        raise ValueError("late rows need a store and events with partition and offset")
    claim = _claim(spark, store, every, pane_of(width, slide), True)
    inside = _slots(start, end, every)
    seen = Observation("late")
    come = events.observe(seen, F.count_if(_within("event_time", start, end)).alias("come"))
    rows = come.filter(_within("event_time", start, end)).select(
        *RAW_SCHEMA.fieldNames(), F.col("partition").cast("int"), F.col("offset").cast("long"),
        *_slot_of(F.col("event_time"), every),
    )
    log, late = _log(spark, store), _late(spark, store)
    held = log.join(_newest(log), [*SLOT, "run"], "left_semi").filter("partition IS NOT NULL").drop("run")
    before: list = []
    if late is not None:
        mine = F.col("batch") == batch
        held = ranges_merged(held.unionByName(_offsets(late.filter(~mine))).filter(inside), LEDGER_KEYS, *RANGE)
        before = late.filter(mine & inside).select(*SLOT).distinct().collect()
    new = outside(rows, held.filter(inside), LEDGER_KEYS, "offset", *RANGE).dropDuplicates([*LEDGER_KEYS, "offset"])
    marks = {"run": F.lit(_newest_run(spark, store)).cast("long"), "batch": F.lit(batch)}
    mark = spark.range(1).select(*[value.alias(name) for name, value in marks.items()])
    _write(new.withColumns(marks), mark, f"{store}/late", ("batch",))
    landed = spark.read.schema(LATE_SCHEMA).parquet(f"{store}/late").filter(F.col("batch") == batch)
    counted = landed.filter("event_time IS NOT NULL").groupBy(*SLOT).agg(F.count("*").alias("n")).collect()
    # At most as many as the range has intervals.
    slots = {tuple(r) for r in before} | {(r["dt"], r["slot"]) for r in counted}
    if slots:
        _store_windows(spark, store, [_begin(*slot) for slot in sorted(slots)], every, width, slide, claim)
    count = sum(r["n"] for r in counted)
    return {"landed": count, "known": seen.get["come"] - count}


def _begin(dt, slot: str) -> datetime:
    return datetime.combine(dt, datetime.strptime(slot, "%H-%M").time())


def aggregate(
    spark: SparkSession,
    store: str,
    start: datetime,
    end: datetime,
    every: str = EVERY,
    width: str = WINDOW_WIDTH,
    slide: str = WINDOW_SLIDE,
) -> None:
    """Stores the windows that end in (start, end], from stored panes, and again those of the next
    intervals that windows of these rows reach into, where these are landed."""
    _check(spark, start, end, every)
    claim = _claimed(spark, store)
    if claim is None:
        raise ValueError("nothing is landed in this store")
    _claim(spark, store, every, pane_of(width, slide), claim.placed)
    _store_windows(spark, store, (start, end), every, width, slide, claim)


def _store_windows(
    spark: SparkSession, store: str, run: tuple[datetime, datetime] | list[datetime], every: str, width: str,
    slide: str, claim: Claim,
) -> None:
    """`run`: a range of intervals, all stored, or the starts of some, of which those that were run are."""
    if _micros(pane_of(width, slide)) % claim.pane:
        raise ValueError(f"windows of {width} every {slide} do not consist of the store's panes")
    step = span(every)
    reach = -(-span(width) // step) * step
    start, end = run if isinstance(run, tuple) else (min(run), max(run) + step)
    until = end + reach
    landed = _folders(spark, store, "panes")
    if isinstance(run, tuple):
        # As many as intervals fit into a window.
        after = landed.filter(_slots(end, until, every)).distinct().collect()
        mine = _run_slots(spark, start, end, every)
    else:
        around = {at + k * step for at in run for k in range(reach // step + 1)}
        runs = landed.filter(_slots(start, until, every)).distinct().collect()
        after, mine = [r for r in runs if _begin(*r) in around], None
    if after:
        more = value_table(spark, SLOT_NAMES, [tuple(r) for r in after])
        mine = more if mine is None else mine.union(more)
    if mine is None:
        return
    first = start - span(width)
    panes, late = _table(spark, store, "panes", PANE_SCHEMA, "pane"), _late(spark, store)
    if late is not None:
        panes = panes.unionByName(pane_partials(late, f"{claim.pane} microseconds", "event_time", SLOT))
    near = panes.filter(_slots(first, until, every) & _within("pane", first, until))
    closed = (F.col("end") > _moment(start)) & (F.col("end") <= _moment(until))
    last_moment = F.col("end") - F.expr("INTERVAL 1 MICROSECOND")
    stats = windows_of_panes(near, width, slide).filter(closed)
    stats = stats.withColumn("last", last_moment).select(
        *STATS_SCHEMA.fieldNames(), *_slot_of(F.col("last"), every)
    )
    _write(stats.join(mine, SLOT, "left_semi"), mine, f"{store}/stats")


def events_received(
    messages: DataFrame, start: datetime, end: datetime, wait: str = LATENESS
) -> DataFrame:
    """Events of topic rows that the topic received from `wait` before the range to `wait` after it,
    since the clocks of senders and brokers differ and events come late; with the time they were
    `received` and their place in the topic."""
    at = F.col("timestamp")
    reach = (at >= _moment(start - span(wait))) & (at < _moment(end + span(wait)))
    places = POSITION if _placed(messages) else []
    parsed = parse_events(messages.filter(reach), keep=("timestamp", *places))
    return with_event_time(parsed).withColumnRenamed("timestamp", "received")


def topic_events(
    spark: SparkSession, servers: str, topic: str, start: datetime, end: datetime,
    wait: str = LATENESS, **more,
) -> DataFrame:
    """The source of a run: `events_received` of a topic, of which no more than that is read."""
    around = span(wait)
    messages = read_topic_batch(spark, servers, topic, start - around, end + around, **more)
    return events_received(messages, start, end, wait)


def run_interval(
    events: DataFrame, store: str, start: datetime, every: str = EVERY, wait: str = LATENESS,
    may_lose: bool = False, **windows: str,
) -> dict[str, int]:
    """One interval: land, then aggregate. An error while landing keeps the second from running; a
    second run of the same interval replaces the first. Returns the counts of `ingest`."""
    return backfill(events, store, start, start + span(every), every, wait, may_lose, **windows)


def backfill(
    events: DataFrame, store: str, start: datetime, end: datetime, every: str = EVERY,
    wait: str = LATENESS, may_lose: bool = False, **windows: str,
) -> dict[str, int]:
    """All intervals of [start, end) at once: as many jobs as one interval takes. Replaces them all, and
    loses landed rows only if it `may_lose` them. Returns the counts of `ingest`."""
    width, slide = windows.get("width", WINDOW_WIDTH), windows.get("slide", WINDOW_SLIDE)
    counts = ingest(events, store, start, end, every, wait, may_lose, pane_of(width, slide))
    aggregate(events.sparkSession, store, start, end, every, width, slide)
    return counts


def covering_range(
    events: DataFrame, every: str = EVERY, width: str = WINDOW_WIDTH
) -> tuple[datetime, datetime]:
    """The interval edges around all events and all their windows, from one pass over the times."""
    low, high = events.agg(
        F.min("event_time").cast("timestamp_ntz"), F.max("event_time").cast("timestamp_ntz")
    ).first()
    step = span(every)
    first = low - (low - EPOCH) % step
    last = high + span(width)
    return first, last + -(last - EPOCH) % step
