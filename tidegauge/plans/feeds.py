"""Feeds derived from the `events` table, whole: ticks, messages, API responses, staged files.

`events(event_id, ts, user_id, event_type, value, props)`: the type stands for the indicator, the id
for the offset of a log of three partitions. Its `ts` has no zone; it is read as UTC.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.encode import encode_event, to_event
from tidegauge.session import fit
from tidegauge.sources.replay import replay_stream

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
STAGED = ("event_id", "ts", "event_type", "value")
#: Bound of a micro-batch that replays files.
BATCH_BYTES = str(8 * 2**30)
IDS_PER_BODY = 500
SERIES_ROW = "event_id bigint, time string, item_code string, data_value double"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_glob(sf_dir: str) -> str:
    """For the file stream, which takes a folder or a glob."""
    return f"{sf_dir}/events*.parquet"


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream of its own files."""
    events(spark, sf_dir)
    return replay_stream(spark, events_glob(sf_dir), EVENTS, max_bytes=BATCH_BYTES)


def ticks(ev: DataFrame) -> DataFrame:
    """Decoded events. A stream needs a time with a zone; a table is fine without."""
    time = F.col("ts").cast("timestamp") if ev.isStreaming else F.col("ts")
    return ev.select(F.col("event_type").alias("indicator"), "value", time.alias("event_time"))


def display_name() -> Column:
    return F.concat(F.lit("지표 "), F.col("event_type"))


def landed_events(ev: DataFrame) -> DataFrame:
    """Full events with their event time, as parsing a topic gives them."""
    at = F.col("ts").cast("timestamp")
    return to_event(
        ev.withColumn("event_time", at), F.col("event_type"), display_name(), F.col("value"), at,
        keep=("event_time",),
    ).select("indicator", "name", "value", "ts", "source", "event_time")


def placed_events(ev: DataFrame) -> DataFrame:
    """The same with their place in a topic: events were dealt to three partitions in turn."""
    at = F.col("ts").cast("timestamp")
    placed = ev.withColumns({
        "event_time": at, "partition": (F.col("event_id") % 3).cast("int"), "offset": F.expr("event_id DIV 3"),
    })
    keep = ("event_time", "partition", "offset")
    return to_event(placed, F.col("event_type"), display_name(), F.col("value"), at, keep=keep).select(
        "indicator", "name", "value", "ts", "source", *keep
    )


def messages(ev: DataFrame, damage: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Topic rows: key, value bytes, topic, partition, offset. `damage` rewrites the JSON text,
    which it sees as column `value`, next to the event's own `reading`."""
    at = F.col("ts").cast("timestamp")
    placed = ev.select(
        "*",
        F.lit("readings").alias("topic"),
        (F.ascii("event_type") % 3).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("value").alias("reading"),
    )
    where = ("topic", "partition", "offset", "reading", *keep)
    made = encode_event(
        to_event(placed, F.col("event_type"), display_name(), F.col("value"), at, keep=where),
        keep=where,
    )
    text = F.col("value") if damage is None else damage
    return made.withColumn("value", text.cast("binary"))


def responses(ev: DataFrame) -> DataFrame:
    """API response bodies: `stat_code`, `body`.

    A body holds the rows of one type among 500 consecutive ids, so it has at most 500 entries
    however common the type is. Each range of ids adds an answer without rows and an error answer.
    """
    row = F.struct(
        "event_id",
        F.date_format("ts", "yyyyMMdd").alias("time"),
        F.col("user_id").cast("string").alias("item_code"),
        F.col("value").alias("data_value"),
    )
    block = F.expr(f"event_id DIV {IDS_PER_BODY}").alias("block")
    # Structs sort by their first field, the id.
    rows = F.sort_array(F.collect_list(row))
    search = F.struct(F.struct(rows.alias("row")).alias("StatisticSearch"))
    full = ev.groupBy(F.col("event_type").alias("stat_code"), block).agg(
        F.to_json(search).alias("body")
    )
    # The two forms of an answer without rows.
    bodies = F.array(
        F.lit('{"StatisticSearch":{}}'), F.lit('{"RESULT":{"CODE":"INFO-200","MESSAGE":"no data"}}')
    )
    empty = ev.groupBy(block).agg(F.first(F.lit("none")).alias("stat_code"))
    empty = empty.select("stat_code", F.explode(bodies).alias("body"))
    return full.select("stat_code", "body").unionByName(empty)


def paged_responses(ev: DataFrame) -> DataFrame:
    """Response bodies of 20 entries each: `stat_code`, `block`, `total`, and `first` and `last`, the entries
    that were asked for.

    A series is one type among 500 consecutive ids. By the number of block and page some pages are left
    out, some answered by an error, some begin five entries early, and some come twice.
    """
    row = F.struct(
        "event_id", F.date_format("ts", "yyyyMMdd").alias("time"), F.col("user_id").cast("string").alias("item_code"),
        F.col("value").alias("data_value"),
    )
    block = F.expr(f"event_id DIV {IDS_PER_BODY}").alias("block")
    whole = ev.groupBy(F.col("event_type").alias("stat_code"), block).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    whole = whole.withColumn("total", F.size("rows").cast("long"))
    paged = whole.withColumn("page", F.explode(F.expr("sequence(0L, (total - 1) DIV 20)")))
    kind = F.col("block") + F.col("page")
    early = F.when((kind % 6 == 0) & (F.col("page") > 0), 5).otherwise(0)
    paged = paged.filter(kind % 4 != 1).withColumn("first", F.col("page") * 20 + 1 - early).withColumn(
        "last", F.least(F.col("page") * 20 + 20, F.col("total"))
    )
    entries = F.slice("rows", F.col("first").cast("int"), (F.col("last") - F.col("first") + 1).cast("int"))
    body = F.to_json(F.struct(F.struct(entries.alias("row")).alias("StatisticSearch")))
    # Fixed value: an answer without rows.
    failed = F.lit('{"RESULT":{"CODE":"INFO-200","MESSAGE":"no data"}}')
    times = F.when(kind % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return paged.select(
        "stat_code", "block", "total", "first", "last", F.when(kind % 7 == 2, failed).otherwise(body).alias("body"),
        F.explode(times).alias("copy"),
    ).drop("copy")


def series(ev: DataFrame) -> DataFrame:
    """Landed rows of statistical tables in two cycles, daily (D) and monthly (M)."""
    cycles = F.array(
        F.struct(F.lit("D").alias("cycle"), F.date_format("ts", "yyyyMMdd").alias("time")),
        F.struct(F.lit("M").alias("cycle"), F.date_format("ts", "yyyyMM").alias("time")),
    )
    return ev.select(
        "event_id",
        F.col("event_type").alias("stat_code"),
        F.col("user_id").cast("string").alias("item_code"),
        F.col("value").alias("data_value"),
        F.inline(cycles),
    )


def middle(ev: DataFrame) -> datetime:
    """The moment halfway between the first and the last event."""
    low, high = ev.agg(F.min("ts"), F.max("ts")).first()
    return low + (high - low) / 2


def before(at: datetime) -> Column:
    return F.col("ts") < F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


class Stages:
    """A stream in two runs: first the table's own files, of which rows may be held back; then what
    is added to a folder beside it, written by Spark. Only the columns streams read are copied.

    A micro-batch takes files up to `BATCH_BYTES`, so a failure repeats no more than that.
    """

    def __init__(self, spark: SparkSession, folder: str, sf_dir: str, first: Column | None = None):
        self.spark, self.folder, self.first = spark, f"{folder}/in", first
        self.table = events_glob(sf_dir)
        self.add(events(spark, sf_dir).limit(0))

    def add(self, ev: DataFrame) -> None:
        ev.select(*STAGED).write.mode("append").parquet(self.folder)

    def stream(self) -> DataFrame:
        own = replay_stream(self.spark, self.table, EVENTS, max_bytes=BATCH_BYTES)
        own = own if self.first is None else own.filter(self.first)
        added = replay_stream(self.spark, self.folder, EVENTS, max_bytes=BATCH_BYTES)
        return own.select(*STAGED).unionByName(added.select(*STAGED))
