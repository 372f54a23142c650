"""The whole streaming aggregate, and what it reports while it runs."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidegauge.operators.decode import (
    parse_events,
    parse_strict,
    tag_bad,
    watch_bad,
    watch_quality,
    with_event_time,
)
from tidegauge.operators.positions import format_line
from tidegauge.operators.windows import window_stats
from tidegauge.schema import CORRUPT, EVENT_SCHEMA, LINE_SCHEMA, READING_SCHEMA
from tidegauge.settings import LATENESS, SINK, WINDOW_SLIDE, WINDOW_WIDTH
from tidegauge.streaming.sinks import BatchFn, process_then_commit, read_batches, replace_batch, write_stream


def message_stats(
    messages: DataFrame,
    width: str = WINDOW_WIDTH,
    slide: str = WINDOW_SLIDE,
    lateness: str = LATENESS,
) -> DataFrame:
    """From topic rows to window results, for a table or a stream of messages. A stream is counted
    on the way."""
    readings = with_event_time(parse_events(messages, READING_SCHEMA))
    if messages.isStreaming:
        readings = watch_quality(readings)
    return window_stats(readings, width, slide, lateness)


def run_stream(
    messages: DataFrame,
    sink: str = SINK,
    width: str = WINDOW_WIDTH,
    slide: str = WINDOW_SLIDE,
    lateness: str = LATENESS,
    **more,
) -> StreamingQuery:
    """Starts the aggregate of a message stream; `more` goes to `write_stream`.

    Each micro-batch counts its rows and those that no window sees; `progress` shows the counts.
    """
    return write_stream(message_stats(messages, width, slide, lateness), sink, **more)


def consumed_lines(messages: DataFrame, strict: bool = False) -> DataFrame:
    """A line per message. `strict` ends the job at a message that cannot be read or lacks its name
    or value; otherwise such messages are left out, and `split_bad` with the same required fields
    shows them. A stream counts both kinds."""
    where, required = ("partition", "offset"), ("name", "value")
    if strict:
        return format_line(parse_strict(messages, LINE_SCHEMA, keep=where, required=required))
    tagged = tag_bad(messages, LINE_SCHEMA, keep=where, required=required)
    if messages.isStreaming:
        tagged = watch_bad(tagged)
    return format_line(tagged.filter(F.col(CORRUPT).isNull()).drop(CORRUPT))


def consume(
    messages: DataFrame, fn: BatchFn, checkpoint: str, strict: bool = False, **more
) -> StreamingQuery:
    """Hands the lines of each micro-batch to `fn`, then stores the position."""
    return process_then_commit(consumed_lines(messages, strict), fn, checkpoint, **more)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Waits for the end of a query; an error of the query is raised here."""
    query.awaitTermination()
    return query


def quarantine(
    messages: DataFrame, path: str, checkpoint: str, schema: T.StructType = EVENT_SCHEMA,
    required: tuple[str, ...] = ("name", "value"), keep: tuple[str, ...] = ("partition", "offset"), **more,
) -> StreamingQuery:
    """Good events and bad messages of a stream, both kept, from one parse: a micro-batch is written once,
    good and bad rows to folders of their own, and one record makes both count. `read_good` and
    `read_bad` read them."""
    tagged = watch_bad(tag_bad(messages, schema, keep=keep, required=required))
    told = tagged.withColumn("bad", F.col(CORRUPT).isNotNull())
    return process_then_commit(told, replace_batch(path, ("bad",)), checkpoint, **more)


def _kept(spark: SparkSession, path: str, schema: T.StructType, keep: str) -> DataFrame:
    places = T.StructType.fromDDL(keep).fields
    kept = T.StructType([*places, *schema.fields, T.StructField(CORRUPT, T.StringType()), T.StructField("bad", T.BooleanType())])
    return read_batches(spark, path, kept)


def read_good(
    spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, keep: str = "partition int, offset bigint"
) -> DataFrame:
    return _kept(spark, path, schema, keep).filter("NOT bad").drop(CORRUPT, "bad")


def read_bad(
    spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, keep: str = "partition int, offset bigint"
) -> DataFrame:
    """Bad messages as they came, in `raw`."""
    rows = _kept(spark, path, schema, keep).filter("bad").withColumnRenamed(CORRUPT, "raw")
    return rows.select(*T.StructType.fromDDL(keep).fieldNames(), "raw", "run", "batch_id")


REPORT = "query string, run string, batch_id bigint, at string, rows_in bigint, watermark string, state_rows bigint, late_groups bigint, millis bigint, observed string"


class Reports(StreamingQueryListener):
    """Appends a row per micro-batch of every query of the session to a table, so that no report is lost,
    however many there are: a query itself keeps its last 100.

    `together` reports make a file; what is left is written when a query ends. Add it with
    `spark.streams.addListener`, and `wait` for the reports of a query that has ended.
    """

    def __init__(self, spark: SparkSession, path: str, together: int = 20):
        self.spark, self.path, self.together = spark, path, together
        self.waiting: list[tuple] = []
        self.ended: dict[str, threading.Event] = {}

    def _write(self) -> None:
        rows, self.waiting = self.waiting, []
        if rows:
            self.spark.createDataFrame(rows, REPORT).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        told = json.loads(event.progress.json)
        report = _report(told)
        self.waiting.append((
            told["id"], told["runId"], report["batch_id"], told["timestamp"], report["rows_in"], report["watermark"],
            report["state_rows"], report["late_groups"], report["millis"], json.dumps(report["observed"]),
        ))
        if len(self.waiting) >= self.together:
            self._write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._write()
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all reports of a query that has ended are written."""
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError("the reports of the query have not come")


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT).parquet(path)


def _report(p) -> dict:
    state = p["stateOperators"]
    return {
        "batch_id": p["batchId"],
        "rows_in": p["numInputRows"],
        "watermark": p.get("eventTime", {}).get("watermark"),
        "state_rows": sum(s["numRowsTotal"] for s in state),
        "late_groups": sum(s["numRowsDroppedByWatermark"] for s in state),
        "millis": p["durationMs"].get("triggerExecution"),
        "observed": dict(p.get("observedMetrics") or {}),
    }


def progress(query: StreamingQuery) -> list[dict]:
    """The latest micro-batches, at most the 100 a query keeps (`Reports` keeps all): rows in, state held
    and dropped, watermark, time, own counts."""
    return [_report(p) for p in query.recentProgress]
