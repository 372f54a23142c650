"""Writers for streams and tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidegauge.schema import RAW_SCHEMA, STATS_SCHEMA, with_fields
from tidegauge.session import exists, require_utc, stream_options
from tidegauge.settings import BROKERS, CONSOLE_ROWS, CONSOLE_TRIGGER, PARQUET_TRIGGER, SINK, TOPIC

#: Called with a micro-batch, its id, and the mark of the run that its id belongs to.
BatchFn = Callable[[DataFrame, int, int], None]
RESULT_KEY = ("start", "end", "indicator")
#: Records of batches and of generations that count.
COMMIT = "run bigint, batch_id bigint, attempt string, at bigint"
GENERATION = "generation bigint, attempt string, run bigint, upto bigint, at bigint"


def trigger(writer: DataStreamWriter, every: str | None, drain: bool) -> DataStreamWriter:
    """`drain`: all that is there now, then stop. Else a micro-batch `every` so often."""
    if drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def start(
    writer: DataStreamWriter,
    spark: SparkSession,
    checkpoint: str | None = None,
    every: str | None = None,
    drain: bool = False,
    shuffle_partitions: int | None = None,
) -> StreamingQuery:
    """Starts a writer with a trigger and a checkpoint, state on RocksDB."""
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    with stream_options(spark, shuffle_partitions):
        return trigger(writer, every, drain).start()


def write_stream(
    df: DataFrame,
    sink: str = SINK,
    path: str | None = None,
    checkpoint: str | None = None,
    every: str | None = None,
    drain: bool = False,
    shuffle_partitions: int | None = None,
    console_rows: int = CONSOLE_ROWS,
) -> StreamingQuery:
    """Window results to a sink by name.

    "console" shows changed windows of each micro-batch, untruncated: its first `console_rows`, since
    the driver's terminal takes no large batch; all go to the other sink. "parquet"
    appends each window once, when the watermark has passed its end, to a folder partitioned by
    indicator; the `path` may be of any file system Spark knows. Its commit log and the checkpoint
    make a restart neither lose nor repeat a window. Both paths are to outlive the job.
    """
    if sink == "console":
        writer = df.writeStream.format("console").outputMode("update")
        writer = writer.option("truncate", "false").option("numRows", str(console_rows))
        every = every or CONSOLE_TRIGGER
    elif sink == "parquet":
        if not path or not checkpoint:
            raise ValueError("the parquet sink needs a path and a checkpoint")
        # Bringing an indicator's results together gives one file of it per trigger instead of one
        # per state partition. The date keeps a long catch-up of one indicator from ending up in
        # one task: a task then holds at most a day's windows of it.
        writer = (
            df.repartition("indicator", F.to_date("start"))
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .partitionBy("indicator")
        )
        every = every or PARQUET_TRIGGER
    else:
        raise ValueError(f"unknown sink: {sink!r} (console, parquet)")
    return start(writer, df.sparkSession, checkpoint, every, drain, shuffle_partitions)


def write_stats(df: DataFrame, path: str) -> None:
    """Window results of a table to a new folder partitioned by indicator.

    `rebalance` gathers the rows of an indicator into few files and lets adaptive execution split
    the tasks of an indicator that has too many of them.
    """
    df.hint("rebalance", "indicator").write.partitionBy("indicator").parquet(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """Window results; a filter on `indicator` reads that indicator's folder only.

    The schema is given, or a code such as "007" would be read back from its folder as a number.
    """
    return spark.read.schema(STATS_SCHEMA).parquet(path).select(STATS_SCHEMA.fieldNames())


def topic_sink_options(
    servers: str = BROKERS, topic: str = TOPIC, extra: dict[str, str] | None = None
) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic} | (extra or {})


def write_topic(
    df: DataFrame,
    servers: str = BROKERS,
    topic: str = TOPIC,
    checkpoint: str | None = None,
    every: str | None = None,
    drain: bool = False,
    **extra: str,
) -> StreamingQuery | None:
    """Publishes `key` and `value`. A table is written at once, a stream as it comes.

    Delivery is at least once: a retried task sends its messages again.
    """
    messages = df.select("key", "value")
    options = topic_sink_options(servers, topic, extra)
    if not df.isStreaming:
        messages.write.format("kafka").options(**options).save()
        return None
    if not checkpoint:
        raise ValueError("publishing a stream needs a checkpoint")
    writer = messages.writeStream.format("kafka").outputMode("append").options(**options)
    return start(writer, df.sparkSession, checkpoint, every, drain)


def write_raw(
    df: DataFrame,
    path: str,
    checkpoint: str | None = None,
    every: str | None = None,
    drain: bool = False,
    rebalance: bool = True,
) -> StreamingQuery | None:
    """Raw events to Parquet by UTC date `dt` of their event time; rows without one land under the
    null partition, so nothing is lost.

    A table is rebalanced by date first: one file set per date, and a date that holds much of the
    data is split over several tasks. Turn it off for input already in time order, which needs no
    shuffle. A table is appended each time it is written; `plans.interval` has runs that replace. A
    stream is written as it comes, since it arrives about in time order, and each file once.
    """
    require_utc(df.sparkSession)
    dated = df.withColumn("dt", F.to_date("event_time"))
    if not df.isStreaming:
        rows = dated.hint("rebalance", "dt") if rebalance else dated
        rows.write.mode("append").partitionBy("dt").parquet(path)
        return None
    if not checkpoint:
        raise ValueError("landing a stream needs a checkpoint")
    writer = (
        dated.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .partitionBy("dt")
    )
    return start(writer, df.sparkSession, checkpoint, every, drain)


def read_raw(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Raw events with their date `dt`; a filter on `dt` reads those dates only."""
    return spark.read.schema(with_fields(schema, dt=T.DateType())).parquet(path)


def run_mark(spark: SparkSession, checkpoint: str) -> int:
    """The moment the checkpoint was first used, in microseconds, kept in the checkpoint.

    Batch ids begin at 0 with each new checkpoint. The mark tells the batches of a later one from
    those an earlier one left in the same place.
    """
    path = f"{checkpoint.rstrip('/')}/run"
    if not exists(spark, path):
        spark.range(1).select(F.unix_micros(F.current_timestamp()).alias("run")).coalesce(1).write.parquet(path)
    return spark.read.schema("run bigint").parquet(path).first()["run"]


def process_then_commit(
    df: DataFrame,
    fn: BatchFn,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    drain: bool = False,
    shuffle_partitions: int | None = None,
) -> StreamingQuery:
    """Runs `fn(batch, batch_id, run)` on each micro-batch and stores the position afterwards.

    After a crash in between, the batch comes again under the same id: at least once. A `fn` that
    replaces what it wrote under that id and run makes it exactly once.
    """
    run = run_mark(df.sparkSession, checkpoint)
    writer = df.writeStream.outputMode(mode).foreachBatch(lambda batch, batch_id: fn(batch, batch_id, run))
    return start(writer, df.sparkSession, checkpoint, every, drain, shuffle_partitions)


def replace_batch(path: str, partition_by: tuple[str, ...] = ()) -> BatchFn:
    """A `fn` for `process_then_commit` in two steps: the batch is written aside, to a folder of its own,
    and then a record says that it counts. A batch that comes again takes the place of the first with
    its own record. Readers see whole batches only, the earlier one until the later has its record.
    """

    def write(batch: DataFrame, batch_id: int, run: int) -> None:
        attempt = uuid.uuid4().hex
        target = f"{path}/data/run={run}/batch_id={batch_id}/attempt={attempt}"
        batch.write.partitionBy(*partition_by).parquet(target)
        commit_batch(batch.sparkSession, path, batch_id, run, attempt)

    return write


def commit_batch(spark: SparkSession, path: str, batch_id: int, run: int, attempt: str) -> None:
    """One row, in one file that appears as a whole."""
    spark.range(1).coalesce(1).select(
        F.lit(run).cast("long").alias("run"), F.lit(batch_id).cast("long").alias("batch_id"),
        F.lit(attempt).alias("attempt"), F.unix_micros(F.current_timestamp()).alias("at"),
    ).write.mode("append").partitionBy("run", "batch_id").parquet(f"{path}/commits")


class Generation(NamedTuple):
    """Batches merged by `generations.compact`: per run all up to one."""

    generation: int
    at: int
    attempt: str
    upto: dict[int, int]


def generation_path(path: str, number: int, attempt: str) -> str:
    return f"{path}/generations/generation={number}/attempt={attempt}"


def newest_generations(spark: SparkSession, path: str) -> list[Generation]:
    """Those with a record, the newest first: the first one counts. A record has a row per run."""
    if not exists(spark, f"{path}/records"):
        return []
    told = spark.read.schema(GENERATION).parquet(f"{path}/records")
    rows = told.groupBy("generation", "at", "attempt").agg(F.map_from_entries(F.collect_list(F.struct("run", "upto"))).alias("upto"))
    return [Generation(*r) for r in rows.orderBy(F.desc("generation"), F.desc("at"), F.desc("attempt")).limit(2).collect()]


def held_by(upto: dict[int, int]) -> Column:
    """Whether a batch is among those up to the given one of its run."""
    held = F.lit(False)
    for run, last in upto.items():
        held = held | ((F.col("run") == run) & (F.col("batch_id") <= last))
    return held


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What `replace_batch` wrote and has a record, with the `run` and `batch_id` of each row. Folders that
    do not count are not read: the records, one per batch, prune them. Of batches that were merged the newest
    generation is read."""
    places = {"run": T.LongType(), "batch_id": T.LongType()}
    placed, marked = with_fields(schema, **places), with_fields(schema, **places, attempt=T.StringType())
    if not exists(spark, f"{path}/commits"):
        return spark.createDataFrame([], placed)
    merged = newest_generations(spark, path)[:1]
    commits = spark.read.schema(COMMIT).parquet(f"{path}/commits")
    for generation in merged:
        commits = commits.filter(~held_by(generation.upto))
    newest = commits.groupBy("run", "batch_id").agg(F.max_by("attempt", "at").alias("attempt"))
    data = spark.read.schema(marked).parquet(f"{path}/data")
    for generation in merged:
        # Files that `generations.prune` may delete meanwhile are not even opened.
        data = data.filter(~held_by(generation.upto))
    rows = data.join(newest, ["run", "batch_id", "attempt"], "left_semi").select(*placed.fieldNames())
    for generation in merged:
        held = spark.read.schema(placed).parquet(generation_path(path, generation.generation, generation.attempt))
        rows = rows.unionByName(held.select(*placed.fieldNames()))
    return rows


def latest_results(df: DataFrame) -> DataFrame:
    """One row per (start, end, indicator): the one of the latest run, and in it of the highest
    `batch_id`. Results that only an earlier run has stay.

    An aggregate, not a ranking: it combines before the shuffle and sorts nothing. Copies of a row
    that a repeated batch appended fall together here.
    """
    payload = F.struct("avg_value", "max_value", "cnt")
    newest = df.groupBy(*RESULT_KEY).agg(F.max_by(payload, F.struct("run", "batch_id")).alias("row"))
    return newest.select(*RESULT_KEY, "row.*")


def jdbc_options(url: str, table: str, connections: int = 8, **extra: str) -> dict[str, str]:
    """`connections` bounds the sessions a database sees, however many tasks a batch has."""
    return {"url": url, "dbtable": table, "numPartitions": str(connections)} | extra


def append_jdbc(url: str, table: str, connections: int = 8, **extra: str) -> BatchFn:
    """A `fn` for `process_then_commit`: appends the batch, marked with its `run` and `batch_id`, to
    a relational table. Read it through `latest_results`, which also undoes a repeated batch."""
    options = jdbc_options(url, table, connections, **extra)

    def write(batch: DataFrame, batch_id: int, run: int) -> None:
        marks = {"run": F.lit(run).cast("long"), "batch_id": F.lit(batch_id).cast("long")}
        batch.withColumns(marks).write.format("jdbc").mode("append").options(**options).save()

    return write


def write_results_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    checkpoint: str,
    every: str | None = PARQUET_TRIGGER,
    drain: bool = False,
    **extra: str,
) -> StreamingQuery:
    """Running window results to a relational table."""
    fn = append_jdbc(url, table, **extra)
    return process_then_commit(df, fn, checkpoint, "update", every, drain)
