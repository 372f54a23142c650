"""Keeping a store of batches small while its stream runs.

`replace_batch` adds a folder per micro-batch, with a file or more per task, and a keyed result is stored
again with every change. `compact` merges what is there into a generation, in the same store, and a record, one
file that appears as a whole, makes it count: `read_batches` then reads the newest generation and the
batches it does not hold. Before the record readers see the batches, after it the generation: the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.session import children, delete
from tidegauge.streaming.sinks import COMMIT, GENERATION, RESULT_KEY, generation_path, held_by, newest_generations, read_batches


def latest_changes(df: DataFrame) -> DataFrame:
    """What `latest_results` takes, with the `run` and `batch_id` it is from: a `merge` for `compact`."""
    row = F.struct("avg_value", "max_value", "cnt", "run", "batch_id")
    newest = df.groupBy(*RESULT_KEY).agg(F.max_by(row, F.struct("run", "batch_id")).alias("row"))
    return newest.select(*RESULT_KEY, "row.*")


def _upto(spark: SparkSession, path: str) -> dict[int, int]:
    """Per run the last batch that cannot come again. A stream may repeat the newest batch of a run; all before
    it are in the checkpoint."""
    commits = spark.read.schema(COMMIT).parquet(f"{path}/commits")
    newest = commits.groupBy("run").agg((F.max("batch_id") - 1).alias("upto")).collect()
    return {r.run: r.upto for r in newest}


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    merge: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: tuple[str, ...] = (),
) -> bool:
    """Merges the batches of a store, but the newest of each run, and its last generation into a new generation.

    Without `merge` all rows are kept, in fewer files; `merge` takes and returns rows with `run` and
    `batch_id`, and what is read must not depend on whether it was applied (`latest_changes` before
    `latest_results`). False if there is nothing to merge. A call that fails leaves the store as it was.
    What only readers of the generation before the last could still want is deleted.
    """
    upto = _upto(spark, path)
    known = newest_generations(spark, path)
    had = known[0].upto if known else {}
    if all(last <= had.get(run, -1) for run, last in upto.items()):
        return False
    rows = read_batches(spark, path, schema).filter(held_by(upto))
    rows = rows if merge is None else merge(rows)
    number, attempt = (known[0].generation + 1 if known else 1), uuid.uuid4().hex
    gathered = rows.hint("rebalance", *partition_by) if partition_by else rows.hint("rebalance")
    gathered.write.partitionBy(*partition_by).parquet(generation_path(path, number, attempt))
    commit_generation(spark, path, number, attempt, upto)
    prune(spark, path)
    return True


def commit_generation(spark: SparkSession, path: str, number: int, attempt: str, upto: dict[int, int]) -> None:
    """A row per run, in one file."""
    rows = spark.createDataFrame([(number, attempt, run, last) for run, last in upto.items()], GENERATION.rsplit(",", 1)[0])
    rows.withColumn("at", F.unix_micros(F.current_timestamp())).coalesce(1).write.mode("append").parquet(f"{path}/records")


def prune(spark: SparkSession, path: str) -> None:
    """Deletes batches that the generation before the last holds, with their records, and older generations.
    Readers that began with the generation before the last find all they want."""
    known = newest_generations(spark, path)
    if len(known) < 2:
        return
    kept = {f"attempt={g.attempt}" for g in known[:2]}
    for folder in children(spark, f"{path}/generations"):
        if int(folder.rsplit("=", 1)[1]) <= known[1].generation:
            for attempt in children(spark, folder):
                if attempt.rsplit("/", 1)[1] not in kept:
                    delete(spark, attempt)
    for run, last in known[1].upto.items():
        for part in ("commits", "data"):
            for folder in children(spark, f"{path}/{part}/run={run}"):
                if int(folder.rsplit("=", 1)[1]) <= last:
                    delete(spark, folder)
