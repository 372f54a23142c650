"""What a running or stopped aggregate holds in its state: the windows that are still open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.stats import PARTIALS, finished
from tidegauge.operators.windows import finish_windows

# The state keeps the buffers of the partial results by position, all sums under one name. A sum of
# decimals has two: the sum, and whether there was none.
KINDS = {"odd": "decimal(38,10),no_odd:boolean", "beyond": "double", "highest": "double"}
STATE = f"struct<{','.join(f'{name}:{KINDS.get(name, 'bigint')}' for name in PARTIALS)}>"


def read_open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Results so far of the windows that the aggregate with this `checkpoint` has not closed, as of its
    last micro-batch or of `batch_id`, which must be one the checkpoint still keeps.

    With an append sink these are the windows it has not written: both together are all windows. The
    state is read in place, by a task per state partition; the query need not run, and is not disturbed.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    held = state.select("key.*", F.col("value").cast(STATE).alias("held"))
    rows = held.select("window", "indicator", "held.*")
    rows = rows.withColumn("odd", F.when(~F.col("no_odd"), F.col("odd")))
    return finish_windows(rows.select("window", "indicator", *finished()))
