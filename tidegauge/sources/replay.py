"""Files played back as a stream: the stand-in for a topic where no broker is at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def replay_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """Parquet files under `path` (a folder or a glob) as a stream, oldest file first.

    `max_files` or `max_bytes` bound one micro-batch. Without a bound all files of a drain form one
    batch; the order of files then cannot make a row late.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)
