"""Reading the tables of a folder, and tables written between the steps of an operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import scratch_dir

# The word and lower-case rules all contracts on texts share.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` to the folder all executors share and reads it again.

    What follows starts from the files: a lost executor costs no more than its own tasks, and a
    table that several steps use is computed once. Meant for narrow tables; they stay until the
    folder that `spark.checkpoint.dir` names is cleaned.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, as UTF-8. NULL has none.

    `bytes.split` cuts at just the six characters that `WORD` leaves out. Surrogates that stand
    alone can't come out of Spark; they would be encoded as they are.
    """
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def id_text(id_column: str) -> Column:
    """An id as text; a NULL id reads as empty text."""
    return F.coalesce(F.col(id_column).cast("string"), F.lit(""))


def fold(id_column: str, modulus: int) -> Column:
    """CRC-32 of the id's text, modulo `modulus`: the folds that learning and testing share."""
    return F.crc32(id_text(id_column).cast("binary")) % modulus
