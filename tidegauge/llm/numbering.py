"""Rows told apart by where they are stored, and gapless numbers inside groups of any size."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.tables import settle

#: A row's place: the file it is read from, and its number in that file.
PLACE = ("_tg_file", "_tg_row")
#: Rows of a file that are numbered together, at most.
BLOCK = 1 << 16


def with_place(df: DataFrame) -> DataFrame:
    """Adds the place of each row, which is the same each time the row is read, however its files are cut
    into tasks. `df` is a table, or what select and filter take from one; rows from elsewhere are written
    first, and their place is that in what was written."""

    def placed(table: DataFrame) -> DataFrame:
        source = table.metadataColumn("_metadata")
        return table.withColumns(dict(zip(PLACE, (source["file_path"], source["row_index"]))))

    try:
        return placed(df)
    except AnalysisException:
        return placed(settle(df, "rows"))


def number_rows(df: DataFrame, group: str, out: str) -> DataFrame:
    """Adds `out`: 0, 1, 2, ... without gaps inside each value of `group`, in the order of files and rows.

    A group may hold any share of the rows, so no task sees a whole group: rows are numbered inside
    their group and a bounded block of their file, and the counts of the blocks before, one number
    each, are added. A row keeps its number when a task is run again, on other cores too.
    """
    placed = with_place(df).withColumn("_tg_block", F.call_function("div", F.col(PLACE[1]), F.lit(BLOCK)))
    # A group that is NULL is a group too: `<=>` below finds its offset.
    before = Window.partitionBy("_tg_group").orderBy("_tg_in", "_tg_from").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        placed.groupBy(
            F.col(group).alias("_tg_group"), F.col(PLACE[0]).alias("_tg_in"), F.col("_tg_block").alias("_tg_from")
        )
        .agg(F.count("*").alias("_tg_rows"))
        .withColumn("_tg_offset", F.coalesce(F.sum("_tg_rows").over(before), F.lit(0)))
        .drop("_tg_rows")
    )
    inside = Window.partitionBy(group, PLACE[0], "_tg_block").orderBy(PLACE[1])
    return (
        placed.withColumn("_tg_rank", F.row_number().over(inside) - 1)
        .join(
            offsets,
            F.col(group).eqNullSafe(F.col("_tg_group"))
            & (F.col(PLACE[0]) == F.col("_tg_in"))
            & (F.col("_tg_block") == F.col("_tg_from")),
        )
        .withColumn(out, (F.col("_tg_offset") + F.col("_tg_rank")).cast("long"))
        .drop(*PLACE, "_tg_block", "_tg_rank", "_tg_group", "_tg_in", "_tg_from", "_tg_offset")
    )
