"""Ranges of whole numbers, such as the offsets of a log: `first` included, `until` not.

Ranges of one key may be many, so they are merged in two steps: places first inside blocks of a bounded
length, whatever the key, and only what is left of them, one range for each gap at most, by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places in a block: what a task sorts at once of one key.
BLOCK = 1 << 16


def block_of(place: str | Column) -> Column:
    return F.call_function("div", F.col(place) if isinstance(place, str) else place, F.lit(BLOCK))


def merged(df: DataFrame, keys: Sequence[str], first: str = "first", until: str = "until") -> DataFrame:
    """Ranges that overlap or touch become one. Empty ones vanish; NULL keys are keys like others."""
    order = Window.partitionBy(*keys).orderBy(first, until)
    reach = F.max(until).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = (reach.isNull() | (F.col(first) > reach)).cast("int")
    marked = df.filter(F.col(first) < F.col(until)).withColumn("_begins", begins)
    run = F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("_run", run).groupBy(*keys, "_run").agg(
        F.min(first).alias(first), F.max(until).alias(until)
    ).drop("_run")


def ranges_of(
    df: DataFrame, keys: Sequence[str], place: str, first: str = "first", until: str = "until"
) -> DataFrame:
    """The ranges that the places of each key fill. Repeated places count once, NULL ones not at all."""
    placed = df.filter(F.col(place).isNotNull()).select(*keys, F.col(place).cast("long").alias("_place"))
    inside = Window.partitionBy(*keys, "_block").orderBy("_place")
    runs = placed.withColumn("_block", block_of("_place")).withColumn(
        "_run", F.col("_place") - F.dense_rank().over(inside)
    )
    short = runs.groupBy(*keys, "_block", "_run").agg(
        F.min("_place").alias(first), (F.max("_place") + 1).alias(until)
    )
    return merged(short.drop("_block", "_run"), keys, first, until)


def difference(
    held: DataFrame, come: DataFrame, keys: Sequence[str], first: str = "first", until: str = "until"
) -> DataFrame:
    """What the ranges of `held` cover and those of `come` do not, as ranges.

    Edges are met in order, counting how many ranges of either side are open between them.
    """
    keyed = [F.col(k) for k in keys]

    def edges(df: DataFrame, held: int, come: int) -> DataFrame:
        ends = [
            F.struct(F.col(place).cast("long").alias("at"), F.lit(step).alias("step"))
            for place, step in ((first, 1), (until, -1))
        ]
        opened = df.select(*keyed, F.explode(F.array(*ends)).alias("_edge")).select(*keyed, "_edge.*")
        return opened.select(*keyed, "at", (F.col("step") * held).alias("held"), (F.col("step") * come).alias("come"))

    order = Window.partitionBy(*keys).orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = edges(held, 1, 0).unionByName(edges(come, 0, 1)).groupBy(*keys, "at").agg(
        F.sum("held").alias("held"), F.sum("come").alias("come")
    )
    open_ = every.select(
        *keyed, F.col("at").alias(first), F.lead("at").over(order).alias(until),
        F.sum("held").over(so_far).alias("_held"), F.sum("come").over(so_far).alias("_come"),
    )
    return merged(open_.filter("_held > 0 AND _come <= 0").drop("_held", "_come"), keys, first, until)


def outside(
    df: DataFrame, ranges: DataFrame, keys: Sequence[str], place: str, first: str = "first", until: str = "until"
) -> DataFrame:
    """The rows of `df` whose place lies in no range of their key; a NULL place lies in none.

    Ranges are cut at the edges of blocks. In a block, rows follow the ranges in order, and the last
    range before a row is the only one that may hold it: no pairs are made. `ranges` do not overlap.
    """
    rows = df.withColumn("_block", block_of(place)).withColumn("_place", F.col(place).cast("long"))
    blocks = F.sequence(block_of(first), block_of(F.col(until) - 1))
    cut = ranges.select(*keys, first, until, F.explode(blocks).alias("_block")).select(
        *keys, "_block",
        F.greatest(F.col(first), F.col("_block") * BLOCK).alias("_place"),
        F.least(F.col(until), (F.col("_block") + 1) * BLOCK).alias("_until"),
    )
    # At one place the range comes before the row.
    order = Window.partitionBy(*keys, "_block").orderBy("_place", F.col("_until").desc_nulls_last())
    reach = F.last("_until", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = rows.withColumn("_row", F.lit(True)).unionByName(cut, allowMissingColumns=True)
    free = both.withColumn("_reach", reach).filter(
        F.col("_row") & (F.col("_place").isNull() | F.col("_reach").isNull() | (F.col("_reach") <= F.col("_place")))
    )
    return free.select(*df.columns)
