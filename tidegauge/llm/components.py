"""Connected components of links that no machine could hold.

Rounds of large star and small star: every node ties its larger neighbours to the least node it
knows, then its smaller ones. Links turn into stars whose centre is the least node, in about as many
rounds as the logarithm of the longest path. Both steps are an aggregate, which combines before it
shuffles, and an equality join, where adaptive execution splits a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import settle

MOST_ROUNDS = 60


def _mark(links: DataFrame) -> tuple:
    """What tells two sets of links apart: their number and an order-free hash."""
    digest = F.xxhash64("a", "b")
    row = links.agg(F.count("*"), F.bit_xor(digest), F.sum(F.pmod(digest, F.lit(1 << 40)))).first()
    return tuple(row)


def _tie(links: DataFrame) -> DataFrame:
    """One round; `links` and the result have a > b, each pair once."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.distinct()
    centre = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(centre, "a")
    near = small.filter(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(centre.withColumnRenamed("m", "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b: bigint): root is the least node it reaches.

    Links to oneself and repeated links do no harm; a NULL end makes no link. The driver sees three
    numbers a round. Each round is written to the shared folder, so a lost executor repeats one.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = settle(ordered.distinct(), "links")
    mark = _mark(now)
    for _ in range(MOST_ROUNDS):
        if not mark[0]:
            break
        then, before = settle(_tie(now), "links"), mark
        now, mark = then, _mark(then)
        if mark == before:
            break
    else:
        raise RuntimeError("links did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
