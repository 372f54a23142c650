"""Shards by jump consistent hashing, in DataFrame functions only.

A key walks a growing row of shards. From shard b it jumps to floor((b + 1) / r), r being its next
draw from (0, 1]; the last shard below the number of shards is its own. Draws depend on the key and
their number alone, so with one more shard a key either stays or jumps into the new shard, and no
table of a ring is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.numbering import number_rows
from tidegauge.llm.tables import id_text

# Fixed value: a draw is the first eight hex digits of an MD5, plus one, over this.
DRAWS = 4294967296.0


def jump(key: Column, shards: int) -> Column:
    """struct(b, j): the key's shard among `shards`, and the first stop at or beyond them.

    A walk takes about ln(shards) jumps and never more than `shards`, since each goes at least one
    shard on; steps after the end pass the state through without a draw.
    """
    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(state: Column, i: Column) -> Column:
        digest = F.md5(F.concat_ws(":", key, i.cast("string")).cast("binary"))
        draw = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 1) / DRAWS
        onward = F.struct(
            state["j"].alias("b"), F.floor((state["j"] + 1) / draw).cast("long").alias("j")
        )
        return F.when(state["j"] < shards, onward).otherwise(state)

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, step)


def with_shard(docs: DataFrame, shards: int, id_column: str = "doc_id") -> DataFrame:
    """Adds `shard`, and `grown_shard`: the shard if there were one more. No shuffle.

    The id's text and the number of shards decide, so rows with equal ids share a shard, and rows
    without an id are those of the empty text.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    walk = F.col("_tg_walk")
    grown = F.when(walk["j"] == shards, F.lit(shards)).otherwise(walk["b"])
    return (
        docs.withColumn("_tg_walk", jump(id_text(id_column), shards))
        .withColumn("shard", walk["b"].cast("int"))
        .withColumn("grown_shard", grown.cast("int"))
        .drop("_tg_walk")
    )


def shard_documents(docs: DataFrame, shards: int, id_column: str = "doc_id") -> DataFrame:
    """All rows with all their columns, plus `shard`, `slot` and `grown_shard`.

    `slot` counts the rows of a shard from 0 without gaps. Columns of these names in `docs` are
    replaced. An empty table gives an empty table.
    """
    return number_rows(with_shard(docs, shards, id_column), "shard", "slot")


def shard_digest(docs: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, size, CRC-32 of the text, law, shard, slot and grown_shard.

    `size` is the text's UTF-8 bytes plus 16; a NULL text counts and is summed as empty.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(id_column),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return shard_documents(narrow, shards, id_column).select(
        id_column, "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
