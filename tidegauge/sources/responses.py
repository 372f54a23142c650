"""Landed responses of a statistics API: documents to rows, and rows of one series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegauge.operators.ranges import difference
from tidegauge.schema import response_schema
from tidegauge.settings import RESPONSE_PAGE


def response_rows(body: Column, row_schema: StructType | str) -> Column:
    """The array of rows in a response body; NULL for an error body or a body without rows."""
    return F.from_json(body.cast("string"), response_schema(row_schema))["StatisticSearch"]["row"]


def explode_response(
    df: DataFrame, body: str, row_schema: StructType | str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per entry of each response, fields of `row_schema` as columns after `keep`.

    The generator holds the only parse of the body; an absent row list gives no rows.
    """
    return df.select(*keep, F.inline(response_rows(F.col(body), row_schema)))


def response_page(
    df: DataFrame,
    body: str,
    row_schema: StructType | str,
    first: int,
    last: int,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """As `explode_response`, for entries `first` to `last` (from 1, both included) of each body and
    no others; `response_pages` gives all.

    The array is cut before it becomes rows.
    """
    if first < 1 or last < first:
        raise ValueError(f"no such page: {first}..{last}")
    rows = F.slice(response_rows(F.col(body), row_schema), first, last - first + 1)
    return df.select(*keep, F.inline(rows))


def response_pages(
    df: DataFrame,
    body: str,
    row_schema: StructType | str,
    keep: tuple[str, ...] = (),
    size: int = RESPONSE_PAGE,
) -> DataFrame:
    """As `explode_response`, with the number of the `page` (from 1) that each entry of a body is on,
    `size` entries a page: all pages together hold every entry."""
    if size < 1:
        raise ValueError(f"no such page size: {size}")
    numbered = F.transform(
        response_rows(F.col(body), row_schema),
        lambda row, i: F.struct((F.floor(i / size) + 1).cast("int").alias("page"), row.alias("row")),
    )
    return df.select(*keep, F.inline(numbered)).select(*keep, "page", "row.*")


def missing_entries(
    df: DataFrame, body: str, row_schema: StructType | str, keys: tuple[str, ...], first: str = "first",
    last: str = "last", total: str | None = None,
) -> DataFrame:
    """Entries of each series that no landed page holds, as ranges `first` to `last`, both included.

    A page was asked for entries `first` to `last` and holds as many of them as its body has rows, from
    the first on: an error body holds none. Pages may overlap or come twice. A series is asked for as
    far as its last page reaches, or has `total` entries where that is known.
    """
    held = F.least(F.greatest(F.size(response_rows(F.col(body), row_schema)), F.lit(0)), F.col(last) - F.col(first) + 1)
    pages = df.select(
        *keys, F.col(first).cast("long").alias("first"), F.coalesce(held, F.lit(0)).alias("held"),
        F.greatest(F.col(last), F.col(total) if total else F.lit(0)).cast("long").alias("last"),
    )
    landed = pages.select(*keys, "first", (F.col("first") + F.col("held")).alias("until"))
    asked = pages.groupBy(*keys).agg(F.lit(1).cast("long").alias("first"), (F.max("last") + 1).alias("until"))
    gaps = difference(asked, landed, keys)
    return gaps.select(*keys, "first", (F.col("until") - 1).alias("last"))


def select_series(
    df: DataFrame, stat: str, cycle: str, start: str, end: str, item: str = ""
) -> DataFrame:
    """Rows of one statistical table (`stat_code`), of one `cycle`, from `start` to `end` inclusive.

    Time codes of one cycle have one length and sort as text. No `item` means every item.
    """
    chosen = (
        (F.col("stat_code") == stat)
        & (F.col("cycle") == cycle)
        & F.col("time").between(start, end)
    )
    if item:
        chosen &= F.col("item_code") == item
    return df.filter(chosen)
