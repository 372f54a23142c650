"""Mean, maximum and count, in one step or from partial results.

A sum of doubles depends, in its last bits, on the order of the rows, and so on splits, shuffles and
retried tasks. A mean that ends in ...5 just behind the kept digits (a sum of cents over 8 rows, say)
would then round up in one run and down in the next. So no doubles are summed. A reading is split on
fixed grids, whatever the other readings are, and each part is summed as a whole number, which has no
order:

- in ten-thousandths, where that is the reading itself, as sent ones are: as one number up to 2 ** 31
  of them, as the multiple of 2 ** 24 and the rest beyond;
- any other reading below 1e18 as the decimal that its digits spell, to ten places.

The mean is rounded once, half up, from the exact quotient. NaN and infinities give what they give in
any order. Only finite readings of 1e18 and more, which no grid of this size holds next to
ten-thousandths, are summed as doubles; their mean has no decimals to round.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.settings import DIGITS

UNIT = 10**DIGITS
# Whole numbers of doubles end here.
WHOLE_BELOW = 2**53
#: Ten-thousandths below this are summed as they are: no sum of fewer than 2**32 rows can overflow.
SMALL = 2**31
#: Others are summed as two numbers: neither can overflow below 2**34 rows.
LOW_BITS = 24
DECIMAL_BELOW = 1e18
LARGE_MEAN = 1e14
PLACES = 10
ODD = f"decimal(28,{PLACES})"
PARTIALS = ("small", "high", "low", "odd", "beyond", "known", "highest", "rows")


def partial_columns(value: str = "value") -> list[Column]:
    """What one slice of the rows adds to `merged_columns`. A part that no reading has is NULL."""
    x = F.col(value)
    units = F.rint(x * UNIT)
    size, itself = F.abs(units), units / UNIT == x
    large = F.when((size >= SMALL) & (size < WHOLE_BELOW) & itself, units.cast("long"))
    no_grid = ~(F.abs(x) < DECIMAL_BELOW)
    return [
        F.sum(F.when((size < SMALL) & itself, units.cast("long"))).alias("small"),
        F.sum(F.shiftright(large, LOW_BITS)).alias("high"),
        F.sum(large.bitwiseAND(F.lit((1 << LOW_BITS) - 1))).alias("low"),
        F.sum(F.when((~itself | (size >= WHOLE_BELOW)) & ~no_grid, x.cast(ODD))).alias("odd"),
        F.sum(F.when(no_grid, x)).alias("beyond"),
        F.count(value).alias("known"),
        F.max(value).alias("highest"),
        F.count("*").alias("rows"),
    ]


def merged_columns() -> list[Column]:
    """The same results as `stat_columns`, from any cover of the rows by `partial_columns`."""
    return _results(*_merged())


def merged_partials() -> list[Column]:
    """Partial results of a union of slices, from those of the slices."""
    return [column.alias(name) for column, name in zip(_merged(), PARTIALS)]


def _merged() -> list[Column]:
    return [F.max(c) if c == "highest" else F.sum(c) for c in PARTIALS]


def finished() -> list[Column]:
    """Results from columns that hold the partial results of all rows, named as `partial_columns` does."""
    return _results(*map(F.col, PARTIALS))


def stat_columns(value: str = "value") -> list[Column]:
    """Mean and maximum skip NULL values, the count does not; NaN is the largest value."""
    return _results(*partial_columns(value))


def _half_up(total: Column, parts: Column) -> Column:
    """`total / parts` to the nearest whole number, halves away from zero, in whole numbers:
    floor(|total| / parts + 1/2)."""
    return F.signum(total) * F.call_function("div", 2 * F.abs(total) + parts, 2 * parts)


def _results(
    small: Column, high: Column, low: Column, odd: Column, beyond: Column, known: Column, highest: Column,
    rows: Column,
) -> list[Column]:
    nothing = F.lit(0).cast("long")
    wide = F.coalesce(high, nothing).cast("decimal(28,0)") * (1 << LOW_BITS) + F.coalesce(low, nothing)
    units = wide + F.coalesce(small, nothing)
    count = known.cast("decimal(18,0)")
    # Readings off the grid of ten-thousandths: all in the last place of theirs. A mean too large for
    # a long has no fifth decimal in a double.
    last = 10 ** (PLACES - DIGITS)
    spelled = (odd * 10**PLACES).cast("decimal(38,0)") + (units * last).cast("decimal(38,0)")
    about = spelled.cast("double") / 10.0**PLACES / known
    mean = (
        F.when(known == 0, None)
        .when(beyond.isNotNull(), beyond / known)
        .when(odd.isNotNull() & (F.abs(about) >= LARGE_MEAN), about)
        .when(odd.isNotNull(), _half_up(spelled, count * last) / UNIT)
        .when(high.isNotNull() | (F.abs(small) >= 2**61), _half_up(units, count) / UNIT)
        .otherwise(_half_up(small, known) / UNIT)
    )
    return [mean.alias("avg_value"), F.round(highest, DIGITS).alias("max_value"), rows.alias("cnt")]
