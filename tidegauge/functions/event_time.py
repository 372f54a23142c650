"""Epoch milliseconds and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Years 1 to 9999. A reading outside is garbage (often nanoseconds sent as milliseconds); as a
# moment it would overflow, or push the watermark past every real row.
FIRST_MILLI = -62_135_596_800_000
LAST_MILLI = 253_402_300_799_999


def millis_to_time(millis: Column) -> Column:
    """Epoch milliseconds as a timestamp; NULL outside of years 1 to 9999."""
    return F.when(millis.between(FIRST_MILLI, LAST_MILLI), F.timestamp_millis(millis))


def time_to_millis(at: Column) -> Column:
    """A timestamp as epoch milliseconds, fractions cut downwards."""
    return F.unix_millis(at)


def stamp_now() -> Column:
    """The current time as epoch milliseconds: one value for a whole batch or micro-batch."""
    return F.unix_millis(F.current_timestamp())
