"""Rounding of readings before they are sent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLITTER = 2.0**27 + 1
INTEGERS_BELOW = 2.0**53


def round_binary(value: Column, digits: int) -> Column:
    """The decimal of `digits` places nearest to the stored binary value, ties to even: how senders
    written in Python round.

    Spark's `round` works on the printed decimal: 2.00015 is stored a little below and goes down
    here, up there. Scaling loses just the bits that decide, so the error of the product is computed
    with it, from the two halves of the value, each short enough to be scaled exactly.
    """
    scale = 10.0**digits
    scaled = value * scale
    high = value * SPLITTER - (value * SPLITTER - value)
    error = (high * scale - scaled) + (value - high) * scale
    below = F.floor(scaled)
    from_tie = (scaled - below) - 0.5
    at_tie = (error > 0) | ((error == 0) & (below % 2 != 0))
    up = (from_tie > 0) | ((from_tie == 0) & at_tie)
    nearest = (below + up.cast("int")).cast("double") / scale
    # Beyond, doubles lie further apart than the decimals: nothing to round, nor for NaN.
    return F.when(F.abs(value) < INTEGERS_BELOW / scale, nearest).otherwise(value)
