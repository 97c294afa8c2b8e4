"""ROUND on doubles, halves away from zero of the scaled binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# From here on a double has no fraction left
_WHOLE = float(2**52)


def round_half_away(column: Column, digits: int = 0) -> Column:
    """Scale, round the scaled double, scale back.

    Spark's `round` works on the shortest decimal text (1.005 -> 1.01); the published
    numbers come from the binary value (1.005 * 100 = 100.49999... -> 1.0).
    """
    scale = F.lit(10.0**digits)
    scaled = F.abs(column) * scale
    whole = F.floor(scaled).cast("double")
    up = F.when(scaled - whole >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0))
    rounded = F.signum(column) * (whole + up) / scale
    return F.when(scaled < F.lit(_WHOLE), rounded).otherwise(column)
