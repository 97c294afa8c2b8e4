"""Labels and bands the dashboard groups by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.functions.clock import monday_first, sunday_first

# Fixed value: an invisible character; more of it sorts later, which keeps text labels
# in calendar (or intensity) order.
ZERO_WIDTH = "\u200b"

# Day names from Monday, and the rain bands with their upper bounds in mm.
DAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
RAIN_BANDS = (
    (1, "Dry"),
    (5, "Light rain (1\u20135 mm)"),
    (15, "Moderate rain (5\u201315 mm)"),
    (None, "Heavy rain (15+ mm)"),
)
DRY_BELOW_MM = RAIN_BANDS[0][0]


def weekday_label(ts: Column) -> Column:
    """Mon ... Sun, each behind as many zero-width characters as days since Monday."""
    name = F.element_at(F.array(*[F.lit(d) for d in DAYS]), monday_first(ts))
    return F.concat(F.repeat(F.lit(ZERO_WIDTH), F.weekday(ts)), name)


def numbered_weekday(ts: Column) -> Column:
    """1 Mon ... 7 Sun."""
    name = F.element_at(F.array(*[F.lit(d) for d in DAYS]), monday_first(ts))
    return F.concat_ws(" ", monday_first(ts).cast("string"), name)


def hour_label(ts: Column) -> Column:
    """00h ... 23h."""
    return F.concat(F.lpad(F.hour(ts).cast("string"), 2, "0"), F.lit("h"))


def day_type(day: Column) -> Column:
    return F.when(sunday_first(day).isin(0, 6), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def rain_band(millimetres: Column) -> Column:
    """Band of a day's rain. An unknown amount lands in the last band."""
    last = len(RAIN_BANDS) - 1
    band = F.lit(ZERO_WIDTH * last + RAIN_BANDS[last][1])
    for rank in reversed(range(last)):
        limit, name = RAIN_BANDS[rank]
        band = F.when(millimetres < F.lit(limit), F.lit(ZERO_WIDTH * rank + name)).otherwise(band)
    return band
