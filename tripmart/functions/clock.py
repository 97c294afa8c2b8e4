"""New York wall-clock time.

Stored times carry no zone. Elapsed time and order are taken from instants, but only for
rows that can touch a daylight-saving switch; every other row uses plain arithmetic.
None of these expressions depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/New_York"



def near_switch(ts: Column) -> Column:
    """A Sunday in the first two weeks of March or November."""
    return F.month(ts).isin(3, 11) & (F.dayofweek(ts) == 1) & (F.dayofmonth(ts) <= 14)


def ny_instant(ts: Column) -> Column:
    """Wall clock in New York -> wall clock in UTC.

    The hour that happens twice in November is read as its second pass (standard time):
    if one hour later still shows the same New York time, that later instant is taken.
    """
    utc = F.convert_timezone(F.lit(ZONE), F.lit("UTC"), ts)
    later = utc + F.expr("INTERVAL 1 HOUR")
    return F.when(F.convert_timezone(F.lit("UTC"), F.lit(ZONE), later) == ts, later).otherwise(utc)


def whole_seconds(ts: Column) -> Column:
    """Seconds since a fixed early date, fraction dropped."""
    since = ts - F.expr("TIMESTAMP_NTZ '0001-01-01 00:00:00'")
    return since.cast("interval second").cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """How many second boundaries lie between two times (0.9 s -> 1.1 s is one)."""
    return whole_seconds(end) - whole_seconds(start)


def elapsed_minutes(start: Column, end: Column) -> Column:
    zoned = near_switch(start) | near_switch(end)
    seconds = F.when(zoned, seconds_between(ny_instant(start), ny_instant(end))).otherwise(
        seconds_between(start, end)
    )
    return seconds.cast("double") / F.lit(60.0)


def is_after(later: Column, earlier: Column) -> Column:
    """Strictly later as an instant; NULL if either side is NULL."""
    zoned = near_switch(earlier) | near_switch(later)
    return F.when(zoned, ny_instant(later) > ny_instant(earlier)).otherwise(later > earlier)


def hour_start(ts: Column) -> Column:
    """The full hour, still without a zone (`date_trunc` would return a zoned value)."""
    past = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts), F.date_part(F.lit("SECOND"), ts)
    )
    return ts - past


def start_of_day(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def sunday_first(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(ts) - F.lit(1)


def monday_first(ts: Column) -> Column:
    """1 = Monday ... 7 = Sunday, as the dashboard counts."""
    return F.weekday(ts) + F.lit(1)


def nanos_to_wall_clock(name: str) -> str:
    """SQL for a count of nanoseconds since 1970 as a timestamp; what is below a microsecond is cut off."""
    micros = f"(({name} - pmod({name}, 1000)) div 1000)"
    return f"timestampadd(MICROSECOND, {micros}, TIMESTAMP_NTZ '1970-01-01 00:00:00')"
