"""Which records count as trips, and which trips count for the marts."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.functions.clock import is_after, start_of_day
from tripmart.paths import PARTITION

# Limits of a plausible trip.
MIN_MINUTES, MAX_MINUTES = 1, 240
MAX_MILES = 100
MAX_FARE = 1000


@dataclass(frozen=True)
class Limits:
    """Bounds of a plausible trip, which a build can set: marts and their tests follow them."""

    min_minutes: float = MIN_MINUTES
    max_minutes: float = MAX_MINUTES
    max_miles: float = MAX_MILES
    max_fare: float = MAX_FARE

    def __post_init__(self):
        wrong = [name for name, bound in asdict(self).items() if not bound >= 0]
        if wrong or self.min_minutes > self.max_minutes:
            raise ValueError(f"limits no trip can meet: {self}")


USUAL = Limits()


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def present(*names: str) -> Column:
    return all_of([F.col(n).isNotNull() for n in names])


def positive(*names: str) -> Column:
    return all_of([F.col(n) > 0 for n in names])


def unknown_or_positive(column: Column) -> Column:
    return column.isNull() | (column > 0)


def times_in_order(pickup: str, dropoff: str) -> Column:
    return present(pickup, dropoff) & is_after(F.col(dropoff), F.col(pickup))


def within_month() -> Column:
    """Picked up in the month the file is for: from its first instant to before the next."""
    first = start_of_day(F.col(PARTITION))
    pickup = F.col("pickup_datetime")
    return (pickup >= first) & (pickup < first + F.expr("INTERVAL 1 MONTH"))


def clean_trip(
    fare: str | None = None,
    has_distance: bool = False,
    *,
    min_minutes: float = MIN_MINUTES,
    max_minutes: float = MAX_MINUTES,
    max_miles: float = MAX_MILES,
    max_fare: float = MAX_FARE,
) -> Column:
    """The rule every mart applies to a staged trip."""
    rules = [within_month(), F.col("trip_duration_minutes").between(min_minutes, max_minutes)]
    if has_distance:
        rules += [positive("trip_distance_miles"), F.col("trip_distance_miles") <= max_miles]
    if fare:
        rules += [positive(fare), F.col(fare) <= max_fare]
    return all_of(rules)
