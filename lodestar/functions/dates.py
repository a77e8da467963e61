"""Business days, release times and period labels as closed forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A Monday; a release after CLOSE local time counts on the next business day.
EPOCH, CLOSE = "1969-12-29", "16:00"


def weekdays_before(d: Column) -> Column:
    """Weekdays from EPOCH to the day before d."""
    n = F.datediff(d, F.lit(EPOCH).cast("date"))
    return (F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))).cast("long")


def business_days(a: Column, b: Column) -> Column:
    """Weekdays in [a, b)."""
    return weekdays_before(b) - weekdays_before(a)


def business_days_inclusive(a: Column, b: Column) -> Column:
    return business_days(a, F.date_add(b, 1))


def business_days_between(a: Column, b: Column) -> Column:
    """Weekdays strictly between a and b."""
    return F.greatest(F.lit(0), business_days(F.date_add(a, 1), b))


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def on_business_day(d: Column) -> Column:
    """d, or the Monday after a weekend."""
    return F.date_add(d, F.when(is_weekend(d), 7 - F.weekday(d)).otherwise(0))


def release_day(at_utc: Column, zone: Column) -> Column:
    """The business day on which a release can be used: the next one after the close in its own zone."""
    local = F.from_utc_timestamp(at_utc, zone)
    day = local.cast("date")
    late = F.date_format(local, "HH:mm:ss.SSSSSS") > F.lit(CLOSE + ":00.000000")
    return on_business_day(F.date_add(day, F.when(late & ~is_weekend(day), 1).otherwise(0)))


def saturday_on_or_before(d: Column) -> Column:
    return F.date_sub(d, F.pmod(F.weekday(d) - 5, F.lit(7)))


def thursday_after(d: Column) -> Column:
    return F.date_add(d, F.pmod(2 - F.weekday(d), F.lit(7)) + 1)


def period_label(d: Column, frequency: Column) -> Column:
    return F.when(frequency == "monthly", F.date_format(d, "yyyy-MM")).otherwise(F.date_format(d, "yyyy-MM-dd"))


def quarter_index(d: Column) -> Column:
    return F.year(d) * 4 + F.quarter(d)


def local_time_utc(d: Column, time: str = "08:30", zone: str = "America/New_York") -> Column:
    return F.to_utc_timestamp(F.concat(d.cast("string"), F.lit(f" {time}:00")).cast("timestamp"), zone)
