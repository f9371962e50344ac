"""Time arithmetic on wall-clock timestamps (``timestamp_ntz``).

All functions take and return Columns built from JVM functions, so they stay in
generated code and never look at the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3600
DAY = 24 * HOUR


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def wall_clock(x: Column | str) -> Column:
    """Typed boundary: zoned timestamps, dates and ISO text become ``timestamp_ntz``.

    Text that does not parse becomes NULL instead of failing the job.
    """
    return _c(x).try_cast("timestamp_ntz")


def instant(text: str) -> Column:
    """A timestamp literal from ISO text."""
    return F.lit(text).cast("timestamp_ntz")


def epoch_seconds(x: Column | str) -> Column:
    """Whole seconds since 1970-01-01 on the wall clock, rounded down."""
    t = wall_clock(x)
    return epoch_hours(x) * HOUR + F.minute(t) * 60 + F.second(t)


def epoch_hours(x: Column | str) -> Column:
    t = wall_clock(x)
    return epoch_days(x) * 24 + F.hour(t)


def epoch_days(x: Column | str) -> Column:
    return F.unix_date(F.to_date(wall_clock(x))).cast("bigint")


def hour_of_day(x: Column | str) -> Column:
    return F.hour(_c(x))


def weekday(x: Column | str) -> Column:
    """Day of the week with Sunday = 0 … Saturday = 6."""
    return F.dayofweek(_c(x)) - 1


def second_floor(x: Column | str) -> Column:
    return F.date_trunc("second", _c(x)).cast("timestamp_ntz")


def hour_floor(x: Column | str) -> Column:
    return F.date_trunc("hour", _c(x)).cast("timestamp_ntz")


def minus_hours(x: Column | str, hours: int) -> Column:
    """``x`` less a fixed number of 60-minute hours, the fraction of a second dropped."""
    return second_floor(x) - F.make_dt_interval(hours=F.lit(hours))


def minus_days(x: Column | str, days: int) -> Column:
    """Calendar day ``days`` before the day of ``x``."""
    return F.date_sub(F.to_date(_c(x)), days)


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """``later - earlier`` in seconds, both taken to the whole second first."""
    return epoch_seconds(later) - epoch_seconds(earlier)


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    return seconds_between(later, earlier) / 60


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return seconds_between(later, earlier) / HOUR


def same_day_flag(a: Column | str, b: Column | str) -> Column:
    return F.when(F.datediff(_c(a), _c(b)) == 0, 1).otherwise(0)


def compact_date(x: Column | str) -> Column:
    """``yyyyMMdd`` text as a date; NULL where the text is no date."""
    return F.try_to_timestamp(_c(x), F.lit("yyyyMMdd")).cast("date")


def gap_score(snapshot: Column | str, event: Column | str, penalty: int = 1_000_000) -> Column:
    """Seconds from snapshot to event; a snapshot after the event pays ``penalty`` on top."""
    past = seconds_between(event, snapshot)
    return F.when(_c(snapshot) <= _c(event), past).otherwise(-past + penalty)
