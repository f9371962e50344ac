"""Predicates, flags and text cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text that must equal the source system's for results to match.
PLACEHOLDER_PHONES = ("0000000", "00000000", "000000000", "0000000000", "#")
PHONE_PUNCTUATION = r"-|\+|\s|#"
DISPATCH_REASON = "OUTCALL分配"
NO_ORDER = -1


def code_is(col: str, code: str) -> Column:
    """Case-blind code equality."""
    return F.upper(F.col(col)) == code


def trimmed_code_is(col: str, code: str) -> Column:
    return F.upper(F.trim(F.col(col))) == code


def mentions(col: str, text: str) -> Column:
    """Case-blind substring test."""
    return F.upper(F.col(col)).contains(text)


def is_not(col: str, sentinel: object) -> Column:
    """Differs from a sentinel; NULL does not pass."""
    return F.col(col) != sentinel


def is_none_of(col: str, sentinels: Sequence[object]) -> Column:
    return ~F.col(col).isin(list(sentinels))


def not_before(late: str, early: str) -> Column:
    """Instant order, equality allowed."""
    return F.col(late) >= F.col(early)


def on_later_day(late: str, early: str) -> Column:
    """Strict day order."""
    return F.to_date(F.col(late)) > F.to_date(F.col(early))


def in_label_range(col: str, lo: float, hi: float | None = None) -> Column:
    """``lo <= col`` and, with ``hi``, ``col < hi``."""
    above = F.col(col) >= lo
    return above if hi is None else above & (F.col(col) < hi)


def strip_marks(col: Column | str, pattern: str = PHONE_PUNCTUATION) -> Column:
    """Phone number without its punctuation."""
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, pattern, "")


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is NULL."""
    return F.when(cond, 1).otherwise(0)


def yes_no(cond: Column) -> Column:
    return F.when(cond, "yes").otherwise("no")


def zero_if_null(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(0))


def busy_keys(df: DataFrame, key: str, more_than: int) -> DataFrame:
    """Keys with more than so many rows, with their row count ``nums``."""
    return df.groupBy(key).agg(F.count("*").alias("nums")).where(F.col("nums") > more_than)
