"""Call reachability: how often a number answers in each hour of the day, and
which hours are worth calling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respfeat.functions import cleaning as cl
from respfeat.functions.stats import conditional_count
from respfeat.operators.ranking import sorted_by, with_neighbours
from respfeat.operators.skew import spread_join

WORK_THRESHOLD = 0.6


def answered(duration: str = "callduration", more_than: float = 0.0) -> Column:
    """A call longer than ``more_than``; NULL durations do not count as answered."""
    return F.col(duration) > more_than


def outbound_calls(calls: DataFrame, calltype: str = "calltype", orderid: str = "orderid") -> DataFrame:
    """Outgoing calls that belong to an order."""
    return calls.where(cl.code_is(calltype, "O") & cl.is_not(orderid, cl.NO_ORDER))


def connect_stats(
    calls: DataFrame,
    phone: str,
    ts: str,
    connected: Column,
    unconnected: Column | None = None,
) -> DataFrame:
    """Per (phone, hour of day): answered and unanswered calls, their rate, and the
    phone's calls over all hours.

    ``unconnected`` defaults to every other row; with a code of its own, rows of
    further codes count only towards the phone's total. One scan: the total is a
    window sum over at most 24 rows per phone.
    """
    yes = F.coalesce(connected, F.lit(False))
    no = ~yes if unconnected is None else unconnected
    hourly = calls.groupBy(phone, F.hour(ts).alias("time_quantum")).agg(
        conditional_count(yes).alias("nums_conn"),
        conditional_count(no).alias("nums_noconn"),
        F.count("*").alias("_calls"),
    )
    total = F.sum("_calls").over(Window.partitionBy(phone))
    return hourly.where(F.col(phone).isNotNull()).select(
        phone,
        "time_quantum",
        "nums_conn",
        "nums_noconn",
        F.try_divide(F.col("nums_conn"), F.col("nums_noconn") + F.col("nums_conn")).alias("con_rate"),
        total.alias("phone_call_nums"),
    )


def hour_values(stats: DataFrame) -> DataFrame:
    """Hours of day seen anywhere."""
    return stats.select("time_quantum").distinct()


def phone_values(stats: DataFrame, phone: str) -> DataFrame:
    """Each phone with its total."""
    return stats.select(phone, "phone_call_nums").distinct()


def hour_grid(stats: DataFrame, phone: str, keep: Sequence[str] = ("phone_call_nums",)) -> DataFrame:
    """Every phone with every hour seen anywhere.

    The hours, at most 24 of them, come in as one array from a scalar subquery and
    are exploded per phone, so the grid needs no product join.
    """
    hours = stats.agg(F.sort_array(F.collect_set("time_quantum")))
    return stats.select(phone, *keep).distinct().withColumn("time_quantum", F.explode(hours.scalar()))


def densify(stats: DataFrame, phone: str, fill: bool = True) -> DataFrame:
    """The statistics on the whole grid; hours without calls count 0, or NULL with
    ``fill=False``.

    A phone's rows, at most one per hour of day, are gathered into one map and looked up for
    each hour of the grid: one pass over the statistics besides the set of hours.
    """
    figures = ["nums_conn", "nums_noconn", "con_rate"]
    hours = stats.agg(F.sort_array(F.collect_set("time_quantum")))
    entry = F.when(F.col("time_quantum").isNotNull(), F.struct("time_quantum", F.struct(*figures)))
    seen = stats.groupBy(phone).agg(
        F.first("phone_call_nums").alias("phone_call_nums"), F.map_from_entries(F.collect_list(entry)).alias("_seen")
    )
    full = seen.withColumn("time_quantum", F.explode(hours.scalar())).withColumn("_at", F.try_element_at("_seen", "time_quantum"))
    full = full.withColumns({c: F.col("_at")[c] for c in figures})
    if fill:
        full = full.withColumns({c: cl.zero_if_null(c) for c in figures})
    return full.select(phone, "time_quantum", *figures, "phone_call_nums")


def mark_workable(full: DataFrame, phone: str, threshold: float = WORK_THRESHOLD) -> DataFrame:
    """``is_work`` = 1 where the hour's own rate reaches the threshold, or where both
    neighbouring hours exist and reach it. Neighbours are adjacent seen hours; there
    is none before the first or after the last."""
    near = with_neighbours(full, phone, "time_quantum", {"con_rate": ("_next_rate", "_last_rate")})
    own = F.col("con_rate") >= threshold
    both = (F.col("_next_rate") >= threshold) & (F.col("_last_rate") >= threshold)
    return near.withColumn("is_work", cl.flag(own | both)).drop("_next_rate", "_last_rate")


def attach_hotel(
    workable: DataFrame,
    phone: str,
    hotels: DataFrame,
    hotel: str = "hotel",
    telephone: str = "telephone",
    placeholders: Sequence[str] = cl.PLACEHOLDER_PHONES,
    marks: str = cl.PHONE_PUNCTUATION,
    hotel_marks: str | None = None,
    share: float | None = None,
) -> DataFrame:
    """Hotels by phone number, both numbers stripped of punctuation. With ``share``, numbers with
    that share of the rows are spread over tasks."""
    book = (
        hotels.where(cl.is_none_of(telephone, placeholders))
        .select(F.col(hotel), F.col(telephone).alias("_tel"))
        .distinct()
        .select(hotel, cl.strip_marks("_tel", hotel_marks or marks).alias("_number"))
    )
    numbered = workable.withColumn("_number", cl.strip_marks(phone, marks))
    if share:
        return spread_join(numbered, book, [("_number", "_number")], share=share).drop("_number")
    return numbered.join(book, "_number").drop("_number")


def holdout_scores(
    stats: DataFrame, later_calls: DataFrame, phone: str, ts: str, connected: Column
) -> DataFrame:
    """Each later call with the earlier period's rate for its phone and hour."""
    later = later_calls.select(
        phone, ts, F.hour(ts).alias("time_quantum"), cl.flag(connected).alias("isconn")
    )
    return stats.select(phone, "time_quantum", "con_rate").join(later, [phone, "time_quantum"]).select(
        phone, ts, "time_quantum", "con_rate", "isconn"
    )


def workable_hours(
    calls: DataFrame, phone: str, ts: str, connected: Column, threshold: float = WORK_THRESHOLD
) -> DataFrame:
    """Connect statistics, grid and rule in one."""
    stats = connect_stats(calls, phone, ts, connected)
    return mark_workable(densify(stats, phone), phone, threshold)


def sorted_stats(stats: DataFrame, phone: str) -> DataFrame:
    return sorted_by(stats, phone, "time_quantum")
