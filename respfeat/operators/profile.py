"""Hour-of-day profiles: the history windows of all anchors of an entity pooled,
then summed up by the hour of the history row.

A history row counts once for each anchor that sees it, so the profile of an early
order contains rows later than that order. It is kept for parity with older
feature tables; the point-in-time blocks are the ones to use.

The pooled pairs are not formed. Rows are folded once, by entity, day, hour and value, and carry
one weight per window length: the number of anchors that see them. Weighted means and quantiles
of all windows then come from running sums over the sorted values. The sums run within buckets of the value,
on top of what lower buckets add up to, so a busy hour is spread over as many tasks
as its values have buckets, and no step depends on the data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respfeat.functions import timefx as tx
from respfeat.functions.stats import QUARTILES
from respfeat.operators.selection import rank_of

#: Buckets to a doubling of the value.
BUCKETS = 16


def _bucket(v: Column) -> Column:
    """A whole number that never falls as the value grows; NaN is the largest value."""
    size = F.floor(F.log2(F.abs(v)) * BUCKETS).cast("double")
    return F.when(F.isnan(v), F.lit(2.0e6)).when(v > 0, F.least(size, F.lit(1.0e6)) + 1.0e5).when(v < 0, -1.0e5 - F.least(size, F.lit(1.0e6))).otherwise(0.0)


def hour_profiles(
    df: DataFrame, entity: str, ts: str, hour_ts: str, value: str, prefixes: Mapping[int, str], hour_name: str, stddev: str = "sample"
) -> DataFrame:
    """Five statistics by (entity, hour of ``hour_ts``) for every window length:
    ``prefixes`` maps days to the prefix of ``<prefix>_<stat>``. A group is there if any of its rows,
    NULL values included, is seen in any window; a window that sees none of its values has NULLs. ``numsord`` tells
    the rows, NULL ones included, that a window sees.
    """
    days = list(prefixes)
    folded = (
        df.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
        # Never NULL, and said so, lest a filter in one use only keep both uses from reading the same shuffled rows.
        .select(F.col(entity).alias("_e"), F.coalesce(tx.epoch_days(ts), F.lit(0)).alias("_day"), F.coalesce(F.hour(hour_ts), F.lit(-1)).alias("_h"), F.col(value).cast("double").alias("_v"))
        .groupBy("_e", "_day", "_h", "_v").agg(F.count("*").alias("_rows"))
    )
    daily = folded.groupBy("_e", "_day").agg(F.sum("_rows").alias("_anchors"))
    for d in days:
        ahead = Window.partitionBy("_e").orderBy("_day").rangeBetween(1, d)
        daily = daily.withColumn(f"_seen{d}", F.coalesce(F.sum("_anchors").over(ahead), F.lit(0)))
    rows = folded.join(daily.where(F.greatest(*[F.col(f"_seen{d}") for d in days], F.lit(0)) > 0).drop("_anchors"), ["_e", "_day"]).select(
        "_e", "_h", "_v", _bucket(F.col("_v")).alias("_b"), *[(F.col("_rows") * F.col(f"_seen{d}")).alias(f"_w{d}") for d in days]
    )
    known = F.col("_v").isNotNull()
    # One shuffle serves the sums of buckets, the running sums inside them, and their join.
    rows = rows.repartition("_e", "_h", "_b")
    sums = [(f"_n{d}", F.sum(F.when(known, F.col(f"_w{d}")).otherwise(0))) for d in days]
    sums += [(f"_s{d}", F.sum(F.when(known & (F.col(f"_w{d}") > 0), F.col(f"_w{d}") * F.col("_v")))) for d in days]
    sums += [(f"_all{d}", F.sum(f"_w{d}")) for d in days]
    buckets = rows.groupBy("_e", "_h", "_b").agg(*[x.alias(n) for n, x in sums])
    group = Window.partitionBy("_e", "_h")
    lower = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(
        "_e", "_h", "_b", *[F.coalesce(F.sum(f"_n{d}").over(lower), F.lit(0)).alias(f"_below{d}") for d in days],
        *[F.sum(f"_n{d}").over(group).alias(f"_n{d}") for d in days], *[F.sum(f"_all{d}").over(group).alias(f"_all{d}") for d in days],
        *[(F.sum(f"_s{d}").over(group) / F.sum(f"_n{d}").over(group)).alias(f"_mean{d}") for d in days],
    )
    up_to = Window.partitionBy("_e", "_h", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.withColumns({f"_upto{d}": F.sum(F.when(known, F.col(f"_w{d}")).otherwise(0)).over(up_to) for d in days})
    met = running.join(buckets, ["_e", "_h", "_b"])
    figures = []
    for d in days:
        held = known & (F.col(f"_w{d}") > 0)
        reached = F.col(f"_below{d}") + F.col(f"_upto{d}")
        off = F.col("_v") - F.col(f"_mean{d}")
        figures += [F.first(f"_n{d}").alias(f"_n{d}"), F.first(f"_all{d}").alias(f"_all{d}"), F.first(f"_mean{d}").alias(f"_mean{d}")]
        figures.append(F.sum(F.when(held, F.col(f"_w{d}") * off * off)).alias(f"_m2{d}"))
        for j, p in enumerate(QUARTILES):
            figures.append(F.min(F.when(held & (reached >= rank_of(p, F.col(f"_n{d}"))), F.col("_v"))).alias(f"_q{d}_{j}"))
    found = met.groupBy("_e", "_h").agg(*figures)
    out = [F.col("_e").alias(entity), F.when(F.col("_h") >= 0, F.col("_h")).alias(hour_name)]
    for d, prefix in prefixes.items():
        freedom = F.col(f"_n{d}") - 1 if stddev == "sample" else F.col(f"_n{d}")
        out += [
            F.col(f"_mean{d}").alias(f"{prefix}_pre"),
            F.when(freedom > 0, F.sqrt(F.col(f"_m2{d}") / freedom)).alias(f"{prefix}_stddev"),
            *[F.col(f"_q{d}_{j}").alias(f"{prefix}_per{25 * (j + 1)}") for j in (2, 1, 0)],
            F.col(f"_all{d}").alias(f"{prefix}_numsord"),
        ]
    return found.select(*out)


def hour_profile(
    df: DataFrame, entity: str, ts: str, hour_ts: str, value: str, days: int, prefix: str, hour_name: str, stddev: str = "sample"
) -> DataFrame:
    """The profile of one window length."""
    return hour_profiles(df, entity, ts, hour_ts, value, {days: prefix}, hour_name, stddev).drop(f"{prefix}_numsord")
