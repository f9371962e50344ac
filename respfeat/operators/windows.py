"""Sums over trailing windows without forming pairs.

Time is cut into cells (clock hours, or calendar days). With hour alignment an
anchor in hour ``c`` sees the whole hours ``c-24N+1 … c-1`` and, of hour
``c-24N``, the seconds from its own second less ``N*86400`` on. So every sum over
the window is

    a RANGE frame over per-hour sums  +  a suffix sum inside one single hour.

Rows are first folded to one per key and second with map-side combining. After
that a key holds at most 3,600 rows per hour, and the frame over its hours at
most one row per hour of the data's time span, however many raw rows it had: a
key with a third of the data costs the same per task as any other.
With day alignment the window is whole days and only the frame is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respfeat.functions import timefx as tx

ALIGNS = ("hour", "day")
CELL, SEC = "_cell", "_sec"


def cells_per_day(align: str) -> int:
    if align not in ALIGNS:
        raise ValueError(f"align must be one of {ALIGNS}, not {align!r}")
    return 24 if align == "hour" else 1


def time_columns(ts: str, align: str) -> dict[str, Column]:
    """The cell number and the second (for days: the cell again) of a timestamp."""
    if align == "day":
        return {CELL: tx.epoch_days(ts), SEC: tx.epoch_days(ts)}
    return {CELL: tx.epoch_hours(ts), SEC: tx.epoch_seconds(ts)}


def hour_of(cell: Column | str) -> Column:
    return F.pmod(F.col(cell) if isinstance(cell, str) else cell, F.lit(24))


def window_sums(
    rows: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    days: int,
    align: str = "hour",
    same_hour: bool = False,
    carry: str | None = None,
) -> DataFrame:
    """For each anchor the sum of each measure over its trailing window.

    ``rows`` has the keys, ``_cell``, ``_sec``, numeric measures and the flag
    ``_anchor``; rows that are anchors only have measures of 0. Returns the keys,
    ``_cell``, ``_sec`` and the sums, one row per distinct anchor second, 0 where no
    history is seen. ``carry`` names a column whose distinct values among the
    anchors of a second (timestamps: at most a million) come along as an array.
    """
    keys, measures = list(keys), list(measures)
    span = days * cells_per_day(align)
    along = [F.collect_set(F.when(F.col("_anchor"), F.col(carry))).alias(carry)] if carry else []
    carried = [carry] if carry else []
    sums = [F.sum(m).alias(m) for m in measures]

    per_second = rows.groupBy(*keys, CELL, SEC).agg(F.bool_or("_anchor").alias("_anchor"), *along, *sums)
    hour_key = [hour_of(CELL)] if same_hour and align == "hour" else []
    if align == "day":
        frame = Window.partitionBy(*keys).orderBy(CELL).rangeBetween(-span, -1)
        return per_second.withColumns({m: _or_zero(F.sum(m).over(frame)) for m in measures}).where(
            "_anchor"
        ).select(*keys, CELL, SEC, *carried, *measures)

    frame = Window.partitionBy(*keys, *hour_key).orderBy(CELL).rangeBetween(1 - span, -1)
    whole = (
        per_second.groupBy(*keys, CELL)
        .agg(F.bool_or("_anchor").alias("_anchor"), *sums)
        .withColumns({f"_whole_{m}": _or_zero(F.sum(m).over(frame)) for m in measures})
        .where("_anchor")
        .select(*keys, CELL, *[f"_whole_{m}" for m in measures])
    )
    # Each anchor asks in the hour where its window opens; descending order makes
    # the sum from its second on a running one.
    zeros = [F.lit(0).cast(per_second.schema[m].dataType).alias(m) for m in measures]
    questions = per_second.where("_anchor").select(
        *keys,
        (F.col(CELL) - span).alias(CELL),
        (F.col(SEC) - days * tx.DAY).alias(SEC),
        F.col(SEC).alias("_asked_by"),
        *carried,
        *zeros,
    )
    nobody = [F.lit(None).cast(questions.schema[c].dataType).alias(c) for c in ("_asked_by", *carried)]
    suffix = (
        Window.partitionBy(*keys, CELL)
        .orderBy(F.col(SEC).desc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    edge = (
        per_second.select(*keys, CELL, SEC, *nobody, *measures)
        .unionByName(questions)
        .withColumns({f"_edge_{m}": F.sum(m).over(suffix) for m in measures})
        .where(F.col("_asked_by").isNotNull())
        .select(
            *keys,
            (F.col(CELL) + span).alias(CELL),
            F.col("_asked_by").alias(SEC),
            *carried,
            *[f"_edge_{m}" for m in measures],
        )
    )
    return edge.join(whole, [*keys, CELL]).select(
        *keys, CELL, SEC, *carried, *[(F.col(f"_whole_{m}") + F.col(f"_edge_{m}")).alias(m) for m in measures]
    )


def window_moments(
    rows: DataFrame, keys: Sequence[str], value: str, days: int, align: str = "hour", same_hour: bool = False
) -> DataFrame:
    """Mean and sum of squared deviations of the values in each anchor's window.

    ``rows`` as for ``window_sums``, with the value, which may be NULL. Values are folded to
    (count, mean, squares) per hour, and per second for the hour where a window opens; a
    window joins its own parts only, at most 24 a day and 3,600, however many rows it
    has: M2 = sum of M2_i + n_i (mean_i - mean)^2. So no digits are lost to values
    outside the window, and a NaN or infinity touches no window but those that hold it.
    """
    keys = list(keys)
    span = days * cells_per_day(align)
    n = F.count(value)
    parts = [n.alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * n).alias("m2")]
    part = F.when(F.col("n") > 0, F.struct("n", "mean", "m2"))
    hour_key = [hour_of(CELL)] if same_hour and align == "hour" else []
    first = 1 - span if align == "hour" else -span
    frame = Window.partitionBy(*keys, *hour_key).orderBy(CELL).rangeBetween(first, -1)
    whole = (
        rows.groupBy(*keys, CELL).agg(F.bool_or("_anchor").alias("_anchor"), *parts)
        .withColumn("_parts", F.collect_list(part).over(frame)).where("_anchor").select(*keys, CELL, "_parts")
    )
    asked = rows.where("_anchor").select(*keys, CELL, SEC).distinct().join(whole, [*keys, CELL])
    if align == "hour":
        opening = rows.where(F.col(value).isNotNull()).groupBy(*keys, CELL, SEC).agg(*parts)
        opening = opening.groupBy(*keys, (F.col(CELL) + span).alias(CELL)).agg(
            F.collect_list(F.struct(F.col(SEC).alias("s"), "n", "mean", "m2")).alias("_open")
        )
        start = F.col(SEC) - days * tx.DAY
        late = F.transform(F.filter("_open", lambda x: x["s"] >= start), lambda x: F.struct(x["n"], x["mean"], x["m2"]))
        none = F.array().cast(asked.schema["_parts"].dataType)
        asked = asked.join(opening, [*keys, CELL], "left").withColumn("_parts", F.concat("_parts", F.coalesce(late, none)))
    zero = F.lit(0.0)
    count = F.aggregate("_parts", F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    total = F.aggregate("_parts", zero, lambda a, x: a + x["n"] * x["mean"])
    mean = F.col("_mean")
    squares = F.aggregate("_parts", zero, lambda a, x: a + x["m2"] + x["n"] * (x["mean"] - mean) * (x["mean"] - mean))
    found = asked.where(count > 0).withColumn("_mean", total / count)
    return found.select(*keys, SEC, "_mean", squares.alias("_m2"))


def _or_zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0))
