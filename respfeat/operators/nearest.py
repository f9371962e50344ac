"""Nearest-in-time match between snapshots and events of the same key.

A snapshot at or before the event scores the seconds between them, a later one
scores those seconds plus a penalty. The lowest score wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respfeat.functions import timefx as tx

#: Seconds of a day.
DAY = 86_400


def nearest_match(
    snapshots: DataFrame,
    events: DataFrame,
    on: Sequence[str],
    snapshot_ts: str,
    event_ts: str,
    event_id: str,
    per: Sequence[str] | None = None,
    penalty: int = 1_000_000,
) -> DataFrame:
    """Best (snapshot, event) pair per key, or per ``per`` columns of the event.

    Of all snapshots of a key an event can only win with the last one before its
    second, the first one after it, or one within it. So snapshots and events are put
    on one time line per key, folded to one row per second (the earliest snapshot; equal
    times by their remaining columns), and each second looks up its neighbours: at most
    three candidates per event instead of every pair of the key.

    Lookups stay within days: a day of a key has at most 86,400 seconds, however many rows
    it has. The first and last snapshot of each day are folded map-side, and only these meet
    per key, to be handed to the days after and before. So a key with all snapshots is
    spread over its days. Ties go to the earlier snapshot, then the lower event id.

    Returns the snapshot columns, ``event_ts``, ``event_id`` and ``dur_time``.
    """
    on = list(on)
    per = on if per is None else list(per)
    snap_cols = snapshots.columns
    # Keys with a NULL match nothing; left in, they would all meet in one task.
    snapshots, events = snapshots.dropna(subset=on), events.dropna(subset=on)
    payload = [c for c in snap_cols if c not in {*on, snapshot_ts}]
    snap = F.struct(F.col(snapshot_ts).alias("t"), *payload)
    kept = snapshots.where(F.col(snapshot_ts).isNotNull())
    asked = events.where(F.col(event_ts).isNotNull()).withColumn("_s", tx.epoch_seconds(event_ts))
    points = kept.select(*on, tx.epoch_seconds(snapshot_ts).alias("_s"), snap.alias("_snap")).unionByName(
        asked.select(*on, "_s"), allowMissingColumns=True
    )
    day = F.floor(F.col("_s") / DAY).alias("_day")
    line = points.groupBy(*on, day, "_s").agg(F.min("_snap").alias("_at"))
    held = F.when(F.col("_at").isNotNull(), F.col("_s"))
    days = line.groupBy(*on, "_day").agg(F.min_by("_at", held).alias("_first"), F.max_by("_at", held).alias("_last"))

    # Both directions as running frames: a frame to the end would be recomputed for each row.
    def running(value: str, keys: list[str], order: Column) -> Column:
        frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.last(value, ignorenulls=True).over(frame)

    carried = days.select(
        *on, "_day", running("_last", on, F.col("_day").asc()).alias("_old"), running("_first", on, F.col("_day").desc()).alias("_new")
    )
    within = [*on, "_day"]
    around = (
        line.withColumns({"_up": running("_at", within, F.col("_s").asc()), "_down": running("_at", within, F.col("_s").desc())})
        .join(carried, within)
        .select(*on, "_s", F.array(F.coalesce("_up", "_old"), F.col("_at"), F.coalesce("_down", "_new")).alias("_near"))
    )
    scored = (
        asked.join(around, [*on, "_s"])
        .withColumn("_snap", F.explode("_near"))
        .where(F.col("_snap").isNotNull())
        .select(
            *on,
            *[c for c in per if c not in on],
            F.struct(
                tx.gap_score(F.col("_snap.t"), F.col(event_ts), penalty).alias("score"),
                F.col("_snap"),
                F.col(event_id).alias("id"),
                F.col(event_ts).alias("at"),
            ).alias("_pair"),
        )
    )
    # min folds map-side; a frequent key sends one pair per task.
    best = scored.groupBy(*dict.fromkeys([*on, *per])).agg(F.min("_pair").alias("_pair"))
    columns = {snapshot_ts: F.col("_pair._snap.t"), **{c: F.col(f"_pair._snap.{c}") for c in payload}}
    return best.select(
        *[F.col(c) if c in on else columns[c].alias(c) for c in snap_cols],
        F.col("_pair.at").alias(event_ts),
        F.col("_pair.id").alias(event_id),
        F.col("_pair.score").alias("dur_time"),
    )
