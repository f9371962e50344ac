"""Outcall response time: base table, history features, room-status match."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respfeat.functions.columns import keep_renamed
from respfeat.functions.stats import EIGHT_STATS, FIVE_STATS
from respfeat.operators import orders as op
from respfeat.operators.assemble import assemble, blank_unless, require
from respfeat.operators.nearest import nearest_match
from respfeat.operators.profile import hour_profiles
from respfeat.operators.trailing import GROUP_ROWS, Block, trailing_features
from respfeat.session import scratch_path
from respfeat.sources.sinks import full_refresh
from respfeat.sources.tables import day_range, since, snapshot

SHORT = ("hour_7", "week_7")
LONG = ("hour_30", "month_30")


def blocks(basis: str, names: Sequence[str], stats: Sequence[str]) -> list[Block]:
    """``duration_<basis>_<name>`` for names like ``hour_7`` or ``month_30``."""
    return [
        Block(f"duration_{basis}_{n}", int(n.split("_")[1]), n.startswith("hour"), tuple(stats)) for n in names
    ]


def outcall_base(
    process_log: DataFrame,
    orders: DataFrame,
    hotels: DataFrame,
    supplier_hotels: DataFrame,
    first_day: str,
    run_date: str,
    version: int = 3,
    confirm_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Orders with dispatch and confirmation time and a clean label."""
    columns = confirm_columns or (op.CONFIRM_COLUMNS_V1 if version == 1 else op.CONFIRM_COLUMNS)
    dispatch = op.dispatch_time(day_range(process_log, first_day))
    extract = op.order_extract(orders, first_day)
    confirmed = op.confirm_time(extract, snapshot(hotels, run_date), columns)
    supplied = op.attach_supplier(confirmed, snapshot(supplier_hotels, run_date))
    return op.clean_outcall_labels(op.response_duration(dispatch, supplied, version), version)


def outcall_features(base: DataFrame, version: int = 3, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Base rows with 7- and 30-day history by hotel. ``base`` is read several times,
    so pass a written table.

    1: day windows per order and pooled hour profiles, rows need all blocks.
    2: five figures per block, all rows stay.
    3: eight figures, rows need all 30-day blocks; 7-day ones come all or none.
    """
    if version == 1:
        return _profile_features(base, group_rows)
    stats = FIVE_STATS if version == 2 else EIGHT_STATS
    names = (*SHORT, *LONG)
    dispatch = trailing_features(
        base, "hotel", "processtime", "duration", blocks("htl_process", names, stats), group_rows=group_rows
    )
    ordered = trailing_features(
        base, "hotel", "orderdate", "duration", blocks("htl_ord", names, stats), group_rows=group_rows
    )
    wide = assemble(
        base, [(dispatch, ("hotel", "processtime"), "left"), (ordered, ("hotel", "orderdate"), "left")]
    )
    if version == 2:
        return wide
    long = [f"duration_htl_{b}_{n}" for b in ("process", "ord") for n in LONG]
    short = [f"duration_htl_{b}_{n}" for b in ("process", "ord") for n in SHORT]
    return blank_unless(require(wide, long), short)


def _profile_features(base: DataFrame, group_rows: int) -> DataFrame:
    per_order = trailing_features(
        base, "hotel", "processtime", "duration",
        [Block(f"duration_month_{d}", d, stats=FIVE_STATS) for d in (7, 30)],
        align="day", group_rows=group_rows,
    )
    links = [(per_order, ("hotel", "processtime"), "inner")]
    for ts, hour, name in (("orderdate", "ord_hour", "ord"), ("processtime", "process_hour", "process")):
        prefixes = {d: f"duration_hour_{name}_{d}" for d in (7, 30)}
        found = hour_profiles(base, "hotel", "processtime", ts, "duration", prefixes, hour)
        # Rows need the profile of either window, so their hour must be seen in both.
        seen = reduce(lambda a, c: a & c, [F.col(f"{p}_numsord") > 0 for p in prefixes.values()])
        links.append((found.where(seen).drop(*[f"{p}_numsord" for p in prefixes.values()]), ("hotel", hour), "inner"))
    wide = assemble(base, links)
    return require(wide, ["duration_month_7", "duration_month_30"])


def outcall_table(
    process_log: DataFrame,
    orders: DataFrame,
    hotels: DataFrame,
    supplier_hotels: DataFrame,
    first_day: str,
    run_date: str,
    version: int = 3,
    confirm_columns: Sequence[str] | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Source tables to feature table; the clean base is written once in between."""
    base = outcall_base(
        process_log, orders, hotels, supplier_hotels, first_day, run_date, version, confirm_columns
    )
    base = full_refresh(base, scratch_path(base.sparkSession, "outcall-base"))
    return outcall_features(base, version, group_rows)


def room_features(
    room_status: DataFrame, orders: DataFrame, dispatch: DataFrame, status_from: str, orders_from: str
) -> DataFrame:
    """For each room and arrival day the room status nearest to a dispatch time."""
    ordered = keep_renamed(
        since(orders, "orderdate", orders_from), {"orderid": "orderid", "room": "roomid", "arrival": "arrival"}
    ).withColumn("effectdate", F.date_format("arrival", "yyyyMMdd"))
    dispatched = since(dispatch, "processtime", orders_from).select("orderid", "processtime")
    events = ordered.join(dispatched, "orderid")
    return nearest_match(
        day_range(room_status, status_from), events, ["roomid", "effectdate"], "createtime", "processtime",
        "orderid",
    )
