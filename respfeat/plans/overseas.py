"""Overseas confirmation time: base table and history features by hotel and supplier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from respfeat.functions.stats import EIGHT_STATS, SEVEN_STATS
from respfeat.operators import orders as op
from respfeat.operators.assemble import assemble, join_sparse, require
from respfeat.operators.trailing import GROUP_ROWS, trailing_features
from respfeat.plans.outcall import LONG, SHORT, blocks
from respfeat.session import scratch_path
from respfeat.sources.sinks import full_refresh
from respfeat.sources.tables import snapshot


def overseas_base(
    orders: DataFrame,
    cities: DataFrame,
    hotels: DataFrame,
    operate_times: DataFrame,
    supplier_hotels: DataFrame,
    first_day: str,
    run_date: str,
    columns: Sequence[str] = op.OVERSEAS_COLUMNS,
) -> DataFrame:
    """Overseas orders with supplier reply, supplier and clean labels."""
    extract = op.order_extract(orders, first_day)
    abroad = op.overseas_orders(extract, cities, snapshot(hotels, run_date), columns=columns)
    replied = op.supplier_reply(abroad, snapshot(operate_times, run_date))
    return op.clean_overseas_labels(op.attach_supplier(replied, snapshot(supplier_hotels, run_date)))


def overseas_features(
    base: DataFrame, with_supplier: bool = True, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Base rows with history by hotel, and by supplier where there is one.

    Rows need both 30-day hotel blocks; 7-day and supplier blocks may be missing.
    With suppliers the geometric mean is left out, as in the source's last table.
    """
    stats = SEVEN_STATS if with_supplier else EIGHT_STATS
    hotel = trailing_features(
        base, "hotel", "orderdate", "duration2", blocks("htl_ord", (*SHORT, *LONG), stats), group_rows=group_rows
    )
    wide = assemble(base, [(hotel, ("hotel", "orderdate"), "left")])
    wide = require(wide, [f"duration_htl_ord_{n}" for n in LONG])
    if not with_supplier:
        return wide
    supplier = trailing_features(
        base, "supplierid", "orderdate", "duration2", blocks("supp_ord", LONG, SEVEN_STATS), group_rows=group_rows
    )
    return join_sparse(wide, supplier, ("supplierid", "orderdate"))


def overseas_table(
    orders: DataFrame,
    cities: DataFrame,
    hotels: DataFrame,
    operate_times: DataFrame,
    supplier_hotels: DataFrame,
    first_day: str,
    run_date: str,
    columns: Sequence[str] = op.OVERSEAS_COLUMNS,
    with_supplier: bool = True,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Source tables to feature table; the clean base is written once in between."""
    base = overseas_base(
        orders, cities, hotels, operate_times, supplier_hotels, first_day, run_date, columns
    )
    base = full_refresh(base, scratch_path(base.sparkSession, "overseas-base"))
    return overseas_features(base, with_supplier, group_rows)
