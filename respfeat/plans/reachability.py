"""From the call log to workable hours per hotel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from respfeat.operators import calls as op
from respfeat.sources.tables import day_range


def call_reachability(
    calls: DataFrame,
    hotel_phones: DataFrame,
    first_day: str,
    run_date: str,
    connected: Column | None = None,
    threshold: float = op.WORK_THRESHOLD,
) -> DataFrame:
    """Workable hours of each phone from the outgoing order calls of the period,
    with the hotels that have this phone."""
    period = op.outbound_calls(day_range(calls, first_day, run_date))
    hours = op.workable_hours(
        period, "dnis_no", "time_in", op.answered() if connected is None else connected, threshold
    )
    return op.attach_hotel(hours, "dnis_no", hotel_phones)


def call_validation(
    calls: DataFrame, first: tuple[str, str], second: tuple[str, str], connected: Column | None = None
) -> DataFrame:
    """Rates of a first period next to the outcome of each call of a second one."""
    connected = op.answered() if connected is None else connected
    train = op.outbound_calls(day_range(calls, *first))
    later = op.outbound_calls(day_range(calls, *second))
    stats = op.connect_stats(train, "dnis_no", "time_in", connected)
    return op.holdout_scores(stats, later, "dnis_no", "time_in", connected)
