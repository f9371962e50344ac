"""Statistics blocks: names of the figures and the group-by form of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.50, 0.75)
FIVE_STATS = ("pre", "stddev", "per75", "per50", "per25")
SEVEN_STATS = (*FIVE_STATS, "numsord", "preord")
EIGHT_STATS = (*SEVEN_STATS, "geomean")


def geometric_mean(value: Column | str) -> Column:
    """exp of the mean log: logs of non-positive values are left out of the sum but
    their rows stay in the divisor; NULL when no value is positive."""
    v = F.col(value) if isinstance(value, str) else value
    return F.exp(F.sum(F.when(v > 0, F.ln(v))) / F.count("*"))


def stats_block(
    prefix: str,
    value: str,
    days: int,
    which: Sequence[str] = EIGHT_STATS,
    stddev: str = "sample",
) -> list[Column]:
    """Aggregate columns ``<prefix>_<stat>`` for ``groupBy().agg``; all of them fold
    map-side, so a hot key costs one small buffer per task. Quartiles of a group of more than about
    10,000 rows are approximate, to one part in 10,000 of the rank; those of trailing blocks are exact."""
    spread = F.stddev_samp if stddev == "sample" else F.stddev_pop
    forms = {
        "pre": F.avg(value),
        "stddev": spread(value),
        "per75": F.percentile_approx(value, 0.75, 10000),
        "per50": F.percentile_approx(value, 0.50, 10000),
        "per25": F.percentile_approx(value, 0.25, 10000),
        "numsord": F.count("*"),
        "preord": F.count("*") / F.lit(days),
        "geomean": geometric_mean(value),
    }
    return [forms[s].alias(f"{prefix}_{s}") for s in which]


def conditional_count(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))
