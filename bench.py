"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default the headline list),
BENCH_COMPARE=1 to time the plain pair join for the flagship as well.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from respfeat.operators.trailing import Block, trailing_features
from respfeat.queries import QUERIES, roles
from respfeat.session import build_session

HEADLINE = [
    "trail_hour_7",
    "trail_all_7",
    "trail_all_30",
    "trail_dispatch_30",
    "trail_supplier_all_30",
    "trail_pairs_hour_30",
    "trail_profile_dispatch_hour",
    "trail_hot_entity",
    "asm_mixed_chain",
    "asof_nearest_penalty",
    "base_duration_full",
    "call_is_work",
    "pipe_call_reachability",
    "pipe_outcall_features",
    "pipe_overseas_features",
]


def pair_join(spark, sf_dir):
    """The flagship blocks as one self-join and group-by, for comparison."""
    h = roles.history(spark, sf_dir)
    h.createOrReplaceTempView("bench_history")
    week = "h.processtime >= date_trunc('second', a.processtime) - interval 168 hours"
    stats = []
    for name, cond in (("week", week), ("month", "true")):
        v = f"case when {week if name == 'week' else 'true'} then h.duration end"
        stats.append(
            f"avg({v}) {name}_pre, stddev({v}) {name}_stddev, percentile_approx({v}, array(0.25, 0.5, 0.75)) {name}_per, "
            f"count({v}) {name}_numsord, sum(ln({v})) {name}_logs"
        )
    return spark.sql(f"""
        select a.hotel, a.processtime, {', '.join(stats)}
        from (select distinct hotel, processtime from bench_history) a join bench_history h on a.hotel = h.hotel
         and h.processtime >= date_trunc('second', a.processtime) - interval 720 hours
         and h.processtime < date_trunc('hour', a.processtime)
        group by a.hotel, a.processtime""")


def same_blocks(spark, sf_dir):
    """What ``pair_join`` computes, by the library."""
    blocks = [Block("week", 7), Block("month", 30)]
    return trailing_features(roles.history(spark, sf_dir), "hotel", "processtime", "duration", blocks)


def timed(fn, spark, sf_dir) -> float:
    start = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "respfeat-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Class loading and code generation, on the smallest tables.
    warm = re.sub(r"sf[0-9.]+/?$", "sf0.001", sf_dir)
    timed(QUERIES["trail_all_7"], spark, warm if os.path.isdir(warm) else sf_dir)

    times = {}
    for name in names:
        times[name] = timed(QUERIES[name], spark, sf_dir)
        print(f"{name}: {times[name]}", file=sys.stderr)
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if (m := re.search(r"sf([0-9.]+)/?$", sf_dir)) else sf_dir,
        "cpus": int(cpus),
    }
    if os.environ.get("BENCH_COMPARE"):
        out["compare"] = {f.__name__: timed(f, spark, sf_dir) for f in (pair_join, same_blocks)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
