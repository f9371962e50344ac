"""Point-in-time trailing-window statistics per entity.

For each (entity, instant) the earlier rows of the same entity over the past N
days are summed up, without the current clock hour (``align="hour"``) or the
current day (``align="day"``):

    hour:  second(anchor) - N*24h  <=  history  <  hour(anchor)
    day:   day(anchor) - N         <=  day(history)  <  day(anchor)

No pair of anchor and history row is ever a row of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from types import SimpleNamespace

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from respfeat.functions import timefx as tx
from respfeat.functions.stats import EIGHT_STATS, QUARTILES
from respfeat.operators import selection as sel
from respfeat.operators import slices
from respfeat.operators.windows import CELL, SEC, cells_per_day, hour_of, time_columns

# Executors get this module with the tasks and need not have the package.
cloudpickle.register_pickle_by_value(slices)

#: Rows of a slice that one task holds, some 2 KB each while four blocks are worked out; larger slices are worked on by many tasks.
GROUP_ROWS = 100_000
#: Cut points are looked through in steps of so many.
CUT_STEP = 16


@dataclass(frozen=True)
class Block:
    """One block of columns ``<prefix>_<stat>`` over the past ``days`` days.

    ``geomean_over="window"`` divides the logs of a same-hour block by the row
    count of the whole window, as older feature tables did; the default divides
    by the rows of that hour.
    """

    prefix: str
    days: int
    same_hour: bool = False
    stats: tuple[str, ...] = EIGHT_STATS
    geomean_over: str = "filtered"


def trailing_features(
    df: DataFrame,
    entity: str,
    ts: str,
    value: str,
    blocks: Sequence[Block],
    align: str = "hour",
    stddev: str = "sample",
    duplicate_anchors: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per distinct (entity, ts) with history in at least one block.

    All blocks come out of one pass. Columns of a block without history are NULL.
    ``duplicate_anchors`` counts the history once per row that shares the
    anchor's (entity, ts) instead of once.

    Rows are spread over (entity, time slice), a slice being as long as the
    longest window; each row goes to its own slice as anchor and history and to
    the next one as history. Slices of up to ``group_rows`` rows are sorted and worked
    through in one task each (``slices``), larger ones by hours and parts of the value, in many tasks.
    """
    if align == "day" and any(b.same_hour for b in blocks):
        raise ValueError("a window of whole days has no current hour")
    span = max(b.days for b in blocks) * cells_per_day(align)
    rows = (
        df.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
        .select(F.col(entity).alias("_e"), F.col(ts).alias("_ts"), F.col(value).cast("double").alias("_v"))
        .withColumns(time_columns("_ts", align))
        .withColumn("_slice", F.floor(F.col(CELL) / span))
    )
    copies = F.explode(F.array(F.lit(0), F.lit(1)))
    sliced = rows.select("*", copies.alias("_copy")).select(
        "_e", (F.col("_slice") + F.col("_copy")).alias("_slice"), "_ts", CELL, SEC, "_v",
        (F.col("_copy") == 0).alias("_own"),
    )
    large = (
        sliced.groupBy("_e", "_slice")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > group_rows)
    )
    if large.isEmpty():
        figures = _by_slices(sliced, blocks, align, duplicate_anchors)
    else:
        large = sel.counted_broadcast(sel.settle(large))
        small = sliced.join(large, ["_e", "_slice"], "left_anti")
        figures = _by_slices(small, blocks, align, duplicate_anchors).unionByName(
            _by_parts(sliced, large, blocks, align, duplicate_anchors, group_rows)
        )
    return _named(figures, entity, ts, blocks, stddev)


def trailing_counts(
    df: DataFrame, entity: str, ts: str, days: int, align: str = "hour", same_hour: bool = False
) -> DataFrame:
    """Rows in the trailing window of each distinct (entity, ts), as ``n_pairs``;
    anchors without history are left out.

    An event sweep: a row comes into sight at the end of its hour (or day) and goes out of it
    when a window opens after it, so it adds 1 at the one time and takes 1 off at the other.
    All of it is folded to one row per entity and second, map-side first, and the count at a second is a
    running sum. The sum runs within slices of time as long as the window, on top of what
    earlier slices left over, so a busy entity is spread over as many tasks as it has slices.
    """
    if align == "day" and same_hour:
        raise ValueError("a window of whole days has no current hour")
    seconds = align == "hour"
    shown = (F.col(CELL) + 1) * (3600 if seconds else 1)
    gone = F.col(SEC) + days * (tx.DAY if seconds else 1) + 1
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = (
        df.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
        .select(F.col(entity).alias("_e"), F.col(ts).alias("_ts"))
        .withColumns(time_columns("_ts", align))
    )
    no_time = F.lit(None).cast(rows.schema["_ts"].dataType)
    event = lambda at, step, who: F.struct(at.cast("bigint").alias("at"), step.alias("step"), who.alias("ts"))
    keys = ["_e", "_h"] if same_hour else ["_e"]
    swept = rows.select(
        "_e", *([hour_of(CELL).alias("_h")] if same_hour else []),
        F.explode(F.array(event(shown, one, no_time), event(gone, -one, no_time), event(F.col(SEC), none, F.col("_ts")))).alias("x"),
    )
    # Never NULL, and said so: a filter on it in one use only would keep both uses from reading the same shuffled rows.
    part = F.coalesce(F.floor(F.col("x.at") / (days * (tx.DAY if seconds else 1))), none).alias("_slice")
    folded = swept.groupBy(*keys, part, F.col("x.at").alias("_at")).agg(
        F.sum("x.step").alias("_step"), F.collect_set("x.ts").alias("_ts")
    )
    # The number of anchors is asked for, though not needed, for the same reason.
    slices_ = folded.groupBy(*keys, "_slice").agg(F.sum("_step").alias("_left"), F.sum(F.size("_ts")).alias("_anchors"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices_.withColumn("_carried", F.coalesce(F.sum("_left").over(before), none)).where("_anchors > 0")
    running = Window.partitionBy(*keys, "_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = folded.withColumn("_sum", F.sum("_step").over(running)).where(F.size("_ts") > 0)
    counts = counted.join(carried.select(*keys, "_slice", "_carried"), [*keys, "_slice"]).withColumn("n_pairs", F.col("_sum") + F.col("_carried"))
    return counts.where("n_pairs > 0").select(F.col("_e").alias(entity), F.explode("_ts").alias(ts), "n_pairs")


def all_pairs_count(df: DataFrame, entity: str) -> DataFrame:
    """Size of the full self-join on the entity, per entity, as ``n_pairs``."""
    n = F.count("*")
    return df.where(F.col(entity).isNotNull()).groupBy(entity).agg((n * n).alias("n_pairs"))


# -- slices that a task can hold ----------------------------------------------


def _by_slices(sliced, blocks, align, duplicate_anchors):
    """One shuffle by slice, then all blocks from the sorted rows (``slices.statistics``)."""
    out = StructType(list(sliced.select("_e", "_ts").schema) + [StructField("_times", LongType())])
    for i, b in enumerate(blocks):
        out.add(f"_n{i}", LongType()).add(f"_nv{i}", LongType()).add(f"_mean{i}", DoubleType())
        if "stddev" in b.stats:
            out.add(f"_m2{i}", DoubleType())
        if "geomean" in b.stats:
            out.add(f"_ln{i}", DoubleType()).add(f"_nwin{i}", LongType())
        for j in range(len(QUARTILES)):
            out.add(f"_q{i}_{j}", DoubleType())
    plain = [SimpleNamespace(days=b.days, same_hour=b.same_hour, stats=b.stats, geomean_over=b.geomean_over) for b in blocks]
    run = slices.statistics(plain, align, QUARTILES, duplicate_anchors, to_arrow_schema(out))
    keys = ["_e", "_slice"]
    return sliced.repartition(*keys).sortWithinPartitions(*keys, "_ts").mapInArrow(run, out)


# -- large slices ------------------------------------------------------------


def _by_parts(sliced, large, blocks, align, duplicate_anchors, part_rows):
    """All anchors of an hour see the same whole hours, folded and counted by part of the value (``whole_hours``), and
    each of them the end of one more hour (``opening_hours``). That gives all sums, and for each quartile the part that
    holds it and the rank in it, which is looked up among the rows of the part (``part_ranks``)."""
    keys = ["_e", "_slice"]
    plain = [SimpleNamespace(days=b.days, same_hour=b.same_hour, stats=b.stats, geomean_over=b.geomean_over) for b in blocks]
    spans = [b.days * cells_per_day(align) for b in blocks]
    cuts = _cuts(sliced, large, part_rows)
    heads = F.filter("_cuts", lambda c, i: (i + 1) % CUT_STEP == 0)
    rows = sel.settle(
        sliced.join(cuts.withColumn("_heads", heads), keys)
        .withColumn("_h", F.size(F.filter("_heads", lambda c: c < F.col("_v"))))
        .withColumn("_cuts", F.slice("_cuts", F.col("_h") * CUT_STEP + 1, F.lit(CUT_STEP)))
        .select(
            *keys, F.col(CELL).cast("bigint").alias(CELL), F.col(SEC).cast("bigint").alias(SEC), "_v", "_own",
            F.when(F.col("_v").isNull(), -1).otherwise(2 * CUT_STEP * F.col("_h") + sel._part()).cast("bigint").alias("_part"),
        )
    )
    v, n = F.col("_v"), F.count("_v")
    strange = F.isnan(v) | (F.abs(v) == float("inf"))
    folds = {
        "n": F.count("*"), "nv": n, "sum": F.sum(v), "mean": F.avg(v), "m2": F.var_pop(v) * n,
        "ln": F.sum(F.when(v > 0, F.ln(v))), "pos": F.count_if(v > 0), "odd": F.count_if(strange),
    }
    folds = [F.coalesce(folds[k].cast("double"), F.lit(0.0)).alias(k) for k in slices.FOLDED]
    run = lambda df, f, out: df.mapInArrow(f(to_arrow_schema(out)), out)
    same = [rows.schema[c] for c in keys]
    doubles = lambda names: [StructField(c, DoubleType()) for c in names]
    longs = lambda *names: [StructField(c, LongType()) for c in names]

    by_cell = rows.groupBy(*keys, CELL).agg(F.bool_or("_own").alias("_own"), *folds).withColumn("_part", F.lit(-1).cast("bigint"))
    by_part = rows.where("_part >= 0").groupBy(*keys, CELL, "_part").agg(n.cast("double").alias("nv"))
    cells = by_cell.unionByName(by_part, allowMissingColumns=True).fillna(0.0, list(slices.FOLDED)).fillna(False, ["_own"])
    cells = cells.repartition(*keys).sortWithinPartitions(*keys, CELL)
    out = StructType([*same, *longs("_block", CELL), *doubles((*slices.FOLDED, "nwin")), StructField("_counts", ArrayType(LongType()))])
    whole = run(cells, lambda schema: slices.whole_hours(plain, spans, schema), out).withColumn("_kind", F.lit(1))

    block = F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(len(blocks))])).alias("_block")
    later = reduce(lambda x, i: F.when(F.col("_block") == i, spans[i]).otherwise(x), range(len(blocks)), F.lit(0))
    seconds = rows.groupBy(*keys, CELL, SEC, "_part").agg(*folds)
    opening = seconds.select("*", block).withColumn(CELL, F.col(CELL) + later).withColumn("_kind", F.lit(0))
    asking = rows.where("_own").select(*keys, CELL, SEC).distinct().select("*", block).withColumn("_kind", F.lit(2))
    hours = opening.unionByName(whole, allowMissingColumns=True).unionByName(asking, allowMissingColumns=True)
    group = [*keys, "_block", CELL]
    hours = hours.fillna(0.0, [*slices.FOLDED, "nwin"]).fillna(0, [SEC, "_part"]).repartition(*group).sortWithinPartitions(*group, "_kind", SEC)
    asks = [f"{c}{j}" for j in range(len(QUARTILES)) for c in ("_part", "_rank")]
    out = StructType([*same, *longs("_block", CELL, SEC, "n", "nv", "nwin"), *doubles(("mean", "m2", "ln")), *longs(*asks)])
    told = sel.settle(run(hours, lambda schema: slices.opening_hours(plain, align, QUARTILES, schema), out))

    quartile = F.explode(
        F.array(*[F.struct(F.lit(j).cast("bigint").alias("j"), F.col(f"_part{j}").alias("part"), F.col(f"_rank{j}").alias("rank")) for j in range(len(QUARTILES))])
    ).alias("x")
    questions = told.where("nv > 0").select(*keys, "_block", CELL, SEC, quartile).select(
        *keys, "_block", CELL, SEC, F.col("x.j").alias("_j"), F.col("x.part").alias("_part"), F.col("x.rank").alias("_rank")
    )
    # Odd parts are the cuts themselves.
    odd = F.col("_part") % 2 == 1
    cut = F.element_at("_cuts", F.floor((F.col("_part") + 1) / 2).cast("int"))
    plainly = questions.where(odd).join(cuts, keys).withColumn("_value", cut)
    searched = rows.where((F.col("_part") >= 0) & ~odd).select(*keys, "_part", CELL, SEC, "_v", F.lit(0).alias("_kind")).unionByName(
        questions.where(~odd).withColumn("_kind", F.lit(1)), allowMissingColumns=True
    )
    group = [*keys, "_part"]
    searched = searched.fillna(0, ["_block", "_rank", "_j"]).fillna(0.0, ["_v"])
    searched = searched.repartition(*group).sortWithinPartitions(*group, "_kind", SEC)
    out = StructType([*same, *longs("_block", SEC, "_j"), *doubles(("_value",))])
    looked_up = run(searched, lambda schema: slices.part_ranks(plain, align, schema), out)
    answers = looked_up.unionByName(plainly.select(*looked_up.columns))

    figures = {"_n": "n", "_nv": "nv", "_mean": "mean", "_m2": "m2", "_ln": "ln", "_nwin": "nwin"}
    wide = []
    for i, b in enumerate(blocks):
        at = F.col("_block") == i
        for name, c in figures.items():
            if not (name == "_m2" and "stddev" not in b.stats or name in ("_ln", "_nwin") and "geomean" not in b.stats):
                over = "n" if name == "_nwin" and b.geomean_over != "window" else c
                wide.append(F.max(F.when(at, F.col(over))).alias(f"{name}{i}"))
        wide += [F.max(F.when(at & (F.col("_j") == j), F.col("_value"))).alias(f"_q{i}_{j}") for j in range(len(QUARTILES))]
    told = told.select(*keys, "_block", SEC, *figures.values()).unionByName(answers, allowMissingColumns=True)
    found = told.groupBy(*keys, SEC).agg(*wide)
    times = F.count("*") if duplicate_anchors else F.first(F.lit(1))
    anchors = sliced.where("_own").join(cuts.select(*keys), keys, "left_semi").groupBy(*keys, "_ts", SEC).agg(times.cast("bigint").alias("_times"))
    some = reduce(lambda a, c: a | c, [F.col(f"_n{i}") > 0 for i in range(len(blocks))])
    return anchors.join(found, [*keys, SEC]).where(some).drop("_slice", SEC)


def _cuts(sliced, large, part_rows):
    """Values that cut each large slice into parts of about ``part_rows`` rows; NaN, the largest, is the last cut."""
    parts = 1 + large.agg(F.max("_n")).first()[0] // part_rows
    shares = [i / parts for i in range(1, parts)] or [0.5]
    value = F.when(~F.isnan("_v"), F.col("_v"))
    found = F.percentile_approx(value, shares, max(10_000, 20 * parts))
    # Smaller slices among them need fewer cuts.
    step = F.greatest(F.floor(parts / (1 + F.floor(F.col("_n") / part_rows))), F.lit(1))
    fewer = F.filter("_found", lambda c, i: (i + 1) % F.col("_step") == 0)
    cuts = F.array_append(F.array_distinct(F.coalesce(fewer, F.array().cast("array<double>"))), F.lit(float("nan")))
    keys = ["_e", "_slice"]
    found = sliced.join(large, keys).groupBy(*keys).agg(F.max("_n").alias("_n"), found.alias("_found"))
    return sel.counted_broadcast(sel.settle(found.withColumn("_step", step).select(*keys, cuts.alias("_cuts"))))


# -- naming ------------------------------------------------------------------


def _named(figures, entity, ts, blocks, stddev):
    out = [F.col("_e").alias(entity), F.col("_ts").alias(ts)]
    for i, b in enumerate(blocks):
        n, nv = F.col(f"_n{i}") * F.col("_times"), F.col(f"_nv{i}") * F.col("_times")
        some = F.col(f"_n{i}") > 0
        forms = {
            "pre": F.col(f"_mean{i}"),
            "per25": F.col(f"_q{i}_0"),
            "per50": F.col(f"_q{i}_1"),
            "per75": F.col(f"_q{i}_2"),
            "numsord": F.when(some, n),
            "preord": F.when(some, n / F.lit(b.days)),
        }
        if "stddev" in b.stats:
            freedom = nv - 1 if stddev == "sample" else nv
            forms["stddev"] = F.when(freedom > 0, F.sqrt(F.col(f"_m2{i}") * F.col("_times") / freedom))
        if "geomean" in b.stats:
            over = F.col(f"_nwin{i}") if b.geomean_over == "window" else F.col(f"_n{i}")
            forms["geomean"] = F.exp(F.col(f"_ln{i}") / over)
        out += [forms[s].alias(f"{b.prefix}_{s}") for s in b.stats]
    return figures.select(*out)
