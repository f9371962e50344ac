"""Order statistics: the k-th smallest value of a trailing window, and weighted
quantiles of groups. Exact at any group size.

A sum over a window can be put together from partial sums, an order statistic
cannot. Small groups are gathered into arrays. A larger one is cut by value into
parts, the rows of every query's window are counted part by part (counts are
window sums), and the query goes on in the one part that holds its rank, until
that part is a single value or small enough to gather.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respfeat.functions import timefx as tx
from respfeat.operators.windows import CELL, SEC, cells_per_day, window_sums
from respfeat.session import checkpoint_root

FANOUT = 16
GATHER_ROWS = 256
SORTED_ROWS = 1_000_000
SMALL_TABLE_ROWS = 200_000


def settle(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and go on from there.

    Used where a later step must see the same cut points even if an executor is
    lost and its tasks run again.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def counted_broadcast(settled: DataFrame) -> DataFrame:
    """Broadcast a settled table only after counting its rows."""
    return F.broadcast(settled) if settled.count() <= SMALL_TABLE_ROWS else settled


def rank_of(p: Column | float, n: Column) -> Column:
    """1-based rank of the p-quantile among n sorted values."""
    return F.greatest(F.ceil((p if isinstance(p, Column) else F.lit(p)) * n), F.lit(1))


def window_array(rows: DataFrame, keys: Sequence[str], span: int) -> DataFrame:
    """Gather the items of the ``span`` cells before each anchor's cell, and of no
    other row. ``rows`` has the keys, ``_cell``, ``_item`` (NULL to add nothing)
    and the flag ``_anchor``. Callers bound the rows per key."""
    frame = Window.partitionBy(*keys).orderBy(CELL).rangeBetween(-span, -1)
    return rows.withColumn("_seen", F.collect_list("_item").over(frame)).where("_anchor")


def select_ranks(
    history: DataFrame,
    queries: DataFrame,
    keys: Sequence[str],
    value: str,
    days: int,
    align: str,
    gather_rows: int | None = None,
) -> DataFrame:
    """Order statistics of the trailing window of each anchor.

    ``history``: keys, ``_cell``, ``_sec``, ``value`` (not NULL).
    ``queries``: one row per anchor with keys, ``_cell``, ``_sec`` and ``_asks``, an
    array of structs ``q`` (label) and ``r`` (1-based rank, not above the window's
    count). Returns keys, ``_sec``, ``_q`` and ``_value``.
    """
    keys = list(keys)
    node_keys = [*keys, "_node"]
    hist = history.select(*keys, F.lit("").alias("_node"), CELL, SEC, F.col(value).alias("_v"))
    todo = queries.select(*keys, F.lit("").alias("_node"), CELL, SEC, "_asks")
    answers = []
    while True:
        large = _large_nodes(hist, node_keys, gather_rows or GATHER_ROWS)
        if large is None:
            answers.append(_gather(hist, todo, node_keys, days, align).select(*keys, SEC, "_q", "_value"))
            break
        nodes = large.select(*node_keys)
        answers.append(
            _gather(
                hist.join(nodes, node_keys, "left_anti"),
                todo.join(nodes, node_keys, "left_anti"),
                node_keys,
                days,
                align,
            ).select(*keys, SEC, "_q", "_value")
        )
        hist, todo, found = _narrow(hist, todo, large, keys, days, align)
        answers.append(found)
        if todo.isEmpty():
            break
    return reduce(DataFrame.unionByName, answers)


def _large_nodes(rows: DataFrame, node_keys: list[str], group_rows: int) -> DataFrame | None:
    """Cut points of the nodes with more rows than the bound; None if there are none."""
    size = rows.groupBy(*node_keys).agg(F.count("*").alias("_n")).where(F.col("_n") > group_rows).drop("_n")
    if size.isEmpty():
        return None
    size = settle(size)
    cuts = F.percentile_approx("_v", [i / FANOUT for i in range(1, FANOUT)])
    return counted_broadcast(
        settle(
            rows.join(counted_broadcast(size), node_keys)
            .groupBy(*node_keys)
            .agg(F.array_distinct(cuts).alias("_cuts"))
        )
    )


def _part() -> Column:
    """Number of the part between, or at, the cut points that a value falls into.
    Values equal to a cut get a part of their own, so a frequent value ends the search."""
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    return (2 * below + F.array_contains("_cuts", F.col("_v")).cast("int")).alias("_part")


def _child() -> Column:
    return F.concat_ws(".", "_node", "_part").alias("_node")


def _narrow(hist, todo, large, keys, days, align):
    """One step down: cut the large nodes by value, find the part each rank is in."""
    node_keys = [*keys, "_node"]
    part_keys = [*node_keys, "_part"]
    parts = settle(hist.join(large, node_keys).select(*node_keys, _part(), CELL, SEC, "_v"))
    kids = settle(parts.groupBy(*part_keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi")))
    kids = counted_broadcast(kids)
    one, none = (F.lit(x).cast("bigint").alias("_w") for x in (1, 0))
    counted = parts.select(*part_keys, CELL, SEC, one, F.lit(False).alias("_anchor")).unionByName(
        todo.join(kids, node_keys).select(*part_keys, CELL, SEC, none, F.lit(True).alias("_anchor"))
    )
    counts = window_sums(counted, part_keys, ["_w"], days, align).where("_w > 0")
    upto = F.sum("_w").over(Window.partitionBy(*node_keys, SEC).orderBy("_part"))
    before = F.col("_upto") - F.col("_w")

    def held(ask: Column) -> Column:
        return (ask["r"] > before) & (ask["r"] <= F.col("_upto"))

    at = settle(
        counts.withColumn("_upto", upto)
        .join(todo.select(*node_keys, SEC, "_asks"), [*node_keys, SEC])
        .withColumn("_asks", F.filter("_asks", held))
        .where(F.size("_asks") > 0)
        .withColumn(
            "_asks",
            F.transform("_asks", lambda a: F.struct(a["q"].alias("q"), (a["r"] - before).alias("r"))),
        )
        .join(kids, part_keys)
    )
    found = (
        at.where("_lo = _hi")
        .select(*keys, SEC, F.explode("_asks").alias("_ask"), F.col("_lo").alias("_value"))
        .select(*keys, SEC, F.col("_ask.q").alias("_q"), "_value")
    )
    left = at.where("_lo < _hi")
    hist = parts.join(left.select(*part_keys).distinct(), part_keys, "left_semi").select(
        *keys, _child(), CELL, SEC, "_v"
    )
    return hist, left.select(*keys, _child(), CELL, SEC, "_asks"), found


def _gather(hist, todo, keys, days, align):
    """Answer the queries of groups that fit into an array."""
    span = days * cells_per_day(align)
    item = F.struct(F.col("_v").alias("v"), F.col(SEC).alias("s"))
    rows = hist.select(
        *keys, CELL, SEC, item.alias("_item"),
        F.lit(None).cast(todo.schema["_asks"].dataType).alias("_asks"), F.lit(False).alias("_anchor"),
    ).unionByName(
        todo.select(
            *keys, CELL, SEC, F.lit(None).cast("struct<v:double,s:bigint>").alias("_item"), "_asks",
            F.lit(True).alias("_anchor"),
        )
    )
    start = F.col(SEC) - (days * tx.DAY if align == "hour" else days)
    return (
        window_array(rows, keys, span)
        .withColumn("_seen", F.sort_array(F.filter("_seen", lambda x: x["s"] >= start)))
        .withColumn("_ask", F.explode("_asks"))
        .select(
            *keys, SEC, F.col("_ask.q").alias("_q"),
            F.element_at("_seen", F.col("_ask.r").cast("int"))["v"].alias("_value"),
        )
    )


def fold(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """Equal values of a group in one row ``_v`` with their weight ``_w``, settled."""
    return settle(
        df.where(F.col(value).isNotNull() & (F.col(weight) > 0))
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.sum(weight).cast("bigint").alias("_w"))
    )


def weighted_quantiles(
    folded: DataFrame, keys: Sequence[str], probs: Sequence[float], sorted_rows: int | None = None
) -> DataFrame:
    """Per group the smallest values whose weights add up to each share of the total.

    ``folded`` comes from :func:`fold`. Groups of up to ``sorted_rows`` distinct values
    are sorted; a larger one is cut by value, and only the parts that hold a rank
    are followed. Returns the keys and one column ``q<i>`` per share.
    """
    keys = list(keys)
    node_keys = [*keys, "_node"]
    wanted = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    )
    rows = folded.select(*keys, F.lit("").alias("_node"), "_v", "_w")
    todo = (
        rows.groupBy(*node_keys)
        .agg(F.sum("_w").alias("_total"))
        .select(*node_keys, "_total", wanted.alias("_p"))
        .select(*node_keys, F.col("_p.i").alias("_q"), rank_of(F.col("_p.p"), F.col("_total")).alias("_rank"))
    )
    answers = []
    while True:
        large = _large_nodes(rows, node_keys, sorted_rows or SORTED_ROWS)
        if large is None:
            answers.append(_sorted_pick(rows, todo, node_keys).select(*keys, "_q", "_value"))
            break
        nodes = large.select(*node_keys)
        answers.append(
            _sorted_pick(
                rows.join(nodes, node_keys, "left_anti"), todo.join(nodes, node_keys, "left_anti"), node_keys
            ).select(*keys, "_q", "_value")
        )
        parts = settle(rows.join(large, node_keys).select(*node_keys, _part(), "_v", "_w"))
        kids = parts.groupBy(*node_keys, "_part").agg(
            F.sum("_w").alias("_w"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
        )
        running = Window.partitionBy(*node_keys, "_q").orderBy("_part")
        at = settle(
            todo.join(kids, node_keys)
            .withColumn("_upto", F.sum("_w").over(running))
            .where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_w") < F.col("_rank")))
            .withColumn("_rank", F.col("_rank") - F.col("_upto") + F.col("_w"))
        )
        answers.append(at.where("_lo = _hi").select(*keys, "_q", F.col("_lo").alias("_value")))
        left = at.where("_lo < _hi")
        part_keys = [*node_keys, "_part"]
        rows = parts.join(left.select(*part_keys).distinct(), part_keys, "left_semi").select(
            *keys, _child(), "_v", "_w"
        )
        todo = left.select(*keys, _child(), "_q", "_rank")
        if todo.isEmpty():
            break
    return (
        reduce(DataFrame.unionByName, answers)
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col("_q") == i, F.col("_value"))).alias(f"q{i}") for i in range(len(probs))])
    )


def _sorted_pick(rows, todo, node_keys):
    """Answer the queries of groups that one task can sort."""
    upto = F.sum("_w").over(Window.partitionBy(*node_keys).orderBy("_v"))
    return (
        rows.withColumn("_upto", upto)
        .join(todo, node_keys)
        .where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_w") < F.col("_rank")))
        .withColumnRenamed("_v", "_value")
    )
