"""First rows per key, neighbours within an entity, ordered results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values of an integer order column to a slice.
LOT = 4096


def first_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key. ``order`` should end in a column that breaks ties.

    Each task keeps one row per key before the shuffle (Spark's WindowGroupLimit),
    so a frequent key sends one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rk", F.row_number().over(first)).where("_rk = 1").drop("_rk")


def with_group_size(df: DataFrame, keys: Sequence[str], name: str = "nums") -> DataFrame:
    """Each row with the row count of its group; rows with a NULL key form groups too.

    Counted map-side and joined back: a window would bring a whole group to one
    task, while a skewed join is split at run time.
    """
    sizes = df.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias(name))
    same = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)]
    return df.join(sizes, same).drop(*[f"_g{i}" for i in range(len(keys))])


def slice_of(df: DataFrame, order: str) -> Column:
    """A number that never falls as the order column grows: days of timestamps, lots of numbers, else one for all."""
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.date_diff(F.col(order).cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return F.floor(F.col(order).cast("double") / LOT).cast("bigint")
    return F.lit(0).cast("bigint")


def with_neighbours(
    df: DataFrame, entity: str, order: str, cols: dict[str, tuple[str | None, str | None]], slices: Column | None = None
) -> DataFrame:
    """For each column its value in the next and in the previous row of the entity,
    under the names given as ``(next, previous)``; None leaves one out. NULL orders come first.

    Rows look for their neighbours within slices of the order column (``slices``, a number that never
    falls as the order grows; ``slice_of`` by default). The first and last row of each slice are folded map-side, and
    the edge rows of the nearest slices of the entity are handed to it. So an entity with most of
    the rows is spread over its slices; only their edges meet in one task.
    """
    cut = (slice_of(df, order) if slices is None else slices).alias("_slice")
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = df.select("*", cut).withColumns({"_row": row, "_at": F.struct(F.col(order).isNotNull(), F.col(order))})
    edges = rows.groupBy(F.col(entity).alias("_e"), F.col("_slice").alias("_s")).agg(
        F.min_by("_row", "_at").alias("_first"), F.max_by("_row", "_at").alias("_last")
    )
    line = Window.partitionBy("_e").orderBy("_s")
    edges = edges.select("_e", "_s", F.lead("_first").over(line).alias("_after"), F.lag("_last").over(line).alias("_before"))
    w = Window.partitionBy(entity, "_slice").orderBy("_at")
    own = rows.withColumns({"_next": F.lead("_row").over(w), "_prev": F.lag("_row").over(w)})
    near = own.join(edges, F.col(entity).eqNullSafe(F.col("_e")) & F.col("_slice").eqNullSafe(F.col("_s"))).withColumns(
        {"_next": F.coalesce("_next", "_after"), "_prev": F.coalesce("_prev", "_before")}
    )
    new = {}
    for i, (after, before) in enumerate(cols.values()):
        if after:
            new[after] = F.col("_next")[f"c{i}"]
        if before:
            new[before] = F.col("_prev")[f"c{i}"]
    return near.withColumns(new).select(*[F.col(f"`{c}`") for c in [*df.columns, *[n for n in new if n not in df.columns]]])


def sorted_by(df: DataFrame, *cols: str) -> DataFrame:
    """Globally ordered rows, by range shuffle."""
    return df.orderBy(*cols)


def top(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """The first n rows in the given order, taken per task before they meet."""
    return df.orderBy(*cols).limit(n)
