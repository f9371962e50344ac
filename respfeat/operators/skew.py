"""Equi-joins whose left side has keys with a large share of its rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with this share of the rows is split into lots of about this share.
SHARE = 1 / 256
#: Counters of the sketch: estimates are off by 3.5 in so many rows at most.
TRACKED = 16_384


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> DataFrame:
    """``_key`` (hash of the key, NULLs included), ``_lots``: keys with at least ``share`` of the rows.

    A frequent-items sketch, built per task and merged, so no key is shuffled. It has at most
    ``2 / share`` rows; which keys are listed decides how rows are dealt, not what a join returns.
    """
    most = ceil(2 / share)
    found = df.select(F.xxhash64(*keys).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {most}, {max(TRACKED, most)})").alias("_top"), F.count("*").alias("_n")
    )
    return (
        found.select("_n", F.inline("_top").alias("_key", "_rows"))
        .where(F.col("_rows") >= F.col("_n") * share)
        .select("_key", F.ceil(F.col("_rows") / (F.col("_n") * share)).cast("int").alias("_lots"))
    )


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], how: str = "inner", share: float = SHARE) -> DataFrame:
    """``left`` joined to ``right`` on pairs of columns, with frequent keys of ``left`` spread.

    Rows of a frequent key are dealt into lots by the hash of the row, and its rows on the right are
    repeated once per lot; all other rows on the right stay single. So a key with 40 % of the rows
    goes to many tasks at any size, whether or not it looks skewed at run time. The list of frequent
    keys has at most ``2 / share`` rows, which bounds the broadcast. Rows that are alike in all
    columns stay in one lot. NULL keys match nothing: inner joins drop them first, left joins spread
    them like any frequent key. ``left`` is read once more, for its keys only. Plans without a job.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"no spread join for {how!r}")
    mine, theirs = [k for k, _ in keys], [k for _, k in keys]
    right = right.dropna(subset=theirs)
    if how == "inner":
        left = left.dropna(subset=mine)
    hot = F.broadcast(frequent_keys(left, mine, share))
    # A value that the left type can't hold equals nothing there.
    alike = [F.col(t).try_cast(left.schema[m].dataType) for m, t in keys]
    lots = F.coalesce("_lots", F.lit(1))
    dealt = left.withColumn("_key", F.xxhash64(*mine)).join(hot, "_key", "left")
    dealt = dealt.withColumn("_lot", F.pmod(F.xxhash64(*left.columns), lots).cast("int")).drop("_key", "_lots")
    copies = right.select("*", F.xxhash64(*alike).alias("_key")).join(hot, "_key", "left")
    copies = copies.select(*[F.col(c).alias(f"_r_{c}") for c in right.columns], F.explode(F.sequence(F.lit(0), lots - 1)).alias("_r_lot"))
    same = [F.col(m) == F.col(f"_r_{t}") for m, t in keys]
    joined = dealt.join(copies, [*same, F.col("_lot") == F.col("_r_lot")], how).drop("_lot", "_r_lot")
    return joined.select(*left.columns, *[F.col(f"_r_{c}").alias(c) for c in right.columns if c not in theirs])
