"""Wide feature tables: base rows with blocks of statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Link = tuple[DataFrame, Sequence[str], str]


def assemble(base: DataFrame, links: Sequence[Link]) -> DataFrame:
    """Join block after block. Each link is ``(block, keys, how)``; with ``"inner"``
    rows without that block go, with ``"left"`` they stay with NULLs.

    Blocks are unique per key, so no join adds rows. Rows with a NULL key, which
    left joins keep, are spread over tasks.
    """

    def add(left: DataFrame, link: Link) -> DataFrame:
        block, keys, how = link
        return join_sparse(left, block, keys) if how == "left" else left.join(block, list(keys), how)

    return reduce(add, links, base)


def join_sparse(left: DataFrame, block: DataFrame, keys: Sequence[str], spread: int = 256) -> DataFrame:
    """Left join on keys that are NULL in many rows.

    Such rows match nothing, but would all be sent to one task. They get a further
    key by the hash of the row, which spreads them; all other rows have 0 there.
    """
    gap = reduce(lambda a, c: a | c, [F.col(k).isNull() for k in keys])
    salt = F.when(gap, F.pmod(F.xxhash64(*left.columns), F.lit(spread))).otherwise(0)
    return (
        left.withColumn("_salt", salt.cast("bigint"))
        .join(block.withColumn("_salt", F.lit(0).cast("bigint")), [*keys, "_salt"], "left")
        .drop("_salt")
    )


def require(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Rows that have each of the blocks: what inner joins to the separate blocks
    leave, when all blocks came in one left join."""
    return df.where(_present(df, prefixes))


def blank_unless(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Keep the blocks' columns where all of the blocks are there, else NULL."""
    mine = [c for c in df.columns if any(c.startswith(f"{p}_") for p in prefixes)]
    kept = df.withColumn("_all", _present(df, prefixes))
    return kept.withColumns({c: F.when(F.col("_all"), F.col(c)) for c in mine}).drop("_all")


def _present(df: DataFrame, prefixes: Sequence[str]) -> Column:
    """The row count of a block tells whether it is there; blocks without one have a
    mean wherever labels are not NULL."""
    marks = [f"{p}_numsord" if f"{p}_numsord" in df.columns else f"{p}_pre" for p in prefixes]
    return reduce(lambda a, c: a & c, [F.col(m).isNotNull() for m in marks])


def merge_on(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Two feature tables of the same rows: the left one with the columns only the
    right one has."""
    new = [c for c in right.columns if c not in left.columns]
    return left.join(right.select(key, *new), key, how)
