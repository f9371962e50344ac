"""Projections on the column set."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the columns named by the keys, under the names in the values."""
    return df.select([F.col(old).alias(new) for old, new in names.items()])


def with_derived(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """All columns plus derived ones."""
    return df.withColumns(dict(exprs))


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """All columns but those whose whole name matches ``pattern``."""
    return df.select([c for c in df.columns if not re.fullmatch(pattern, c)])


def with_constant(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def distinct_of(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()
