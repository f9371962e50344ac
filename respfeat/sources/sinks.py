"""Writes: full-refresh tables and CSV exports.

A refresh is staged: rows are written beside the target, counted while they are written, compared
with what is read back, and only then put in the target's place. A job that fails leaves the old
table as it was; what it wrote is removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from respfeat.sources.tables import between_instants


class _Files:
    """Renames and removals in whatever store the path is in."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path_of = spark._jvm.org.apache.hadoop.fs.Path
        self.store = self.path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.store.exists(self.path_of(path))

    def move(self, old: str, new: str) -> None:
        if not self.store.rename(self.path_of(old), self.path_of(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def remove(self, path: str) -> None:
        self.store.delete(self.path_of(path), True)


def _staged(
    df: DataFrame, path: str, write: Callable[[DataFrame, str], None], read: Callable[[str], DataFrame], measures: Mapping[str, Column]
) -> dict:
    """Write under a fresh path and give the measures taken on the way; the rows read back must be as many."""
    seen = Observation()
    files = _Files(df.sparkSession, path)
    try:
        write(df.observe(seen, F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in measures.items()]), path)
        got = dict(seen.get)
        n = got.pop("_rows")
        held = read(path).count()
        if n != held:
            raise OSError(f"{n} rows were written to {path}, {held} are there")
    except BaseException:
        files.remove(path)
        raise
    return got


def _replace(spark: SparkSession, staged: str, path: str) -> None:
    """Put what was staged in the place of the target: two renames, the first taken back if the second fails."""
    files = _Files(spark, path)
    old = f"{path}.old-{uuid.uuid4().hex}"
    had = files.exists(path)
    if had:
        files.move(path, old)
    try:
        files.move(staged, path)
    except BaseException:
        if had:
            files.move(old, path)
        raise
    if had:
        files.remove(old)


def measured_refresh(
    df: DataFrame, path: str, measures: Mapping[str, Column], partition_by: Sequence[str] = (), compression: str = "snappy"
) -> tuple[DataFrame, dict]:
    """Replace the table at ``path``. Returns it as read back, and aggregates over the rows
    (``measures``) that are taken while they are written, without a scan of their own."""
    spark = df.sparkSession

    def write(rows: DataFrame, to: str) -> None:
        writer = rows.write.option("compression", compression)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(to)

    staged = f"{path}.new-{uuid.uuid4().hex}"
    got = _staged(df, staged, write, spark.read.parquet, measures)
    _replace(spark, staged, path)
    return spark.read.parquet(path), got


def full_refresh(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "snappy"
) -> DataFrame:
    """Replace the table at ``path`` and return it as read back."""
    return measured_refresh(df, path, {}, partition_by, compression)[0]


def refresh_table(df: DataFrame, name: str, folder: str, compression: str = "snappy") -> DataFrame:
    """The same for a table of the session's catalog, whose versions lie in ``folder``: the new one is
    written, then the catalog points to it. Readers see the old or the new version; the old files are removed after that."""
    spark = df.sparkSession
    version = f"{folder}/v-{uuid.uuid4().hex}"
    _staged(df, version, lambda rows, to: rows.write.option("compression", compression).parquet(to), spark.read.parquet, {})
    old = None
    if spark.catalog.tableExists(name):
        about = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe extended {name}").collect()}
        old = about.get("Location")
        if spark.table(name).schema.simpleString() == df.schema.simpleString():
            spark.sql(f"alter table {name} set location '{version}'")
        else:
            spark.sql(f"drop table {name}")
            spark.catalog.createTable(name, version, "parquet")
    else:
        spark.catalog.createTable(name, version, "parquet")
    spark.catalog.refreshTable(name)
    if old and old.removeprefix("file:").startswith(folder.removeprefix("file:")):
        _Files(spark, old).remove(old)
    return spark.table(name)


# Every value survives the round trip: microseconds (Spark's default format stops at milliseconds),
# line breaks, quotes, blanks at the ends, and the empty text next to NULL, which is written as \\N.
_CSV = {
    "header": True,
    "nullValue": "\\N",
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def csv_export(df: DataFrame, path: str) -> DataFrame:
    """Write CSV with a header, one file per task, and return it as read back. A text
    ``\\N`` is read as NULL."""
    read = df.sparkSession.read.schema(df.schema).options(**_CSV)
    staged = f"{path}.new-{uuid.uuid4().hex}"
    _staged(df, staged, lambda rows, to: rows.write.options(**_CSV).csv(to), read.csv, {})
    _replace(df.sparkSession, staged, path)
    return read.csv(path)


def csv_slice(df: DataFrame, path: str, ts: str, lo: str, hi: str) -> DataFrame:
    """CSV export of the rows in ``[lo, hi)``."""
    return csv_export(between_instants(df, ts, lo, hi), path)
