"""What the text operators share: reading, whole texts as bytes, tables written for reuse."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from respfeat.session import scratch_path

#: A word is a run of anything but space, tab, newline, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def body(text: str | Column) -> Column:
    """The whole text as UTF-8 bytes; NULL counts as empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.cast("string").cast("binary"), F.lit(b""))


def row_key(doc_id: str, text: str) -> Column:
    """A text key for a row: its id and a hash of its text. Rows that repeat both share
    it, and get the same results; NULL ids and NULL texts have keys too."""
    return F.concat_ws(
        ":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.hex(F.xxhash64(body(text)))
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows from a table in the shared folder: later steps read one and the same
    copy, and a lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def text_batches(spark: SparkSession, rows: int = 1_000):
    """Arrow batches of fewer rows, for jobs that run inside and move whole texts: each batch is held several
    times, as vectors that double as they grow and as messages, beside the heap and in the Python worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Keys that are sent to every executor, at most; 16 to 40 bytes each. Beyond that they are shuffled.
BROADCAST_KEYS = 500_000


def bounded(df: DataFrame, rows: int = BROADCAST_KEYS) -> DataFrame:
    """A written table, marked for broadcast if it is counted to be small enough.
    The result of a join is the same either way."""
    return F.broadcast(df) if df.count() <= rows else df


def without(df: DataFrame, doc_id: str, text: str, keys: DataFrame) -> DataFrame:
    """The rows whose key (``row_key``) is not among ``keys`` (a written table: key)."""
    at = "key"
    while at in df.columns:
        at += "_"
    listed = bounded(keys.select(F.col("key").alias(at)).distinct())
    return df.withColumn(at, row_key(doc_id, text)).join(listed, at, "left_anti").select(*[f"`{c}`" for c in df.columns])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of undirected edges (a, b), root the smallest node of the
    component. Alternates large-star and small-star steps (Kiveris et al. 2014); each round
    is written, so that none is computed twice."""
    stars = written(edges.where("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), "stars")
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.min("m").alias("low")).select("v", F.least("v", "low").alias("low"))
        # Large star: larger neighbours of v go under its least neighbour.
        large = (
            both.join(least, "v").where("m > v").select(F.col("m").alias("v"), F.col("low").alias("m")).where("v != m").distinct()
        )
        # Small star: v and its smaller neighbours go under the least of them.
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(low, "v").select(F.explode(F.array("v", "m")).alias("v"), F.col("low").alias("m"))
        stars = written(small.where("v != m").distinct(), "stars")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return stars.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(
        stars.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()
    )
