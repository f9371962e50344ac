"""Exact duplicates by Grace hashing: records are dealt into buckets until each bucket
fits an open-addressing table that compares complete contents.

1. Each task folds its rows through a bounded table of its own, so that a text that
   makes up a third of all rows leaves a task once, not once per row. One record per
   text and task goes, with its content, to a table in the shared folder (the spill
   files), next to one light row per document that names its record.
2. Records whose hash occurs once equal no other. The rest are dealt by hash into
   buckets. A bucket that is too large is dealt again with another seed, until it fits
   or holds one hash only.
3. Each bucket goes through a table once more, and documents look up their record.

Defined results: NULL text counts as empty, so all NULL and empty texts are equal. Of
equal texts the row with the largest id stays; NULL ids come last; among rows that
repeat the id as well, one stays. An empty table gives an empty result. Columns other than id and text
are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respfeat.llm.common import body, bounded, table, text_batches, written

#: A bucket, or what one task folds at a time, holds about this many bytes of distinct content.
TABLE_BYTES = 32 << 20
#: Bytes of records that leave a task together.
_SENT_BYTES = 1 << 20

_LIGHT = "row long, rec long, h long, size long, content binary, sha string, n long, top long, top_row long"


class ContentTable:
    """Open addressing with linear probing; entries are equal if their bytes are."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.used = 0

    def entry(self, h: int, content: bytes) -> int:
        """The number of the content's entry, a new one if it is not there yet."""
        mask = len(self.slots) - 1
        at = (h ^ (h >> 32)) & mask
        while (e := self.slots[at]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                return e
            at = (at + 1) & mask
        e = self.slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.used += len(content) + 100
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return e

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for e, h in enumerate(self.hashes):
            at = (h ^ (h >> 32)) & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = e


def _better(a: tuple, b: tuple) -> bool:
    """Is row a (id, row) to stay rather than b? NULL ids last, then the earlier row."""
    return (a[0] is not None, a[0] or 0, -a[1]) > (b[0] is not None, b[0] or 0, -b[1])


def _fold(table_bytes: int):
    def rows(rest, columns: list):
        names = ["id", "row", "rec", "h", "size", "content", "sha", "n", "top", "top_row"]
        kinds = {"content": pa.binary(), "sha": pa.string()}
        arrays = [pa.array(c, kinds.get(x, pa.int64())) if not isinstance(c, pa.Array) else c for x, c in zip(names, columns)]
        return pa.record_batch([arrays[0], rest, *arrays[1:]], names=[names[0], "rest", *names[1:]])

    def records(t: ContentTable, n: list, top: list, first: int, rest_type):
        """What the table holds, in batches of about a megabyte."""
        lo = size = 0
        for hi, c in enumerate(t.contents, 1):
            size += len(c)
            if size < _SENT_BYTES and hi < len(t.contents):
                continue
            k = hi - lo
            yield rows(pa.nulls(k, rest_type), [
                pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), range(first + lo, first + hi), t.hashes[lo:hi],
                list(map(len, t.contents[lo:hi])), t.contents[lo:hi], [hashlib.sha256(c).hexdigest() for c in t.contents[lo:hi]], n[lo:hi],
                [x[0] for x in top[lo:hi]], [x[1] for x in top[lo:hi]],
            ])
            lo, size = hi, 0

    def fold(batches):
        base = TaskContext.get().partitionId() << 36
        row = first = base
        t, n, top, rest_type = ContentTable(), [], [], None
        for b in batches:
            ids, own, rest_type = b["id"].to_pylist(), [], b["rest"].type
            for i, h, content in zip(ids, b["h"].to_pylist(), b["content"]):
                e = t.entry(h, content.as_py())
                if e == len(n):
                    n.append(0)
                    top.append((i, row))
                elif _better((i, row), top[e]):
                    top[e] = (i, row)
                n[e] += 1
                own.append(first + e)
                row += 1
                if t.used > table_bytes:
                    yield from records(t, n, top, first, rest_type)
                    first += len(n)
                    t, n, top = ContentTable(), [], []
            k = len(ids)
            null = pa.nulls(k, pa.int64())
            yield rows(b["rest"], [b["id"], range(row - k, row), own, null, null, pa.nulls(k, pa.binary()), pa.nulls(k, pa.string()), null, null, null])
        yield from records(t, n, top, first, rest_type)

    return fold


def _resolve(batches):
    """Records sorted by bucket -> the class of each record."""
    out = pa.schema([
        ("rec", pa.int64()), ("n", pa.int64()), ("top", pa.int64()), ("top_row", pa.int64()), ("sha", pa.string()),
    ])
    bucket, t, n, top, recs = None, ContentTable(), [], [], []

    def done():
        sha = [hashlib.sha256(c).hexdigest() for c in t.contents]
        return pa.record_batch([
            pa.array([r for r, _ in recs], pa.int64()), pa.array([n[e] for _, e in recs], pa.int64()),
            pa.array([top[e][0] for _, e in recs], pa.int64()), pa.array([top[e][1] for _, e in recs], pa.int64()),
            pa.array([sha[e] for _, e in recs], pa.string()),
        ], schema=out)

    for b in batches:
        heads = zip(*(b[c].to_pylist() for c in ("bucket", "rec", "h", "n", "top", "top_row")))
        for (at, rec, h, m, best, best_row), content in zip(heads, b["content"]):
            if at != bucket:
                if recs:
                    yield done()
                bucket, t, n, top, recs = at, ContentTable(), [], [], []
            e = t.entry(h, content.as_py())
            if e == len(n):
                n.append(0)
                top.append((best, best_row))
            elif _better((best, best_row), top[e]):
                top[e] = (best, best_row)
            n[e] += m
            recs.append((rec, e))
    if recs:
        yield done()


def _dealt(shared: DataFrame, table_bytes: int) -> tuple[DataFrame, int]:
    """Records with their bucket, and the number of buckets. Sizes are taken from the
    light columns of the written table; the contents move once, when all is settled."""
    total = shared.agg(F.sum("size")).first()[0] or 0
    buckets = 1 + total // table_bytes
    dealt = shared.withColumn("bucket", F.pmod(F.xxhash64("h", F.lit(0)), F.lit(buckets)))
    level = 0
    while True:
        level += 1
        sizes = dealt.groupBy("bucket").agg(F.sum("size").alias("size"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        large = sizes.where((F.col("size") > 2 * table_bytes) & (F.col("lo") < F.col("hi"))).select(
            "bucket", (1 + F.floor(2 * F.col("size") / table_bytes)).alias("parts")
        )
        more = large.agg(F.sum("parts")).first()[0]
        if more is None:
            return dealt, buckets
        buckets += more
        again = F.xxhash64("bucket", F.pmod(F.xxhash64("h", F.lit(level)), "parts"))
        dealt = dealt.join(large, "bucket", "left").withColumn(
            "bucket", F.when(F.col("parts").isNull(), F.col("bucket")).otherwise(again)
        ).drop("parts")


def _classes(df: DataFrame, id_col: str, text_col: str, rest: list[str], table_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(documents with the class of their text, written records)."""
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        (F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("int")).alias("rest"),
        F.xxhash64(body(text_col)).alias("h"),
        body(text_col).alias("content"),
    )
    light = [T.StructField("id", T.LongType()), T.StructField("rest", rows.schema["rest"].dataType)]
    schema = T.StructType([*light, *T.StructType.fromDDL(_LIGHT).fields])
    with text_batches(df.sparkSession):
        folded = written(rows.mapInArrow(_fold(table_bytes), schema), "grace")
    members = folded.where(F.col("row").isNotNull()).select("id", "rest", "row", "rec")
    records = folded.where(F.col("row").isNull()).select("rec", "h", "size", "content", "sha", "n", "top", "top_row")
    # Hashes of several records, by light columns. Contents of the others never move again.
    shared = written(records.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"), "shared")
    listed = bounded(shared)
    alone = records.join(listed, "h", "left_anti").select("rec", "n", "top", "top_row", "sha")
    dealt, buckets = _dealt(records.join(listed, "h", "left_semi"), table_bytes)
    together = (
        dealt.repartition(max(1, buckets), "bucket").sortWithinPartitions("bucket")
        .mapInArrow(_resolve, "rec long, n long, top long, top_row long, sha string")
    )
    return members.join(alone.unionByName(together), "rec"), records


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    classed, _ = _classes(df, id_col, text_col, [], table_bytes)
    return classed.select(
        F.col("id").alias("doc_id"), F.col("top").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("top_row")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def kept_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The documents that stay, with all columns of the input."""
    rest = [c for c in df.columns if c not in (id_col, text_col)]
    classed, records = _classes(df, id_col, text_col, [*rest, id_col], table_bytes)
    stays = classed.where(F.col("row") == F.col("top_row")).select("rec", "rest")
    out = stays.join(records.select("rec", "content"), "rec")
    text = F.col("content").cast("string")
    return out.select(*[text.alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in df.columns])


def query(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""
