"""Repeated passages of words, found through difference-cover anchors.

A set of residues modulo 31 in which every difference occurs is a difference cover: two
equal passages, wherever they begin, have words at some common offset below 31 whose places
both lie in the cover. So it is enough to hash windows of 20 words at places in the
cover (6 of 31): any two equal passages of 20 + 31 - 1 = 50 words share one of these anchors.

1. Copies: of equal texts only the first document looks for passages; the others are
   windows of a smaller document throughout.
2. Anchors that two documents hold are shared; the documents look up which of theirs are.
3. Around each shared anchor the match is extended: the windows of 50 words that hold it
   are hashed whole, and each learns the smallest document that has one like it.
4. Words covered by a window of which a smaller document has one are removed.

Frequent anchors and windows are sums and minima, folded within each task before
they are shuffled; no group of documents is ever gathered.

Defined results: NULL, empty and wordless texts have no words. A row without an id ranks
after all others and never before one another. Rows that repeat an id are the same document, so none
removes words of the other. Texts shorter than a window keep all words. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respfeat.llm.common import body, bounded, row_key, table, text_batches, written
from respfeat.llm.words import window_hashes, word_hashes

WINDOW = 50
PERIOD = 31
#: A perfect difference set modulo 31.
COVER = (1, 5, 11, 24, 25, 27)
_LAST = 2**63 - 1


def _anchors(window: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of a document."""
    w = window_hashes(h, window - PERIOD + 1)
    places = np.flatnonzero(np.isin(np.arange(PERIOD), COVER)[np.arange(len(w)) % PERIOD])
    return places, w[places]


def _counted(window: int):
    """Texts -> (anchor, documents that hold it, at most two), folded per batch."""

    def run(batches):
        for b in batches:
            own = [np.unique(_anchors(window, word_hashes(t.as_py(), lower=False))[1]) for t in b["text"]]
            a, n = np.unique(np.concatenate(own) if own else np.zeros(0, np.uint64), return_counts=True)
            yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int8))], names=["anchor", "n"])

    return run


def _listed(window: int):
    """(row, text) -> (anchor, row)."""

    def run(batches):
        for b in batches:
            rows = b["row"].to_numpy()
            own = [np.unique(_anchors(window, word_hashes(t.as_py(), lower=False))[1]) for t in b["text"]]
            of = np.repeat(rows, [len(x) for x in own])
            a = np.concatenate(own) if own else np.zeros(0, np.uint64)
            yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(of)], names=["anchor", "row"])

    return run


def _windowed(window: int):
    """(row, id, text, shared anchors) -> the windows that hold one: (hash, row, id, place)."""

    def run(batches):
        for b in batches:
            parts = []
            for row, i, t, shared in zip(b["row"].to_pylist(), b["id"].to_pylist(), b["text"], b["anchors"]):
                h = word_hashes(t.as_py(), lower=False)
                places, anchors = _anchors(window, h)
                hit = places[np.isin(anchors.view(np.int64), shared.values.to_numpy())]
                w = window_hashes(h, window)
                # Starts from which a window covers the anchor whole.
                edge = np.zeros(len(h) + 2, np.int64)
                np.add.at(edge, np.maximum(hit - PERIOD + 1, 0), 1)
                np.add.at(edge, hit + 1, -1)
                at = np.flatnonzero(np.cumsum(edge)[: len(w)] > 0)
                parts.append((w[at], np.full(len(at), row), np.full(len(at), i), at))
            cols = [np.concatenate([p[k] for p in parts]) for k in range(4)]
            yield pa.record_batch(
                [pa.array(cols[0].view(np.int64)), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3].astype(np.int32))],
                names=["window", "row", "id", "place"],
            )

    return run


def covered(places: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of n items lie in a window that begins at one of the places."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + window, -1)
    return np.cumsum(edge)[:n] > 0


def _cut(window: int):
    """(key, text, places) -> what stays of the text."""

    def run(batches):
        for b in batches:
            gone, sha, kept = [], [], []
            for t, places in zip(b["text"], b["places"]):
                words = t.as_py().split()
                out = covered(np.unique(places.values.to_numpy()), len(words), window)
                gone.append(int(out.sum()))
                kept.append(b" ".join([w for w, x in zip(words, out.tolist()) if not x]))
                sha.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.record_batch([b["key"], pa.array(gone, pa.int64()), pa.array(sha), pa.array(kept, pa.binary())],
                                  names=["key", "n_removed", "kept_sha256", "kept"])

    return run


def _whole(batches):
    """Every row as if nothing were removed."""
    for b in batches:
        n, sha = [], []
        for t in b["text"]:
            words = t.as_py().split()
            n.append(len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.record_batch([b["id"], b["doc_id"], b["key"], b["same"], pa.array(n, pa.int64()), pa.array(sha, pa.string())],
                              names=["id", "doc_id", "key", "same", "n_words", "kept_sha256"])


def repeated_windows(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, ...]:
    """(rows, classes, cut): rows (id, doc_id, key, same, n_words, kept_sha256) as if nothing
    were removed; the first id of each text (same, first); what is left of the documents of which
    something is removed (key, n_removed, kept_sha256, kept)."""
    texts = df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.col(id_col).alias("doc_id"),
        row_key(id_col, text_col).alias("key"), F.xxhash64(F.col(id_col), body(text_col)).alias("row"),
        F.md5(body(text_col)).alias("same"), body(text_col).alias("text"),
    )
    kinds = f"id long, doc_id {df.schema[id_col].dataType.simpleString()}, key string, same string, n_words long, kept_sha256 string"
    with text_batches(df.sparkSession):
        rows = written(texts.select("id", "doc_id", "key", "same", "text").mapInArrow(_whole, kinds), "rows")
        classes = rows.groupBy("same").agg(F.min("id").alias("first"))
        copies = written(rows.join(classes, "same").where("id > first").select("key").distinct(), "copies")
        own = texts.where(F.octet_length("text") >= 2 * window - 1).join(bounded(copies), "key", "left_anti")

        shared = (
            own.select("text").mapInArrow(_counted(window), "anchor long, n byte")
            .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
        )
        held = own.select("row", "text").mapInArrow(_listed(window), "anchor long, row long").join(shared, "anchor")
        asked = written(held.groupBy("row").agg(F.collect_set("anchor").alias("anchors")), "anchors")
        some = own.select("row", "id", "text").join(bounded(asked.select("row").alias("some")), "row", "left_semi")
        windows = written(some.join(asked, "row").mapInArrow(_windowed(window), "window long, row long, id long, place int"), "windows")
        first = windows.groupBy("window").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
        hits = windows.join(first.select("window", "first"), "window").where("id > first")
        places = written(hits.groupBy("row").agg(F.collect_set("place").alias("places")), "places")
    hit = own.select("row", "key", "text").join(bounded(places.select("row")), "row", "left_semi").dropDuplicates(["key"])
    cut = hit.join(places, "row").mapInArrow(_cut(window), "key string, n_removed long, kept_sha256 string, kept binary")
    return rows, classes, cut


def substring_dedup(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    rows, classes, cut = repeated_windows(df, window, id_col, text_col)
    with text_batches(df.sparkSession):
        found = written(cut.select("key", "n_removed", F.col("kept_sha256").alias("cut_sha")), "cut")
    copy = (F.col("id") > F.col("first")) & (F.col("n_words") >= window)
    return rows.join(classes, "same").join(found, "key", "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "kept_sha256")).alias("kept_sha256"),
    )


def query(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents"))
