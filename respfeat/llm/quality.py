"""Ordinal quality classifier: cumulative links over hashed text features.

Grades are ordered: 0 harmful, 1 poor, 2 good. One weight vector gives a document's
latent score s; ordered thresholds give P(grade > k) = sigmoid(s - theta_k). The score
is the sum of the weights of the distinct features of the whole text: hashed
words, the marks that words end in, and how often a word follows itself.

The model is fitted on at most ``MAX_LABELLED`` labelled documents, the first by
hash of their id; nothing else here is bounded. Features that few of them hold, or that are
spread over the grades as chance would, get no weight.

Defined results: NULL and empty texts have no feature and take the thresholds' own
probabilities; labels with NULLs in any column or without a document are left out;
a document labelled several times counts by its lowest grade; without any label, every
document counts as good and is kept. Each row gets its own result, repeated or not.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respfeat.llm.common import body, table

#: Labelled documents that the model is fitted on, at most.
MAX_LABELLED = 20_000
MIN_DOCUMENTS = 2
#: Standard errors by which a feature's shares must differ, beyond what chance brings about among n labels, sqrt(2 ln n).
CLEAR = 0.5
BITS = 20
GRADES = 3
#: The penalty on squared weights is DECAY by the number of labels.
STEPS, RATE, DECAY = 250, 0.05, 1.0
_STRIP = re.compile(rb"^[^0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff]+$")
#: About 10 MB in each worker.
_CACHE_WORDS = 40_000


def _feature(name: bytes) -> int:
    return zlib.crc32(name) & ((1 << BITS) - 1)


class _Words(dict):
    """Features of a word, remembered."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        core = _STRIP.sub(b"", word)
        marks = word[len(word.rstrip(b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~")) :]
        out = [_feature(b"w" + core)] if core else []
        if marks:
            out.append(_feature(b"m" + marks))
        out = self[word] = tuple(out)
        return out


_words = _Words()


def features(text: bytes) -> set[int]:
    """Hashed features of a whole text."""
    words = text.lower().split()
    out: set[int] = set()
    for w in set(words):
        out.update(_words[w])
    if words:
        again = sum(map(bytes.__eq__, words, words[1:])) / len(words)
        if again > 0.02:
            out.add(_feature(b"again" + b"%d" % min(4, int(again * 10))))
    return out


class Model:
    """Weights of all features, and the thresholds between grades."""

    def __init__(self, weights: np.ndarray, theta: np.ndarray) -> None:
        self.weights, self.theta = weights, theta

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and k."""
        return 1 / (1 + np.exp(np.clip(self.theta[None, :] - scores[:, None], -60, 60)))


def _telling(flat: np.ndarray, of: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Which features split the grades at some threshold more clearly than chance would: a test of
    two shares. Most words tell nothing, and their weights would only add up to noise."""
    held = np.bincount(flat, minlength=1 << BITS)
    share, best = held / len(grades), np.zeros(1 << BITS)
    for k in range(GRADES - 1):
        low = grades <= k
        n = int(low.sum())
        if 0 < n < len(grades):
            part = np.bincount(flat[low[of]], minlength=1 << BITS)
            spread = np.sqrt(share * (1 - share) * (1 / n + 1 / (len(grades) - n)))
            z = np.abs(part / n - (held - part) / (len(grades) - n)) / np.maximum(spread, 1e-12)
            best = np.maximum(best, np.where(held < len(grades), z, 0))
    return (held >= MIN_DOCUMENTS) & (best >= CLEAR + np.sqrt(2 * np.log(len(grades))))


def fit(rows: list[np.ndarray], grades: np.ndarray) -> Model:
    """Maximum likelihood with weight decay, by Adam over all rows at once."""
    weights = np.zeros(1 << BITS, np.float32)
    if not len(rows):
        return Model(weights, np.array([-30.0, -29.0]))
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    enough = _telling(flat, of, grades)
    own = np.flatnonzero(enough)
    number = np.zeros(1 << BITS, np.int64)
    number[own] = np.arange(len(own))
    of, flat = of[enough[flat]], number[flat[enough[flat]]]
    above = (grades[:, None] > np.arange(GRADES - 1)[None, :]).astype(float)
    # theta = first, then positive gaps, so that thresholds stay in order.
    x = np.zeros(len(own) + GRADES - 1)
    m, v = np.zeros_like(x), np.zeros_like(x)
    x[len(own)] = -1.0
    for step in range(1, STEPS + 1):
        w, raw = x[: len(own)], x[len(own) :]
        gaps = np.log1p(np.exp(raw[1:]))
        theta = np.concatenate([raw[:1], raw[0] + np.cumsum(gaps)])
        s = np.bincount(of, w[flat], minlength=len(rows))
        z = np.clip(s[:, None] - theta[None, :], -60, 60)
        tail = np.concatenate([np.ones((len(s), 1)), 1 / (1 + np.exp(-z)), np.zeros((len(s), 1))], axis=1)
        p = np.maximum(tail[np.arange(len(s)), grades] - tail[np.arange(len(s)), grades + 1], 1e-9)
        slope = tail * (1 - tail)  # of each tail by s
        lo, hi = slope[np.arange(len(s)), grades], slope[np.arange(len(s)), grades + 1]
        by_s = -(lo - hi) / p / len(s)
        by_theta = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            sign = np.where(grades == k + 1, slope[:, k + 1], 0) - np.where(grades == k, slope[:, k + 1], 0)
            by_theta[k] = (sign / p).sum() / len(s)
        g = np.empty_like(x)
        g[: len(own)] = np.bincount(flat, by_s[of], minlength=len(own)) + DECAY / len(rows) * w
        g[len(own)] = by_theta.sum()
        g[len(own) + 1 :] = np.cumsum(by_theta[::-1])[::-1][1:] / (1 + np.exp(-raw[1:]))
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    raw = x[len(own) :]
    weights[own] = x[: len(own)]
    return Model(weights, np.concatenate([raw[:1], raw[0] + np.cumsum(np.log1p(np.exp(raw[1:])))]))


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade: harmful before poor before good."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    known = F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & F.col("quality").isNotNull()
    return labels.where(known).groupBy("doc_id").agg(F.min(grade).alias("grade"))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on the labelled documents (``labels``: doc_id, grade)."""
    some = labels.select(F.col("doc_id").alias("labelled"), "grade").orderBy(F.xxhash64("labelled"), "labelled").limit(max_labelled)

    def run(batches):
        for b in batches:
            sets = [np.fromiter(f, np.int32, len(f)).tobytes() for f in (features(t.as_py()) for t in b["text"])]
            yield pa.record_batch([b["grade"], pa.array(sets, pa.binary())], names=["grade", "features"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), body(text_col).alias("text"))
    # At most max_labelled rows of two numbers.
    held = rows.join(F.broadcast(some), F.col("id") == F.col("labelled")).select(F.col("grade").cast("int").alias("grade"), "text")
    got = held.mapInArrow(run, "grade int, features binary").toArrow()
    order = sorted(range(got.num_rows), key=lambda k: (got["features"][k].as_py(), got["grade"][k].as_py()))
    sets = [np.frombuffer(got["features"][k].as_py(), np.int32).astype(np.int64) for k in order]
    return fit(sets, np.array([got["grade"][k].as_py() for k in order], np.int64))


def _scorer(spark, model: Model):
    shared = spark.sparkContext.broadcast((model.weights, model.theta))

    def scores(texts) -> np.ndarray:
        weights, theta = shared.value
        s = [float(weights[np.fromiter(f, np.int64, len(f))].sum()) for f in (features(t.as_py()) for t in texts)]
        return Model(weights, theta).tails(np.array(s))

    return scores


def grade(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, expected_grade, p_above_0, p_above_1, kept: whether the expected grade is nearest to good."""
    scores = _scorer(df.sparkSession, model)

    def run(batches):
        for b in batches:
            tails = scores(b["text"])
            yield pa.record_batch([
                b["doc_id"], pa.array(tails.sum(axis=1)), pa.array(tails[:, 0]), pa.array(tails[:, 1]), pa.array(_keep(tails)),
            ], names=["doc_id", "expected_grade", "p_above_0", "p_above_1", "kept"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), body(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, expected_grade double, p_above_0 double, p_above_1 double, kept boolean")


def _keep(tails: np.ndarray) -> np.ndarray:
    return tails.sum(axis=1) >= GRADES - 1.5


def kept_documents(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that stay, with all columns of the input."""
    scores = _scorer(df.sparkSession, model)

    def run(batches):
        for b in batches:
            # NULL texts arrive as NULL here.
            texts = [pa.scalar((t.as_py() or "").encode()) for t in b.column(b.schema.names.index(text_col))]
            yield b.filter(pa.array(_keep(scores(texts))))

    return df.mapInArrow(run, df.schema)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return grade(docs, train(docs, graded(table(spark, sf_dir, "labels"))))
