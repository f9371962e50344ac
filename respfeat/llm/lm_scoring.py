"""Language-model scores: a unigram base and a gated recurrent network.

Counts. Each task folds its words before they are shuffled; counts cover all training
documents, those whose crc32 of the id leaves a remainder other than 0.

Model. The most frequent words have ids of their own, all others share ids by a hash of
their ending; both numbers follow the vocabulary that was counted. The network gives P(id | what came before), with the state carried over the whole
document; within a shared id a word has its smoothed share of the counts. So the
score is the log-probability of the text, over any vocabulary. Every training document is learned from
once: tasks train side by side on theirs and the weights are averaged by Spark, first over the
documents with remainders 1 to 3, then from there over the others.

Scores. Documents go through the network batch by batch. The counts of words with ids of their own go
around with the weights, so frequent words are summed where they stand. For the others each batch sends out one row
per distinct word with the places where it occurs; rows meet the counts in a join by word
and come back by batch as sums per document.

Defined results: NULL text counts as empty, one end token. A NULL id counts as the
empty text for the remainder. Repeated rows are scored each, and learned from each. Without
training tokens every word is unknown. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respfeat.llm import gru
from respfeat.llm.common import body, table, written

#: Words with an id of their own, ids for the others, both at least; units of the state.
OWN_IDS, SHARED_IDS, HIDDEN = 640, 384, 8
#: They grow with the root of the vocabulary: ids of their own, and for the others, times that root.
OWN_GROWTH, SHARED_GROWTH = 2.0, 1.2
#: Documents that run side by side, in training and in scoring; step size.
GROUP, SCORED_GROUP, RATE = 512, 2048, 0.08
#: Remainders of the two rounds of training.
ROUNDS = ((1, 2, 3), (4, 5, 6, 7, 8, 9))
ADDED = 0.1
#: The end is counted as a word that no text can hold.
END = b""
#: Documents of a batch, at most; places in it are two bytes wide.
_BATCH = 50_000


def _remainder(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10, F.lit(0))


def _ending(word: bytes) -> int:
    return zlib.crc32(word.rstrip(b".,")[-3:])


def ids_for(vocabulary: int) -> tuple[int, int]:
    """How many words of a vocabulary have ids of their own, and how many ids the others share."""
    root = vocabulary**0.5
    return max(OWN_IDS, int(OWN_GROWTH * root)), max(SHARED_IDS, int(SHARED_GROWTH * root))


class _Numbered:
    """Documents as arrays of the batch's own word numbers."""

    def __init__(self, texts) -> None:
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        end = number[END]
        self.docs = []
        for t in texts:
            words = t.as_py().lower().split()
            ids = np.empty(len(words) + 1, np.int32)
            ids[:-1] = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
            ids[-1] = end
            self.docs.append(ids)
        self.words = list(number)

    def flat(self) -> np.ndarray:
        return np.concatenate(self.docs) if self.docs else np.zeros(0, np.int32)


def _slices(batches):
    for b in batches:
        for at in range(0, b.num_rows, _BATCH):
            yield b.slice(at, _BATCH)


def _count(batches):
    for b in _slices(batches):
        n = _Numbered(b["text"])
        c = np.bincount(n.flat(), minlength=len(n.words))
        yield pa.record_batch(
            [pa.array(n.words, pa.binary()), pa.array(c), pa.array([_ending(w) for w in n.words], pa.int64())], names=["word", "n", "ending"]
        )


class Model:
    """Weights of the network, and which words have ids of their own."""

    def __init__(self, own: dict[bytes, int], own_ids: int, shared_ids: int, flat: np.ndarray) -> None:
        self.own, self.own_ids, self.shared_ids, self.flat = own, own_ids, shared_ids, flat
        self.shape = gru.Shape(own_ids + shared_ids, HIDDEN)

    def shared_id(self, word: bytes) -> int:
        return _ending(word) % self.shared_ids

    def ids(self, words: list[bytes]) -> np.ndarray:
        own, first, shared, crc = self.own, self.own_ids, self.shared_ids, zlib.crc32
        # As ``shared_id`` gives them, without two calls a word.
        return np.array([own[w] if w in own else first + crc(w.rstrip(b".,")[-3:]) % shared for w in words], np.int64)

    def documents(self, n: _Numbered) -> list[np.ndarray]:
        ids = self.ids(n.words)
        return [ids[d] for d in n.docs]


def _learner(shared):
    """Texts -> the weights after one pass over the task's documents, and their tokens."""

    def run(batches):
        model, seen = shared.value, 0
        flat = model.flat.copy()
        for b in _slices(batches):
            seen += gru.train(flat, model.shape, model.documents(_Numbered(b["text"])), GROUP, RATE)
        if seen:
            yield pa.record_batch([
                pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat.astype(np.float64) * seen), pa.array(np.full(len(flat), float(seen))),
            ], names=["i", "sum", "tokens"])

    return run


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, ending, c) over the training documents, written."""
    rows = df.where(_remainder(id_col) != 0).select(body(text_col).alias("text"))
    return written(
        rows.mapInArrow(_count, "word binary, n long, ending long").groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("c")),
        "counts",
    )


def train(df: DataFrame, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    own_ids, shared_ids = ids_for(counts.count())
    top = counts.orderBy(F.desc("c"), "word").limit(own_ids).collect()  # own_ids rows
    mass = np.zeros(own_ids + shared_ids)
    for r in _by_shared_id(counts, shared_ids):
        mass[own_ids + r["shared"]] = r["c"]
    for k, r in enumerate(top):
        mass[k] = r["c"]
        mass[own_ids + r["ending"] % shared_ids] -= r["c"]
    model = Model({bytes(r["word"]): k for k, r in enumerate(top)}, own_ids, shared_ids, np.zeros(0))
    model.flat = model.shape.initial(mass)
    for remainders in ROUNDS:
        shared = df.sparkSession.sparkContext.broadcast(model)
        rows = df.where(_remainder(id_col).isin(*remainders)).select(body(text_col).alias("text"))
        mean = rows.mapInArrow(_learner(shared), "i int, sum double, tokens double").groupBy("i").agg((F.sum("sum") / F.sum("tokens")).alias("v"))
        got = mean.toArrow()  # one row per weight
        flat = model.flat.copy()
        flat[got["i"].to_numpy()] = got["v"].to_numpy()
        model = Model(model.own, own_ids, shared_ids, flat)
    return model


def _by_shared_id(counts: DataFrame, shared_ids: int) -> list:
    """Rows (shared, c, v), one per shared id: its tokens and its words."""
    return counts.groupBy((F.col("ending") % shared_ids).alias("shared")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()


def _sent(shared, own_logs: np.ndarray):
    """(doc_id, held_out, text) -> per batch, one row for each distinct word that shares its id, with its places,
    and one with the documents, what the network says and the sums over words with ids of their own.
    own_logs: log10 of the share of the counts of these words, by id."""

    def run(batches):
        model, part = shared.value, TaskContext.get().partitionId()
        for k, b in enumerate(_slices(batches)):
            n = _Numbered(b["text"])
            size = len(n.docs)
            lengths = np.array([len(d) for d in n.docs], np.int64)
            ids = model.ids(n.words)
            scores = gru.score(model.flat, model.shape, [ids[d] for d in n.docs], SCORED_GROUP)
            flat, of = n.flat(), np.repeat(np.arange(size), lengths)
            common = (ids < model.own_ids)[flat]
            bases = np.bincount(of[common], own_logs[ids[flat[common]]], minlength=size)
            known = np.bincount(of[common], minlength=size)
            rare = np.flatnonzero(ids >= model.own_ids)
            number = np.zeros(len(ids), np.int64)
            number[rare] = np.arange(len(rare))
            places, times = np.unique(number[flat[~common]] * size + of[~common], return_counts=True)
            # More than two bytes hold goes as several places.
            parts = 1 + (times - 1) // 65535
            of, last = np.repeat(np.arange(len(places)), parts), np.cumsum(parts) - 1
            put = np.full(len(of), 65535)
            put[last] = times - 65535 * (parts - 1)
            packed = np.empty((len(of), 2), np.uint16)
            packed[:, 0], packed[:, 1] = (places % max(size, 1))[of], put
            at, w, words = (part << 24) + k, len(rare), [n.words[x] for x in rare]
            edges = np.searchsorted((places // max(size, 1))[of], np.arange(w + 1)).astype(np.int32) * 4
            postings = pa.Array.from_buffers(pa.binary(), w, [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(packed.tobytes())])
            yield pa.record_batch(
                [pa.array(np.full(w, at)), pa.array(words, pa.binary()), postings, pa.array(ids[rare] - model.own_ids, pa.int32()), pa.nulls(w, pa.binary())],
                names=_NAMES,
            )
            docs = np.zeros(size, _DOCUMENT)
            docs["doc_id"], docs["no_id"] = b["doc_id"].fill_null(0).to_numpy(), b["doc_id"].is_null().to_numpy(zero_copy_only=False)
            docs["held_out"] = b["held_out"].to_numpy(zero_copy_only=False)
            docs["length"], docs["score"], docs["base"], docs["known"] = lengths, scores, bases, known
            # A word with a space meets no count; the number spreads these rows over the partitions.
            yield pa.record_batch(
                [pa.array([at], pa.int64()), pa.array([b" %d" % at], pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()),
                 pa.array([docs.tobytes()], pa.binary())],
                names=_NAMES,
            )

    return run


#: A batch's documents travel as bytes: Spark measures a batch at each row that it adds, which for
#: a column of lists takes a step for each NULL before it, so columns of lists are quadratic there.
_DOCUMENT = np.dtype([("doc_id", "i8"), ("no_id", "?"), ("held_out", "?"), ("length", "i8"), ("score", "f8"), ("base", "f8"), ("known", "i8")])
_NAMES = ["batch", "word", "postings", "shared", "docs"]
_SENT = "batch long, word binary, postings binary, shared int, docs binary"


def _folded(total: float, below: np.ndarray):
    """The rows of one batch -> its documents. total: what counts are divided by; below: the
    same for words that share an id, by id."""

    def fold(t: pa.Table) -> pa.Table:
        packed = t["postings"].to_pylist()
        head = next(k for k, p in enumerate(packed) if p is None)
        docs = np.frombuffer(t["docs"][head].as_py(), _DOCUMENT)
        of = np.repeat(np.arange(len(packed)), [len(p) // 4 if p else 0 for p in packed])
        places = np.frombuffer(b"".join(p for p in packed if p), np.uint16).reshape(-1, 2)
        at, times = places[:, 0], places[:, 1].astype(float)
        c, shared = t["c"].to_numpy(), t["shared"].fill_null(-1).to_numpy()
        logs = np.log10(c + ADDED)

        def summed(by_word: np.ndarray) -> np.ndarray:
            return np.bincount(at, by_word[of] * times, minlength=len(docs))

        return pa.table({
            "doc_id": pa.array(docs["doc_id"], mask=docs["no_id"]), "held_out": pa.array(docs["held_out"]), "n_tokens": pa.array(docs["length"]),
            "n_known": pa.array(docs["known"] + summed(c > 0).round().astype(np.int64)),
            "base_score": pa.array(docs["base"] + summed(logs - np.log10(total))),
            "score": pa.array(docs["score"] + summed(np.where(shared >= 0, logs - np.log10(below[shared]), 0.0))),
        })

    return fold


def scores(df: DataFrame, counts: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    shared_sums = {r["shared"]: [r["c"], r["v"]] for r in _by_shared_id(counts, model.shared_ids)}
    own = df.sparkSession.createDataFrame([(w,) for w in model.own], "word binary")
    own_logs, total = np.zeros(model.own_ids), n + ADDED * (v + 1)
    for r in counts.join(F.broadcast(own), "word", "left_semi").collect():  # own_ids rows
        own_logs[model.own[bytes(r["word"])]] = np.log10(r["c"] + ADDED) - np.log10(total)
        shared_sums[r["ending"] % model.shared_ids][0] -= r["c"]
        shared_sums[r["ending"] % model.shared_ids][1] -= 1
    below = np.array([c + ADDED * (v + 1) for c, v in (shared_sums.get(k, (0, 0)) for k in range(model.shared_ids))])
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), (_remainder(id_col) == 0).alias("held_out"), body(text_col).alias("text"))
    sent = rows.mapInArrow(_sent(shared, own_logs), _SENT).join(counts.select("word", "c"), "word", "left")
    counted = sent.withColumn("c", F.coalesce("c", F.lit(0))).drop("word")
    found = counted.groupBy("batch").applyInArrow(
        _folded(total, below), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = word_counts(docs)
    return scores(docs, counts, train(docs, counts))
