"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks over the characters with the nodes from which some piece may still
reach ahead; that window is bounded by the longest piece. As soon as all surviving
backpointer paths go through one boundary, what lies before is committed. In front of a
space mark that follows another character there is only one survivor, so words commit one
by one. Words that a task has not met lately are searched side by side in numpy, by the same
recurrence; the ids of others come from a cache of bounded size.

Scores are the model's own for a unigram model. A BPE model's scores are merge ranks, not
probabilities; they are read as Zipf probabilities, log p = -log(rank + 2), so the result is
the most probable segmentation, not the sequence of merges.
Characters without a piece of their own go as UTF-8 bytes, and so does a literal U+2581,
which otherwise stands for the space; decoding therefore gives back every text exactly.

Defined results: NULL and empty texts have no ids; whole texts of any length are encoded;
rows that repeat are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respfeat.llm.common import body, table

#: Place of the public vocabulary; a parameter of every function here.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_SPACE_CODE, _FACTOR = np.uint64(ord(SPACE)), np.uint64(0x9E3779B97F4A7C15)
#: Texts that are cut into stretches at a time.
_CHUNK = 1 << 20
#: Words that a worker remembers before it starts anew.
CACHE_WORDS = 80_000
_SEGMENT = re.compile(r" *[^ ]+| +")
#: The same, cut between a letter and a full stop or comma as well.
_LETTER = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_FINER = re.compile(rf" *[{_LETTER}]+(?=[.,])| *[^ ]+| +")
_STOP = re.compile(rf"[{_LETTER}][.,]")


class Codec:
    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes_id = [0] * 256
        self.text = [b""] * n
        self.pieces: dict[str, tuple[int, float]] = {}
        ranked = all(model.get_score(i) == round(model.get_score(i)) for i in range(n))
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.bytes_id[value], self.text[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece, score = model.id_to_piece(i), model.get_score(i)
                self.pieces[piece] = (i, -math.log(2 - score) if ranked else score)
                self.text[i] = piece.replace(SPACE, " ").encode()
        #: A byte is taken only where no piece covers the character.
        self.byte_score = min(s for _, s in self.pieces.values()) - 20
        self.prefixes = {p[:k] for p in self.pieces for k in range(1, len(p))}
        self.span = max(map(len, self.pieces))
        self.apart = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.pieces)
        #: Stretches whose ends are boundaries of every path, as no piece goes across.
        self.stretch = _SEGMENT if any(map(_STOP.search, self.pieces)) else _FINER
        self.newline = array("i", self.viterbi("\n")).tobytes()
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # For the search over many stretches at once: pieces and their beginnings by hash.
        named = {p: self.pieces.get(p) for p in [*self.pieces, *self.prefixes]}
        keys = np.array([_hash(p) for p in named], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ids = np.array([x[0] if x else -1 for x in named.values()], np.int32)[order]
        self.key_scores = np.array([x[1] if x else -np.inf for x in named.values()])[order]
        self.key_ahead = np.array([p in self.prefixes for p in named])[order]

    def viterbi(self, chars: str) -> list[int]:
        """Ids of the best path over ``chars``, in which spaces are marks already."""
        out: list[int] = []
        get, prefixes, end = self.pieces.get, self.prefixes, len(chars)
        # Nodes from the last committed one on: best score, best predecessor, its piece.
        base, score, back, by = 0, [0.0], [0], [-1]
        far = 0  # how far an edge from a node before this one reaches
        for i in range(end):
            here = score[i - base]
            if far <= i:
                if i > base:
                    self._commit(chars, base, back, by, i, out)
                    base, score, back, by = i, [here], [i], [-1]
            elif i - base > 4 * self.span:
                at = self._meeting(base, back, len(score), i)
                if at > base:
                    self._commit(chars, base, back, by, at, out)
                    cut = at - base
                    base, score, back, by = at, score[cut:], back[cut:], by[cut:]
            j = i + 1
            part = chars[i:j]
            found = get(part)
            if found is None:
                found = (-1, len(part.encode()) * self.byte_score)
            while True:
                if found is not None:
                    total, k = here + found[1], j - base
                    if k >= len(score):
                        score += [-math.inf] * (k + 1 - len(score))
                        back += [-1] * (k + 1 - len(back))
                        by += [-1] * (k + 1 - len(by))
                    if total > score[k]:
                        score[k], back[k], by[k] = total, i, found[0]
                    if j > far:
                        far = j
                if j == end or part not in prefixes:
                    break
                j += 1
                part = chars[i:j]
                found = get(part)
        if base < end:
            self._commit(chars, base, back, by, end, out)
        return out

    @staticmethod
    def _meeting(base: int, back: list[int], known: int, now: int) -> int:
        """The last boundary on all paths to this node and the reached ones ahead."""
        common = None
        for node in range(now, base + known):
            if node > now and back[node - base] < 0:
                continue
            path = {node}
            while node > base:
                node = back[node - base]
                path.add(node)
            common = path if common is None else common & path
        return max(x for x in common if x <= now)

    def _commit(self, chars: str, base: int, back: list[int], by: list[int], hi: int, out: list[int]) -> None:
        steps = []
        while hi > base:
            i, piece = back[hi - base], by[hi - base]
            steps.append([piece] if piece >= 0 else [self.bytes_id[b] for b in chars[i:hi].encode()])
            hi = i
        for s in reversed(steps):
            out += s

    def _stretch(self, key: str) -> bytes:
        """Ids of a stretch whose ends are boundaries of every path."""
        ids: list[int] = []
        for k, part in enumerate(key.split(SPACE)):
            if k:
                ids += [self.bytes_id[b] for b in SPACE.encode()]
            if part:
                ids += self.viterbi(part.replace(" ", SPACE))
        return array("i", ids).tobytes()

    def _side_by_side(self, keys: list[str]) -> list[bytes]:
        """The same search over many short stretches, one character of each at a time."""
        n = len(keys)
        length = np.array([len(k) for k in keys])
        order = np.argsort(-length, kind="stable")
        length, top = length[order], int(length.max())
        codes = np.full((top + 1, n), _SPACE_CODE, np.uint64)
        flat = np.frombuffer("".join([keys[k] for k in order]).encode("utf-32-le"), np.uint32)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
        codes[at, np.repeat(np.arange(n), length)] = np.where(flat == 32, _SPACE_CODE, flat)
        score = np.full((top + 1, n), -np.inf)
        score[0] = 0
        back, by = np.zeros((top + 1, n), np.int32), np.full((top + 1, n), -1, np.int32)
        for i in range(top):
            w = np.arange(int(np.searchsorted(-length, -i, side="left")))  # those longer than i
            here, h, k = score[i, w], np.zeros(len(w), np.uint64), 0
            while len(w) and k < self.span:
                c = codes[i + k, w]
                h = (h + c + np.uint64(1)) * _FACTOR
                h ^= h >> np.uint64(32)
                slot = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                known = self.keys[slot] == h
                found = np.where(known, self.key_scores[slot], -np.inf)
                ids = np.where(known, self.key_ids[slot], -1)
                if k == 0:
                    size = 1 + (c >= 0x80).astype(int) + (c >= 0x800) + (c >= 0x10000)
                    found = np.where(np.isfinite(found), found, size * self.byte_score)
                total, k = here + found, k + 1
                better = total > score[i + k, w]
                on = w[better]
                score[i + k, on], back[i + k, on], by[i + k, on] = total[better], i, ids[better]
                more = known & self.key_ahead[slot] & (length[w] > i + k)
                w, h, here = w[more], h[more], here[more]
        out, at, w = [[] for _ in keys], length.copy(), np.arange(n)
        while len(w):
            for x, piece, j, i in zip(w.tolist(), by[at[w], w].tolist(), at[w].tolist(), back[at[w], w].tolist()):
                if piece >= 0:
                    out[x].append(piece)
                else:
                    out[x] += [self.bytes_id[b] for b in reversed(keys[order[x]][i:j].encode())]
            at[w] = back[at[w], w]
            w = w[at[w] > 0]
        found = [b""] * n
        for k, ids in zip(order.tolist(), out):
            found[k] = array("i", reversed(ids)).tobytes()
        return found

    def _remember(self, stretches: set[str]) -> None:
        """Puts the ids of all stretches into the cache."""
        cache, older, new = self.cache, self.older, []
        for x in stretches:
            if x not in cache:
                if x in older:
                    cache[x] = older[x]
                else:
                    new.append(x)
        short = [x for x in new if len(x) <= 40 and SPACE not in x]
        for lo in range(0, len(short), 20_000):
            part = short[lo : lo + 20_000]
            cache.update(zip(part, self._side_by_side(part)))
        for x in new:
            if x not in cache:
                cache[x] = self._stretch(x)

    def _turn_over(self) -> None:
        """Forgets the stretches that have not been met for long."""
        if len(self.cache) > CACHE_WORDS:
            self.older, self.cache = {k: v for k, v in self.cache.items() if len(k) <= 40}, {}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit integers. A space goes in front, as the model was made with."""
        if not self.apart:
            return [self._stretch(" " + t) if t else b"" for t in texts]
        cut = self.stretch.findall
        split = [[cut(line) for line in (" " + t).split("\n")] if t else [] for t in texts]
        self._turn_over()
        self._remember({x for lines in split for line in lines for x in line})
        of = self.cache.__getitem__
        return [self.newline.join([b"".join(map(of, line)) for line in lines]) for lines in split]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        """The text as UTF-8."""
        return b"".join(map(self.text.__getitem__, ids))[1:]


def _hash(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h + ord(c) + 1) * int(_FACTOR) % 2**64
        h ^= h >> 32
    return h


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _chunks(texts):
    """Lists of whole texts, of about ``_CHUNK`` bytes each."""
    part, size = [], 0
    for t in texts:
        part.append(t.as_py())
        size += len(part[-1])
        if size >= _CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """doc_id, n_ids, ids, round_trip: whether decoding the ids gives the text back."""

    def run(batches):
        c = codec(model)
        for b in batches:
            ids, offsets, ok = [], [0], []
            for raws in _chunks(b["text"]):
                for raw, found in zip(raws, c.encode_all([r.decode() for r in raws])):
                    ids.append(found)
                    offsets.append(offsets[-1] + len(found) // 4)
                    ok.append(c.decode(array("i", found)) == raw)
            values = pa.array(np.frombuffer(b"".join(ids), np.int32), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            counts = pa.array(np.diff(np.array(offsets, np.int64)), pa.int64())
            yield pa.record_batch([b["doc_id"], counts, lists, pa.array(ok, pa.bool_())], names=["doc_id", "n_ids", "ids", "round_trip"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), body(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_ids long, ids array<int>, round_trip boolean")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """doc_id, text: the texts of lists of ids; NULL lists give the empty text."""

    def run(batches):
        c = codec(model)
        for b in batches:
            texts = [c.decode(x or []).decode(errors="replace") for x in b["ids"].to_pylist()]
            yield pa.record_batch([b["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def query(spark, sf_dir):
    return encode(table(spark, sf_dir, "documents"))
