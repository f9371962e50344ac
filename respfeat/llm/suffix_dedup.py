"""Repeated byte strings, by suffix arrays of all places that may repeat.

1. Copies: of equal texts only the first document is searched; the others repeat it
   throughout.
2. Every string of 100 bytes has a mark, the 36 bytes within it whose hash is least (the
   first such). Equal strings have equal marks at equal places. Marks that occur once are left out
   here, with the strings that they belong to.
3. For each place of a shared mark, the strings that belong to it lie side by side; they
   go out as one snippet. A task folds equal snippets before they are shuffled by mark.
4. The distinct snippets under a mark that hold a string whose hash another one holds, joined by separators, go through linear grouping
   (``suffixes``): in the suffix array equal strings are neighbours, and neighbours are compared
   in full. Each learns its earliest place in the corpus.
   A mark with many distinct snippets (a frequent line in ever other surroundings) is split: of its
   strings, those whose hash occurs in several snippets are grouped by their full content, and the
   earliest places are folded before they are shuffled. So a task never holds all of a mark.
5. A string that begins later than its earliest place is a repetition; bytes that
   repetitions cover are removed.

Defined results: NULL and empty texts have no bytes; texts shorter than a string keep all. A NULL
id comes after all others and before none. Rows that repeat an id count as one document at
equal places, so they don't remove bytes of one another; within a document earlier starts come first. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respfeat.llm.common import body, bounded, row_key, table, text_batches, written
from respfeat.llm.suffixes import suffix_array, suffix_arrays
from respfeat.llm.substring_dedup import covered
from respfeat.llm.words import byte_windows

LENGTH, MARK = 100, 36
_LAST = 2**63 - 1
#: Window starts that are worked through at a time; a place within takes 21 bits.
_CHUNK = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
#: Bytes of snippets that go through linear grouping together, and how long a string joins in.
_BLOCK, _LONG = 1 << 20, 4096
#: Neighbours in a suffix array that are compared at a time.
_COMPARED = 10_000
#: Bytes of snippets under one mark, from which on it is split by its strings.
SPLIT = 1 << 17


#: A run of a snippet's strings, from the k-th, whose earliest places follow one another.
_RUN = np.dtype([("k", "<i4"), ("n", "<i4"), ("id", "<i8"), ("place", "<i8")])


def _runs(ids: np.ndarray, places: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """The runs of each of some snippets, whose strings lie side by side between the edges."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (places[1:] != places[:-1] + 1)
    new[edges[:-1]] = True
    at = np.flatnonzero(new)
    cuts = np.searchsorted(at, edges)
    out = np.empty(len(at), _RUN)
    out["k"], out["n"] = at - np.repeat(edges[:-1], np.diff(cuts)), np.diff(np.append(at, len(ids)))
    out["id"], out["place"] = ids[at], places[at]
    whole, cuts = out.tobytes(), (cuts * _RUN.itemsize).tolist()
    return [whole[a:b] for a, b in zip(cuts, cuts[1:])]


def marks(text: bytes, length: int = LENGTH, mark: int = MARK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For runs of starts with the same mark: (hash of the mark, its place, first start, number of starts)."""
    data, span, parts = np.frombuffer(text, np.uint8), length - mark, []
    for lo in range(0, max(0, len(data) - length + 1), _CHUNK):
        h = byte_windows(data[lo : lo + _CHUNK + length - 1], mark)
        least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        # Minima over 2, 4, ... places, then over all length - mark + 1.
        width = 1
        while 2 * width <= span + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = span + 1 - width
        if rest:
            least = np.minimum(least[: len(least) - rest], least[rest:])
        at = (least & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.diff(at, prepend=-1))
        parts.append((h[at[new]], at[new] + lo, new + lo, np.diff(np.append(new, len(at)))))
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts))


def _counted(length: int):
    """Texts -> (mark, places, at most two), folded per batch."""

    def run(batches):
        for b in batches:
            own = [marks(t.as_py(), length)[0] for t in b["text"]]
            a, n = np.unique(np.concatenate(own) if own else np.zeros(0, np.uint64), return_counts=True)
            yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int8))], names=["mark", "n"])

    return run


def _listed(length: int):
    """(row, text) -> (mark, row)."""

    def run(batches):
        for b in batches:
            own = [np.unique(marks(t.as_py(), length)[0]) for t in b["text"]]
            of = np.repeat(b["row"].to_numpy(), [len(x) for x in own])
            a = np.concatenate(own) if own else np.zeros(0, np.uint64)
            yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(of)], names=["mark", "row"])

    return run


_PLACED = "mark long, snippet long, row long, id long, start int, n int, content binary"


def _cut_out(length: int):
    """(row, id, text, shared marks) -> the snippets: one light row for each place, and the
    content once for each snippet of the batch, with its earliest place."""

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            best: dict[tuple[int, bytes], tuple] = {}
            for row, i, t, shared in zip(b["row"].to_pylist(), b["id"].to_pylist(), b["text"], b["marks"]):
                text = t.as_py()
                h, place, first, n = marks(text, length)
                h = h.view(np.int64)
                hit = np.flatnonzero(np.isin(h, shared.values.to_numpy()))
                for m, p, s, k in zip(h[hit].tolist(), place[hit].tolist(), first[hit].tolist(), n[hit].tolist()):
                    content = text[s : s + k + length - 1]
                    # Equal content is one snippet; where its mark lies follows from the content.
                    name = int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True)
                    for c, x in zip(cols, (m, name, row, i, s, k, None)):
                        c.append(x)
                    at = best.get((m, content))
                    if at is None or (i, s) < at[:2]:
                        best[m, content] = (i, s, k, name)
            for (m, content), (i, s, k, name) in best.items():
                for c, x in zip(cols, (m, name, None, i, s, k, content)):
                    c.append(x)
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["mark", "snippet", "row", "id", "start", "n", "content"])

    return run


def _sharing(groups: list[list[tuple]], length: int) -> np.ndarray:
    """Which snippets hold a string whose hash occurs again under their mark; the strings of all others occur once."""
    sizes = np.array([len(x[4]) for g in groups for x in g])
    h = byte_windows(np.frombuffer(b"".join(x[4] for g in groups for x in g), np.uint8), length)
    of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[: len(h)]
    whole = of == np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[length - 1 :]
    h, of = h[whole], of[whole]
    group = np.repeat(np.arange(len(groups), dtype=np.uint64), [len(g) for g in groups])
    h = h + group[of] * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(h)
    again = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    out = np.zeros(len(sizes), bool)
    out[of[order[again]]] = out[of[order[again + 1]]] = True
    return out


def _grouped(length: int):
    """Snippets sorted by mark and content -> for each, the earliest place of each of its strings."""

    def first_places(group: list[tuple]) -> list[tuple]:
        """Snippets (name, id, start, n, content) need no order if no other has strings of theirs."""
        return [(x[0], struct.pack("<iiqq", 0, x[3], x[1], x[2])) for x in group]

    def ordered(groups: list[list[tuple]]):
        """The runs of each snippet, by suffix arrays of the groups; all groups are worked on side by side."""
        snippets = [x for g in groups for x in g]
        data = np.frombuffer(b"".join([x[4] + b"\0" for x in snippets]), np.uint8)
        sizes = np.array([len(x[4]) + 1 for x in snippets])
        ends, n = np.cumsum(sizes), sizes - length
        lasts = ends[np.cumsum([len(g) for g in groups]) - 1]
        text = data.astype(np.int16) + 2
        text[ends - 1] = 1
        text[lasts - 1] = 0
        sa = arrays(text, np.diff(lasts, prepend=0))
        valid = np.repeat(np.tile([True, False], len(sizes)), np.stack([n, sizes - n], axis=1).ravel())
        ids = np.repeat(np.array([x[1] for x in snippets], np.int64), sizes)
        places = np.repeat(np.array([x[2] for x in snippets]) - (ends - sizes), sizes) + np.arange(len(text))
        own = sa[valid[sa]]
        # Neighbours that are equal in full, within a group.
        windows, same = np.lib.stride_tricks.sliding_window_view(data, length), np.zeros(len(own), bool)
        for lo in range(1, len(own), _COMPARED):
            rows = windows[own[lo - 1 : lo + _COMPARED]]
            same[lo : lo + _COMPARED] = (rows[1:] == rows[:-1]).all(axis=1)
        same[np.cumsum(valid)[lasts[:-1] - 1]] = False
        heads, of = np.flatnonzero(~same), np.cumsum(~same) - 1
        least = np.minimum.reduceat(ids[own], heads)[of]
        ids[own], at = least, np.where(ids[own] == least, places[own], _LAST)
        places[own] = np.minimum.reduceat(at, heads)[of]
        return zip([x[0] for x in snippets], _runs(ids[valid], places[valid], np.append(0, np.cumsum(n))))

    def arrays(text: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The suffix array of each of some strings, as positions in all of them."""
        sa, ends, short = np.empty(len(text), np.int32), np.cumsum(lengths), lengths <= _LONG
        if short.any():
            at = np.flatnonzero(np.repeat(short, lengths)).astype(np.int32)
            sa[at] = at[suffix_arrays(text[at], lengths[short])]
        for k in np.flatnonzero(~short):
            lo, hi = ends[k] - lengths[k], ends[k]
            sa[lo:hi] = np.array(suffix_array(text[lo:hi]), np.int32) + lo
        return sa

    def run(batches):
        group, waiting, size, mark = [], [], 0, None
        done: list[tuple] = []

        def batch():
            out = pa.record_batch([
                pa.array([m for m, _ in done], pa.int64()), pa.array([x[0] for _, x in done], pa.int64()),
                pa.array([x[1] for _, x in done], pa.binary()),
            ], names=["mark", "snippet", "firsts"])
            done.clear()
            return out

        def close():
            nonlocal size
            if len(group) == 1:
                done.extend((mark, x) for x in first_places(group))
            elif group:
                waiting.append((mark, list(group)))
                size += sum(len(x[4]) + 1 for x in group)
            group.clear()

        def work():
            nonlocal size
            sharing = iter(_sharing([g for _, g in waiting], length).tolist())
            kept = []
            for m, g in waiting:
                some = [(x, next(sharing)) for x in g]
                done.extend((m, x) for x in first_places([x for x, shares in some if not shares]))
                if own := [x for x, shares in some if shares]:
                    kept.append((m, own))
            if kept:
                done.extend(zip([m for m, g in kept for _ in g], ordered([g for _, g in kept])))
            waiting.clear()
            size = 0

        for b in batches:
            for m, name, i, s, n, content in zip(*(b[c].to_pylist() for c in ("mark", "snippet", "id", "start", "n", "content"))):
                if m != mark:
                    close()
                    mark = m
                    if size > _BLOCK:
                        work()
                    if len(done) > 5_000:
                        yield batch()
                if group and group[-1][4] == content:
                    if (i, s) < group[-1][1:3]:
                        group[-1] = (name, i, s, n, content)
                else:
                    group.append((name, i, s, n, content))
        close()
        if waiting:
            work()
        if done:
            yield batch()

    return run


def _string_hashes(content: bytes, length: int) -> np.ndarray:
    return byte_windows(np.frombuffer(content, np.uint8), length).view(np.int64)


def _hashed(length: int):
    """Snippets -> (h, mark, snippet): the hashes of their strings."""

    def run(batches):
        for b in batches:
            own = [np.unique(_string_hashes(c.as_py(), length)) for c in b["content"]]
            of = np.repeat(np.arange(len(own)), [len(x) for x in own])
            h = np.concatenate(own) if own else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array(h), b["mark"].take(pa.array(of)), b["snippet"].take(pa.array(of))], names=["h", "mark", "snippet"])

    return run


def _strings(length: int):
    """Snippets with the hashes that occur elsewhere too -> those strings in full, with their earliest places there."""

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for m, name, i, s, content, asked in zip(*(b[c].to_pylist() for c in ("mark", "snippet", "id", "start", "content", "hashes"))):
                for k in np.flatnonzero(np.isin(_string_hashes(content, length), np.array(asked, np.int64))).tolist():
                    for c, x in zip(cols, (m, name, k, i, s + k, content[k : k + length])):
                        c.append(x)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names=["mark", "snippet", "k", "id", "place", "string"])

    return run


def _filled(batches):
    """Snippets with what is known of some of their strings -> the earliest places of all their strings."""
    for b in batches:
        firsts = []
        for i, s, n, known in zip(*(b[c].to_pylist() for c in ("id", "start", "n", "known"))):
            to_id, to_place = np.full(n, i, np.int64), s + np.arange(n, dtype=np.int64)
            for x in known or ():
                to_id[x["k"]], to_place[x["k"]] = x["id"], x["place"]
            firsts += _runs(to_id, to_place, np.array([0, n]))
        yield pa.record_batch([b["mark"], b["snippet"], pa.array(firsts, pa.binary())], names=["mark", "snippet", "firsts"])


def _split(snippets: DataFrame, length: int) -> DataFrame:
    """What ``_grouped`` gives, for marks with any number of snippets; groups are equal strings."""
    one = F.min(F.struct("id", "start", "n", "content")).alias("s")
    own = written(snippets.groupBy("mark", "snippet").agg(one).select("mark", "snippet", "s.*"), "split")
    hashed = own.select("mark", "snippet", "content").mapInArrow(_hashed(length), "h long, mark long, snippet long")
    again = written(hashed.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "again")
    asked = hashed.join(bounded(again), "h").groupBy("mark", "snippet").agg(F.collect_list("h").alias("hashes"))
    each = own.join(asked, ["mark", "snippet"]).select("mark", "snippet", "id", "start", "content", "hashes")
    each = written(each.mapInArrow(_strings(length), "mark long, snippet long, k int, id long, place long, string binary"), "strings")
    first = each.groupBy("string").agg(F.min(F.struct("id", "place")).alias("f"))
    known = each.select("mark", "snippet", "k", "string").join(first, "string").groupBy("mark", "snippet").agg(
        F.collect_list(F.struct("k", "f.id", "f.place")).alias("known")
    )
    return own.select("mark", "snippet", "id", "start", "n").join(known, ["mark", "snippet"], "left").mapInArrow(
        _filled, "mark long, snippet long, firsts binary"
    )


def _late(batches):
    """Places of snippets with the earliest places of their strings -> (row, runs of starts that are repetitions: first, number)."""
    for b in batches:
        firsts = b["firsts"].to_pylist()
        runs = np.frombuffer(b"".join(firsts), _RUN)
        of = np.repeat(np.arange(len(firsts)), [len(x) // _RUN.itemsize for x in firsts])
        i, own = b["id"].to_numpy().take(of), b["start"].to_numpy().take(of) + runs["k"]
        # Documents without an id precede nothing, one another included.
        late = np.flatnonzero((runs["id"] < i) | ((runs["id"] == i) & (runs["place"] < own) & (i != _LAST)))
        row, own, n = b["row"].to_numpy().take(of.take(late)), own.take(late), runs["n"].take(late)
        order = np.lexsort((own, row))
        row, own = row.take(order), own.take(order)
        end = own + n.take(order)
        # Runs of a document that touch become one.
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (own[1:] > end[:-1])
        at = np.flatnonzero(new)
        row, own = row.take(at), own.take(at)
        out = np.empty((len(at), 2), np.int32)
        out[:, 0], out[:, 1] = own, (np.maximum.reduceat(end, at) if len(at) else end) - own
        cuts = np.flatnonzero(np.diff(row, prepend=row[:1] - 1))
        starts = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer((np.append(cuts, len(row)) * 8).astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())])
        yield pa.record_batch([pa.array(row.take(cuts)), starts], names=["row", "starts"])


def _kept(length: int):
    def run(batches):
        for b in batches:
            gone, spans, sha, kept = [], [], [], []
            for t, lots in zip(b["text"], b["starts"].to_pylist()):
                text = np.frombuffer(t.as_py(), np.uint8)
                first, n = np.frombuffer(b"".join(lots), np.int32).reshape(-1, 2).T
                out = covered(first, len(text), length - 1 + n)
                gone.append(int(out.sum()))
                spans.append(int(np.count_nonzero(np.diff(out.astype(np.int8), prepend=0) > 0)))
                kept.append(text[~out].tobytes())
                sha.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.record_batch([b["key"], pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha), pa.array(kept, pa.binary())],
                                  names=["key", "n_removed", "n_spans", "cut_sha", "kept"])

    return run


def repeated_bytes(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, ...]:
    """(rows, classes, cut): all rows (id, doc_id, key, same, n_bytes, sha); the first id of each text; what is
    left of documents of which something is removed (key, n_removed, n_spans, cut_sha, kept)."""
    texts = df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.col(id_col).alias("doc_id"),
        row_key(id_col, text_col).alias("key"), F.xxhash64(F.col(id_col), body(text_col)).alias("row"), body(text_col).alias("text"),
    )
    sha = F.sha2("text", 256)
    with text_batches(df.sparkSession):
        rows = written(texts.select("id", "doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), sha.alias("sha")), "rows")
        classes = rows.groupBy("sha").agg(F.min("id").alias("first"))
        again = rows.groupBy("key").agg(F.count("*").alias("times"), F.first("sha").alias("sha"), F.first("id").alias("id"))
        copies = written(again.join(classes, "sha").where("id > first").select("key"), "copies")
        own = texts.where(F.octet_length("text") >= length).join(bounded(copies), "key", "left_anti")

        shared = (
            own.select("text").mapInArrow(_counted(length), "mark long, n byte")
            .groupBy("mark").agg(F.sum("n").alias("n")).where("n > 1").select("mark")
        )
        held = own.select("row", "text").mapInArrow(_listed(length), "mark long, row long").join(shared, "mark")
        asked = written(held.groupBy("row").agg(F.collect_set("mark").alias("marks")), "marks")
        some = own.select("row", "id", "text").join(bounded(asked.select("row").alias("some")), "row", "left_semi")
        placed = written(some.join(asked, "row").mapInArrow(_cut_out(length), _PLACED), "snippets")

        contents = placed.where("content is not null").select("mark", "snippet", "id", "start", "n", "content")
        held = contents.groupBy("mark").agg(F.sum(F.octet_length("content")).alias("bytes"))
        large = bounded(written(held.where(F.col("bytes") > SPLIT).select("mark"), "large"))
        firsts = (
            contents.join(large, "mark", "left_anti").repartition("mark").sortWithinPartitions("mark", "content")
            .mapInArrow(_grouped(length), "mark long, snippet long, firsts binary")
        )
        firsts = firsts.unionByName(_split(contents.join(large, "mark", "left_semi"), length))
        back = placed.where("content is null").select("mark", "snippet", "row", "id", "start").join(firsts, ["mark", "snippet"])
        late = back.mapInArrow(_late, "row long, starts binary")
        starts = written(late.groupBy("row").agg(F.collect_list("starts").alias("starts")), "starts")
    hit = own.select("row", "key", "text").join(bounded(starts.select("row")), "row", "left_semi").dropDuplicates(["key"])
    cut = hit.join(starts, "row").mapInArrow(_kept(length), "key string, n_removed long, n_spans long, cut_sha string, kept binary")
    return rows, classes, cut


def suffix_dedup(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    rows, classes, cut = repeated_bytes(df, length, id_col, text_col)
    copy = (F.col("id") > F.col("first")) & (F.col("n_bytes") >= length)
    none = F.lit(0).cast("long")
    with text_batches(df.sparkSession):
        found = written(cut.select("key", "n_removed", "n_spans", "cut_sha"), "cut")
    return rows.join(classes, "sha").join(found, "key", "left").select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
    )


def query(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents"))
