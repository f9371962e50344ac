"""Near duplicates by min-max hashing of word shingles.

Each permutation of the shingle hashes gives two values of a signature, its minimum and
its maximum, so 100 permutations give 200 values. Five values make a band; two texts of
similarity 0.8 share none of the 40 bands with probability 1e-7.

1. Texts with equal shingle sets are one node from here on, however many copies there are.
2. Nodes that share a band lie in one bucket. Buckets with the same members count once.
3. First, every node looks at one pivot per bucket and takes the one whose signature is
   nearest. Candidates are confirmed on the full sets, and confirmed links merge nodes
   into components. A large group of near copies collapses here, without pairs.
4. Then, nodes of different components in a bucket are compared. Those of the bucket's
   largest component and all others are dealt into blocks, and each pair of blocks is a group of its
   own, so no task holds a large bucket. Signatures tell which nodes have a partner that may be
   similar; the full sets of these meet, block pair by block pair, and every such pair that is
   still apart is tested. Only links leave a group, fewer than it has nodes, never pairs. A pair
   is compared in one bucket only.

Signatures only propose: a pair is dropped unseen when its estimate lies more than four
standard errors below the threshold.

Defined results: NULL, empty and wordless texts have no shingles and are linked with
nothing; a text with fewer words than a shingle has one, of all its words. Rows that repeat id and text share
their result. A NULL id never names a component unless the component has no other.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respfeat.llm.common import body, bounded, components, row_key, table, without, written
from respfeat.llm.words import word_hashes

PERMUTATIONS, BAND = 100, 5
THRESHOLD = 0.8
#: Signatures agree on one value with probability similarity + 1/256.
SLACK = 4 * (0.8 * 0.2 / (2 * PERMUTATIONS)) ** 0.5
#: Nodes of a block on average, and shingles of its sets; a group has two blocks.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 19
#: Partners of a node that are tested at a time, the nearest first.
TESTED = 64
_U = np.uint64
_ODD = np.random.default_rng(20240501).integers(0, 2**63, PERMUTATIONS).astype(_U) * _U(2) + _U(1)
_MIX = _U(0x9E3779B97F4A7C15)


def shingles(text: bytes, size: int) -> np.ndarray:
    """The set of shingles of a whole text, as sorted 64-bit hashes."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(size, len(h))
    out = np.full(len(h) - k + 1, _U(k))
    for j in range(k):
        out = (out ^ h[j : len(h) - k + 1 + j]) * _MIX
        out ^= out >> _U(29)
    return np.unique(out)


def signature(s: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the set under each permutation."""
    lo, hi = np.full(PERMUTATIONS, _U(2**64 - 1)), np.zeros(PERMUTATIONS, _U)
    for at in range(0, len(s), 2048):
        y = _ODD[:, None] * s[None, at : at + 2048]
        np.minimum(lo, y.min(axis=1), out=lo)
        np.maximum(hi, y.max(axis=1), out=hi)
    return np.concatenate([lo, hi])


def _bands(v: np.ndarray) -> np.ndarray:
    rows = v.reshape(-1, BAND)
    out = np.arange(1, len(rows) + 1, dtype=_U) * _MIX
    for j in range(BAND):
        out = (out ^ rows[:, j]) * _MIX
        out ^= out >> _U(32)
    return out.view(np.int64)


def _sketch(size: int):
    def run(batches):
        for b in batches:
            n, node, sig, bands = [], [], [], []
            for t in b["text"]:
                s = shingles(t.as_py(), size)
                n.append(len(s))
                if not len(s):
                    node.append(None), sig.append(None), bands.append(None)
                    continue
                v = signature(s)
                node.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sig.append(((v * _MIX) >> _U(56)).astype(np.uint8).tobytes())
                bands.append(_bands(v))
            yield pa.record_batch([
                b["doc_id"], b["key"], pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(sig, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ], names=["doc_id", "key", "n", "node", "sig", "bands"])

    return run


def _estimate(sig: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarity of one signature to each of the others."""
    share = (others == sig[None, :]).mean(axis=1)
    return (share - 1 / 256) * (256 / 255)


def _pair_estimate(batches):
    """Rows of two signatures -> the estimate."""
    for b in batches:
        x, y = (np.frombuffer(b"".join(b[c].to_pylist()), np.uint8).reshape(-1, 2 * PERMUTATIONS) for c in ("sig", "pivot_sig"))
        est = ((x == y).mean(axis=1) - 1 / 256) * (256 / 255)
        yield pa.record_batch([b["a"], b["b"], pa.array(est)], names=["a", "b", "est"])


class _Blocks:
    """One pair of blocks of a bucket: the pairs across components that may be similar. A pair is
    looked at in the first bucket that both lie in, and in no other."""

    def __init__(self, t: pa.Table, percent: int, least: float) -> None:
        self.t, self.percent, self.least = t, percent, least
        self.nodes = t["node"].to_pylist()
        self.sigs = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(len(self.nodes), -1)
        self.lies = np.frombuffer(b"".join(t["lies"].to_pylist()), np.int64).reshape(len(self.nodes), -1)
        self.here = int(np.flatnonzero(self.lies[0] == t["bucket"][0].as_py())[0])
        self.n = t["n"].to_numpy()
        number = {r: k for k, r in enumerate(dict.fromkeys(t["root"].to_pylist()))}
        #: Changes as links are found.
        self.root = np.array([number[r] for r in t["root"].to_pylist()])
        block, first, second = t["block"].to_numpy(), t["one"][0].as_py(), t["other"][0].as_py()
        self.first, self.second, self.same = np.flatnonzero(block == first), np.flatnonzero(block == second), first == second

    def partners(self, k: int) -> np.ndarray:
        """Those of the second block that may be similar to k of the first, the nearest first."""
        others = self.second[self.second > k] if self.same else self.second
        n, m = self.n[k], self.n[others]
        others = others[(self.root[others] != self.root[k]) & (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m))]
        if self.here:
            before = (self.lies[others, : self.here] == self.lies[k, : self.here]) & (self.lies[k, : self.here] != 0)
            others = others[~before.any(axis=1)]
        est = _estimate(self.sigs[k], self.sigs[others])
        near = est >= self.least
        return others[near][np.argsort(-est[near], kind="stable")]


def _with_partners(percent: int, least: float):
    """One pair of blocks -> its nodes with a partner that may be similar."""

    def run(t: pa.Table) -> pa.Table:
        g, hit = _Blocks(t, percent, least), np.zeros(t.num_rows, bool)
        for k in g.first:
            near = g.partners(k)
            hit[near] = True
            hit[k] |= len(near) > 0
        return t.select(["bucket", "one", "other", "block", "node"]).filter(pa.array(hit))

    return run


def _links(percent: int, least: float):
    """One pair of blocks, with full sets -> links that join all components with a similar pair."""

    def run(t: pa.Table) -> pa.Table:
        g = _Blocks(t, percent, least)
        sets = [x.values.to_numpy() for x in t["shingles"]]
        own = np.unique(np.concatenate(sets))
        sets = [np.searchsorted(own, x) for x in sets]
        has = np.zeros(len(own), bool)
        a, b = [], []
        for k in g.first:
            left = g.partners(k)
            if len(left):
                has[sets[k]] = True
            while len(left):
                tried, left = left[:TESTED], left[TESTED:]
                ends = np.cumsum(g.n[tried])
                both = np.add.reduceat(has[np.concatenate([sets[j] for j in tried])].astype(np.int64), ends - g.n[tried])
                for j in tried[100 * both >= percent * (g.n[k] + g.n[tried] - both)]:
                    if g.root[j] != g.root[k]:
                        g.root[g.root == g.root[j]] = g.root[k]
                        x, y = sorted((g.nodes[k], g.nodes[j]))
                        a.append(x), b.append(y)
                left = left[g.root[left] != g.root[k]]
            has[sets[k]] = False
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _lies(batches):
    """(node, n, sig, bands, the buckets that count) -> the buckets by band, 0 for others."""
    for b in batches:
        lies = []
        for bands, mine in zip(b["bands"], b["mine"]):
            x = bands.values.to_numpy()
            lies.append(np.where(np.isin(x, mine.values.to_numpy()), x, 0).tobytes())
        yield pa.record_batch([b["node"], b["n"], b["sig"], pa.array(lies, pa.binary())], names=["node", "n", "sig", "lies"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with the truth about their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", (100 * both >= percent * (F.size("x") + F.size("y") - both)).alias("linked")
    )


def _members(nodes: DataFrame) -> DataFrame:
    """(bucket, node, size): the buckets with several nodes, one of each set of members."""
    dealt = nodes.select(F.explode("bands").alias("bucket"), "node")
    shared = (
        dealt.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("print"))
        .where("size > 1").groupBy("size", "print").agg(F.min("bucket").alias("bucket"))
    )
    return dealt.join(shared.select("bucket", "size"), "bucket")


def near_classes(df: DataFrame, size: int, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, n, component_id, root (NULL without shingles) for every row."""
    least = percent / 100 - SLACK
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("key"), body(text_col).alias("text"))
    sketched = written(
        texts.mapInArrow(_sketch(size), "doc_id long, key string, n long, node binary, sig binary, bands array<long>"), "sketches"
    )
    nodes = sketched.where("n > 0").groupBy("node").agg(F.min_by(F.struct("key", "n", "sig", "bands"), "key").alias("s"))
    nodes = written(nodes.select("node", "s.key", "s.n", "s.sig", "s.bands"), "nodes")
    members = written(_members(nodes), "buckets")
    sigs = nodes.select("node", "sig")

    # One pivot per bucket, another in each; every node takes the nearest of its pivots.
    pivots = members.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("bucket", "node"), "node")).alias("p"))
    asked = members.join(pivots, "bucket").select(F.col("node").alias("a"), F.col("p.node").alias("b")).where("a != b").distinct()
    with_sigs = asked.join(sigs.select(F.col("node").alias("a"), "sig"), "a").join(
        sigs.select(F.col("node").alias("b"), F.col("sig").alias("pivot_sig")), "b"
    )
    near = with_sigs.mapInArrow(_pair_estimate, "a binary, b binary, est double").where(F.col("est") >= least)
    best = near.groupBy("a").agg(F.max(F.struct("est", "b")).alias("m"))
    pairs = best.select(F.least("a", "m.b").alias("a"), F.greatest("a", "m.b").alias("b")).distinct()
    pairs = written(pairs, "pairs")

    # The full sets of nodes that lie in some shared bucket.
    wanted = written(nodes.join(members.select("node").distinct(), "node", "left_semi").select("key", "node"), "wanted")

    def sets_of(batches):
        for b in batches:
            sets = [shingles(t.as_py(), size).view(np.int64) for t in b["text"]]
            yield pa.record_batch([b["node"], pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    held = texts.join(bounded(wanted), "key").select("node", "text")
    sets = written(held.mapInArrow(sets_of, "node binary, shingles array<long>").dropDuplicates(["node"]), "sets")

    mine = members.groupBy("node").agg(F.collect_set("bucket").alias("mine"))  # at most one per band
    placed = nodes.select("node", "n", "sig", "bands").join(mine, "node").mapInArrow(_lies, "node binary, n long, sig binary, lies binary")
    placed = written(placed, "placed")
    tested = written(_confirmed(pairs, sets, percent), "tested")
    roots = components(tested.where("linked").select("a", "b"))
    roots = written(roots, "roots")
    roots = _merged(roots, written(_late_links(members, placed, roots, sets, percent, least), "links"))

    named = (
        sketched.select("doc_id", "node").join(roots, "node", "left")
        .groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("doc_id").alias("component_id"))
    )
    rooted = sketched.select("doc_id", "key", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rooted.join(named, "root", "left").select(
        "doc_id", "key", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "root"
    )


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links between nodes: links between components are few."""
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    ends = links.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
    top = components(ends.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
    up = top.select(F.col("node").alias("root"), F.col("root").alias("above"))
    old = roots.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    new = top.join(roots.select("node"), "node", "left_anti")
    return written(old.unionByName(new), "roots")


def _dealt(members: DataFrame, placed: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, one, other, block, node): the buckets that hold several components, by pairs of blocks."""
    at = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    at = at.join(placed.select("node", "n"), "node")
    sizes = at.groupBy("bucket", "root").agg(F.count("*").alias("nodes"), F.sum("n").alias("shingles"))
    blocks = lambda nodes, shingles: F.greatest(F.ceil(nodes / BLOCK), F.ceil(shingles / BLOCK_SHINGLES))
    most = F.max(F.struct("nodes", "shingles", "root"))
    mixed = sizes.groupBy("bucket").agg(
        F.count("*").alias("roots"), F.sum("nodes").alias("nodes"), F.sum("shingles").alias("shingles"), most.alias("m")
    ).where("roots > 1")
    mixed = mixed.select(
        "bucket", F.col("m.root").alias("major"), blocks(F.col("nodes") - F.col("m.nodes"), F.col("shingles") - F.col("m.shingles")).alias("minors"),
        blocks(F.col("m.nodes"), F.col("m.shingles")).alias("majors"),
    )
    # Blocks of the others come first, then those of the largest component, which aren't compared with one another.
    hash_of, minor = F.xxhash64("node"), F.col("root") != F.col("major")
    block = F.when(minor, F.pmod(hash_of, F.col("minors"))).otherwise(F.col("minors") + F.pmod(hash_of, F.col("majors")))
    found = at.join(mixed, "bucket").withColumn("block", block)
    with_blocks = F.when(minor, F.col("minors") + F.col("majors")).otherwise(F.col("minors"))
    dealt = found.select("bucket", "node", "block", F.explode(F.sequence(F.lit(0).cast("long"), with_blocks - 1)).alias("with"))
    return dealt.select("bucket", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"), "block", "node")


def _late_links(members: DataFrame, placed: DataFrame, roots: DataFrame, sets: DataFrame, percent: int, least: float) -> DataFrame:
    """Links across components."""
    by = ["bucket", "one", "other"]
    full = lambda rows: rows.join(placed, "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    some = full(_dealt(members, placed, roots)).groupBy(*by).applyInArrow(_with_partners(percent, least), "bucket long, one long, other long, block long, node binary")
    some = written(some, "partners")
    return full(some).join(sets, "node").groupBy(*by).applyInArrow(_links(percent, least), "a binary, b binary")


def near_dedup(df: DataFrame, size: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    found = near_classes(df, size, percent, id_col, text_col)
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def kept_documents(df: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the least id and then the least key, with all columns of the input."""
    found = written(near_classes(df, size, percent, id_col, text_col).where("root is not null").select("root", "doc_id", "key"), "classes")
    stays = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("stays"))
    gone = written(found.join(stays, "root").where("key <> stays").select("key"), "gone")
    return without(df, id_col, text_col, gone)


def query(spark, sf_dir):
    return near_dedup(table(spark, sf_dir, "documents"))
