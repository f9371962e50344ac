"""Phrases and their scores against plain counting."""

import collections
import re

import duckdb
import numpy as np
import pytest

from respfeat.llm import collocations as co

from .conftest import EDGES, SF_DIR

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs, longest=4):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    return f, n


def wanted(docs, support, top, longest=4):
    f, n = counted(docs, longest)
    frequent = {k: v for k, v in f.items() if v >= support and len(k[1]) > 1}
    rows = collections.defaultdict(list)
    for (lang, w), a in frequent.items():
        m = len(w)
        if any(len(x) > m and g == lang and 100 * b >= 80 * a and any(x[i : i + m] == w for i in range(len(x))) for (g, x), b in frequent.items()):
            continue
        score, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, m))
        rows[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return sorted(
        (lang, k, p.decode(), -a, l, r, n[lang], -s) for lang, got in rows.items() for k, (s, a, p, l, r) in enumerate(sorted(got)[:top], 1)
    )


def test_whole_table(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    df = co.query(spark, SF_DIR)
    assert df.columns == [d[0] for d in con.execute(co.ORACLE).description]
    assert sorted(map(tuple, df.collect())) == sorted(con.execute(co.ORACLE).fetchall())


@pytest.mark.parametrize(("shards", "block", "bits"), [(1, 1 << 23, 26), (5, 2000, 26), (3, 2000, 6)])
def test_odd_rows(spark, docs_of, monkeypatch, shards, block, bits):
    """Any number of shards, size of blocks and width of the bitmap gives the exact counts."""
    monkeypatch.setattr(co, "BLOCK_BYTES", block)
    monkeypatch.setattr(co, "BITS", bits)
    monkeypatch.setattr(co, "PART_WORDS", 5000)
    texts = [t for _, t in EDGES] + ["A b c d e. A b\tc  d! x:A b c", "a b c d\x0be a b c d", "über Über ÜBER, a b"] * 3 + ["a b"] * 40
    langs = [None, "en", "de", "und"]
    docs = [(langs[k % 4], t) for k, t in enumerate(texts)]
    df = docs_of(list(enumerate(texts))).withColumn("lang", co.F.element_at(co.F.array(*map(co.F.lit, langs)), (co.F.col("doc_id") % 4 + 1).cast("int")))
    got = co.collocations(df, support=3, top=40, shards=shards)
    assert sorted(map(tuple, got.collect())) == wanted(docs, 3, 40)
    assert co.collocations(df.limit(0)).count() == 0


def test_colliding_hashes_are_told_apart(spark, docs_of, monkeypatch):
    """With hashes of four bits everything collides, and the counts are exact all the same."""
    real = co.window_hashes
    monkeypatch.setattr(co, "window_hashes", lambda h, size: real(h, size) % np.uint64(4))
    run = co._spell(2, type("B", (), {"value": b"\xff" * (1 << (co.BITS - 3))}))
    batch = co.pa.record_batch([co.pa.array(["x"]), co.pa.array([b"a b c a b c d e f g"])], names=["lang", "text"])
    seen = collections.Counter()
    for b in run([batch]):
        for phrase, n in zip(b["phrase"].to_pylist(), b["n"].to_pylist()):
            seen["x", tuple(phrase.split())] += n
    assert seen == counted([("x", "a b c a b c d e f g")], 2)[0]
