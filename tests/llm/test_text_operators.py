"""Each text operator against its definition: on whole small tables, and on rows that hold
NULLs, empty and very long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from respfeat.llm import (
    decontaminate,
    exact_dedup,
    gru,
    lm_scoring,
    near_dedup,
    pii,
    quality,
    sentencepiece_codec,
    substring_dedup,
    suffix_dedup,
    suffixes,
    url_filters,
)
from respfeat.llm.common import components

from .conftest import EDGES, EXTRA, SF_DIR, prose

ALL = 2**63 - 1


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def pairs(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


def sha(b):
    return hashlib.sha256(b).hexdigest()


def split(text):
    return (text or "").encode().split()


# -- URL filters ------------------------------------------------------------------


def test_url_rules_and_patterns(spark):
    urls = [
        (1, "http://www.EXAMPLE.com/en/x"), (2, "https://a.example.com/en/"), (3, "https://example.com/en"), (4, "http://x.net/fr/1?a=/es/"),
        (5, "http://x.net"), (6, "http://badexample.com/en/"), (7, None), (8, "no scheme/com/"), (9, "http://ads.site.org/x"), (10, ""),
        (11, "http://a.org/casino/#://b.com/"), (1, "http://www.EXAMPLE.com/en/x"), (12, "x://y.org?redirect=http://com/"), (13, "http://com/" + "a" * 50_000),
    ]
    pages = spark.createDataFrame([(i, u, "h", "r", 1) for i, u in urls], "page_id long, url string, host string, rule string, n int")
    rules = url_filters.rule_table(spark, url_filters.RULES, url_filters.PATTERNS)
    rows = got(url_filters.judge(pages, rules), "page_id", "host", "rule", "verdict", "pattern")
    assert rows == sorted([
        (1, "www.example.com", "www.example.com/en/", "allow", None), (1, "www.example.com", "www.example.com/en/", "allow", None),
        (2, "a.example.com", "example.com/en/", "block", None), (3, "example.com", "com/", "allow", None), (4, "x.net", "net/fr/", "block", None),
        (5, "x.net", None, "allow", None), (6, "badexample.com", "com/", "allow", None), (7, "", None, "allow", None), (8, "", None, "allow", None),
        (9, "ads.site.org", None, "block", "*://ads.*"), (10, "", None, "allow", None), (11, "a.org", None, "block", "*/casino/*"),
        (12, "y.org", None, "block", "*?redirect=http*"), (13, "com", "com/", "allow", None),
    ], key=repr)
    assert url_filters.judge(pages.limit(0), rules).count() == 0
    assert url_filters.judge(pages, url_filters.rule_table(spark, [], [])).where("verdict = 'block'").count() == 0


def test_index_uses_the_rarest_token(spark):
    pages = spark.createDataFrame([(k, f"http://h{k}.net/fr/{k}") for k in range(5)], "page_id long, url string")
    rules = url_filters.rule_table(spark, [("net", "/fr/", "block")], [("*zzz*", "block")])
    rows = {r["rule"]: r["tokens"] for r in rules.collect()}
    assert rows == {"net/fr/": ["net", "fr"], "*zzz*": []}
    assert url_filters.judge(pages, rules).where("verdict = 'block'").count() == 5


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
@pytest.mark.parametrize("module", [url_filters, exact_dedup])
def test_query_equals_sql(spark, module):
    con = duckdb.connect()
    for t in ("pages", "documents"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    cur = con.execute(module.ORACLE)
    cols = [d[0] for d in cur.description]
    assert got(module.query(spark, SF_DIR), *cols) == sorted((tuple(r) for r in cur.fetchall()), key=repr)


# -- exact copies -----------------------------------------------------------------


def exact_wanted(rows):
    by = collections.defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    return sorted(
        [(i, max((x for x in by[t or ""] if x is not None), default=None), len(by[t or ""]), sha((t or "").encode())) for i, t in rows], key=repr
    )


@pytest.mark.parametrize("table_bytes", [1, 2000, exact_dedup.TABLE_BYTES])
def test_exact_dedup_at_every_table_size(docs_of, table_bytes):
    rows = EDGES + [(100 + k, prose(k % 7, 9)) for k in range(200)]
    found = exact_dedup.exact_dedup(docs_of(rows).repartition(3), table_bytes=table_bytes).cache()
    assert got(found, "doc_id", "keep_id", "group_size", "text_sha256") == exact_wanted(rows)
    # One row of each text stays, also among rows that repeat the id.
    assert found.where("kept").count() == len({t or "" for _, t in rows}) == found.select("text_sha256").distinct().count()
    assert found.where("kept and not (doc_id <=> keep_id)").count() == 0


def test_exact_dedup_moves_texts_in_small_batches(spark, docs_of, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)
    written = exact_dedup.written
    monkeypatch.setattr(exact_dedup, "written", lambda df, at: seen.append((at, int(spark.conf.get(name)))) or written(df, at))
    assert exact_dedup.exact_dedup(docs_of([(1, "a"), (2, "a")])).count() == 2
    assert dict(seen)["grace"] <= 1000 and spark.conf.get(name) == before
    # A task's records go out by about a megabyte at a time.
    t = [(i, i, b"%d" % i * 20_000) for i in range(100)]
    schema = exact_dedup.pa.schema([("id", "int64"), ("rest", "int32"), ("h", "int64"), ("content", "binary")])
    monkeypatch.setattr(exact_dedup.TaskContext, "get", lambda: type("C", (), {"partitionId": lambda self: 0})())
    batch = exact_dedup.pa.record_batch([[i for i, *_ in t], [None] * 100, [h for _, h, _ in t], [c for *_, c in t]], schema=schema)
    assert max(b.nbytes for b in exact_dedup._fold(1 << 30)(iter([batch]))) < 2 << 20


def test_exact_dedup_keeps_columns(docs_of):
    df = docs_of(EDGES)
    kept = exact_dedup.kept_documents(df)
    assert kept.schema.names == df.schema.names
    assert kept.count() == len({t or "" for _, t in EDGES})
    assert {r["key"] for r in kept.select("key").collect()} == {0}
    assert exact_dedup.exact_dedup(df.limit(0)).count() == exact_dedup.kept_documents(df.limit(0)).count() == 0


def test_content_table_compares_content():
    t = exact_dedup.ContentTable()
    assert [t.entry(7, x) for x in (b"a", b"b", b"a", b"c")] == [0, 1, 0, 2]
    assert [t.entry(k, b"%d" % k) for k in range(5000)] == list(range(3, 5003))
    assert t.entry(7, b"b") == 1 and t.entry(4999, b"4999") == 5002


# -- near copies ------------------------------------------------------------------


def near_wanted(rows, size, percent=80):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset())
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = collections.defaultdict(lambda: None)
    for k, (i, _) in enumerate(rows):
        r = root(k)
        if i is not None and (least[r] is None or i < least[r]):
            least[r] = i
    return sorted([(i, len(sets[k]), least[root(k)] if sets[k] else i) for k, (i, _) in enumerate(rows)], key=repr)


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join("x%d" % rng.randrange(10**6) if rng.random() < share else w for w in text.split())


def test_near_dedup_equals_brute_force(docs_of):
    rows = EDGES + [(200 + k, edited(prose(k % 4, 120), k, 0.012 * (k % 5))) for k in range(60)]
    rows = [r for r in rows if r[0] != 13]
    found = near_dedup.near_dedup(docs_of(rows))
    assert got(found, "doc_id", "n_shingles", "component_id") == near_wanted(rows, 4)
    five = near_dedup.kept_documents(docs_of(rows))
    assert five.schema.names == ["doc_id", "text", *EXTRA]
    gone = {i for i, _, c in near_wanted(rows, 5) if i != c}
    assert {r["doc_id"] for r in five.collect()} - {None} == {i for i, _ in rows} - gone - {None}


def test_near_dedup_of_forms_in_bounded_groups(docs_of, monkeypatch):
    """One form filled in differently: a large bucket of many components, with a few links among them."""
    form = prose(4, 120).split()
    rows = []
    for k in range(240):
        rows.append((k, " ".join([f"own{k}x{j}" for j in range(18)] + form[18:])))
    rows += [(500 + k, rows[k][1] + " end") for k in range(0, 240, 20)]
    monkeypatch.setattr(near_dedup, "BLOCK", 32)
    assert got(near_dedup.near_dedup(docs_of(rows), size=1), "doc_id", "n_shingles", "component_id") == near_wanted(rows, 1)


def test_pairs_of_blocks_are_bounded_and_hold_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 64)
    n, major = 1500, 500
    members = spark.range(n).selectExpr("7L as bucket", "cast(cast(id as string) as binary) as node", f"{n}L as size")
    placed = members.selectExpr("node", "100L as n")
    roots = members.where(f"cast(cast(node as string) as int) < {major}").selectExpr("node", "cast('0' as binary) as root")
    groups = collections.defaultdict(lambda: ([], []))
    for r in near_dedup._dealt(members, placed, roots).collect():
        groups[r["one"], r["other"]][r["block"] == r["other"]].append(int(bytes(r["node"])))
    assert max(len(a) + len(b) for a, b in groups.values()) < 4 * near_dedup.BLOCK
    met = collections.Counter()
    for (i, j), (a, b) in groups.items():
        met.update((min(x, y), max(x, y)) for x in (b if i == j else a) for y in b if i != j or x < y)
    want = {(x, y) for y in range(n) for x in range(y) if y >= major}
    assert set(met) == want and max(met.values()) == 1


def test_one_near_copy_stays_without_ids_and_with_equal_ids(docs_of):
    near = [prose(1, 120) + f" end{k}" for k in range(3)] + [prose(7, 120) + f" end{k}" for k in range(2)]
    kept = near_dedup.kept_documents(docs_of([(None, near[0]), (None, near[1]), (None, near[2]), (4, near[3]), (4, near[4]), (None, None), (5, "")]))
    assert got(kept, "doc_id").count((None,)) == 2 and got(kept, "doc_id").count((4,)) == 1 and kept.count() == 4


def test_near_dedup_of_nothing(docs_of):
    assert near_dedup.near_dedup(docs_of([]).limit(0)).count() == 0
    assert got(near_dedup.near_dedup(docs_of([(1, None), (2, "a")])), "doc_id", "component_id") == [(1, 1), (2, 2)]


def test_signatures_estimate_without_bias():
    rng = np.random.default_rng(1)
    off = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 400).astype(np.uint64)
        a, b = near_dedup.signature(pool[:300]), near_dedup.signature(pool[100:])
        off.append((a == b).mean() - 200 / 400)
    # Twice as many values as permutations; the mean error of 60 pairs is within three standard errors.
    assert len(a) == 2 * near_dedup.PERMUTATIONS
    assert abs(np.mean(off)) < 3 * (0.25 / len(a) / 60) ** 0.5
    assert np.std(off) < 1.5 * (0.25 / len(a)) ** 0.5


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(90, 91), (91, 95), (60, 60)], "a long, b long")
    assert got(components(chain), "node", "root") == sorted([(k, 0) for k in range(41)] + [(90, 90), (91, 90), (95, 90)], key=repr)


# -- repeated passages ------------------------------------------------------------


def passages_wanted(rows, cut, join, length):
    """Items covered by a window that also starts in a document with a smaller id."""
    first = {}
    items = [cut(t) for _, t in rows]
    for (i, _), w in zip(rows, items):
        for k in range(len(w) - length + 1):
            x = tuple(w[k : k + length])
            first[x] = min(first.get(x, ALL), ALL if i is None else i)
    out = []
    for (i, _), w in zip(rows, items):
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < (ALL if i is None else i):
                gone[k : k + length] = [True] * length
        out.append((i, len(w), sum(gone), sha(join([x for x, g in zip(w, gone) if not g]))))
    return sorted(out, key=repr)


def test_substring_dedup_equals_brute_force(docs_of):
    rows = EDGES + [(300 + k, prose(20 + k, 40) + " " + prose(k % 3, 52 - k) + " tail") for k in range(8)] + [(299, prose(50, 30)), (299, prose(1, 60))]
    want = passages_wanted(rows, split, b" ".join, 50)
    assert got(substring_dedup.substring_dedup(docs_of(rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert sum(r[2] > 0 for r in want) >= 7
    assert substring_dedup.substring_dedup(docs_of(rows).limit(0)).count() == 0


def test_substring_dedup_moves_texts_in_small_batches(spark, docs_of, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)
    written = substring_dedup.written
    monkeypatch.setattr(substring_dedup, "written", lambda df, at: seen.append((at, int(spark.conf.get(name)))) or written(df, at))
    rows = [(1, prose(3, 60) + " a"), (2, "b " + prose(3, 60))]
    assert sum(r["n_removed"] for r in substring_dedup.substring_dedup(docs_of(rows)).collect()) == 60
    assert {"rows", "anchors", "windows", "places", "cut"} <= dict(seen).keys()
    assert all(n <= 1000 for _, n in seen) and spark.conf.get(name) == before


def test_substring_dedup_on_the_table(documents):
    want = passages_wanted(pairs(documents), split, b" ".join, 50)
    assert got(substring_dedup.substring_dedup(documents), "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_difference_cover():
    assert {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER} == set(range(substring_dedup.PERIOD))


def bytes_wanted(rows, length):
    seen, out = set(), []
    first = {}
    data = [(t or "").encode() for _, t in rows]
    for (i, _), x in zip(rows, data):
        for k in range(len(x) - length + 1):
            at = (ALL if i is None else i, k)
            first[x[k : k + length]] = min(first.get(x[k : k + length], (ALL, ALL)), at)
    for (i, _), x in zip(rows, data):
        gone = np.zeros(len(x) + 1, int)
        for k in range(len(x) - length + 1):
            if i is not None and first[x[k : k + length]] < (i, k) or i is None and first[x[k : k + length]][0] < ALL:
                gone[k] += 1
                gone[min(k + length, len(x))] -= 1
        gone = np.cumsum(gone)[: len(x)] > 0
        spans = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) > 0))
        out.append((i, len(x), int(gone.sum()), spans, sha(bytes(c for c, g in zip(x, gone) if not g))))
    assert not seen
    return sorted(out, key=repr)


_BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffix_dedup_equals_brute_force(docs_of):
    rows = [r for r in EDGES if r[0] != 13] + [(300 + k, prose(20 + k, 9) + prose(k % 3, 20 + k) + "é" + prose(k, 12)) for k in range(12)]
    rows += [(400, "ab" * 300), (401, "a" * 100), (402, "a" * 99), (403, "x" + "a" * 101)]
    want = bytes_wanted(rows, 100)
    assert got(suffix_dedup.suffix_dedup(docs_of(rows)), *_BYTES) == want
    assert sum(r[2] > 0 for r in want) > 10
    assert suffix_dedup.suffix_dedup(docs_of(rows).limit(0)).count() == 0


def test_suffix_dedup_of_a_frequent_line_in_bounded_groups(docs_of, monkeypatch):
    line = "This line of seventy bytes stands in every third document of all, so. "
    near = [prose(60 + k % 5, 4) for k in range(60)]
    rows = [(k, prose(k, 12) + f" {k} " + (near[k] if k % 3 else "") + line + (near[-k] if k % 2 else "") + f" {k} " + prose(k + 9, 12)) for k in range(60)]
    rows += [(None, rows[7][1][:400] + "!"), (70, rows[8][1][50:]), (8, rows[9][1] + "?")]
    grouped = suffix_dedup._grouped
    monkeypatch.setattr(suffix_dedup, "SPLIT", 3000)

    def seen(length):
        def run(batches):
            for b in batches:
                by = collections.Counter()
                for m, c in zip(b["mark"].to_pylist(), b["content"].to_pylist()):
                    by[m] += len(c)
                assert max(by.values(), default=0) <= 3000
                yield from grouped(length)([b])

        return run

    monkeypatch.setattr(suffix_dedup, "_grouped", seen)
    want = bytes_wanted(rows, 100)
    assert got(suffix_dedup.suffix_dedup(docs_of(rows).coalesce(1)), *_BYTES) == want
    assert sum(r[2] > 0 for r in want) > 10
    monkeypatch.setattr(suffix_dedup, "SPLIT", 0)
    assert got(suffix_dedup.suffix_dedup(docs_of(rows)), *_BYTES) == want


def test_suffix_dedup_starts_travel_as_runs(docs_of, monkeypatch):
    sizes, written = {}, suffix_dedup.written

    def seen(df, name):
        out = written(df, name)
        if name == "starts":
            sizes[name] = out.selectExpr("sum(aggregate(starts, 0, (n, x) -> n + octet_length(x)))").first()[0]
        return out

    monkeypatch.setattr(suffix_dedup, "written", seen)
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(5_000))
    rows = [(1, passage), (2, "x" + passage), (3, passage[2_000:] + passage[:3_000])]
    want = bytes_wanted(rows, 100)
    assert got(suffix_dedup.suffix_dedup(docs_of(rows)), *_BYTES) == want
    # 4,901 repeated starts in the second document, and twice 2,901 in the third; a start is four bytes.
    assert 0 < sizes["starts"] < 8_000


def test_suffix_dedup_on_the_table(documents):
    assert got(suffix_dedup.suffix_dedup(documents), *_BYTES) == bytes_wanted(pairs(documents), 100)


def test_suffix_arrays():
    rng, strings = random.Random(1), [[0], [2] * 50 + [0], [1, 2] * 40 + [0], [2, 1] * 40 + [0]]
    for k in range(200):
        s = [rng.randrange(1, rng.choice([2, 3, 27])) for _ in range(rng.randrange(50))]
        strings.append((s * 3 if k % 4 == 0 else s) + [0])
    lengths = np.array([len(s) for s in strings])
    all_at_once, at = suffixes.suffix_arrays(np.array([x for s in strings for x in s], np.int16), lengths), 0
    for s in strings:
        want = sorted(range(len(s)), key=lambda i: s[i:])
        assert suffixes.suffix_array(np.array(s)) == want
        assert (all_at_once[at : at + len(s)] - at).tolist() == want
        at += len(s)


def test_marks_of_a_long_text_do_not_depend_on_chunks(monkeypatch):
    text = prose(9, 400).encode()
    whole = [x.tolist() for x in suffix_dedup.marks(text)]
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 256)
    h, place, first, n = suffix_dedup.marks(text)
    each = [(p, s) for p, f, k in zip(place, first, n) for s in range(f, f + k)]
    assert each == [(p, s) for p, f, k in zip(*whole[1:]) for s in range(f, f + k)]


# -- decontamination --------------------------------------------------------------

_ITEM = "A train leaves Springfield at 7 am and travels 60 km per hour, so after how many hours has Alice, who sits in it, seen 180 km of track go by?"


def test_decontamination(spark, docs_of):
    items = [(1, _ITEM), (2, None), (3, ""), (4, "short one"), (1, _ITEM), (5, prose(40, 30))]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, words int")
    other = _ITEM.replace("60", "75").replace("180", "225").replace("Alice", "Bob").replace("Springfield", "Berlin")
    twice = "He paid 5 dollars for 3 apples, then another 5 dollars for 3 pears, and in the end he had spent 10 dollars on 6 fruits in all."
    bench = bench.unionByName(spark.createDataFrame([(6, twice, 0)], bench.schema))
    rows = [
        (1, "Intro text here. " + _ITEM + " And more."), (2, "Well, " + other), (3, prose(41, 200)), (4, None), (5, ""), (6, "short one"),
        (7, "a short one here"), (8, prose(40, 30) + prose(42, 50)), (8, prose(40, 30) + prose(42, 50)), (9, prose(40, 12) + " and then " + prose(43, 20)),
        (10, twice.replace("5", "7").replace("3", "4").replace("10", "14").replace("6", "8")), (11, twice.replace("another 5", "another 9").replace("for 3 apples", "for 8 apples")),
        (None, _ITEM),
    ]
    found = decontaminate.decontaminate(docs_of(rows), bench)
    hits = {(r["doc_id"], tuple(r["items"])) for r in found.where("contaminated").collect()}
    # Consistent changes of numbers and names are caught, inconsistent ones (11) aren't.
    assert hits == {(1, (1,)), (2, (1,)), (6, (4,)), (7, (4,)), (8, (5,)), (10, (6,)), (None, (1,))}
    assert found.count() == len(rows)
    clean = decontaminate.clean_documents(docs_of(rows), bench)
    assert clean.schema.names == ["doc_id", "text", *EXTRA] and {r["doc_id"] for r in clean.collect()} == {3, 4, 5, 9, 11}
    assert decontaminate.decontaminate(docs_of(rows), bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs_of(rows).limit(0), bench).count() == 0


def test_decontamination_finds_planted_items(spark, documents):
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    found = decontaminate.decontaminate(documents, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
    want = {i for i, t in pairs(documents) if any(x in t for x in items)}
    assert {r["doc_id"] for r in found.where("contaminated").collect()} == want


def test_decontamination_whatever_the_capitals_and_spaces(spark, docs_of):
    shouted = "Mary Had A Little Lamb Whose Fleece Was White As Snow And Everywhere That Mary Went"
    bench = spark.createDataFrame([(1, _ITEM), (2, shouted)], "item_id long, text string")
    clean = "Today John Paul George Ringo Peter Mike Davy Micky Brian Keith Charlie Ronnie Bill Mick Anna Otto Emil all came"
    rows = [
        (1, "So: " + _ITEM.upper()), (2, _ITEM.lower()), (3, _ITEM.title()), (4, _ITEM.replace(" Springfield", "\nSpringfield").replace(" Alice", "  Alice")),
        (5, "He sang: " + shouted.lower() + "."), (6, clean), (7, _ITEM.replace("Springfield", "Berlin").replace("60", "70")), (8, prose(44, 80)),
    ]
    found = {r["doc_id"]: r["items"] for r in decontaminate.decontaminate(docs_of(rows), bench).collect()}
    assert found == {1: [1], 2: [1], 3: [1], 4: [1], 5: [2], 6: [], 7: [1], 8: []}


def test_slots_and_single_words_do_not_contaminate(spark, docs_of):
    items = [(1, "42"), (2, "Yes"), (3, "1 2 3 4 5 6 7 8 9 10 km"), (4, "pi 3 14 15 92 65 35 89 79"), (5, "No 5 entry")]
    rows = [(1, "Call 5 now"), (2, "yes"), (3, "Oh yes, 42!"), (4, "9 8 7 6 5 4 3 2 1 0 kg"), (5, "Take 1 2 3 4 5 6 7 8 of it"), (6, "there was no 7 entry at all"), (7, "42")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r["doc_id"]: r["items"] for r in decontaminate.decontaminate(docs_of(rows), bench).collect()}
    assert found == {1: [], 2: [2], 3: [], 4: [], 5: [], 6: [5], 7: []}


# -- personal data ----------------------------------------------------------------

_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(_PLAIN.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            twice = [int(c) * (1 + j % 2) for j, c in enumerate(reversed(d))]
            luhn = sum(v - 9 if v > 9 else v for v in twice) % 10 == 0
            ip = kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
            if {"email": True, "ip": ip, "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns(docs_of):
    rng = random.Random(5)
    rows = [(k, "".join(rng.choice("ab1.2@_- +()9é\n4,") for _ in range(rng.randrange(60)))) for k in range(800)]
    rows += [(1000, "4111 1111-1111 1111 a@b.c_d@e.f x@y.z.w.@q.r +1 (234) 555-1212. 255.255.1.256 0255.1.1.1 1.2.3.4.5.6.7.8"), (1001, None), (1002, "")]
    rows += [(1003, "😀 me@here.org"), (1003, "😀 me@here.org")]
    for r in pii.find(docs_of(rows)).collect():
        spans = plain_spans(dict(rows)[r["doc_id"]] or "")
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert (r["base_sha256"], r["spans"]) == (sha(text.encode()), text)
        assert [r[f"n_{k}"] for k in _PLAIN] == [sum(s[3] == k for s in spans) for k in _PLAIN]
    assert pii.find(docs_of(rows)).count() == len(rows) and pii.find(docs_of(rows).limit(0)).count() == 0


def test_base_spans_of_very_long_texts(docs_of):
    rows = [(1, "1" * 200_000), (2, "a" * 200_000), (3, "a@" + "b." * 50_000 + "c"), (4, "+1" + "(" * 100_000), (5, "1 " * 50_000)]
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs_of(rows)).collect()}
    assert found == {1: "", 2: "", 3: "email:0:100003", 4: "", 5: ""}


def test_disclosing_terms_are_found_and_removed(docs_of):
    rows = [(k, f"Letter {k}: dear Zorblax, write to zb@corp.example today, {prose(k, 20)}") for k in range(5)]
    rows += [(10, "They met Zorblax! " + prose(11, 20))] + [(20 + k, "dear reader, write today: " + prose(30 + k, 60)) for k in range(400)]
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs_of(rows)).collect()}
    assert found[10] == "term:9:16" and "term:15:22" in found[0] and "email:33:48" in found[0]
    assert all(not found[20 + k] for k in range(400))
    texts = {r["doc_id"]: r["text"] for r in pii.sanitise(docs_of(rows)).collect()}
    assert texts[10].startswith("They met [TERM]!") or texts[10].startswith("They met !")
    assert "zb@" not in texts[0] and "[EMAIL]" in texts[0] and texts[20] == dict(rows)[20]


def test_terms_of_one_or_two_texts_disclose_from_anywhere_in_them(docs_of):
    rows = [(k, f"Quibblesnort said that {prose(k, 30)} and so on, by mail to qs{k // 2}@corp.example") for k in range(2)]
    rows += [(5, f"Only Wumplefitz knows: {prose(5, 40)} or +1 234 555 1212"), (5, f"Only Wumplefitz knows: {prose(5, 40)} or +1 234 555 1212")]
    rows += [(20 + k, "only dear reader said that mail knows and so on: " + prose(30 + k, 20)) for k in range(200)]
    found = {r["doc_id"]: r["spans"].split(",") for r in pii.find(docs_of(rows)).collect()}
    assert "term:0:12" in found[0] and "term:0:12" in found[1] and "term:5:15" in found[5]
    assert all(found[20 + k] == [""] for k in range(200))


_COMMON = "harvest river window garden market letter winter summer bridge station".split()


def test_rare_words_beside_an_entity_stay(docs_of):
    text = "Please write to bob@x.org about the harvest festival, says our neighbour Quentinus from the village."
    rows = [(0, text), (1, "Nothing personal about the zymurgy of Quincetown here.")] + [(10 + k, prose(k, 30)) for k in range(198)]
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs_of(rows)).collect()}
    name = text.index("Quentinus")
    assert found[0] == f"email:16:25,term:{name}:{name + 9}"
    assert not any(v for k, v in found.items() if k)


def test_terms_equal_counted_shares(docs_of):
    """k and n counted by hand for every term and entity of small random texts."""
    rng = random.Random(4)
    people = [(f"Name{chr(97 + k) * 3}", f"p{k}@corp.example") for k in range(12)]
    rows = []
    for i in range(700):
        words = rng.choices(_COMMON, k=6)
        if i % 7 == 0:
            name, mail = people[i // 7 % 12]
            words += [mail] + ([name] if rng.random() < 0.7 else []) + ([name.lower()] if rng.random() < 0.2 else [])
            words += [f"rare{''.join(chr(97 + int(c)) for c in str(i // 7 % 36))}"]
        rows.append((i, "so it went: " + " ".join(words)))
    sets = [set(re.sub(r"(?<!\w)\W+|\W+(?!\w)", " ", t.lower().replace("went:", "went")).split()) for _, t in rows]
    named = [{w.lower() for w in re.findall(r"(?<= )[A-Z]\w+", t)} for _, t in rows]
    want = {}
    for mail in {m for _, m in people}:
        holders = [i for i, s in enumerate(sets) if mail in s]
        for term in set().union(*[sets[i] for i in holders]):
            if len(term) < 3 or re.search("[@0-9]", term):
                continue
            extra = sum(term in named[i] for i in holders)
            k, n = sum(term in sets[i] for i in holders) + extra, sum(term in s for s in sets) + extra
            p, z = k / n, pii.SURE**2
            low = (p + z / (2 * n) - pii.SURE * math.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)
            if low >= pii.LIKELY and math.log2(low / (len(holders) / len(rows))) >= pii.BITS:
                want[term] = max(want.get(term, 0), low)
    texts = pii._keyed(docs_of(rows), "doc_id", "text").select("key", "text")
    found = {r["term"]: r["likely"] for r in pii.disclosing_terms(texts, pii.base_spans(texts)).collect()}
    assert set(found) == set(want) and any(t.startswith("name") for t in want) and any(t.startswith("rare") for t in want)
    assert all(math.isclose(found[t], want[t], rel_tol=1e-9) for t in want)


def test_texts_without_personal_data_stay_clean(documents):
    """On the test tables, a text without base spans has none of terms either, but for names."""
    found = pii.find(documents).where("spans like '%term%' and n_email + n_ip + n_card + n_phone = 0").count()
    assert found <= documents.count() // 100


# -- language model ---------------------------------------------------------------


def unigram_wanted(rows):
    words = [(t or "").encode().lower().split() + [b""] for _, t in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _ in rows]
    c = collections.Counter()
    for w, h in zip(words, held):
        if not h:
            c.update(w)
    n = sum(c.values())
    base = [sum(math.log10((c[x] + 0.1) / (n + 0.1 * (len(c) + 1))) for x in w) for w in words]
    return sorted([(i, h, len(w), sum(c[x] > 0 for x in w), n, b) for (i, _), w, h, b in zip(rows, words, held, base)], key=repr)


_LM = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")


def test_lm_base_equals_counts_and_model_is_better(documents):
    counts = lm_scoring.word_counts(documents)
    found = lm_scoring.scores(documents, counts, lm_scoring.train(documents, counts)).cache()
    rows, want = got(found, *_LM), unigram_wanted(pairs(documents))
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(rows, want))
    base, score = found.where("held_out").selectExpr("sum(base_score)", "sum(score)").first()
    assert score > base


def test_lm_ids_follow_the_vocabulary(spark):
    small, large = (
        spark.range(n).selectExpr("cast(concat('w', id) as binary) as word", "crc32(concat('w', id)) as ending", "id + 1 as c") for n in (50, 400_000)
    )
    none = spark.createDataFrame([], "doc_id long, text string")
    models = [lm_scoring.train(none, c) for c in (small, large)]
    assert models[0].shape.ids >= 640 + 384
    assert len(models[1].own) > 640 and models[1].own_ids + models[1].shared_ids > 640 + 384
    assert models[1].shape.classes > models[0].shape.classes
    text = " ".join(f"w{k}" for k in range(0, 400_000, 1000))
    scored = lm_scoring.scores(spark.createDataFrame([(1, text)], none.schema), large, models[1]).first()
    assert scored["n_known"] == 400 and math.isfinite(scored["score"])


def test_lm_on_odd_rows(docs_of):
    df = docs_of(EDGES + [(60 + k, prose(k, 20)) for k in range(30)])
    counts = lm_scoring.word_counts(df)
    found = lm_scoring.scores(df, counts, lm_scoring.train(df, counts))
    rows, want = got(found, *_LM), unigram_wanted(pairs(df))
    assert [r[:5] for r in rows] == [r[:5] for r in want] and all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(rows, want))
    none = df.limit(0)
    counts = lm_scoring.word_counts(none)
    model = lm_scoring.train(none, counts)
    assert lm_scoring.scores(none, counts, model).count() == 0
    untrained = lm_scoring.scores(df, counts, model).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in untrained)


def test_only_snippets_that_share_a_string_are_ordered():
    shared = b"s" * 60 + b"t" * 60
    groups = [[("a", 1, 0, 31, b"x" * 10 + shared), ("b", 2, 0, 31, shared + b"y" * 10), ("c", 3, 0, 21, b"z" * 120)], [("d", 4, 0, 21, shared), ("e", 5, 0, 21, b"u" + shared[1:-1] + b"v")]]
    # Hashes count per mark: d's string in the first group is another mark's. c repeats itself and may stay.
    assert suffix_dedup._sharing(groups, 100).tolist()[:2] == [True, True]
    assert suffix_dedup._sharing([groups[0][:1], groups[1][:1]], 100).tolist() == [False, False]


def test_lm_rows_that_are_grouped_hold_no_lists(spark):
    # Batches for grouped rows are measured row by row, which is quadratic for lists that are NULL.
    schema = spark.createDataFrame([], lm_scoring._SENT).schema
    assert not [f.name for f in schema if f.dataType.typeName() in ("array", "map")]


def test_gru_gradient_and_state():
    shape, rng = gru.Shape(9, 3), np.random.default_rng(3)
    flat = (rng.standard_normal(shape.size) * 0.5).astype(np.float32)
    docs = [rng.integers(0, 9, n) for n in (7, 5, 5, 1)]
    (_, before, ids, sizes, _) = next(gru.windows(docs, shape, 4, 16))
    p, g = shape.views(flat), np.zeros_like(flat)

    def loss(x):
        v = shape.views(x)
        return -gru.window_log10(v, shape, before, ids, sizes, np.zeros((4, 3), np.float32)).mean() * math.log(10)

    gru.window_gradient(p, shape, before, ids, sizes, np.zeros((4, 3), np.float32), shape.views(g))
    for k in rng.integers(0, shape.size, 60):
        x = flat.astype(np.float64)
        x[k] += 1e-4
        y = flat.astype(np.float64)
        y[k] -= 1e-4
        assert math.isclose((loss(x) - loss(y)) / 2e-4, g[k], rel_tol=2e-2, abs_tol=2e-4)
    # A document scores alike however it is cut into windows, and probabilities sum to one.
    whole = gru.score(flat, shape, docs, 4)
    old, gru.SCORED = gru.SCORED, 2
    try:
        assert np.allclose(whole, gru.score(flat, shape, docs, 1), atol=1e-4)
    finally:
        gru.SCORED = old
    each = gru.score(flat, shape, [np.array([3, k]) for k in range(9)], 9)
    assert math.isclose((10 ** (each - gru.score(flat, shape, [np.array([3])], 1))).sum(), 1, rel_tol=1e-4)


def test_gru_windows_take_few_steps_whatever_the_classes(monkeypatch):
    calls = collections.Counter()

    class Counted:
        def __getattr__(self, name):
            calls[name] += 1
            return getattr(np, name)

    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 900, 12) for _ in range(40)]
    seen = []
    for ids in (9, 900):
        shape = gru.Shape(ids, 4)
        flat = shape.initial(np.ones(ids))
        own = [d % ids for d in docs]
        (_, before, now, sizes, _) = next(gru.windows(own, shape, 40, 16))
        with monkeypatch.context() as m:
            m.setattr(gru, "np", Counted())
            gru.window_gradient(shape.views(flat), shape, before, now, sizes, np.zeros((40, 4), np.float32), shape.views(np.zeros_like(flat)))
            gru.window_log10(shape.views(flat), shape, before, now, sizes, np.zeros((40, 4), np.float32))
        seen.append(calls.pop("exp"))
        calls.clear()
    assert seen[0] == seen[1]


def test_gru_with_logits_far_apart():
    shape, rng = gru.Shape(30, 3), np.random.default_rng(6)
    flat = (rng.standard_normal(shape.size) * 60).astype(np.float32)
    p, doc = shape.views(flat), rng.integers(0, 30, 200)
    (_, before, ids, sizes, _) = next(gru.windows([doc], shape, 1, 200))
    found = gru.window_log10(p, shape, before, ids, sizes, np.zeros((1, 3), np.float32))
    out, _ = gru._steps(p, shape, before, sizes, np.zeros((1, 3), np.float32))
    want = []
    for h, i in zip(out.T.astype(float), ids):
        c, k = divmod(int(i), shape.width)
        outer, inner = h @ p["wc"] + p["bc"], h @ p["wi"][c] + p["bi"][c]
        want.append(outer[c] - np.logaddexp.reduce(outer) + inner[k] - np.logaddexp.reduce(inner))
    assert np.allclose(found, np.array(want) / math.log(10), rtol=1e-3, atol=1e-3) and min(want) < -100
    g = np.zeros_like(flat)
    gru.window_gradient(p, shape, before, ids, sizes, np.zeros((1, 3), np.float32), shape.views(g))
    assert np.isfinite(g).all()


# -- SentencePiece ----------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.codec(sentencepiece_codec.MODEL)


def best_score(c, chars):
    s = [0.0] + [-math.inf] * len(chars)
    for j in range(1, len(s)):
        for i in range(max(0, j - c.span), j):
            if (found := c.pieces.get(chars[i:j])) is not None:
                s[j] = max(s[j], s[i] + found[1])
        if chars[j - 1] not in c.pieces:
            s[j] = max(s[j], s[j - 1] + len(chars[j - 1].encode()) * c.byte_score)
    return s[-1]


def test_viterbi_is_optimal_and_streams(codec):
    score = {i: s for i, s in codec.pieces.values()}
    for text in ("Hello world, this is it.", "aaaaaaaaaaaaaaa" * 20, "é😀x  two   spaces", "Ünïcödé.word,and" * 9, "int main() { return 0; }"):
        ids = np.frombuffer(codec.encode(text), np.int32).tolist()
        chars = (" " + text).replace(" ", "▁")
        assert math.isclose(sum(score.get(i, codec.byte_score) for i in ids), best_score(codec, chars), rel_tol=1e-9)
        assert codec.viterbi(chars) == ids


def test_round_trip(docs_of, documents):
    rows = EDGES + [(90, "▁ literal ▁▁ marks"), (91, "  spaces  \n\n and\ttabs "), (92, "\x00\x01"), (93, " "), (94, "\n")]
    encoded = sentencepiece_codec.encode(docs_of(rows)).cache()
    assert encoded.count() == len(rows) and encoded.where("not round_trip").count() == 0
    back = got(sentencepiece_codec.decode(encoded), "doc_id", "text")
    assert back == sorted([(i, t or "") for i, t in rows], key=repr)
    assert encoded.where("n_ids <> size(ids)").count() == 0
    assert sentencepiece_codec.encode(documents).where("not round_trip").count() == 0
    assert sentencepiece_codec.encode(documents.limit(0)).count() == 0


# -- quality ----------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("no test tables here")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = quality.graded(spark.read.parquet(f"{sf}/labels.parquet"))
    model = quality.train(docs, labels.where("doc_id % 3 <> 0"))
    found = quality.grade(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    right = [r["kept"] == (r["grade"] == 2) for r in found]
    assert len(right) > 100 and sum(right) / len(right) > 0.93
    assert model.theta[0] < model.theta[1]
    assert all(0 <= r["p_above_1"] <= r["p_above_0"] <= 1 for r in found)


def test_quality_on_odd_rows(spark, docs_of):
    rows = EDGES + [(200 + k, prose(k, 30) + (" idiot" if k % 2 else "")) for k in range(40)]
    bad = [(None, 1, 1), (201, None, 1), (203, 1, None), (9999, 0, 1), (202, 1, 0), (202, 1, 1)]
    labels = spark.createDataFrame([(200 + k, 1, k % 2) for k in range(4, 40)] + bad, "doc_id long, quality int, toxic int")
    assert {r["doc_id"]: r["grade"] for r in quality.graded(labels).collect()}[202] == 0
    df = docs_of(rows)
    model = quality.train(df, quality.graded(labels.where("doc_id is null or doc_id <> 202")))
    found = quality.grade(df, model)
    assert found.count() == len(rows)
    assert {r["doc_id"] for r in found.where("not kept").collect()} >= {200 + k for k in range(1, 40, 2)}
    kept = quality.kept_documents(df, model)
    assert kept.schema.names == df.schema.names and kept.count() == found.where("kept").count()
    assert quality.grade(df.limit(0), model).count() == 0
    assert quality.grade(df, quality.train(df, quality.graded(labels.limit(0)))).where("not kept").count() == 0
    assert len(quality.train(df, quality.graded(labels), max_labelled=3).theta) == 2
