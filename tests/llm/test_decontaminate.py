"""Window search of the benchmark filter, held against a plain search in Python over the same template words."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from respfeat.llm import decontaminate as d

ITEMS = [
    (1, "A train travels 120 km in 3 hours and then 60 km in 2 hours, how far did the train travel in all?"),
    (2, "Yesterday in the market Maria sold 12 apples to Peter and then Maria sold 5 pears to Peter for 12 dollars."),
    (3, "42"),
    (4, "the harvest of the year"),
    (5, "Yes"),
    (6, "1 2 3 4 5 6 7 8 9 10"),
    (7, ""),
    (8, None),
    (9, "when 3 men need 4 days for a wall, how many days do 6 men need for a wall of the same size"),
]
ITEMS.append((10, ITEMS[0][1]))
DOCS = [
    (1, "Asked in class: A train travels 450 km in 7 hours and then 80 km in 5 hours, how far did the train travel in all? Well."),
    (2, "A train travels 120 km in 3 hours and then 60 km in 3 hours, how far did the train travel in all?"),
    (3, "YESTERDAY IN THE MARKET MARIA SOLD 12 APPLES TO PETER AND THEN MARIA SOLD 5 PEARS TO PETER FOR 12 DOLLARS."),
    (4, "Yesterday in the market Anna sold 9 apples to Otto and then Anna sold 4 pears to Otto for 9 dollars."),
    (5, "Yesterday in the market Anna sold 9 apples to Otto and then Berta sold 4 pears to Hugo for 8 dollars."),
    (6, "Call 5 now"), (7, "42"), (8, "yes"), (9, "well yes"), (10, "They spoke of the harvest of the year at length."),
    (11, "11 12 13 14 15 16 17 18 19 20 21"), (12, ""), (13, None), (None, ITEMS[1][1]), (14, ITEMS[8][1] * 3), (14, ITEMS[8][1] * 3),
    (15, " \n".join(t for _, t in ITEMS if t)), (16, "if 5 men need 9 days for a wall, how many days do 2 men need for a wall"),
]


def _kind(word):
    return word.split("=")[0] if word.startswith("<") else word


def _templates(df, text):
    """text -> its words by template."""
    rows = df.select(F.col(text).alias("text"), d.template(text, True).alias("named"), d.template(text, False).alias("plain")).collect()
    return {r["text"]: {True: r["named"], False: r["plain"]} for r in rows}


def _plain_search(docs, items, window, coverage):
    """{(text, item)}: the definition in the module's docstring."""
    first = {}
    for item, text in {*items}:
        for named, words in text.items():
            size = min(window, len(words))
            for p in range(len(words) - size + 1 if size else 0):
                own = tuple(words[p : p + size])
                first.setdefault((item, named), {}).setdefault((size, tuple(map(_kind, own))), (p, [w for w in own if w.startswith("<")]))
    found = set()
    for text, by in docs.items():
        for item in {i for i, _ in first}:
            held = {True: set(), False: set()}
            for named, words in by.items():
                lines = defaultdict(lambda: (set(), set()))
                for (size, kinds), (q, slots) in first.get((item, named), {}).items():
                    if size - len(slots) < 2 and not (size == 1 and not slots and len(words) == 1):
                        continue
                    for p in range(len(words) - size + 1):
                        if tuple(map(_kind, words[p : p + size])) == kinds:
                            own = [w for w in words[p : p + size] if w.startswith("<")]
                            lines[p - q][0].add(q)
                            lines[p - q][1].update(zip(slots, own))
                for at, pairs in lines.values():
                    if len({a for a, _ in pairs}) == len(pairs):
                        held[named] |= at
            n_named, n_plain = (len(first.get((item, k), ())) for k in (True, False))
            if n_named and max(len(held[True]) / n_named, min(len(held[True] | held[False]) / n_plain, 1)) >= coverage:
                found.add((text, item))
    return found


class _Item(dict):
    __hash__ = object.__hash__


@pytest.mark.parametrize("window", [3, 8])
@pytest.mark.parametrize("sent", [True, False])
def test_windows_and_slots(spark, monkeypatch, window, sent):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    if not sent:
        monkeypatch.setattr(d, "BROADCAST_KEYS", 0)
    by_text = _templates(items, "text")
    expected = _plain_search(_templates(docs, "text"), [(i, _Item(by_text[t])) for i, t in ITEMS], window, d.COVERAGE)
    got = d.decontaminate(docs, items, window=window).collect()
    assert len(got) == len(DOCS)
    texts = sorted(DOCS, key=lambda x: (x[0] is None, x[0] or 0))
    rows = sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    for (i, text), r in zip(texts, rows):
        assert r["items"] == sorted(k for t, k in expected if t == text), (i, text)
        assert r["contaminated"] == bool(r["items"])
    if window == 8:
        assert {1, 3, 4, 8, 14, 15} <= {r["doc_id"] for r in rows if r["contaminated"]}
        assert not {5, 6, 7, 9, 11, 12, 13} & {r["doc_id"] for r in rows if r["contaminated"]}


def test_no_words_of_the_text_leave_the_search(spark):
    """A row that held the words of its text for each window would take the square of its length."""
    item = ITEMS[0][1]
    docs = spark.createDataFrame([(1, f"{item} " * 3000)], "doc_id long, text string")
    assert [r["items"] for r in d.decontaminate(docs, spark.createDataFrame(ITEMS[:1], "item_id long, text string")).collect()] == [[1]]
