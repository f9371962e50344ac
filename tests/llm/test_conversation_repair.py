"""Conversation repair against a full search of edit scripts, on a table and on odd rows."""

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from respfeat.llm import conversation_repair as cr
from respfeat.llm.common import table

from .conftest import SF_DIR

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cheapest(rows):
    """(cost, audit, lines) over all scripts: rows of (role, text, fault)."""

    @functools.cache
    def go(at, last, run):
        found = [(0, "", ())] if at == len(rows) and last in ("", "a") else []
        steps = [("I", 3, at, s, (NAMES[s], ""), run + 1) for s in NEXT[last] if s in NAMES] if run < 3 else []
        if at < len(rows):
            role, text, fault = rows[at]
            steps.append(("D", 4, at + 1, last, None, 0))
            if fault in ("", "truncated"):
                more = 3 * (fault == "truncated")
                steps += [("R", 3 + more, at + 1, s, (NAMES[s], text), 0) for s in NEXT[last] if s in NAMES]
                if role and role[0] in NEXT[last]:
                    steps.append(("K", more, at + 1, role[0], (role, text), 0))
        for letter, cost, to, state, line, n in steps:
            rest = go(to, state, n)
            if rest:
                found.append((cost + rest[0], letter + rest[1], ((line,) if line else ()) + rest[2]))
        return min(found, key=lambda x: x[:2]) if found else None

    return go(0, "", 0)


def wanted(rows, harm=True):
    """The query's rows by definition."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        out = convs[conv]
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if harm else 9
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    result = []
    for conv, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, marked = set(), []
        for _, role, text in got:
            bare = text.strip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        cost, audit, lines = cheapest(tuple(marked))
        turns = {t for t, _, _ in got if t is not None}
        counts = [sum(m[2] == x for m in marked) for x in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        result.append((conv, gaps, *counts, illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in lines))))
    return sorted(result, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, sha string, present int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)


def repaired(df):
    judged = cr.judge(df).cache()
    both = judged.join(cr.digests(cr.apply(df, judged)), judged["conv_id"].eqNullSafe(cr.F.col("conv")), "left").drop("conv")
    return sorted((tuple(r[:-1]) + (r[-1] or sha(""),) for r in both.collect()), key=repr)


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, cr.query(spark, SF_DIR).collect()), key=repr) == wanted(rows)


@pytest.mark.parametrize("block_rows", [2, 512])
def test_odd_rows(spark, monkeypatch, block_rows):
    monkeypatch.setattr(cr, "BLOCK_ROWS", block_rows)
    rng = random.Random(block_rows)
    roles = ["user", "assistant", "system", "tool", "", None, "ux"]
    texts = ["Fine.", "Cut off", "", " \n\t", None, "So? ", "é!", "Fine.", "long " * 20_000 + "."]
    rows = [(c, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for c in [None, *range(40)] for _ in range(rng.randrange(1, 9))]
    rows += [(99, None, "user", "Again.")] * 5 + [(98, 1, "user", "Hi."), (98, 5, "assistant", "Ho.")]
    assert repaired(frame(spark, rows)) == wanted(rows, harm=False)


def test_long_conversation_in_blocks(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Text {rng.randrange(2000)}" + rng.choice([".", ""])) for t in range(3000)]
    df = frame(spark, rows)
    whole = cr._Conversation(1)
    seen = set()
    for _, t, role, text in rows:
        whole.read(t, role, text.encode(), False, text[-1] != ".", (role, text) in seen)
        seen.add((role, text))
    (got,) = cr.judge(df).collect()
    assert tuple(got) == whole.result()
    # The same by plain dynamic programming over (cost, audit).
    seen, best = set(), {0: (0, "")}

    def filled(best):
        for _ in range(2):
            for s, w in list(best.items()):
                for n, to in cr.STEP[s].items():
                    if n in "ua":
                        best[to] = min(best.get(to, (10**9, "")), (w[0] + 3, w[1] + "I"))
        return best

    best = filled(best)
    for _, _, role, text in rows:
        twice, cut, new = (role, text) in seen, text[-1] != ".", {}
        seen.add((role, text))
        for s, (c, a) in best.items():
            options = [(s, (c + 4, a + "D"))]
            if not twice:
                options += [(to, (c + 3 * cut + 3 * (n != role[0]), a + ("K" if n == role[0] else "R"))) for n, to in cr.STEP[s].items() if n in "ua"]
            for to, w in options:
                new[to] = min(new.get(to, (10**9, "")), w)
        best = filled(new)
    assert (got["cost"], got["audit"]) == min(best[0], best[3])


def test_agenda_with_several_antecedents():
    # sum(a, b) -> c and max(a, c) -> d, as superior functions: deduced when the later antecedent finalises.
    rules = {"c": ("a", "b", lambda x, y: x + y), "d": ("a", "c", lambda x, y: max(x, y) + 1)}
    final = {}

    def deduce(item, weight):
        final[item] = weight
        for head, (x, y, f) in rules.items():
            if item in (x, y) and x in final and y in final:
                yield f(final[x], final[y]), head

    assert cr.lightest([(2, "a"), (5, "b"), (9, "c")], deduce, "d") == {"a": 2, "b": 5, "c": 7, "d": 8}


def test_empty_table(spark):
    assert repaired(frame(spark, [])) == []
