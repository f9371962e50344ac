import math
import random
from datetime import timedelta
from statistics import mean, pstdev, stdev

import pytest
from conftest import at

from respfeat.functions.stats import FIVE_STATS, stats_block
from respfeat.operators import selection as sel
from respfeat.operators.profile import hour_profile
from respfeat.operators.trailing import Block, all_pairs_count, trailing_counts, trailing_features

SCHEMA = "e long, ts timestamp_ntz, v double"
FOUR = [Block("h7", 7, True), Block("a7", 7), Block("h30", 30, True), Block("a30", 30)]


def visible(history, e, ts, days, same_hour=False, align="hour"):
    """The window by its definition."""
    if align == "day":
        hi = ts.replace(hour=0, minute=0, second=0, microsecond=0)
        lo = hi - timedelta(days=days)
    else:
        hi = ts.replace(minute=0, second=0, microsecond=0)
        lo = ts.replace(microsecond=0) - timedelta(hours=24 * days)
    return [
        v for he, hts, v in history if he == e and hts and lo <= hts < hi and (not same_hour or hts.hour == ts.hour)
    ]


def figures(values, days, times=1):
    vals = sorted(v for v in values if v is not None)
    n = len(values) * times
    logs = [math.log(v) for v in vals if v > 0]
    pick = lambda p: vals[max(math.ceil(p * len(vals)), 1) - 1] if vals else None
    return {
        "pre": mean(vals) if vals else None,
        "stddev": stdev(vals * times) if len(vals) * times > 1 else None,
        "per25": pick(0.25),
        "per50": pick(0.5),
        "per75": pick(0.75),
        "numsord": n,
        "preord": n / days,
        "geomean": math.exp(sum(logs) / len(values)) if logs else None,
    }


def same(got, want):
    if want is None or got is None:
        return got is want
    return math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-9)


def compare(df, history, blocks, align="hour"):
    got = {(r["e"], r["ts"]): r for r in df.collect()}
    expected = {}
    for e, ts in {(e, ts) for e, ts, _ in history if e is not None and ts is not None}:
        seen = [visible(history, e, ts, b.days, b.same_hour, align) for b in blocks]
        if any(seen):
            expected[(e, ts)] = seen
    assert set(got) == set(expected)
    for key, seen in expected.items():
        for b, values in zip(blocks, seen):
            want = figures(values, b.days) if values else dict.fromkeys(b.stats)
            for s in b.stats:
                assert same(got[key][f"{b.prefix}_{s}"], want[s]), (key, b.prefix, s, got[key], want)


def fixture(seed, n, entities, days, values=lambda rnd: round(rnd.random() * 90, 2)):
    rnd = random.Random(seed)
    start = at("2024-01-01 00:00:00")
    out = []
    for _ in range(n):
        e = 0 if rnd.random() < 0.4 else rnd.randrange(1, entities)
        seconds = rnd.randrange(days * 86400)
        micros = rnd.choice([0, 0, 250_000, 999_999])
        out.append((e, start + timedelta(seconds=seconds, microseconds=micros), values(rnd)))
    return out


@pytest.mark.parametrize("group_rows,gather_rows", [(4096, 256), (30, 256), (30, 5)])
def test_blocks_equal_their_definition(spark, monkeypatch, group_rows, gather_rows):
    monkeypatch.setattr(sel, "GATHER_ROWS", gather_rows)
    history = fixture(1, 400, 8, 70)
    history += [(None, at("01-12 10:00:00"), 1.0), (2, None, 1.0), (2, at("01-12 10:00:00"), None)]
    history += [(0, at("01-12 10:00:00"), 0.0), (0, at("01-12 10:00:00"), 7.0), (0, at("02-01 10:00:00"), -3.0)]
    # A frequent value, which the search must not try to cut.
    history += [(0, at("01-20 03:00:00") + timedelta(hours=i), 5.0) for i in range(40)]
    df = spark.createDataFrame(history, SCHEMA)
    compare(trailing_features(df, "e", "ts", "v", FOUR, group_rows=group_rows), history, FOUR)


@pytest.mark.parametrize("group_rows", [4096, 20])
def test_day_windows_equal_their_definition(spark, monkeypatch, group_rows):
    monkeypatch.setattr(sel, "GATHER_ROWS", 5)
    history = fixture(2, 250, 6, 50)
    blocks = [Block("d7", 7), Block("d30", 30)]
    df = spark.createDataFrame(history, SCHEMA)
    compare(trailing_features(df, "e", "ts", "v", blocks, "day", group_rows=group_rows), history, blocks, "day")


@pytest.mark.parametrize("group_rows", [4096, 1])
def test_window_bounds(spark, group_rows):
    anchor = at("01-15 10:30:20.700")
    history = [
        (1, anchor, 100.0),
        (1, at("01-08 10:30:20.000"), 1.0),
        (1, at("01-08 10:30:19.999"), 2.0),
        (1, at("01-15 09:59:59.999"), 4.0),
        (1, at("01-15 10:00:00.000"), 8.0),
        (1, at("01-12 10:05:00"), 16.0),
        (None, at("01-14 10:05:00"), 32.0),
        (2, at("01-14 10:05:00"), 64.0),
    ]
    df = spark.createDataFrame(history, SCHEMA)
    blocks = [Block("h", 7, True), Block("a", 7)]
    got = trailing_features(df, "e", "ts", "v", blocks, group_rows=group_rows).collect()
    row = next(r for r in got if r["ts"] == anchor)
    assert row["a_numsord"] == 3 and same(row["a_pre"], 7.0)
    assert row["h_numsord"] == 2 and same(row["h_pre"], 8.5)
    day = trailing_features(df, "e", "ts", "v", [Block("d", 7)], "day", group_rows=group_rows)
    row = next(r for r in day.collect() if r["ts"] == anchor)
    assert row["d_numsord"] == 3 and same(row["d_pre"], 19 / 3)


def stats_of(spark, cases, group_rows=4096, last=999.0, **how):
    """Each list of values as the history of one entity; the figures at one later anchor."""
    anchor = at("01-12 10:00:00")
    history = [(e, anchor, last) for e in range(len(cases))]
    for e, values in enumerate(cases):
        history += [(e, at("01-10 10:00:00") + timedelta(minutes=i), v) for i, v in enumerate(values)]
    out = trailing_features(
        spark.createDataFrame(history, SCHEMA), "e", "ts", "v", [Block("s", 7)], group_rows=group_rows, **how
    )
    got = {r["e"]: r for r in out.collect() if r["ts"] == anchor}
    return [got[e] for e in range(len(cases))]


@pytest.mark.parametrize("group_rows", [4096, 1])
def test_statistics_by_hand(spark, group_rows):
    cases = [[1.0, 2.0, 4.0, 8.0], [1.0, 2.0, 4.0], [5.0], [0.0, 4.0], [0.0, 0.0]]
    four, three, one, zero, zeros = stats_of(spark, cases, group_rows)
    assert (four["s_per25"], four["s_per50"], four["s_per75"]) == (1.0, 2.0, 4.0)
    assert same(four["s_geomean"], 64 ** 0.25) and same(four["s_preord"], 4 / 7)
    assert same(three["s_stddev"], stdev([1, 2, 4])) and one["s_stddev"] is None
    assert same(zero["s_geomean"], 2.0) and zeros["s_geomean"] is None
    _, three, one, _, _ = stats_of(spark, cases, group_rows, stddev="population")
    assert same(three["s_stddev"], pstdev([1, 2, 4])) and one["s_stddev"] == 0


@pytest.mark.parametrize("group_rows", [4096, 1])
def test_squares_keep_their_precision(spark, group_rows):
    (r,) = stats_of(spark, [[1e9 + x for x in (1.0, 2.0, 4.0)]], group_rows, last=1e9)
    assert math.isclose(r["s_stddev"], stdev([1, 2, 4]), rel_tol=1e-6)


@pytest.mark.parametrize("group_rows, odd", [(4096, 1e9), (60, 1e9), (60, math.nan)])
def test_odd_values_touch_only_windows_that_hold_them(spark, group_rows, odd):
    start = at("01-01 00:30:00")
    plain = [(1, start + timedelta(hours=k), 1.0 + (k * 7) % 13 / 5) for k in range(96)]
    marked = [(1, t, odd if k == 20 else v) for k, (_, t, v) in enumerate(plain)]
    blocks = [Block("w", 1), Block("m", 3)]
    got = {}
    for name, history in (("plain", plain), ("marked", marked)):
        out = trailing_features(spark.createDataFrame(history, SCHEMA), "e", "ts", "v", blocks, group_rows=group_rows)
        got[name] = {r.ts: r for r in out.collect()}
    for ts, r in got["plain"].items():
        for b in blocks:
            hour = ts.replace(minute=0, second=0)
            if not any(ts - timedelta(days=b.days) <= t < hour for t in (plain[20][1],)):
                for k in ("pre", "stddev", "per25", "per75", "geomean", "numsord"):
                    a, c = r[f"{b.prefix}_{k}"], got["marked"][ts][f"{b.prefix}_{k}"]
                    assert a == c or math.isclose(a, c, rel_tol=1e-12), (ts, b, k)
    if odd == 1e9:
        values = [v for _, t, v in marked if plain[80][1] - timedelta(days=3) <= t < plain[80][1].replace(minute=0)]
        assert odd in values and math.isclose(got["marked"][plain[80][1]]["m_stddev"], stdev(values), rel_tol=1e-9)


@pytest.mark.parametrize("group_rows", [4096, 1])
def test_geomean_over_the_window(spark, group_rows):
    history = [(1, at("01-10 10:00:00"), 4.0), (1, at("01-10 09:00:00"), 2.0), (1, at("01-12 10:30:00"), 9.0)]
    df = spark.createDataFrame(history, SCHEMA)
    for over, want in (("filtered", 4.0), ("window", 2.0)):
        out = trailing_features(
            df, "e", "ts", "v", [Block("h", 7, True, geomean_over=over)], group_rows=group_rows
        ).collect()
        assert same(next(r for r in out if r["ts"] == at("01-12 10:30:00"))["h_geomean"], want)


@pytest.mark.parametrize("group_rows", [4096, 1])
def test_duplicate_anchors(spark, group_rows):
    history = [(1, at("01-10 10:00:00"), 1.0), (1, at("01-10 11:00:00"), 2.0), (1, at("01-10 12:00:00"), 4.0)]
    history += [(1, at("01-12 10:00:00"), 9.0)] * 2
    df = spark.createDataFrame(history, SCHEMA)
    for twice, times in ((False, 1), (True, 2)):
        out = trailing_features(
            df, "e", "ts", "v", [Block("s", 7)], duplicate_anchors=twice, group_rows=group_rows
        ).where("ts = timestamp_ntz'2024-01-12 10:00:00'").collect()
        assert len(out) == 1
        want = figures([1.0, 2.0, 4.0], 7, times)
        assert all(same(out[0][f"s_{k}"], v) for k, v in want.items())


def test_month_block_is_per_thirty_days(spark):
    history = [(1, at("01-10 10:00:00") + timedelta(minutes=i // 2), 1.0) for i in range(60)]
    history.append((1, at("01-12 10:00:00"), 9.0))
    out = trailing_features(spark.createDataFrame(history, SCHEMA), "e", "ts", "v", [Block("m", 30)]).collect()
    assert next(r for r in out if r["ts"] == at("01-12 10:00:00"))["m_preord"] == 2.0


def test_counts_equal_their_definition(spark):
    history = fixture(3, 400, 5, 40) + [(None, at("01-12 10:00:00"), 1.0)]
    df = spark.createDataFrame(history, SCHEMA)
    for days, align, same_hour in ((7, "hour", False), (30, "hour", True), (7, "day", False)):
        got = {(r.e, r.ts): r.n_pairs for r in trailing_counts(df, "e", "ts", days, align, same_hour).collect()}
        want = {}
        for e, ts in {(e, ts) for e, ts, _ in history if e is not None}:
            n = len(visible(history, e, ts, days, same_hour, align))
            if n:
                want[(e, ts)] = n
        assert got == want
    sizes = {r.e: r.n_pairs for r in all_pairs_count(df, "e").collect()}
    assert sizes == {e: sum(h[0] == e for h in history) ** 2 for e in {h[0] for h in history} - {None}}


def test_no_pairs_in_the_plan(spark):
    df = spark.createDataFrame(fixture(4, 50, 3, 20), SCHEMA)
    plan = trailing_features(df, "e", "ts", "v", FOUR)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("fanout_rows", [1_000_000, 4])
def test_profile_equals_pooled_pairs(spark, monkeypatch, fanout_rows):
    monkeypatch.setattr(sel, "SORTED_ROWS", fanout_rows)
    history = fixture(5, 200, 4, 30)
    df = spark.createDataFrame(history, SCHEMA)
    got = {(r.e, r.hour): r for r in hour_profile(df, "e", "ts", "ts", "v", 7, "p", "hour").collect()}
    pooled = {}
    for e, ts, _ in history:
        lo = at("2024-01-01 00:00:00")
        hi = ts.replace(hour=0, minute=0, second=0, microsecond=0)
        for he, hts, v in history:
            if he == e and max(lo, hi - timedelta(days=7)) <= hts < hi:
                pooled.setdefault((e, hts.hour), []).append(v)
    assert set(got) == set(pooled)
    for key, values in pooled.items():
        want = figures(values, 7)
        assert all(same(got[key][f"p_{s}"], want[s]) for s in FIVE_STATS)


def test_group_by_form_of_the_block(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 4.0), (1, 8.0), (2, 0.0), (2, 4.0)], "k int, v double")
    got = {r.k: r for r in df.groupBy("k").agg(*stats_block("s", "v", 7)).collect()}
    for k, values in ((1, [1.0, 2.0, 4.0, 8.0]), (2, [0.0, 4.0])):
        assert all(same(got[k][f"s_{s}"], w) for s, w in figures(values, 7).items())


def test_memory_of_a_task_does_not_grow_with_its_rows():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from respfeat.operators import slices

    schema = pa.schema([("_e", pa.int64()), ("_ts", pa.timestamp("us")), ("_times", pa.int64())])
    for i in range(4):
        schema = schema.append(pa.field(f"_n{i}", pa.int64())).append(pa.field(f"_q{i}_1", pa.float64()))
    run = slices.statistics(FOUR, "hour", (0.25, 0.5, 0.75), False, schema)

    def batches(n, per=10_000, slice_rows=50):
        sec = np.sort(np.random.default_rng(1).integers(0, 20 * 86400, (per // slice_rows, slice_rows)), axis=1).ravel() + 19_723 * 86400
        for lo in range(0, n, per):
            e = (lo + np.arange(per)) // slice_rows
            yield pa.record_batch({
                "_e": e, "_slice": np.zeros(per, np.int64), "_ts": pa.array(sec * 1_000_000, pa.timestamp("us")),
                "_cell": sec // 3600, "_sec": sec, "_v": sec % 97 + 0.5, "_own": np.ones(per, bool),
            })

    tracemalloc.start()
    rows = sum(b.num_rows for b in run(batches(400_000)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 300_000 and peak < 150 << 20, (rows, peak >> 20)


@pytest.mark.parametrize("chunk_rows", [50_000, 64])
def test_a_busy_entity_takes_few_steps(spark, monkeypatch, chunk_rows):
    from respfeat.operators import slices

    settled = []
    settle = sel.settle
    monkeypatch.setattr(sel, "settle", lambda df: settled.append(1) or settle(df))
    monkeypatch.setattr(slices, "CHUNK_ROWS", chunk_rows)
    history = fixture(7, 3000, 2, 40, lambda rnd: rnd.choice([5.0, 7.0, None, float(rnd.randrange(1000))]))
    df = spark.createDataFrame(history, SCHEMA)
    whole = trailing_features(df, "e", "ts", "v", FOUR).orderBy("e", "ts").collect()
    assert not settled
    parted = trailing_features(df, "e", "ts", "v", FOUR, group_rows=200).orderBy("e", "ts").collect()
    # Steps depend neither on the number of blocks nor on the rows of the entity.
    assert len(settled) <= 4
    assert len(whole) == len(parted)
    for a, b in zip(whole, parted):
        assert a[:2] == b[:2] and all(same(x, y) for x, y in zip(a[2:], b[2:])), (a, b)
