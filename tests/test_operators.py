import random
from datetime import timedelta

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from respfeat.operators import calls as ca
from respfeat.operators import orders as op
from respfeat.operators.assemble import assemble, blank_unless, merge_on, require
from respfeat.operators.nearest import nearest_match
from respfeat.operators.profile import hour_profiles
from respfeat.operators.ranking import first_per_key, slice_of, with_group_size, with_neighbours
from respfeat.operators.skew import frequent_keys, spread_join
from respfeat.operators.trailing import trailing_counts
from respfeat.plans import outcall, overseas, reachability
from respfeat.sources import sinks

CALLS = "orderid long, dnis_no string, time_in timestamp_ntz, callduration double, calltype string, d string"


def call(phone, hour, duration, orderid=1, calltype="O", day="2024-01-15"):
    return (orderid, phone, at(f"{day} {hour:02d}:30:00"), duration, calltype, day)


def stats(spark, calls):
    df = spark.createDataFrame(calls, CALLS)
    return ca.connect_stats(ca.outbound_calls(df), "dnis_no", "time_in", ca.answered())


def test_connect_stats(spark):
    got = stats(
        spark,
        [call("a", 9, 5.0), call("a", 9, 0.0), call("a", 9, None), call("a", 14, 3.0, calltype="o"),
         call("a", 9, 5.0, orderid=-1), call("a", 9, 5.0, orderid=None), call("a", 9, 5.0, calltype="I")],
    )
    assert rows(got) == [("a", 14, 1, 0, 1.0, 4), ("a", 9, 1, 2, 1 / 3, 4)]


def test_third_code_counts_towards_the_total_only(spark):
    df = spark.createDataFrame([call("a", 9, 0.0, calltype=c) for c in "0122"], CALLS)
    got = ca.connect_stats(df, "dnis_no", "time_in", df.calltype == "0", df.calltype == "1")
    assert rows(got) == [("a", 9, 1, 1, 0.5, 4)]
    none = ca.connect_stats(df, "dnis_no", "time_in", df.calltype == "8", df.calltype == "9")
    assert rows(none) == [("a", 9, 0, 0, None, 4)]


def test_densify(spark):
    s = stats(spark, [call("a", 9, 5.0), call("b", 9, 5.0), call("b", 14, 0.0)])
    assert rows(ca.densify(s, "dnis_no")) == [
        ("a", 14, 0, 0, 0.0, 1), ("a", 9, 1, 0, 1.0, 1), ("b", 14, 0, 1, 0.0, 2), ("b", 9, 1, 0, 1.0, 2),
    ]
    assert ("a", 14, None, None, None, 1) in rows(ca.densify(s, "dnis_no", fill=False))
    assert rows(ca.hour_values(s)) == [(14,), (9,)]
    assert rows(ca.phone_values(s, "dnis_no")) == [("a", 1), ("b", 2)]


def test_workable_hours(spark):
    cases = {
        "up": ([0.7, 0.1, 0.8], [1, 1, 1]),
        "low": ([0.7, 0.1, 0.5], [1, 0, 0]),
        "edge": ([0.1, 0.9], [0, 1]),
        "alone": ([0.6], [1]),
    }
    data = [(k, 9 + 5 * i, r) for k, (rates, _) in cases.items() for i, r in enumerate(rates)]
    df = spark.createDataFrame(data, "p string, time_quantum int, con_rate double")
    got = ca.mark_workable(df, "p").orderBy("p", "time_quantum").collect()
    for k, (_, want) in cases.items():
        assert [r.is_work for r in got if r.p == k] == want


def test_phone_match(spark):
    hotels = spark.createDataFrame(
        [(1, "+86-21 5555#1"), (2, "862155551"), (2, "862155551"), (3, "0000000"), (4, "#"), (5, None)],
        "hotel long, telephone string",
    )
    phones = spark.createDataFrame([("86 2155551",), ("0000000",), ("",)], "dnis_no string")
    assert rows(ca.attach_hotel(phones, "dnis_no", hotels)) == [("86 2155551", 1), ("86 2155551", 2)]


def test_call_plans(spark):
    calls = spark.createDataFrame(
        [call("1-1", 9, 5.0), call("1-1", 9, 0.0, day="2024-01-20"), call("1-1", 9, 7.0, day="2024-02-01")], CALLS
    )
    hotels = spark.createDataFrame([(8, "11")], "hotel long, telephone string")
    got = reachability.call_reachability(calls, hotels, "2024-01-01", "2024-01-31")
    assert rows(got) == [("1-1", 9, 1, 1, 0.5, 2, 0, 8)]
    scores = reachability.call_validation(calls, ("2024-01-01", "2024-01-15"), ("2024-01-16", "2024-01-31"))
    assert rows(scores, "dnis_no", "time_quantum", "con_rate", "isconn") == [("1-1", 9, 1.0, 0)]


SNAP = "roomid long, effectdate string, createtime timestamp_ntz, price int"
EVENT = "roomid long, effectdate string, processtime timestamp_ntz, orderid long"


def match(spark, snaps, events, **how):
    return nearest_match(
        spark.createDataFrame(snaps, SNAP), spark.createDataFrame(events, EVENT), ["roomid", "effectdate"],
        "createtime", "processtime", "orderid", **how,
    )


def test_nearest_by_hand(spark):
    noon = at("01-15 12:00:00")
    cases = [
        (["01-15 11:00:00", "01-15 12:00:01"], "01-15 11:00:00", 3600),
        (["01-15 12:00:00"], "01-15 12:00:00", 0),
        (["01-15 12:30:00"], "01-15 12:30:00", 1_001_800),
        (["01-03 12:00:00", "01-15 12:00:01"], "01-15 12:00:01", 1_000_001),
        (["01-15 12:00:00.500"], "01-15 12:00:00.500", 1_000_000),
    ]
    snaps = [(i, "20240115", at(t), 1) for i, (times, _, _) in enumerate(cases) for t in times]
    events = [(i, "20240115", noon, 7) for i in range(len(cases))]
    got = {r.roomid: (r.createtime, r.dur_time) for r in match(spark, snaps, events).collect()}
    assert got == {i: (at(t), s) for i, (_, t, s) in enumerate(cases)}


def test_one_row_per_room_and_date_or_per_order(spark):
    noon = at("01-15 12:00:00")
    snaps = [(1, "20240115", noon, 1)]
    events = [(1, "20240115", noon + timedelta(seconds=s), o) for s, o in ((5, 1), (3, 9), (3, 8))]
    assert rows(match(spark, snaps, events), "orderid", "dur_time") == [(8, 3)]
    assert rows(match(spark, snaps, events, per=["orderid"]), "orderid", "dur_time") == [(1, 5), (8, 3), (9, 3)]


def test_nearest_equals_all_pairs(spark):
    rnd = random.Random(6)
    base = at("01-15 00:00:00")

    def moment():
        return base + timedelta(seconds=rnd.randrange(40), microseconds=rnd.choice([0, 300_000, 700_000]))

    snaps = [(rnd.randrange(12), "20240115", moment(), i) for i in range(90)]
    events = [(rnd.randrange(12), "20240115", moment(), i) for i in range(60)]

    def score(c, p):
        gap = int((p.replace(microsecond=0) - c.replace(microsecond=0)).total_seconds())
        return gap if c <= p else -gap + 20

    best = {}
    for room, _, c, price in snaps:
        for r, _, p, o in events:
            if r == room:
                pair = (score(c, p), c, price, o)
                best[room] = min(best.get(room, pair), pair)
    got = match(spark, snaps, events, penalty=20)
    assert rows(got, "roomid", "dur_time", "createtime", "price", "orderid") == sorted(
        ((k, *v) for k, v in best.items()), key=repr
    )


def test_first_per_key_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 2, "a"), (2, 5, "c"), (2, 3, "d")], "k int, t int, x string")
    first = first_per_key(df, "k", ["t", "x"])
    assert rows(first) == [(1, 2, "a"), (2, 3, "d")]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    assert rows(with_group_size(df, ["k"]), "x", "nums") == [("a", 2), ("b", 2), ("c", 2), ("d", 2)]


# -- order pipelines -------------------------------------------------------------

DAY = "2024-01-31"


def order_tables(spark, n=60):
    """Orders of two hotels, ten hours apart, dispatched 10 and confirmed 40 minutes later."""
    start = at("01-02 08:00:00")
    orders, log, times = [], [], []
    for i in range(n):
        t = start + timedelta(hours=10 * i)
        # Order 3 is confirmed after arrival, order 5 before its dispatch.
        arrival = t + timedelta(minutes=20) if i == 3 else t + timedelta(days=2)
        confirmed = t + timedelta(minutes=5 if i == 5 else 40)
        orders.append((i, 1 + i % 2, 1 + i % 3, 100 + i % 2, confirmed, t, arrival, 10.0 * i, "ip"))
        log += [
            (i, t + timedelta(minutes=10), t, "x outcall分配", "2024-01-02"),
            (i, t + timedelta(minutes=12), t, "outcall分配", "2024-01-02"),
            (i, t, t, "other", "2024-01-02"),
        ]
        times += [(i, t + timedelta(minutes=m), k, DAY) for m, k in ((30, " p "), (25, "P"), (1, "X"))]
    return {
        "orders": spark.createDataFrame(
            orders,
            "orderid long, hotel long, cityid long, room long, confirmdate2 timestamp_ntz, orderdate timestamp_ntz, "
            "arrival timestamp_ntz, ord_amount double, ipid string",
        ),
        "log": spark.createDataFrame(
            log,
            "orderid long, operatetime timestamp_ntz, datachange_lasttime timestamp_ntz, reason string, d string",
        ),
        "hotels": spark.createDataFrame(
            [(h, h * 10, 4, 3, 5, d) for h in (1, 2) for d in (DAY, "2024-01-30")],
            "hotel long, actualmasterhotelid long, masterstar int, star int, goldstar int, d string",
        ),
        "suppliers": spark.createDataFrame([(1, 77, DAY)], "hotelid long, supplierid long, d string"),
        "cities": spark.createDataFrame(
            [(1, "x", 1, "home"), (2, "y", 2, "away"), (3, "z", 3, "far")],
            "cityid long, cityname string, country int, countryname string",
        ),
        "times": spark.createDataFrame(
            times, "orderid long, operatetime timestamp_ntz, operatetype string, d string"
        ),
    }


COLUMNS = ["orderid", "hotel", "confirmdate", "orderdate", "arrival", "ord_amount", "istodayord", *op.HOTEL_ATTRIBUTES]


def test_outcall_base_and_versions(spark):
    t = order_tables(spark)
    args = (t["log"], t["orders"], t["hotels"], t["suppliers"], "2024-01-01", DAY)
    base = outcall.outcall_base(*args, version=3, confirm_columns=COLUMNS)
    got = {r.orderid: r for r in base.collect()}
    assert set(got) == set(range(60)) - {3, 5}
    assert got[0].duration == 30.0 and got[0].process2ord_time == 10.0 and got[0].process_hour == 8
    assert got[0].process_week == 2 and got[0].supplierid == 77 and got[1].supplierid is None
    assert got[0].arr2process_time == 2 * 1440 - 10 and "ipid" not in base.columns
    two = outcall.outcall_base(*args, version=2, confirm_columns=COLUMNS).where("orderid = 0").first()
    assert two.process2ord_time == 10 / 60 and "process_week" not in two.__fields__
    # The day rule drops an order confirmed on its arrival day.
    one = outcall.outcall_base(*args, version=1, confirm_columns=COLUMNS)
    assert {r.orderid for r in one.collect()} == set(range(60)) - {3, 5}

    base.cache()
    all_rows = {r.orderid for r in base.collect()}
    v2 = outcall.outcall_features(outcall.outcall_base(*args, version=2, confirm_columns=COLUMNS), 2)
    v3 = outcall.outcall_features(base, 3)
    v1 = outcall.outcall_features(one, 1)
    left, inner = ({r.orderid for r in df.collect()} for df in (v2, v3))
    assert left == all_rows and inner < left
    assert {r.orderid for r in v1.collect()} <= all_rows
    assert len(v1.columns) == len(one.columns) + 30
    assert len(v2.columns) == len(COLUMNS) + 1 + 6 + 40
    assert len(v3.columns) == len(base.columns) + 64
    for r in v3.collect():
        short = [r[f"duration_htl_{b}_{n}_numsord"] for b in ("process", "ord") for n in outcall.SHORT]
        assert all(x is None for x in short) or all(x is not None for x in short)
        assert r["duration_htl_ord_hour_30_numsord"] <= r["duration_htl_ord_month_30_numsord"]
        if short[0] is not None:
            assert r["duration_htl_ord_week_7_numsord"] <= r["duration_htl_ord_month_30_numsord"]
    written = outcall.outcall_table(*args, version=3, confirm_columns=COLUMNS)
    assert rows(written, "orderid") == rows(v3, "orderid")


def test_overseas_base_and_features(spark):
    t = order_tables(spark)
    columns = [c for c in op.OVERSEAS_COLUMNS if c in {
        "orderid", "hotel", "cityid", "country", "confirmdate", "orderdate", "ord_hour", "arrival", "arr_week",
        "arr2ord_time", "duration1", "star"}]
    args = (t["orders"], t["cities"], t["hotels"], t["times"], t["suppliers"], "2024-01-01", DAY)
    base = overseas.overseas_base(*args, columns=columns)
    got = {r.orderid: r for r in base.collect()}
    assert set(got) == {i for i in range(60) if i % 3 != 0}
    assert got[1].duration1 == 40.0 and got[1].duration2 == 25.0 and got[2].supplierid == 77
    hotel = overseas.overseas_features(base, with_supplier=False)
    both = overseas.overseas_table(*args, columns=columns)
    assert len(hotel.columns) == len(base.columns) + 32
    assert len(both.columns) == len(base.columns) + 28 + 14
    assert rows(hotel, "orderid") == rows(both, "orderid")
    for r in both.collect():
        if r.supplierid is None:
            assert r["duration_supp_ord_month_30_pre"] is None
        else:
            assert r["duration_supp_ord_month_30_numsord"] >= r["duration_htl_ord_month_30_numsord"]


def test_room_features(spark):
    t = order_tables(spark, 4)
    rooms = spark.createDataFrame(
        [(100, "20240104", at("01-02 08:05:00"), "a", "2024-01-02"), (100, "20240104", at("01-02 08:11:00"), "b", "2024-01-02"),
         (101, "20240109", at("01-02 08:11:00"), "c", "2024-01-02"), (100, "bad", at("01-02 08:11:00"), "d", "2024-01-02")],
        "roomid long, effectdate string, createtime timestamp_ntz, status string, d string",
    )
    dispatch = op.dispatch_time(t["log"])
    got = outcall.room_features(rooms, t["orders"], dispatch, "2024-01-01", "2024-01-01")
    assert rows(got, "roomid", "status", "orderid", "dur_time") == [(100, "a", 0, 300)]


def test_label_counts_and_lookup_of_busy_orders(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (5.0,), (None,)], "duration double")
    assert rows(op.label_counts(df)) == [(4, 2, 1)]


def test_dispatch_ties_and_clean_bounds(spark):
    rows_in = [(at("01-15"), at("01-15"), 1.0), (at("01-16"), at("01-15"), 4500.0), (at("01-16"), at("01-15"), 0.0)]
    df = spark.createDataFrame(rows_in, "arrival timestamp_ntz, confirmdate timestamp_ntz, duration double")
    assert rows(op.clean_outcall_labels(df, 3), "duration") == [(0.0,), (1.0,)]
    assert rows(op.clean_outcall_labels(df, 1), "duration") == [(0.0,), (4500.0,)]


# -- assembly ----------------------------------------------------------------------


def test_assembly_keeps_the_right_rows(spark):
    base = spark.createDataFrame([(i,) for i in range(4)], "k int")
    short = spark.createDataFrame([(0, 1.0), (2, 2.0)], "k int, s_pre double")
    long = spark.createDataFrame([(0, 3.0), (1, 4.0)], "k int, l_pre double")
    hows = {("inner", "inner"): 1, ("left", "inner"): 2, ("left", "left"): 4}
    for (a, b), n in hows.items():
        assert assemble(base, [(short, ["k"], a), (long, ["k"], b)]).count() == n
    wide = assemble(base, [(short, ["k"], "left"), (long, ["k"], "left")])
    assert rows(require(wide, ["l"]), "k") == [(0,), (1,)]
    assert rows(blank_unless(wide, ["s", "l"]), "k", "s_pre", "l_pre") == [
        (0, 1.0, 3.0), (1, None, None), (2, None, None), (3, None, None),
    ]
    assert merge_on(wide.drop("l_pre"), wide.drop("s_pre"), "k").columns == ["k", "s_pre", "l_pre"]


def test_csv_gives_back_what_it_wrote(spark, tmp_path):
    texts = [None, "", "a\nb", 'say "x", y', "back\\slash", " padded ", "\r\n", '"', "é;\t"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert rows(sinks.csv_export(df, str(tmp_path / "csv"))) == rows(df)


def test_group_size_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k int, v string")
    assert rows(with_group_size(df, ["k"]), "v", "nums") == [("a", 2), ("b", 2), ("c", 2), ("d", 2), ("e", 1)]


# -- staged refresh ----------------------------------------------------------------


def failing(spark):
    return spark.range(100, numPartitions=4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("dies"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_failed_refresh_leaves_the_old_table(spark, tmp_path):
    for refresh in (sinks.full_refresh, sinks.csv_export):
        path = f"{tmp_path}/{refresh.__name__}/t"
        refresh(spark.range(5), path)
        with pytest.raises(Exception, match="dies"):
            refresh(failing(spark), path)
        old = spark.read.parquet(path) if refresh is sinks.full_refresh else spark.read.option("header", True).csv(path)
        assert old.count() == 5
        assert [p.name for p in (tmp_path / refresh.__name__).iterdir()] == ["t"]
        assert refresh(spark.range(7), path).count() == 7


def test_failed_refresh_leaves_the_old_version_of_a_catalog_table(spark, tmp_path):
    folder = f"{tmp_path}/versions"
    assert sinks.refresh_table(spark.range(5), "staged_t", folder).count() == 5
    with pytest.raises(Exception, match="dies"):
        sinks.refresh_table(failing(spark), "staged_t", folder)
    assert spark.table("staged_t").count() == 5
    assert sinks.refresh_table(spark.range(3), "staged_t", folder).count() == 3
    wider = spark.range(4).withColumn("x", F.lit("a"))
    assert sinks.refresh_table(wider, "staged_t", folder).columns == ["id", "x"]
    assert len([p for p in (tmp_path / "versions").iterdir()]) == 1
    spark.sql("drop table staged_t")


def test_measures_are_taken_while_writing(spark, tmp_path):
    df, got = sinks.measured_refresh(spark.range(10), f"{tmp_path}/m", {"n": F.count(F.lit(1)), "top": F.max("id")}, partition_by=[])
    assert got == {"n": 10, "top": 9} and df.count() == 10


# -- neighbours, counts and profiles of busy entities ---------------------------------


def test_neighbours_across_slices(spark):
    rng = random.Random(3)
    data = [(None if k % 50 == 0 else "hot" if k % 10 else f"e{k % 7}", None if k % 97 == 0 else rng.randrange(10**6) * 10 + k % 10, k) for k in range(3000)]
    data = list({(e, o): (e, o, k) for e, o, k in data}.values())
    df = spark.createDataFrame(data, "e string, o long, v long")
    got = {(r.e, r.o): (r.up, r.down) for r in with_neighbours(df, "e", "o", {"v": ("up", "down")}).collect()}
    want = {}
    for e in {d[0] for d in data}:
        line = sorted((d for d in data if d[0] == e), key=lambda d: (d[1] is not None, d[1] or 0))
        for i, d in enumerate(line):
            want[e, d[1]] = (line[i + 1][2] if i + 1 < len(line) else None, line[i - 1][2] if i else None)
    assert got == want


def test_neighbours_of_a_hot_entity_are_spread(spark):
    """No slice of an entity with 90 % of the rows has more than twice the mean."""
    df = spark.range(40_000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("e"), "id")
    sizes = [r["count"] for r in df.where("e = 'hot'").groupBy(slice_of(df, "id")).count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_counts_and_profiles_read_their_base_once(spark, tmp_path):
    path = f"{tmp_path}/base"
    at = (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id") % 1000)).cast("timestamp_ntz")
    spark.range(5000).select((F.col("id") % 3).alias("e"), at.alias("ts"), F.col("id").cast("double").alias("v")).write.parquet(path)
    base = spark.read.parquet(path)
    for df in (trailing_counts(base, "e", "ts", 7), hour_profiles(base, "e", "ts", "ts", "v", {7: "a", 30: "b"}, "h")):
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan") == 1 and "ReusedExchange" in final


# -- hot keys -------------------------------------------------------------------------


def test_nearest_in_one_room_over_many_days(spark):
    """All rows under one key, days without snapshots or events between; against a sorted search."""
    rng = random.Random(8)
    start = at("01-01 00:00:00")
    times = sorted({rng.randrange(40) * 7 * 86_400 // 5 + rng.randrange(3000) for _ in range(400)})
    snaps = [(1, "x", start + timedelta(seconds=t), i) for i, t in enumerate(times)]
    asked = [rng.randrange(60 * 86_400) for _ in range(300)]
    events = [(1, "x", start + timedelta(seconds=t), i) for i, t in enumerate(asked)]
    got = {r.orderid: (r.createtime, r.dur_time) for r in match(spark, snaps, events, per=["orderid"]).collect()}
    for i, t in enumerate(asked):
        best = min(((t - c if c <= t else c - t + 1_000_000), c) for c in times)
        assert got[i] == (start + timedelta(seconds=best[1]), best[0])


def crowded(spark, n=20_000):
    """Four in ten rows under key 7, one in ten without a key."""
    key = F.when(F.col("id") % 10 < 4, 7).when(F.col("id") % 10 > 4, F.col("id") % 3000)
    return spark.range(n).select("id", key.cast("bigint").alias("k"))


def test_spread_join_equals_a_plain_join(spark):
    left = crowded(spark, 5000)
    right = spark.createDataFrame([(k, f"{k}/{j}") for k in [*range(0, 3000, 2), 7, None] for j in range(1 + (k == 7))], "k2 int, v string")
    for how in ("inner", "left"):
        got = spread_join(left, right, [("k", "k2")], how)
        assert got.columns == ["id", "k", "v"]
        assert rows(got) == rows(left.join(right, left.k == right.k2, how).drop("k2"))
    empty = spread_join(left.limit(0), right, [("k", "k2")], "left")
    assert empty.count() == 0 and spread_join(left, right.limit(0), [("k", "k2")]).count() == 0
    assert spread_join(left, right.limit(0), [("k", "k2")], "left").where("v is null").count() == 5000


def test_frequent_keys_are_found_and_spread(spark):
    left = crowded(spark)
    found = frequent_keys(left, ["k"])
    assert sorted(r._lots for r in found.collect()) == [26, 103]
    names = {r.h: r.k for r in left.select(F.xxhash64("k").alias("h"), "k").distinct().collect()}
    assert {names[r._key] for r in found.collect()} == {7, None}


def test_no_task_of_a_spread_join_has_twice_the_mean(spark):
    """Forty per cent of the rows under one key, without adaptive plans or broadcasts."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {c: spark.conf.get(c) for c in conf}
    right = spark.range(3000).select(F.col("id").alias("k2"), F.lit("x").alias("v"))
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        for how in ("inner", "left"):
            joined = spread_join(crowded(spark), right, [("k", "k2")], how)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / 8
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_left_blocks_spread_rows_without_a_key(spark):
    base = crowded(spark, 1000)
    block = spark.createDataFrame([(7, 1.0), (5, 2.0)], "k long, b_pre double")
    got = assemble(base, [(block, ["k"], "left")])
    assert got.count() == 1000 and got.where("k is null and b_pre is null").count() == 100
    assert got.where("b_pre = 1").count() == base.where("k = 7").count()
