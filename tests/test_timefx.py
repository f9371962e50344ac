from conftest import at

from respfeat.functions import cleaning as cl
from respfeat.functions import timefx as tx
from respfeat.functions.columns import drop_matching
from respfeat.sources import sinks, tables


def one(spark, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {t}" for k, t in zip(cols, _types(cols))))
    return df


def _types(cols):
    return ["timestamp_ntz" if hasattr(v, "hour") else "string" for v in cols.values()]


def value(df, col):
    return df.select(col).first()[0]


def test_weekday_counts_from_sunday(spark):
    for day, want in (("2018-03-25", 0), ("2018-03-26", 1), ("1920-01-01", 4), ("2018-03-24", 6)):
        assert value(one(spark, t=at(day)), tx.weekday("t")) == want


def test_differences_drop_fractions_first(spark):
    df = one(spark, a=at("01-15 10:00:01.100"), b=at("01-15 09:58:00.900"))
    assert value(df, tx.minutes_between("a", "b")) == 121 / 60
    assert value(df, tx.hours_between("a", "b")) == 121 / 3600


def test_epoch_numbers_round_down_before_1970(spark):
    df = one(spark, t=at("1969-12-31 23:59:59.500"))
    assert value(df, tx.epoch_seconds("t")) == -1
    assert value(df, tx.epoch_hours("t")) == -1
    assert value(df, tx.epoch_days("t")) == -1


def test_epoch_numbers_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = one(spark, t=at("2024-03-31 02:30:00"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert value(df, tx.epoch_seconds("t")) == 1711852200
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_floors_and_windows(spark):
    df = one(spark, t=at("01-15 10:30:20.700"))
    assert value(df, tx.second_floor("t")) == at("01-15 10:30:20")
    assert value(df, tx.hour_floor("t")) == at("01-15 10:00:00")
    assert value(df, tx.minus_hours("t", 168)) == at("01-08 10:30:20")
    assert str(value(df, tx.minus_days("t", 7))) == "2024-01-08"


def test_text_that_is_no_time_becomes_null(spark):
    df = one(spark, a="2018-03-21 15:11:14.10", b="soon", c="20240115", d="2024")
    assert value(df, tx.wall_clock("a")) == at("2018-03-21 15:11:14.100")
    assert value(df, tx.wall_clock("b")) is None
    assert str(value(df, tx.compact_date("c"))) == "2024-01-15"
    assert value(df, tx.compact_date("d")) is None


def test_gap_score(spark):
    noon = at("01-15 12:00:00")
    for snap, want in (("11:00:00", 3600), ("12:00:00", 0), ("12:00:01", 1_000_001), ("12:30:00", 1_001_800)):
        assert value(one(spark, s=at(f"01-15 {snap}"), p=noon), tx.gap_score("s", "p")) == want


def test_predicates_and_flags(spark):
    df = spark.createDataFrame(
        [("o", 1, "0000000"), ("O", -1, "12"), (" p ", None, None), ("x", 5, "#")], "code string, id int, tel string"
    )
    assert df.where(cl.code_is("code", "O")).count() == 2
    assert df.where(cl.trimmed_code_is("code", "P")).count() == 1
    assert df.where(cl.is_not("id", -1)).count() == 2
    assert df.where(cl.is_none_of("tel", cl.PLACEHOLDER_PHONES)).count() == 1
    assert [r[0] for r in df.select(cl.flag(df.id > 0)).collect()] == [1, 0, 0, 1]
    reasons = spark.createDataFrame([("x outcall分配 y",), ("other",), (None,)], "reason string")
    assert reasons.where(cl.mentions("reason", cl.DISPATCH_REASON)).count() == 1


def test_phone_marks(spark):
    assert value(one(spark, t="+86-21 5555#1"), cl.strip_marks("t")) == "862155551"


def test_label_ranges(spark):
    df = spark.createDataFrame([(float(x),) for x in (-1, 0, 4499.99, 4500, 9999.99, 10000)], "d double")
    assert df.where(cl.in_label_range("d", 0, 4500)).count() == 2
    assert df.where(cl.in_label_range("d", 0, 10000)).count() == 4
    assert df.where(cl.in_label_range("d", 3)).count() == 4


def test_drop_matching_needs_the_whole_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "ipid int, ipid2 int, x int")
    assert drop_matching(df, r"(ipid|businessgroup)").columns == ["ipid2", "x"]


def test_partition_days_are_pruned_and_instants_pushed_down(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, at("01-15 10:00:00"), "2024-01-15"), (2, at("01-16 11:00:00.123456"), "2024-01-16")],
        "id int, ts timestamp_ntz, d string",
    )
    back = sinks.full_refresh(df, str(tmp_path / "t"), ["d"])
    back = tables.read_table(spark, str(tmp_path / "t"))
    plan = tables.snapshot(back, "2024-01-16")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    plan = tables.since(back, "ts", "2024-01-16")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2024-01-16T00:00" in plan
    assert [r.id for r in tables.day_range(back, "2024-01-15", "2024-01-15").collect()] == [1]
    out = sinks.csv_slice(df, str(tmp_path / "csv"), "ts", "2024-01-16", "2024-01-17")
    assert [tuple(r) for r in out.collect()] == [(2, at("01-16 11:00:00.123456"), "2024-01-16")]


def test_roles_type_their_columns(spark, tmp_path):
    raw = spark.createDataFrame(
        [("7", "2018-03-21 15:11:14.10", "x"), ("?", "later", "y")], "orderid string, operatetime string, extra string"
    )
    raw.write.parquet(str(tmp_path / "log"))
    got = tables.read_table(spark, str(tmp_path / "log"), "process_log").orderBy("extra").collect()
    assert [tuple(r) for r in got] == [(7, at("2018-03-21 15:11:14.100"), "x"), (None, None, "y")]
