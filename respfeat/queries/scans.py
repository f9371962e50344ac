"""Scans, sinks, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from respfeat.functions import cleaning as cl
from respfeat.functions import columns as co
from respfeat.functions import timefx as tx
from respfeat.operators import orders as op
from respfeat.operators.ranking import first_per_key, sorted_by, top
from respfeat.queries import roles
from respfeat.queries.registry import query
from respfeat.queries.roles import rounded, table, with_roles
from respfeat.session import scratch_path
from respfeat.sources import sinks, tables

# -- scans ---------------------------------------------------------------------


@query("scan_snapshot_day", with_roles("hotels") + "select * from hotels where d = '2024-01-30'")
def scan_snapshot_day(spark, sf_dir):
    return tables.snapshot(roles.hotels(spark, sf_dir), roles.RUN_DATE)


@query("scan_day_range", with_roles("call_log") + "select * from call_log where '2024-01-05' <= d and d <= '2024-01-11'")
def scan_day_range(spark, sf_dir):
    return tables.day_range(roles.call_log(spark, sf_dir), "2024-01-05", "2024-01-11")


@query("scan_day_from", with_roles("call_log") + "select * from call_log where d >= '2024-01-20'")
def scan_day_from(spark, sf_dir):
    return tables.day_range(roles.call_log(spark, sf_dir), "2024-01-20")


@query("scan_ts_from", "select * from orders where o_orderdate >= timestamp '1998-06-01 00:00:00'")
def scan_ts_from(spark, sf_dir):
    return tables.since(table(spark, sf_dir, "orders"), "o_orderdate", "1998-06-01")


@query(
    "scan_param_run_date",
    with_roles("supplier_hotels") + "select hotelid, supplierid, '2024-01-29' as run_date from supplier_hotels where d = '2024-01-29'",
)
def scan_param_run_date(spark, sf_dir, run_date="2024-01-29"):
    day = tables.snapshot(roles.supplier_hotels(spark, sf_dir), run_date)
    return day.select("hotelid", "supplierid", F.lit(run_date).alias("run_date"))


@query("scan_dim_filtered", "select * from nation where n_regionkey <> 1")
def scan_dim_filtered(spark, sf_dir):
    return tables.excluding_code(table(spark, sf_dir, "nation"), "n_regionkey", 1)


@query("scan_point_lookup", "select * from lineitem where l_orderkey = 4711")
def scan_point_lookup(spark, sf_dir):
    return tables.lookup(table(spark, sf_dir, "lineitem"), "l_orderkey", 4711)


# -- sinks ---------------------------------------------------------------------


@query("sink_full_refresh", "select event_id, ts, user_id, value from events")
def sink_full_refresh(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return sinks.full_refresh(df, scratch_path(spark, "events"))


@query("sink_refresh_table", "select event_id, user_id, value from events where value > 10")
def sink_refresh_table(spark, sf_dir):
    """A catalog table that is refreshed once: its second version is read."""
    folder = scratch_path(spark, "versions")
    name = "events_" + folder.rsplit("-", 1)[1]
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    sinks.refresh_table(events.where("value <= 10"), name, folder)
    return sinks.refresh_table(events.where("value > 10"), name, folder)


@query("sink_csv_export", "select event_id, ts, event_type, value from events")
def sink_csv_export(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return sinks.csv_export(df, scratch_path(spark, "events-csv"))


@query(
    "sink_csv_slice",
    """select event_id, ts, event_type, value from events
       where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20'""",
)
def sink_csv_slice(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return sinks.csv_slice(df, scratch_path(spark, "slice-csv"), "ts", "2024-01-10", "2024-01-20")


_TEXTS = """case event_id % 7 when 0 then null when 1 then '' when 2 then concat('two', chr(10), 'lines') when 3 then 'a "b", c'
       when 4 then concat('back', chr(92), 'slash') when 5 then ' padded ' else event_type end"""


@query("sink_csv_text", f"select event_id, {_TEXTS} as note, ts from events")
def sink_csv_text(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", F.expr(_TEXTS).alias("note"), "ts")
    return sinks.csv_export(df, scratch_path(spark, "text-csv"))


# -- projections -----------------------------------------------------------------


@query("proj_rename", "select l_orderkey as orderid, l_shipdate as processtime from lineitem")
def proj_rename(spark, sf_dir):
    return co.keep_renamed(
        table(spark, sf_dir, "lineitem"), {"l_orderkey": "orderid", "l_shipdate": "processtime"}
    )


@query("proj_star_plus", "select *, cast(hour(ts) as integer) as ord_hour, value / 60 as value_hours from events")
def proj_star_plus(spark, sf_dir):
    return co.with_derived(
        table(spark, sf_dir, "events"), {"ord_hour": tx.hour_of_day("ts"), "value_hours": F.col("value") / 60}
    )


@query("proj_exclude_regex", "select * exclude (c_acctbal, c_mktsegment) from customer")
def proj_exclude_regex(spark, sf_dir):
    return co.drop_matching(table(spark, sf_dir, "customer"), r"(c_acctbal|c_mktsegment|c_comment)")


@query("proj_constant", "select distinct user_id, 0 as same from events")
def proj_constant(spark, sf_dir):
    return co.with_constant(co.distinct_of(table(spark, sf_dir, "events"), "user_id"), "same", 0)


@query(
    "proj_unicode_alias",
    """select ts as "呼出时间", value as "通话时长", user_id as "被叫号码" from events""",
)
def proj_unicode_alias(spark, sf_dir):
    return co.keep_renamed(table(spark, sf_dir, "events"), {"ts": "呼出时间", "value": "通话时长", "user_id": "被叫号码"})


@query("proj_distinct", "select distinct c_nationkey, c_mktsegment from customer")
def proj_distinct(spark, sf_dir):
    return co.distinct_of(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")


# -- filters -----------------------------------------------------------------------


@query("filt_upper_eq", with_roles("call_log") + "select * from call_log where upper(calltype) = 'O'")
def filt_upper_eq(spark, sf_dir):
    return roles.call_log(spark, sf_dir).where(cl.code_is("calltype", "O"))


@query("filt_upper_trim_eq", with_roles("operate_times") + "select * from operate_times where upper(trim(operatetype)) = 'P'")
def filt_upper_trim_eq(spark, sf_dir):
    return roles.operate_times(spark, sf_dir).where(cl.trimmed_code_is("operatetype", "P"))


@query("filt_like_contains", with_roles("process_log") + "select * from process_log where upper(reason) like '%OUTCALL分配%'")
def filt_like_contains(spark, sf_dir):
    return roles.process_log(spark, sf_dir).where(cl.mentions("reason", cl.DISPATCH_REASON))


@query("filt_sentinel_id", with_roles("call_log") + "select * from call_log where orderid <> -1")
def filt_sentinel_id(spark, sf_dir):
    return roles.call_log(spark, sf_dir).where(cl.is_not("orderid", cl.NO_ORDER))


@query(
    "filt_sentinel_list",
    with_roles("hotel_phones")
    + """select * from hotel_phones
         where telephone <> '0000000' and telephone <> '00000000' and telephone <> '000000000'
           and telephone <> '0000000000' and telephone <> '#'""",
)
def filt_sentinel_list(spark, sf_dir):
    return roles.hotel_phones(spark, sf_dir).where(cl.is_none_of("telephone", cl.PLACEHOLDER_PHONES))


@query(
    "filt_ts_order",
    """select l_orderkey, l_linenumber, l_partkey, o_orderdate, l_shipdate
       from lineitem join orders on l_orderkey = o_orderkey where l_shipdate >= o_orderdate""",
)
def filt_ts_order(spark, sf_dir):
    return _shipped(spark, sf_dir).where(cl.not_before("l_shipdate", "o_orderdate"))


@query(
    "filt_date_order",
    with_roles("ord") + "select orderid, arrival, confirmdate2 from ord where cast(arrival as date) > cast(confirmdate2 as date)",
)
def filt_date_order(spark, sf_dir):
    late = cl.on_later_day("arrival", "confirmdate2")
    return roles.orders(spark, sf_dir).where(late).select("orderid", "arrival", "confirmdate2")


@query("filt_label_range", "select event_id, value from events where value >= 0 and value < 45")
def filt_label_range(spark, sf_dir):
    return table(spark, sf_dir, "events").where(cl.in_label_range("value", 0, 45)).select("event_id", "value")


@query(
    "filt_two_label_range",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from lineitem
       where l_quantity >= 3 and (l_extendedprice >= 0 and l_extendedprice < 50000)""",
)
def filt_two_label_range(spark, sf_dir):
    both = cl.in_label_range("l_quantity", 3) & cl.in_label_range("l_extendedprice", 0, 50000)
    return table(spark, sf_dir, "lineitem").where(both).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )


@query("filt_having", "select l_orderkey, count(*) as nums from lineitem group by l_orderkey having count(*) > 5")
def filt_having(spark, sf_dir):
    return cl.busy_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", 5)


def _shipped(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return op.join_dim(li, o, "l_orderkey", "o_orderkey")


# -- ranks, sorts, limits ------------------------------------------------------------


@query(
    "win_first_per_key",
    """select l_orderkey, l_shipdate, l_linenumber, l_partkey from (
         select *, row_number() over (partition by l_orderkey order by l_shipdate, l_linenumber, l_partkey) as rk
         from lineitem) where rk = 1""",
)
def win_first_per_key(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey")
    return first_per_key(li, "l_orderkey", ["l_shipdate", "l_linenumber", "l_partkey"])


@query("sort_two_keys", "select user_id, ts, value from events order by user_id, ts")
def sort_two_keys(spark, sf_dir):
    return sorted_by(table(spark, sf_dir, "events").select("user_id", "ts", "value"), "user_id", "ts")


@query("sort_limit", "select user_id, ts, value from events order by user_id, ts limit 100")
def sort_limit(spark, sf_dir):
    return top(table(spark, sf_dir, "events").select("user_id", "ts", "value"), 100, "user_id", "ts")


# -- scalar functions ------------------------------------------------------------------


@query("fn_hour", "select event_id, cast(hour(ts) as integer) as ord_hour from events")
def fn_hour(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.hour_of_day("ts").alias("ord_hour"))


@query(
    "fn_same_day_flag",
    with_roles("ord")
    + """select orderid, case when date_diff('day', cast(orderdate as date), cast(arrival as date)) = 0
                              then 1 else 0 end as istodayord from ord""",
)
def fn_same_day_flag(spark, sf_dir):
    return roles.orders(spark, sf_dir).select("orderid", tx.same_day_flag("arrival", "orderdate").alias("istodayord"))


@query("fn_weekday", "select event_id, cast(dayofweek(ts) as integer) as ord_week from events")
def fn_weekday(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.weekday("ts").alias("ord_week"))


_SECONDS = "date_diff('second', date_trunc('second', {b}), date_trunc('second', {a}))"


@query(
    "fn_minutes_between",
    with_roles("ord") + f"select orderid, {_SECONDS.format(a='arrival', b='orderdate')} / 60 as arr2ord_time from ord",
)
def fn_minutes_between(spark, sf_dir):
    return roles.orders(spark, sf_dir).select("orderid", tx.minutes_between("arrival", "orderdate").alias("arr2ord_time"))


@query(
    "fn_hours_between",
    with_roles("ord") + f"select orderid, {_SECONDS.format(a='confirmdate2', b='orderdate')} / 3600 as confirm2ord_time from ord",
)
def fn_hours_between(spark, sf_dir):
    return roles.orders(spark, sf_dir).select(
        "orderid", tx.hours_between("confirmdate2", "orderdate").alias("confirm2ord_time")
    )


@query("fn_second_floor", "select event_id, date_trunc('second', ts) as orderdate_format from events")
def fn_second_floor(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.second_floor("ts").alias("orderdate_format"))


@query("fn_hour_floor", "select event_id, date_trunc('hour', ts) as hour_start from events")
def fn_hour_floor(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.hour_floor("ts").alias("hour_start"))


@query("fn_minus_hours", "select event_id, date_trunc('second', ts) - interval 168 hour as window_start from events")
def fn_minus_hours(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.minus_hours("ts", 168).alias("window_start"))


@query("fn_date_sub", "select event_id, cast(ts as date) - 30 as window_day from events")
def fn_date_sub(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.minus_days("ts", 30).alias("window_day"))


@query("fn_to_date", "select event_id, cast(ts as date) as day from events")
def fn_to_date(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))


@query(
    "fn_parse_compact_date",
    with_roles("room_status") + "select snapshot_id, cast(strptime(effectdate, '%Y%m%d') as date) as day from room_status",
)
def fn_parse_compact_date(spark, sf_dir):
    return roles.room_status(spark, sf_dir).select("snapshot_id", tx.compact_date("effectdate").alias("day"))


@query(
    "fn_phone_normalise",
    """select c_custkey as id, regexp_replace(c_name, '-|\\+|\\s|#', '', 'g') as number from customer
       union all select o_orderkey, regexp_replace(o_orderpriority, '-|\\+|\\s|#', '', 'g') from orders
       union all select p_partkey, regexp_replace(p_name, '-|\\+|\\s|#', '', 'g') from part""",
)
def fn_phone_normalise(spark, sf_dir):
    names = (("customer", "c_custkey", "c_name"), ("orders", "o_orderkey", "o_orderpriority"), ("part", "p_partkey", "p_name"))
    parts = [table(spark, sf_dir, t).select(F.col(k).alias("id"), cl.strip_marks(c).alias("number")) for t, k, c in names]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("fn_case_flag", "select event_id, case when value > 50 then 'yes' else 'no' end as isconn from events")
def fn_case_flag(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", cl.yes_no(F.col("value") > 50).alias("isconn"))


@query(
    "fn_null_to_zero",
    with_roles("history") + "select orderid, case when supplierid is null then 0 else supplierid end as supplierid from history",
)
def fn_null_to_zero(spark, sf_dir):
    return roles.history(spark, sf_dir).select("orderid", cl.zero_if_null("supplierid").alias("supplierid"))


@query(
    "fn_exp_log_power",
    "select event_id, " + roles.r("case when value > 0 then exp(ln(power(value, 1.0 / 3))) end") + " as root from events",
)
def fn_exp_log_power(spark, sf_dir):
    v = F.col("value")
    root = F.when(v > 0, F.exp(F.ln(F.pow(v, F.lit(1.0 / 3)))))
    return rounded(table(spark, sf_dir, "events").select("event_id", root.alias("root")))


@query(
    "fn_gap_penalty",
    with_roles("ord")
    + f"""select orderid, case when orderdate <= confirmdate2
            then {_SECONDS.format(a='confirmdate2', b='orderdate')}
            else {_SECONDS.format(a='orderdate', b='confirmdate2')} + 1000000 end as dur_time from ord""",
)
def fn_gap_penalty(spark, sf_dir):
    return roles.orders(spark, sf_dir).select("orderid", tx.gap_score("orderdate", "confirmdate2").alias("dur_time"))
