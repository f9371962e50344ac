"""The driver's tables in the roles of the source tables, once as DataFrames and
once as SQL, so that queries and their oracles start from the same rows.

The roles are whole-table projections of ``events``, ``customer``, ``nation`` and
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_DATE = "2024-01-30"
FIRST_DAY = "2024-01-01"
DAYS = ("2024-01-29", RUN_DATE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shifted(ts: str, seconds) -> F.Column:
    return F.col(ts) + F.make_dt_interval(secs=seconds)


def _copies(df: DataFrame) -> DataFrame:
    """A full copy per day, as a daily-snapshot dimension has."""
    return df.withColumn("d", F.explode(F.array(*[F.lit(d) for d in DAYS])))


# -- DataFrames ----------------------------------------------------------------


def call_log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 50 == 0, -1).otherwise(F.col("event_id")).alias("orderid"),
        F.concat(F.lit("0-"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("dnis_no"),
        F.col("ts").alias("time_in"),
        F.col("value").alias("callduration"),
        F.when(F.col("event_type") == "error", "i").otherwise("o").alias("calltype"),
        F.date_format("ts", "yyyy-MM-dd").alias("d"),
    )


def hotel_phones(spark, sf_dir):
    number = F.concat(F.lit("+0"), F.expr("substring(c_name, 9)"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("hotel"),
        F.when(F.col("c_custkey") % 10 == 3, "0000000").otherwise(number).alias("telephone"),
    )


# The other source columns of an order, as expressions that Spark and the oracle both read.
ORDER_REST = {
    "canceltime": "case when event_id % 11 = 0 then ts end",
    "isholdroom": "cast(event_id % 2 as int)",
    "holdroomtype": "cast(event_id % 3 as int)",
    "freesale": "cast(event_id % 5 as int)",
    "submitfrom": "case when event_id % 4 = 0 then null else event_type end",
    "remarktype": "cast(user_id % 7 as int)",
    "iscorp": "case when user_id % 6 = 0 then 'T' else 'F' end",
    "cost": "value * 0.5",
    "ave_price": "value * 0.25",
    "cii_amount": "value + 1.5",
    "cii_amount_valid": "case when event_id % 3 = 0 then value end",
    "ord_persons": "cast(event_id % 4 + 1 as int)",
    "ismaskedorder": "case when event_id % 13 = 0 then 'T' else 'F' end",
    "frompackageorder": "case when event_id % 17 = 0 then 'T' else 'F' end",
    "ord_roomstatus": "event_type",
    "ord_days": "cast(event_id % 6 + 1 as int)",
    "ord_roomnum": "cast(event_id % 2 + 1 as int)",
    "recommendlevel": "cast(user_id % 9 as int)",
    "isdelay": "case when event_id % 19 = 0 then 'T' else 'F' end",
    "isonline": "case when event_id % 8 = 0 then 'F' else 'T' end",
}


def orders(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("orderid"),
        F.col("user_id").alias("hotel"),
        (F.col("user_id") % 25).cast("int").alias("cityid"),
        F.col("user_id").alias("room"),
        shifted("ts", F.floor(F.col("value") * 1200 - 36000)).alias("confirmdate2"),
        shifted("ts", F.col("event_id") % 600 * -60).alias("orderdate"),
        (F.date_trunc("day", "ts").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("event_id") % 9).cast("int")))
        .alias("arrival"),
        F.col("value").alias("ord_amount"),
        F.col("event_type").alias("ordertype"),
        F.col("props").alias("commentdate"),
        *[F.expr(e).alias(name) for name, e in ORDER_REST.items()],
    )


def process_log(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    again = F.explode(F.array(F.lit(0), F.lit(7)))
    return e.select("*", again.alias("_m")).select(
        F.col("event_id").alias("orderid"),
        shifted("ts", F.col("_m") * 60).alias("operatetime"),
        shifted("ts", F.col("_m") * 60 + 30).alias("datachange_lasttime"),
        F.concat(F.when(F.col("event_type") == "error", "other ").otherwise("outcall分配 "), "event_type").alias("reason"),
        F.date_format("ts", "yyyy-MM-dd").alias("d"),
    )


def hotels(spark, sf_dir):
    return _copies(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("hotel"),
            F.col("c_nationkey").cast("bigint").alias("actualmasterhotelid"),
            (F.col("c_nationkey") % 6).alias("masterstar"),
            (F.col("c_custkey") % 5).cast("int").alias("star"),
            (F.col("c_custkey") % 4).cast("int").alias("goldstar"),
        )
    )


def supplier_hotels(spark, sf_dir):
    return _copies(
        table(spark, sf_dir, "customer")
        .where("c_mktsegment <> 'MACHINERY'")
        .select(F.col("c_custkey").alias("hotelid"), F.expr("c_custkey div 5").alias("supplierid"))
    )


def cities(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("cityid"),
        F.col("n_name").alias("cityname"),
        F.col("n_regionkey").alias("country"),
        F.col("r_name").alias("countryname"),
    )


def operate_times(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    again = F.explode(F.array(F.lit(0), F.lit(11)))
    kind = (
        F.when(F.col("event_type") == "view", " p ").when(F.col("event_type") == "error", "X").otherwise("P")
    )
    return _copies(
        e.select("*", again.alias("_m")).select(
            F.col("event_id").alias("orderid"),
            shifted("ts", F.floor(F.col("value") * 600 - 6000) + F.col("_m") * 60).alias("operatetime"),
            kind.alias("operatetype"),
        )
    )


def room_status(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type = 'signup'").select(
        F.col("user_id").alias("roomid"),
        F.date_format("ts", "yyyyMMdd").alias("effectdate"),
        F.col("ts").alias("createtime"),
        F.col("event_id").alias("snapshot_id"),
        F.col("value").alias("price"),
    )


def room_events(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        F.col("user_id").alias("roomid"),
        F.date_format("ts", "yyyyMMdd").alias("effectdate"),
        F.col("ts").alias("processtime"),
        F.col("event_id").alias("orderid"),
    )


def history(spark, sf_dir):
    """Order history for the window queries: label ``duration``, dispatch at ``ts``
    and the order up to ten hours before."""
    e = table(spark, sf_dir, "events")
    s = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("user_id"), F.expr("c_custkey div 5").alias("supplierid")
    )
    return e.join(s, "user_id", "left").select(
        F.col("event_id").alias("orderid"),
        F.col("user_id").alias("hotel"),
        "supplierid",
        F.col("ts").alias("processtime"),
        shifted("ts", F.col("event_id") % 600 * -60).alias("orderdate"),
        F.col("value").alias("duration"),
    )


# -- SQL -------------------------------------------------------------------------

_DAYS_SQL = "(values " + ", ".join(f"('{d}')" for d in DAYS) + ") days(d)"

ROLE_SQL = {
    "call_log": """
        select case when event_id % 50 = 0 then -1 else event_id end as orderid,
               '0-' || lpad(cast(user_id as varchar), 9, '0') as dnis_no, ts as time_in,
               value as callduration, case when event_type = 'error' then 'i' else 'o' end as calltype,
               strftime(ts, '%Y-%m-%d') as d
        from events""",
    "hotel_phones": """
        select c_custkey as hotel,
               case when c_custkey % 10 = 3 then '0000000' else '+0' || substr(c_name, 9) end as telephone
        from customer""",
    "ord": f"""
        select event_id as orderid, user_id as hotel, cast(user_id % 25 as integer) as cityid, user_id as room,
               ts + to_seconds(cast(floor(value * 1200 - 36000) as bigint)) as confirmdate2,
               ts - to_minutes(event_id % 600) as orderdate,
               date_trunc('day', ts) + to_days(cast(event_id % 9 as integer)) as arrival,
               value as ord_amount, event_type as ordertype, props as commentdate,
               {', '.join(f'{e} as {name}' for name, e in ORDER_REST.items())}
        from events""",
    "process_log": """
        select event_id as orderid, ts + to_minutes(m) as operatetime,
               ts + to_minutes(m) + to_seconds(30) as datachange_lasttime,
               case when event_type = 'error' then 'other ' else 'outcall分配 ' end || event_type as reason,
               strftime(ts, '%Y-%m-%d') as d
        from events, (values (0), (7)) again(m)""",
    "hotels": f"""
        select c_custkey as hotel, cast(c_nationkey as bigint) as actualmasterhotelid,
               c_nationkey % 6 as masterstar, cast(c_custkey % 5 as integer) as star,
               cast(c_custkey % 4 as integer) as goldstar, d
        from customer, {_DAYS_SQL}""",
    "supplier_hotels": f"""
        select c_custkey as hotelid, c_custkey // 5 as supplierid, d
        from customer, {_DAYS_SQL} where c_mktsegment <> 'MACHINERY'""",
    "cities": """
        select n_nationkey as cityid, n_name as cityname, n_regionkey as country, r_name as countryname
        from nation join region on n_regionkey = r_regionkey""",
    "operate_times": f"""
        select event_id as orderid,
               ts + to_seconds(cast(floor(value * 600 - 6000) as bigint)) + to_minutes(m) as operatetime,
               case event_type when 'view' then ' p ' when 'error' then 'X' else 'P' end as operatetype, d
        from events, (values (0), (11)) again(m), {_DAYS_SQL}""",
    "room_status": """
        select user_id as roomid, strftime(ts, '%Y%m%d') as effectdate, ts as createtime,
               event_id as snapshot_id, value as price
        from events where event_type = 'signup'""",
    "room_events": """
        select user_id as roomid, strftime(ts, '%Y%m%d') as effectdate, ts as processtime, event_id as orderid
        from events where event_type = 'purchase'""",
    "history": """
        select event_id as orderid, user_id as hotel, supplierid, ts as processtime,
               ts - to_minutes(event_id % 600) as orderdate, value as duration
        from events left join
             (select c_custkey, c_custkey // 5 as supplierid from customer where c_mktsegment <> 'MACHINERY') s
             on user_id = c_custkey""",
}


def with_roles(*names: str, **more: str) -> str:
    """``with`` clause of the named roles and further named selects."""
    parts = [f"{n} as ({ROLE_SQL[n]})" for n in names] + [f"{n} as ({q})" for n, q in more.items()]
    return "with " + ",\n".join(parts) + "\n"


# -- comparing floating-point results ----------------------------------------------

# Sums in another order differ in the last bits. Both sides are rounded to six
# places; the small shift keeps exact halves, which short decimals over powers of
# two hit often, from rounding apart.
_SHIFT = 3e-9


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        [
            F.round(F.col(f.name) + _SHIFT, 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def r(expr: str) -> str:
    return f"round(({expr}) + {_SHIFT}, 6)"


def rounded_sql(sql: str, doubles: list[str], head: str = "") -> str:
    """``sql`` with the named columns rounded; ``head`` is its ``with`` clause."""
    return f"{head}select * replace ({', '.join(f'{r(c)} as {c}' for c in doubles)}) from ({sql}) rounded"


def nearest_sql(snapshots: str, events: str, on: str) -> str:
    """The pair with the least score per room and day: whole seconds apart, and a million more
    where the snapshot is the later one."""
    seconds = lambda t: f"epoch_us({t}) // 1000000"
    score = f"abs({seconds('e.processtime')} - {seconds('s.createtime')}) + if(s.createtime > e.processtime, 1000000, 0)"
    pair = ["createtime", "orderid", "snapshot_id", "price", "processtime"]
    fields = ", ".join(f"'{c}': {'e' if c in ('orderid', 'processtime') else 's'}.{c}" for c in pair)
    return f"""select roomid, effectdate, {", ".join(f"best.{c}" for c in [*pair, "dur_time"])} from (
        select s.roomid, s.effectdate, min({{'dur_time': {score}, {fields}}}) as best
        from {snapshots} s join {events} e on {on} group by all)"""
