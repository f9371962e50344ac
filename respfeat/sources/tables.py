"""Input schemas, typed reads and partition-day scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respfeat.functions import timefx as tx


# Column names and types of the source tables.
SCHEMAS = {
    "call_log": (
        "maincid string, orderid long, dnis_no string, time_in timestamp_ntz, "
        "callduration double, calltype string, d string"
    ),
    "desk_call_log": ("ani string, datacreatetime timestamp_ntz, outcalltype string, d string"),
    "hotel_phones": ("hotel long, telephone string"),
    "orders": (
        "orderid long, hotel long, cityid long, room long, confirmdate2 timestamp_ntz, "
        "orderdate timestamp_ntz, arrival timestamp_ntz, canceltime timestamp_ntz, "
        "ord_amount double, cost double, ave_price double, cii_amount double, cii_amount_valid double, "
        "ord_persons int, ord_days int, ord_roomnum int, recommendlevel int, "
        "freesale string, submitfrom string, ord_roomstatus string, iscorp string, isdelay string, "
        "isholdroom string, ordertype string, isonline string, holdroomtype string, "
        "ismaskedorder string, frompackageorder string, remarktype string, "
        "hotelcountry string, ipid string, commentdate string, isdirectorder string, businessgroup string"
    ),
    "cities": ("cityid long, cityname string, country int, countryname string"),
    "hotels": (
        "hotel long, actualmasterhotelid long, masterstar int, star int, goldstar int, d string"
    ),
    "operate_times": ("orderid long, operatetime timestamp_ntz, operatetype string, d string"),
    "supplier_hotels": ("hotelid long, supplierid long, d string"),
    "process_log": (
        "orderid long, operatetime timestamp_ntz, datachange_lasttime timestamp_ntz, reason string, d string"
    ),
    "room_status": ("roomid long, effectdate string, createtime timestamp_ntz, d string"),
}


def read_table(spark: SparkSession, path: str, role: str | None = None) -> DataFrame:
    """Parquet table, with its time columns as wall-clock timestamps.

    With a role its columns take the types of ``SCHEMAS``; text that does not
    parse becomes NULL. Columns the role does not name pass through.
    """
    df = spark.read.parquet(path)
    typed = {f.name: f.dataType for f in T.StructType.fromDDL(SCHEMAS[role]).fields} if role else {}
    casts = {}
    for f in df.schema.fields:
        want = typed.get(f.name)
        if want is not None and want != f.dataType:
            casts[f.name] = F.col(f.name).try_cast(want)
        elif want is None and isinstance(f.dataType, T.TimestampType):
            casts[f.name] = tx.wall_clock(f.name)
    return df.withColumns(casts) if casts else df


def snapshot(df: DataFrame, run_date: str, day_col: str = "d") -> DataFrame:
    """One partition day of a table that keeps a full copy per day."""
    return df.where(F.col(day_col) == run_date)


def day_range(df: DataFrame, lo: str, hi: str | None = None, day_col: str = "d") -> DataFrame:
    """Partition days ``lo … hi``, both included; without ``hi`` all from ``lo`` on."""
    day = F.col(day_col)
    return df.where(day >= lo if hi is None else day.between(lo, hi))


def since(df: DataFrame, ts: str, lo: str) -> DataFrame:
    """Rows from an instant on. A typed literal, so it reaches the Parquet scan."""
    return df.where(F.col(ts) >= tx.instant(lo))


def between_instants(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    """Rows in ``[lo, hi)``."""
    return df.where((F.col(ts) >= tx.instant(lo)) & (F.col(ts) < tx.instant(hi)))


def excluding_code(df: DataFrame, col: str, code: object) -> DataFrame:
    return df.where(F.col(col) != code)


def lookup(df: DataFrame, col: str, key: object) -> DataFrame:
    return df.where(F.col(col) == key)


def day_text(ts: str) -> Column:
    """The partition day ``yyyy-MM-dd`` of a timestamp."""
    return F.date_format(F.col(ts), "yyyy-MM-dd")
