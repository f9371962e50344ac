"""Base tables of orders: dispatch and confirmation times, suppliers, labels.

Dimension joins carry no broadcast hint: Spark broadcasts a side whose size it
has measured below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it
otherwise, with skewed keys split at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respfeat.functions import cleaning as cl
from respfeat.functions import timefx as tx
from respfeat.functions.columns import drop_matching
from respfeat.operators.ranking import first_per_key
from respfeat.operators.skew import spread_join
from respfeat.sources.tables import excluding_code, since

# Columns the order extract leaves out, and those each base table keeps.
UNWANTED_ORDER_COLUMNS = r"(hotelcountry|ipid|commentdate|isdirectorder|businessgroup)"
HOTEL_ATTRIBUTES = ["actualmasterhotelid", "masterstar", "star", "goldstar"]
CONFIRM_COLUMNS_V1 = [
    "orderid", "hotel", "confirmdate", "canceltime", "ord_amount", "arrival", "isholdroom",
    "freesale", "submitfrom", "ord_roomstatus", "orderdate", "ordertype", "iscorp",
    "istodayord", "isdelay", "cityid", "isonline", *HOTEL_ATTRIBUTES,
]
CONFIRM_COLUMNS = [
    "orderid", "hotel", "confirmdate", "canceltime", "ord_amount", "arrival", "isholdroom",
    "holdroomtype", "freesale", "submitfrom", "orderdate", "remarktype", "ordertype", "iscorp",
    "cost", "ave_price", "cii_amount", "cii_amount_valid", "ord_persons", "ismaskedorder",
    "frompackageorder", "ord_roomstatus", "ord_days", "ord_roomnum", "recommendlevel",
    "istodayord", "isdelay", "arr2ord_time", "cityid", "isonline", *HOTEL_ATTRIBUTES,
]
OVERSEAS_COLUMNS = [
    "orderid", "hotel", "cityid", "cityname", "country", "countryname", "confirmdate", "orderdate",
    "ord_hour", "arrival", "arr_hour", "istodayord", "arr2ord_time", "arr_week", "ord_week",
    "freesale", "submitfrom", "ord_roomstatus", "iscorp", "isdelay", "isholdroom", "ordertype",
    "canceltime", "ord_amount", "isonline", "recommendlevel", "holdroomtype", "cost", "ave_price",
    "cii_amount", "cii_amount_valid", "ord_persons", "ismaskedorder", "frompackageorder",
    "ord_days", "ord_roomnum", "remarktype", "confirmdate_format", "orderdate_format", "duration1",
    *HOTEL_ATTRIBUTES,
]


# -- joins ---------------------------------------------------------------------


def join_dim(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
    cols: Sequence[str] | None = None, how: str = "inner", share: float | None = None,
) -> DataFrame:
    """Fact with the columns of a dimension; ``how="left"`` keeps unmatched facts. With ``share``,
    keys with that share of the facts are spread over tasks (``spread_join``)."""
    dim_key = dim_key or key
    cols = [c for c in dim.columns if c != dim_key] if cols is None else list(cols)
    side = dim.select(F.col(dim_key).alias("_k"), *cols)
    if share:
        return spread_join(fact, side, [(key, "_k")], how, share)
    return fact.join(side, F.col(key) == F.col("_k"), how).drop("_k")


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    return left.join(right, list(keys), how)


def join_on_compact_day(
    left: DataFrame, right: DataFrame, id_pair: tuple[str, str], day_text: str, ts: str
) -> DataFrame:
    """Join on an id and on ``yyyyMMdd`` text of the left against the day of an
    instant of the right."""
    return left.join(
        right,
        (F.col(id_pair[0]) == F.col(id_pair[1])) & (tx.compact_date(day_text) == F.to_date(F.col(ts))),
    )


# -- dispatch, extract, confirmation ---------------------------------------------


def dispatch_time(process_log: DataFrame, reason: str = cl.DISPATCH_REASON) -> DataFrame:
    """First matching log row per order: ``orderid, processtime, datachange_lasttime``."""
    hits = process_log.where(cl.mentions("reason", reason))
    return first_per_key(hits, "orderid", ["operatetime", "datachange_lasttime"]).select(
        "orderid", F.col("operatetime").alias("processtime"), "datachange_lasttime"
    )


def order_extract(
    orders: DataFrame, lo: str, ts: str = "confirmdate2", unwanted: str = UNWANTED_ORDER_COLUMNS
) -> DataFrame:
    """Orders from an instant on, without the unwanted columns."""
    return drop_matching(since(orders, ts, lo), unwanted)


def confirm_time(orders: DataFrame, hotels: DataFrame, columns: Sequence[str] = CONFIRM_COLUMNS, share: float | None = None) -> DataFrame:
    """Orders with hotel attributes, the first confirmation per order, same-day flag
    and minutes from order to arrival.

    Orders are reduced before the dimension join, so the join sees each order once. A
    hotel that is listed several times gives its first row; ties end in all columns.
    ``share`` as in ``join_dim``.
    """
    ties = [c for c in orders.columns if c not in ("orderid", "confirmdate2", "hotel")]
    first = first_per_key(orders, "orderid", ["confirmdate2", "hotel", *ties])
    listed = first_per_key(hotels.select("hotel", *HOTEL_ATTRIBUTES), "hotel", HOTEL_ATTRIBUTES)
    return join_dim(first, listed, "hotel", cols=HOTEL_ATTRIBUTES, how="left", share=share).withColumns(
        {
            "confirmdate": F.col("confirmdate2"),
            "istodayord": tx.same_day_flag("arrival", "orderdate"),
            "arr2ord_time": tx.minutes_between("arrival", "orderdate"),
        }
    ).select(*columns)


def attach_supplier(orders: DataFrame, supplier_hotels: DataFrame, share: float | None = None) -> DataFrame:
    """``supplierid`` of the hotel, NULL where there is none. ``share`` as in ``join_dim``."""
    return join_dim(orders, supplier_hotels, "hotel", "hotelid", ["supplierid"], "left", share)


def response_duration(dispatch: DataFrame, confirmed: DataFrame, version: int = 3) -> DataFrame:
    """Minutes from dispatch to confirmation and the time features of each version:
    1 hours of day; 2 adds hours from order to dispatch; 3 has weekdays, and minutes
    from order to dispatch and from dispatch to arrival."""
    joined = confirmed.join(dispatch, "orderid")
    new: dict[str, Column] = {
        "process_hour": F.hour("processtime"),
        "ord_hour": F.hour("orderdate"),
        "duration": tx.minutes_between("confirmdate", "processtime"),
    }
    if version == 2:
        new["process2ord_time"] = tx.hours_between("processtime", "orderdate")
    if version == 3:
        new |= {
            "process_week": tx.weekday("processtime"),
            "ord_week": tx.weekday("orderdate"),
            "process2ord_time": tx.minutes_between("processtime", "orderdate"),
            "arr2process_time": tx.minutes_between("arrival", "processtime"),
        }
    return joined.withColumns(new)


# -- overseas --------------------------------------------------------------------


def overseas_orders(
    orders: DataFrame, cities: DataFrame, hotels: DataFrame, home_country: int = 1,
    columns: Sequence[str] = OVERSEAS_COLUMNS, share: float | None = None,
) -> DataFrame:
    """Orders in other countries with city and hotel attributes and time features. ``share`` as in ``join_dim``."""
    abroad = join_dim(
        orders, excluding_code(cities, "country", home_country), "cityid",
        cols=["cityname", "country", "countryname"], share=share,
    )
    return join_dim(abroad, hotels, "hotel", cols=HOTEL_ATTRIBUTES, share=share).withColumns(
        {
            "confirmdate": F.col("confirmdate2"),
            "ord_hour": F.hour("orderdate"),
            "arr_hour": F.hour("arrival"),
            "istodayord": tx.same_day_flag("arrival", "orderdate"),
            "arr2ord_time": tx.minutes_between("arrival", "orderdate"),
            "arr_week": tx.weekday("arrival"),
            "ord_week": tx.weekday("orderdate"),
            "confirmdate_format": tx.second_floor("confirmdate2"),
            "orderdate_format": tx.second_floor("orderdate"),
            "duration1": tx.minutes_between("confirmdate2", "orderdate"),
        }
    ).select(*columns)


def first_reply(operate_times: DataFrame, code: str = "P") -> DataFrame:
    """Earliest supplier reply per order, to the second."""
    return (
        operate_times.where(cl.trimmed_code_is("operatetype", code))
        .groupBy("orderid")
        .agg(F.min(tx.second_floor("operatetime")).alias("operatetime"))
    )


def supplier_reply(orders: DataFrame, operate_times: DataFrame, code: str = "P") -> DataFrame:
    """Orders with a supplier reply and the minutes from order to reply."""
    return orders.join(first_reply(operate_times, code), "orderid").withColumn(
        "duration2", tx.minutes_between("operatetime", "orderdate")
    )


# -- labels ----------------------------------------------------------------------


def clean_outcall_labels(df: DataFrame, version: int = 3) -> DataFrame:
    """Version 1: arrival on a later day than confirmation, label under 10000
    minutes; later versions: arrival not before confirmation, label under 4500."""
    if version == 1:
        return df.where(cl.on_later_day("arrival", "confirmdate") & cl.in_label_range("duration", 0, 10000))
    return df.where(cl.not_before("arrival", "confirmdate") & cl.in_label_range("duration", 0, 4500))


def clean_overseas_labels(df: DataFrame) -> DataFrame:
    return df.where(
        cl.not_before("arrival", "confirmdate")
        & cl.in_label_range("duration1", 3)
        & cl.in_label_range("duration2", 0, 10000)
    )


def label_measures(duration: str = "duration") -> dict[str, Column]:
    """Aggregates over labels: rows, rows with a label of zero or less, rows with a negative label."""
    d = F.col(duration)
    return {"n_rows": F.count(F.lit(1)), "n_not_positive": F.count_if(d <= 0), "n_negative": F.count_if(d < 0)}


def label_counts(df: DataFrame, duration: str = "duration") -> DataFrame:
    """The label measures by one scan."""
    return df.agg(*[c.alias(n) for n, c in label_measures(duration).items()])
