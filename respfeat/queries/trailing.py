"""Trailing windows and the feature tables built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from respfeat.functions.stats import EIGHT_STATS, FIVE_STATS, SEVEN_STATS
from respfeat.functions.timefx import wall_clock
from respfeat.operators.assemble import assemble, blank_unless, join_sparse, merge_on, require
from respfeat.operators.profile import hour_profiles
from respfeat.operators.trailing import Block, all_pairs_count, trailing_counts, trailing_features
from respfeat.plans import outcall, overseas
from respfeat.queries import orders as oq
from respfeat.queries import roles
from respfeat.queries.registry import query
from respfeat.queries.roles import FIRST_DAY, RUN_DATE, rounded, rounded_sql, with_roles

# -- SQL of the naive pair join ------------------------------------------------------

_STAT_SQL = {
    "pre": "avg(h.{v})",
    "stddev": "stddev_samp(h.{v})",
    "per75": "quantile_disc(h.{v}, 0.75)",
    "per50": "quantile_disc(h.{v}, 0.50)",
    "per25": "quantile_disc(h.{v}, 0.25)",
    "numsord": "count(*)",
    "preord": "count(*) / {d}",
    "geomean": "exp(sum(case when h.{v} > 0 then ln(h.{v}) end) / count(*))",
}


def in_window(ts: str, days: int, align: str = "hour", same_hour: bool = False) -> str:
    if align == "day":
        return f"h.{ts} >= cast(a.{ts} as date) - {days} and h.{ts} < cast(a.{ts} as date)"
    hour = f" and hour(h.{ts}) = hour(a.{ts})" if same_hour else ""
    return (
        f"h.{ts} >= date_trunc('second', a.{ts}) - interval {days * 24} hour "
        f"and h.{ts} < date_trunc('hour', a.{ts}){hour}"
    )


def block_sql(
    base: str, entity: str, ts: str, value: str, b: Block, align: str = "hour", anchors: str = "select distinct"
) -> str:
    cols = ", ".join(f"{_STAT_SQL[s].format(v=value, d=b.days)} as {b.prefix}_{s}" for s in b.stats)
    return f"""select a.{entity}, a.{ts}, {cols} from ({anchors} {entity}, {ts} from {base}) a
        join {base} h on a.{entity} = h.{entity} and {in_window(ts, b.days, align, b.same_hour)}
        group by a.{entity}, a.{ts}"""


def double_columns(blocks) -> list[str]:
    return [f"{b.prefix}_{s}" for b in blocks for s in b.stats if s != "numsord"]


def pair_count_sql(entity: str, ts: str, days: int, align: str) -> str:
    return with_roles("history") + f"""
        select a.{entity}, a.{ts}, count(*) as n_pairs from (select distinct {entity}, {ts} from history) a
        join history h on a.{entity} = h.{entity} and {in_window(ts, days, align)} group by all"""


# -- pair counts -----------------------------------------------------------------------


@query(
    "trail_pairs_full",
    with_roles("history")
    + "select a.hotel, count(*) as n_pairs from history a join history h on a.hotel = h.hotel group by a.hotel",
)
def trail_pairs_full(spark, sf_dir):
    return all_pairs_count(roles.history(spark, sf_dir), "hotel")


@query(
    "trail_supplier_pairs_full",
    with_roles("history")
    + "select a.supplierid, count(*) as n_pairs from history a join history h on a.supplierid = h.supplierid group by all",
)
def trail_supplier_pairs_full(spark, sf_dir):
    return all_pairs_count(roles.history(spark, sf_dir), "supplierid")


def _pair_counts(name: str, entity: str, ts: str, days: int, align: str) -> None:
    @query(name, pair_count_sql(entity, ts, days, align))
    def run(spark, sf_dir):
        return trailing_counts(roles.history(spark, sf_dir), entity, ts, days, align)


_pair_counts("trail_pairs_hour_7", "hotel", "orderdate", 7, "hour")
_pair_counts("trail_pairs_hour_30", "hotel", "orderdate", 30, "hour")
_pair_counts("trail_pairs_day_7", "hotel", "processtime", 7, "day")
_pair_counts("trail_pairs_day_30", "hotel", "processtime", 30, "day")
_pair_counts("trail_supplier_pairs_day", "supplierid", "processtime", 7, "day")
_pair_counts("trail_supplier_pairs_day_30", "supplierid", "processtime", 30, "day")


# -- statistics blocks --------------------------------------------------------------------


def _blocks(name: str, entity: str, ts: str, blocks: list[Block], align: str = "hour", **how) -> None:
    """One query per list of blocks; several blocks are joined in full in the oracle."""
    parts = [f"({block_sql('history', entity, ts, 'duration', b, align)})" for b in blocks]
    joined = f"select * from {parts[0]}" + "".join(f" full join {p} using ({entity}, {ts})" for p in parts[1:])

    @query(name, rounded_sql(joined, double_columns(blocks), with_roles("history")))
    def run(spark, sf_dir):
        return rounded(trailing_features(roles.history(spark, sf_dir), entity, ts, "duration", blocks, align, **how))


_blocks("trail_hour_7", "hotel", "orderdate", [Block("duration_htl_ord_hour_7", 7, True)])
_blocks("trail_all_7", "hotel", "orderdate", [Block("duration_htl_ord_week_7", 7)])
_blocks("trail_hour_30", "hotel", "orderdate", [Block("duration_htl_ord_hour_30", 30, True)])
_blocks("trail_all_30", "hotel", "orderdate", [Block("duration_htl_ord_month_30", 30)])
_blocks("trail_dispatch_7", "hotel", "processtime", outcall.blocks("htl_process", outcall.SHORT, EIGHT_STATS))
_blocks("trail_dispatch_30", "hotel", "processtime", outcall.blocks("htl_process", outcall.LONG, EIGHT_STATS))
_blocks(
    "trail_five_stats", "hotel", "orderdate",
    outcall.blocks("htl_ord", (*outcall.SHORT, *outcall.LONG), FIVE_STATS),
)
_blocks(
    "trail_supplier_hour_30", "supplierid", "orderdate",
    [Block("duration_supp_ord_hour_30", 30, True, SEVEN_STATS)],
)
_blocks("trail_supplier_all_30", "supplierid", "orderdate", [Block("duration_supp_ord_month_30", 30, stats=SEVEN_STATS)])
_blocks("trail_day_7", "hotel", "processtime", [Block("duration_month_7", 7, stats=FIVE_STATS)], "day")
_blocks("trail_day_30", "hotel", "processtime", [Block("duration_month_30", 30, stats=FIVE_STATS)], "day")
# The same by way of hours and parts of the value, forced by a small group bound.
_blocks("trail_large_groups", "supplierid", "orderdate", [Block("duration_supp_ord_month_30", 30)], group_rows=100)


_HOT = [Block("duration_hour_30", 30, True), Block("duration_month_30", 30)]
_ONE = "select 1 as hotel, processtime, orderdate, duration from history"


@query(
    "trail_hot_entity",
    rounded_sql(
        "select * from " + " full join ".join(f"({block_sql('one', 'hotel', 'orderdate', 'duration', b)})" for b in _HOT) + " using (hotel, orderdate)",
        double_columns(_HOT), with_roles("history", one=_ONE),
    ),
)
def trail_hot_entity(spark, sf_dir):
    """All events in one entity."""
    one = roles.history(spark, sf_dir).withColumn("hotel", F.lit(1))
    return rounded(trailing_features(one, "hotel", "orderdate", "duration", _HOT))


_WINDOW_GEO = Block("duration_htl_ord_hour_7", 7, True, ("numsord", "geomean"), "window")


@query(
    "trail_hour_7_window_geomean",
    rounded_sql(
        f"""select a.hotel, a.orderdate, count(*) as duration_htl_ord_hour_7_numsord,
                   exp(sum(case when h.duration > 0 then ln(h.duration) end) / any_value(nums)) as duration_htl_ord_hour_7_geomean
            from (select a.hotel, a.orderdate, count(*) as nums from history a join history h
                  on a.hotel = h.hotel and {in_window('orderdate', 7)} group by all) a
            join history h on a.hotel = h.hotel and {in_window('orderdate', 7, same_hour=True)}
            group by a.hotel, a.orderdate""",
        ["duration_htl_ord_hour_7_geomean"],
        with_roles("history"),
    ),
)
def trail_hour_7_window_geomean(spark, sf_dir):
    return rounded(trailing_features(roles.history(spark, sf_dir), "hotel", "orderdate", "duration", [_WINDOW_GEO]))


_DAILY = Block("duration_month_7", 7, stats=SEVEN_STATS)
_TWICE = "select hotel, date_trunc('day', processtime) as processtime, duration from history"


@query(
    "trail_duplicate_anchors",
    rounded_sql(
        block_sql("daily", "hotel", "processtime", "duration", _DAILY, anchors="select"),
        double_columns([_DAILY]),
        with_roles("history", daily=_TWICE),
    ),
)
def trail_duplicate_anchors(spark, sf_dir):
    daily = roles.history(spark, sf_dir).withColumn("processtime", wall_clock(F.date_trunc("day", "processtime")))
    return rounded(
        trailing_features(daily, "hotel", "processtime", "duration", [_DAILY], duplicate_anchors=True)
    )


# -- hour-of-day profiles --------------------------------------------------------------------


def profile_sql(base: str, ts: str, hour_ts: str, days: int, prefix: str, hour: str) -> str:
    cols = ", ".join(f"{_STAT_SQL[s].format(v='duration', d=days)} as {prefix}_{s}" for s in FIVE_STATS)
    return f"""select h.hotel, cast(hour(h.{hour_ts}) as integer) as {hour}, {cols}
        from {base} a join {base} h on a.hotel = h.hotel and {in_window(ts, days, 'day')} group by 1, 2"""


def _profiles(name: str, hour_ts: str, hour: str, kind: str) -> None:
    prefixes = {d: f"duration_hour_{kind}_{d}" for d in (7, 30)}
    parts = [f"({profile_sql('history', 'processtime', hour_ts, d, p, hour)})" for d, p in prefixes.items()]
    sql = f"select * from {parts[0]} full join {parts[1]} using (hotel, {hour})"
    doubles = [f"{p}_{s}" for p in prefixes.values() for s in FIVE_STATS]

    @query(name, rounded_sql(sql, doubles, with_roles("history")))
    def run(spark, sf_dir):
        h = roles.history(spark, sf_dir)
        found = hour_profiles(h, "hotel", "processtime", hour_ts, "duration", prefixes, hour)
        return rounded(found.drop(*[f"{p}_numsord" for p in prefixes.values()]))


_profiles("trail_profile_dispatch_hour", "processtime", "process_hour", "process")
_profiles("trail_profile_order_hour", "orderdate", "ord_hour", "ord")


# -- assembly ------------------------------------------------------------------------------------

_ORD = outcall.blocks("htl_ord", (*outcall.SHORT, *outcall.LONG), EIGHT_STATS)
_ORD_FIVE = outcall.blocks("htl_ord", (*outcall.SHORT, *outcall.LONG), FIVE_STATS)
_FLAGSHIP = [Block("duration_htl_process_week_7", 7)]


def chain_sql(base: str, links, value: str, align: str = "hour") -> str:
    """``links``: (entity, ts, block, how)."""
    sql = f"select b.* from {base} b"
    cols = ""
    for i, (entity, ts, b, how) in enumerate(links):
        sql += f"\n {how} join ({block_sql(base, entity, ts, value, b, align)}) x{i} on b.{entity} = x{i}.{entity} and b.{ts} = x{i}.{ts}"
        cols += "".join(f", x{i}.{b.prefix}_{s}" for s in b.stats)
    return sql.replace("select b.*", f"select b.*{cols}", 1)


@query(
    "trail_left_join",
    rounded_sql(
        chain_sql("history", [("hotel", "processtime", _FLAGSHIP[0], "left")], "duration"),
        ["duration", *double_columns(_FLAGSHIP)],
        with_roles("history"),
    ),
)
def trail_left_join(spark, sf_dir):
    h = roles.history(spark, sf_dir)
    block = trailing_features(h, "hotel", "processtime", "duration", _FLAGSHIP)
    return rounded(assemble(h, [(block, ("hotel", "processtime"), "left")]))


def _chain(name: str, blocks: list[Block], hows: dict[str, str], build) -> None:
    links = [("hotel", "orderdate", b, hows[b.prefix.rsplit("_", 1)[1]]) for b in blocks]
    sql = rounded_sql(
        chain_sql("history", links, "duration"), ["duration", *double_columns(blocks)], with_roles("history")
    )

    @query(name, sql)
    def run(spark, sf_dir):
        h = roles.history(spark, sf_dir)
        wide = trailing_features(h, "hotel", "orderdate", "duration", blocks)
        return rounded(build(assemble(h, [(wide, ("hotel", "orderdate"), "left")])))


_LONG = [f"duration_htl_ord_{n}" for n in outcall.LONG]
_SHORT = [f"duration_htl_ord_{n}" for n in outcall.SHORT]
_chain("asm_left_chain", _ORD_FIVE, {"7": "left", "30": "left"}, lambda df: df)
_chain("asm_inner_chain", _ORD, {"7": "inner", "30": "inner"}, lambda df: require(df, _SHORT + _LONG))
_chain("asm_mixed_chain", _ORD, {"7": "left", "30": "inner"}, lambda df: require(df, _LONG))


_SEP = {b.prefix: b for b in _ORD}


def _feature_tables(spark, sf_dir):
    """Two tables of the same rows, built block by block: 7 days and 30 days."""
    h = roles.history(spark, sf_dir)
    out = []
    for names in (_SHORT, _LONG):
        links = [
            (trailing_features(h, "hotel", "orderdate", "duration", [_SEP[n]]), ("hotel", "orderdate"), "inner")
            for n in names
        ]
        out.append(assemble(h, links))
    return out


def _merge_sql(first: str, how: str, second: str) -> str:
    f7 = chain_sql("history", [("hotel", "orderdate", _SEP[n], "inner") for n in _SHORT], "duration")
    f30 = chain_sql("history", [("hotel", "orderdate", _SEP[n], "inner") for n in _LONG], "duration")
    mine = {"f7": _SHORT, "f30": _LONG}[second]
    cols = ", ".join(f"b.{n}_{s}" for n in mine for s in EIGHT_STATS)
    sql = f"select a.*, {cols} from {first} a {how} join {second} b on a.orderid = b.orderid"
    return rounded_sql(sql, ["duration", *double_columns(_ORD)], with_roles("history", f7=f7, f30=f30))


@query("asm_merge_windows", _merge_sql("f7", "inner", "f30"))
def asm_merge_windows(spark, sf_dir):
    f7, f30 = _feature_tables(spark, sf_dir)
    return rounded(merge_on(f7, f30, "orderid"))


@query("asm_merge_windows_left", _merge_sql("f7", "left", "f30"))
def asm_merge_windows_left(spark, sf_dir):
    f7, f30 = _feature_tables(spark, sf_dir)
    return rounded(merge_on(f7, f30, "orderid", "left"))


@query("asm_merge_windows_reversed", _merge_sql("f30", "left", "f7"))
def asm_merge_windows_reversed(spark, sf_dir):
    # The same result from one pass: the 7-day blocks come all or none.
    h = roles.history(spark, sf_dir)
    wide = assemble(
        h, [(trailing_features(h, "hotel", "orderdate", "duration", _ORD), ("hotel", "orderdate"), "left")]
    )
    return rounded(blank_unless(require(wide, _LONG), _SHORT))


# -- feature tables from the sources ------------------------------------------------------------------

_BASE_DOUBLES = {
    1: ["ord_amount", "duration"],
    2: ["ord_amount", "arr2ord_time", "duration", "process2ord_time"],
    3: ["ord_amount", "arr2ord_time", "duration", "process2ord_time", "arr2process_time"],
}
_CLEAN = {1: oq.CLEAN_V1, 2: oq.CLEAN_V2, 3: oq.CLEAN}


def _outcall_links(names, stats, how):
    return [
        ("hotel", ts, b, how)
        for basis, ts in (("htl_process", "processtime"), ("htl_ord", "orderdate"))
        for b in outcall.blocks(basis, names, stats)
    ]


def _outcall_sql(version: int) -> str:
    if version == 1:
        blocks = [Block(f"duration_month_{d}", d, stats=FIVE_STATS) for d in (7, 30)]
        sql = chain_sql("base", [("hotel", "processtime", b, "inner") for b in blocks], "duration", "day")
        doubles = double_columns(blocks)
        for d in (7, 30):
            for ts, hour, kind in (("orderdate", "ord_hour", "ord"), ("processtime", "process_hour", "process")):
                p = f"duration_hour_{kind}_{d}"
                cols = ", ".join(f"{p}.{p}_{s}" for s in FIVE_STATS)
                sql = f"""select c.*, {cols} from ({sql}) c join
                    ({profile_sql('base', 'processtime', ts, d, p, hour)}) {p} on c.hotel = {p}.hotel and c.{hour} = {p}.{hour}"""
                doubles += [f"{p}_{s}" for s in FIVE_STATS]
        return rounded_sql(sql, _BASE_DOUBLES[1] + doubles, oq.outcall_sql(base=_CLEAN[1]))
    stats, how = (FIVE_STATS, "left") if version == 2 else (EIGHT_STATS, "inner")
    short, long = (_outcall_links(n, stats, how) for n in (outcall.SHORT, outcall.LONG))
    doubles = _BASE_DOUBLES[version] + double_columns([b for *_, b, _ in short + long])
    cols = ", ".join(f"b.{b.prefix}_{s}" for *_, b, _ in short for s in b.stats)
    head = oq.outcall_sql(
        base=_CLEAN[version], f7=chain_sql("base", short, "duration"), f30=chain_sql("base", long, "duration")
    )
    return rounded_sql(f"select a.*, {cols} from f30 a left join f7 b on a.orderid = b.orderid", doubles, head)


def _outcall(name: str, version: int) -> None:
    @query(name, _outcall_sql(version))
    def run(spark, sf_dir):
        return rounded(
            outcall.outcall_table(
                *oq.outcall_tables(spark, sf_dir), FIRST_DAY, RUN_DATE, version, oq.confirm_columns(version)
            )
        )


_outcall("asm_profile_features", 1)
_outcall("asm_outcall_five_stats", 2)
_outcall("pipe_outcall_features", 3)

_OVERSEAS_DOUBLES = ["ord_amount", "arr2ord_time", "duration1", "duration2"]


def _overseas_sql(with_supplier: bool) -> str:
    stats = SEVEN_STATS if with_supplier else EIGHT_STATS
    links = [("hotel", "orderdate", b, "left") for b in outcall.blocks("htl_ord", outcall.SHORT, stats)]
    links += [("hotel", "orderdate", b, "inner") for b in outcall.blocks("htl_ord", outcall.LONG, stats)]
    if with_supplier:
        links += [("supplierid", "orderdate", b, "left") for b in outcall.blocks("supp_ord", outcall.LONG, SEVEN_STATS)]
    doubles = _OVERSEAS_DOUBLES + double_columns([b for *_, b, _ in links])
    return rounded_sql(chain_sql("base", links, "duration2"), doubles, oq.overseas_sql())


@query("asm_hotel_features", _overseas_sql(False))
def asm_hotel_features(spark, sf_dir):
    return rounded(
        overseas.overseas_table(*oq.overseas_tables(spark, sf_dir), FIRST_DAY, RUN_DATE, oq.OVERSEAS, with_supplier=False)
    )


@query("pipe_overseas_features", _overseas_sql(True))
def pipe_overseas_features(spark, sf_dir):
    return rounded(overseas.overseas_table(*oq.overseas_tables(spark, sf_dir), FIRST_DAY, RUN_DATE, oq.OVERSEAS))


_HOTEL_SEVEN = outcall.blocks("htl_ord", (*outcall.SHORT, *outcall.LONG), SEVEN_STATS)
_SUPPLIER = outcall.blocks("supp_ord", outcall.LONG, SEVEN_STATS)


@query(
    "asm_hotel_supplier",
    rounded_sql(
        chain_sql(
            "history",
            [("hotel", "orderdate", b, "inner" if b.days == 30 else "left") for b in _HOTEL_SEVEN]
            + [("supplierid", "orderdate", b, "left") for b in _SUPPLIER],
            "duration",
        ),
        ["duration", *double_columns(_HOTEL_SEVEN + _SUPPLIER)],
        with_roles("history"),
    ),
)
def asm_hotel_supplier(spark, sf_dir):
    h = roles.history(spark, sf_dir)
    hotel = trailing_features(h, "hotel", "orderdate", "duration", _HOTEL_SEVEN)
    supplier = trailing_features(h, "supplierid", "orderdate", "duration", _SUPPLIER)
    wide = require(assemble(h, [(hotel, ("hotel", "orderdate"), "left")]), _LONG)
    return rounded(join_sparse(wide, supplier, ("supplierid", "orderdate")))


@query(
    "room_features",
    oq.outcall_sql(
        status=roles.ROLE_SQL["room_status"].replace("strftime(ts,", "strftime(ts + to_days(2),"),
    )
    + roles.nearest_sql(
        "status",
        """(select room as roomid, strftime(arrival, '%Y%m%d') as effectdate, processtime, orderid from ord
            join dispatch using (orderid) where least(orderdate, processtime) >= timestamp '2024-01-01')""",
        "s.roomid = e.roomid and s.effectdate = e.effectdate",
    ),
)
def room_features(spark, sf_dir):
    status = roles.room_status(spark, sf_dir).withColumns(
        {
            "effectdate": F.date_format(F.col("createtime") + F.make_dt_interval(days=F.lit(2)), "yyyyMMdd"),
            "d": F.date_format("createtime", "yyyy-MM-dd"),
        }
    )
    dispatch = oq._dispatch(spark, sf_dir)
    return outcall.room_features(status, roles.orders(spark, sf_dir), dispatch, FIRST_DAY, FIRST_DAY).drop("d")
