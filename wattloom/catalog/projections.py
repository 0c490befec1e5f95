"""Row-wise expressions (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.functions import scalars as S
from wattloom.plans import shapes
from wattloom.plans.shapes import DEMAND
from wattloom.sources.tables import read_table

_DAY = "cast(o_orderdate as date)"


def _orders(spark, d):
    return read_table(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))


def _by_key(n, *values):
    key = F.col("o_orderkey") % n
    out = F.when(key == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        out = out.when(key == i, v)
    return out


@query("p1_parse_ts", f"""
    select o_orderkey, {_DAY} as ts from orders where o_orderkey % 4 <> 2""")
def p1(spark, d):
    day = F.col("day")
    raw = _by_key(4, F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy/M/d"), F.lit("n/a"), F.date_format(day, "yyyyMMdd"))
    return S.parse_ts(_orders(spark, d).select("o_orderkey", raw.alias("ts")), "ts")


@query("p2_parse_cn_month", f"""
    select o_orderkey, case o_orderkey % 3 when 0 then make_date(year(o_orderdate), month(o_orderdate), 15)
        when 1 then {_DAY} end as ts from orders""")
def p2(spark, d):
    cn = F.concat(F.year("day"), F.lit("年"), F.month("day"), F.lit("月"))
    raw = _by_key(3, cn, F.concat(cn, F.day("day"), F.lit("日")), F.lit("合计"))
    return _orders(spark, d).select("o_orderkey", S.parse_cn_month(raw).alias("ts"))


@query("p3_to_double", """
    select o_orderkey, case when o_orderkey % 4 in (0, 3) then o_totalprice end as value from orders""")
def p3(spark, d):
    text = shapes.money("o_totalprice").cast("string")
    raw = _by_key(4, text, F.concat(text, F.lit("abc")), F.lit(""), F.concat(F.lit("  "), text))
    return _orders(spark, d).select("o_orderkey", S.to_double(raw).alias("value"))


@query("p4_parse_dirty_number", """
    select o_orderkey, case when o_orderkey % 4 in (0, 1) then o_totalprice end as value from orders""")
def p4(spark, d):
    money = shapes.money("o_totalprice")
    raw = _by_key(4, F.concat(F.format_number(money, 2), F.lit("\t")), F.concat(F.lit("\t"), money.cast("string")), F.lit("--"), F.lit("…"))
    return _orders(spark, d).select("o_orderkey", S.parse_dirty_number(raw).alias("value"))


@query("p5_drop_header_rows", """
    select c_custkey, nullif(c_mktsegment, 'MACHINERY') as segment from customer
    where c_mktsegment <> 'BUILDING'""")
def p5(spark, d):
    seg = F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment")
    return S.drop_header_rows(read_table(spark, d, "customer").select("c_custkey", seg), "segment", "BUILDING")


@query("p11_filter_years", """
    select cast(year(o_orderdate) as int) as year, count(*) as n,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) as value
    from orders where o_orderdate >= date '1996-01-01' and o_orderdate < date '1998-01-01' group by 1""")
def p11(spark, d):
    kept = S.filter_years(read_table(spark, d, "orders"), "o_orderdate", 1996, 1997)
    return kept.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(shapes.money("o_totalprice")).cast("double").alias("value"))


@query("p12_to_month", """
    select cast(date_trunc('month', l_shipdate) as date) as month, count(*) as n from lineitem group by 1""")
def p12(spark, d):
    return read_table(spark, d, "lineitem").groupBy(S.to_month("l_shipdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))


_FEATURES = f"""cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
    cast(quarter(o_orderdate) as int) as quarter"""


@query("p13_calendar_features", f"select o_orderkey, {_FEATURES} from orders")
def p13(spark, d):
    return S.calendar_features(_orders(spark, d), "day").select("o_orderkey", "year", "month", "quarter")


@query("p14_cyclic_month", f"""select o_orderkey, {sq("sin(2*pi()*month(o_orderdate)/12)", 6, "month_sin")},
    {sq("cos(2*pi()*month(o_orderdate)/12)", 6, "month_cos")} from orders""")
def p14(spark, d):
    return settled(S.calendar_features(_orders(spark, d), "day").select("o_orderkey", "month_sin", "month_cos"), 6)


@query("p15_clip", """select c_custkey, case when c_acctbal is not null then least(greatest(c_acctbal, 0.0), 5000.0) end as bounded,
    case when c_acctbal is not null then greatest(c_acctbal, 0.0) end as non_negative from customer""")
def p15(spark, d):
    return read_table(spark, d, "customer").select(
        "c_custkey", S.clip("c_acctbal", 0.0, 5000.0).alias("bounded"), S.clip("c_acctbal", lo=0.0).alias("non_negative"))


_ZERO_SUM = "coalesce(seg_1, 0) + coalesce(seg_2, 0) + coalesce(seg_3, 0)"


@query("p16_row_sum", with_("gappy") + f"""
    select region, ts, {sq(_ZERO_SUM, 2, "skip_null")},
        {sq("case when coalesce(seg_1, seg_2) is not null then coalesce(seg_1, 0) + coalesce(seg_2, 0) end", 2, "need_one")}
    from gappy""")
def p16(spark, d):
    return settled(shapes.demand_gappy(spark, d).select(
        "region", "ts", S.row_sum(["seg_1", "seg_2", "seg_3"]).alias("skip_null"),
        S.row_sum(["seg_1", "seg_2"], min_count=1).alias("need_one")), 2)


@query("p17_safe_ratio", f"""select l_orderkey, l_linenumber, {sq("l_extendedprice / nullif(l_discount, 0)", 2, "plain")},
    {sq("coalesce(l_extendedprice / nullif(l_discount, 0), 0)", 2, "filled")} from lineitem""")
def p17(spark, d):
    return settled(read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", S.safe_ratio("l_extendedprice", "l_discount").alias("plain"),
        S.safe_ratio("l_extendedprice", "l_discount", 0.0).alias("filled")), 2, ["plain", "filled"])


@query("p18_bin_labels", """select o_orderkey, case when r > 0 and r <= 0.95 then 'undersupply' when r > 0.95 and r <= 1.05 then 'balanced'
    when r > 1.05 then 'oversupply' end as label from (select o_orderkey, (o_totalprice - 30000) / 150000 as r from orders)""")
def p18(spark, d):
    ratio = (F.col("o_totalprice") - 30000) / 150000
    return _orders(spark, d).select("o_orderkey", S.bin_labels(ratio, S.BALANCE_EDGES, S.BALANCE_LABELS).alias("label"))


@query("p19_flag", """select o_orderkey, case when year(o_orderdate) <= 1998 then 'historical' else 'forecast' end as flag from orders""")
def p19(spark, d):
    return _orders(spark, d).select("o_orderkey", S.flag(F.year("day") <= 1998, "historical", "forecast").alias("flag"))


@query("p22_month_start", """select o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) as month from orders""")
def p22(spark, d):
    return _orders(spark, d).select("o_orderkey", S.month_start(F.year("day"), F.month("day")).alias("month"))


@query("p23_round", """select c_custkey, cast(round(cast(c_acctbal as decimal(18,2)), 1) as double) as value from customer""")
def p23(spark, d):
    rows = read_table(spark, d, "customer").select("c_custkey", shapes.money("c_acctbal").alias("value"))
    return S.round_cols(rows, ["value"], 1).withColumn("value", F.col("value").cast("double"))


@query("p24_map_codes", """select c_custkey, n_name as nation, 'CN-' || cast(n_nationkey + 10 as varchar) as code
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    where r_name in ('ASIA', 'EUROPE', 'AFRICA')""")
def p24(spark, d):
    places = shapes.regions(spark, d)
    named = read_table(spark, d, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "nation")
    known = places.filter(F.col("region").isin("ASIA", "EUROPE", "AFRICA"))
    dim = known.select("nation", F.concat(F.lit("CN-"), (F.col("n_nationkey") + 10).cast("string")).alias("code"))
    return S.map_codes(named, dim, "nation")


@query("p25_normalize_region_key", """select c_custkey, case c_custkey % 6
        when 5 then 'NATION-' || cast(c_nationkey as varchar) when 4 then ''
        else 'CN-' || lpad(cast(c_nationkey as varchar), 2, '0') end as region_key from customer""")
def p25(spark, d):
    n = F.col("c_nationkey").cast("string")
    two = F.lpad(n, 2, "0")
    raw = F.array(F.concat(F.lit("chn_"), n), F.concat(F.lit(" cn."), two, F.lit("X ")), F.concat(F.lit("CN"), two), n,
                  F.lit("  "), F.concat(F.lit("nation_"), n))
    picked = F.get(raw, (F.col("c_custkey") % 6).cast("int"))
    return read_table(spark, d, "customer").select("c_custkey", S.normalize_region_key(picked).alias("region_key"))


# Prices of one order as found in the wild: per kWh, per MWh, in cents.
_A = "case o_orderkey % 4 when 0 then p / 1000 when 1 then p when 2 then p * 1000 end"
_B = "case o_orderkey % 3 when 0 then p / 1000 when 1 then p / 10 end"
_ODD = "select o_orderkey, {a} as a, {b} as b from (select o_orderkey, o_totalprice / 400 as p from orders)".format(a=_A, b=_B)
_LEVEL = "case when abs({c}) > 0 and abs({c}) < 2 then {c} * 1000 when abs({c}) > 80 and abs({c}) < 900 then abs({c}) end"
_HINT = f"""select *, case when la is null and lb is null then 400.0 when la is null then lb when lb is null then la
    else greatest(la, lb) end as hint from (select *, {_LEVEL.format(c='a')} as la, {_LEVEL.format(c='b')} as lb from odd)"""


def _odd(spark, d):
    p = F.col("o_totalprice") / 400
    return _orders(spark, d).select(
        "o_orderkey", _by_key(4, p / 1000, p, p * 1000).alias("a"), _by_key(3, p / 1000, p / 10).alias("b"))


@query("p26_normalize_unit", f"""with odd as ({_ODD}), hinted as ({_HINT})
    select o_orderkey, {sq('''case when abs(a) > 0 and abs(a) < 2 then a * 1000
        when abs(a) > 5 and abs(a) < 2000 and low < 80 then case when abs(a / 1000) < 2 then a / 1000 * 1000 else a / 1000 end
        when abs(a) > 2500 then a / 1000 else a end''', 4, "price")}
    from (select *, hint - 150 as low from hinted)""")
def p26(spark, d):
    low = S.row_unit_hint(["a", "b"]) - 150
    return settled(_odd(spark, d).select("o_orderkey", S.normalize_unit("a", low).alias("price")), 4)


@query("p27_row_unit_hint", f"with odd as ({_ODD}), hinted as ({_HINT}) select o_orderkey, {sq('hint', 4, 'hint')} from hinted")
def p27(spark, d):
    return settled(_odd(spark, d).select("o_orderkey", S.row_unit_hint(["a", "b"]).alias("hint")), 4)


@query("p28_parse_year", """select o_orderkey, case when o_orderkey % 7 <> 3
    then cast(round_even(year(o_orderdate) + (o_orderkey % 10) / 10.0, 0) as int) end as year from orders""")
def p28(spark, d):
    text = F.concat(F.year("day"), F.lit(","), (F.col("o_orderkey") % 10).cast("string"))
    raw = F.when(F.col("o_orderkey") % 7 != 3, text).otherwise("n.a.")
    return _orders(spark, d).select("o_orderkey", S.parse_year(raw).alias("year"))
