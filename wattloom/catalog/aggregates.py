"""Aggregations (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.operators import stats as A
from wattloom.operators import windows as W
from wattloom.plans import shapes
from wattloom.plans.shapes import DEMAND, KEYS, TS
from wattloom.sources.tables import read_table

_COLS = ["total_demand", "seg_1", "seg_2"]


def _long(cols, make):
    return " union all ".join(make(c) for c in cols)


@query("a1_monthly_mean", f"""select o_custkey, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
    cast(min(o_orderdate) as date) as day, {sq("avg(o_totalprice)", 2, "o_totalprice")} from orders group by 1, 2, 3""")
def a1(spark, d):
    rows = read_table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    return settled(A.monthly_mean(rows, ["o_custkey"], "day", ["o_totalprice"]), 2)


@query("a2_annual_sum", with_("gappy") + "select region, cast(year(ts) as int) as year, " + ", ".join(
    sq(f"coalesce(sum({c}), 0)", 2, f"{c}_annual") for c in _COLS) + " from gappy group by 1, 2")
def a2(spark, d):
    return settled(A.annual_sum(shapes.demand_gappy(spark, d), KEYS, TS, _COLS), 2)


@query("a3_entity_total", with_("panel_annual") + "select year, " + ", ".join(
    sq(f"coalesce(sum({m}), 0)", 2, f"{m}_sum") for m in ("m1", "m2", "m3")) + " from panel_annual group by 1")
def a3(spark, d):
    return settled(A.entity_total(shapes.panel_annual(spark, d), ["year"], ["m1", "m2", "m3"]), 2)


@query("a4_describe", with_("gappy") + _long(_COLS, lambda c: f"""select region, '{c}' as "column", count({c}) as n,
    {sq(f"avg({c})", 2, "mean")}, {sq(f"stddev_samp({c})", 2, "std")}, {sq(f"min({c})", 2, "min")},
    {sq(f"quantile_cont({c}, 0.25)", 2, "q25")}, {sq(f"quantile_cont({c}, 0.5)", 2, "q50")},
    {sq(f"quantile_cont({c}, 0.75)", 2, "q75")}, {sq(f"max({c})", 2, "max")} from gappy group by 1"""))
def a4(spark, d):
    return settled(A.describe_cols(shapes.demand_gappy(spark, d), _COLS, KEYS), 2)


@query("a5_quantiles", with_("gappy") + _long(_COLS, lambda c: _long(["0.01", "0.5", "0.99"], lambda p: f"""
    select region, '{c}' as "column", cast({p} as double) as prob, {sq(f"quantile_cont({c}, {p})", 2, "value")} from gappy group by 1""")))
def a5(spark, d):
    return settled(A.quantiles(shapes.demand_gappy(spark, d), _COLS, [0.01, 0.5, 0.99], KEYS), 2, ["value"])


@query("a5_quantiles_large_groups", _long(["0.01", "0.25", "0.5", "0.99"], lambda p: f"""
    select l_returnflag, 'l_extendedprice' as "column", cast({p} as double) as prob, {sq(f"quantile_cont(l_extendedprice, {p})", 2, "value")}
    from lineitem group by 1"""))
def a5_large(spark, d):
    rows = read_table(spark, d, "lineitem")
    return settled(A.large_quantiles(rows, "l_extendedprice", [0.01, 0.25, 0.5, 0.99], ["l_returnflag"]), 2, ["value"])


@query("a6_null_profile", with_("gappy") + _long(_COLS, lambda c: f"""select region, '{c}' as "column",
    count(*) - count({c}) as nulls, {sq(f"(count(*) - count({c})) * 100.0 / count(*)", 6, "pct")} from gappy group by 1"""))
def a6(spark, d):
    return settled(A.null_profile(shapes.demand_gappy(spark, d), _COLS, KEYS), 6)


@query("a7_count_where", """select l_returnflag, count(*) filter (l_discount > 0.05) as big_discount,
    count(*) filter (l_quantity < 10) as small from lineitem group by 1""")
def a7(spark, d):
    return A.count_where(read_table(spark, d, "lineitem"), {
        "big_discount": F.col("l_discount") > 0.05, "small": F.col("l_quantity") < 10}, ["l_returnflag"])


@query("a8_value_counts", "select o_orderpriority, count(*) as n from orders group by 1")
def a8(spark, d):
    return A.value_profile(read_table(spark, d, "orders"), "o_orderpriority")


@query("a8_range_profile", """select o_orderstatus, count(*) as rows, count(distinct o_custkey) as distinct_values,
    cast(min(o_orderdate) as date) as first_ts, cast(max(o_orderdate) as date) as last_ts from orders group by 1""")
def a8_range(spark, d):
    rows = read_table(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return A.range_profile(rows, "o_custkey", "day", ["o_orderstatus"])


@query("a9_metric_scale", """with m as (select n_name as nation, cast(date_trunc('month', o_orderdate) as date) as ts,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) as v
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2)
    select ts, """ + sq("avg(v)", 2, "mean") + """, (select min(v) from m) as scale_min, (select max(v) from m) as scale_max
    from m group by 1""")
def a9(spark, d):
    monthly = shapes.orders_by_place(spark, d).groupBy("nation", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias(TS)).agg(
        F.sum(shapes.money("o_totalprice")).cast("double").alias("v"))
    return settled(A.metric_scale(monthly, "v", TS), 2, ["mean"])


_MOM = "abs({0} / nullif(lag({0}) over (partition by region order by ts), 0) - 1)"
_VOLATILE = {"demand": ["total_demand", "seg_1", "seg_2"], "supply": ["total_supply"]}
_CHANGES = " union all ".join(
    f"select region, '{g}' as \"group\", '{c}_mom' as \"column\", stddev_samp(v) as std from (select region, {_MOM.format(c)} as v from merged) group by 1"
    for g, cols in _VOLATILE.items() for c in cols)


@query("a10_volatility_top", with_("merged", chg=_CHANGES) + f"""select region, "group", arg_max("column", std) as "column", {sq("max(std)", 6, "std")}
    from chg group by 1, 2""")
def a10(spark, d):
    cols = [c for cs in _VOLATILE.values() for c in cs]
    changed = W.pct_change_many(shapes.merged(spark, d), KEYS, TS, {f"{c}_mom": (c, 1) for c in cols}, pad=False)
    return settled(A.volatility_top(changed, {g: [f"{c}_mom" for c in cs] for g, cs in _VOLATILE.items()}, KEYS), 6)


@query("a11_edge_means", with_("demand_wide") + f"""select region, {sq("avg(total_demand) filter (up <= 12)", 2, "first_mean")},
    {sq("avg(total_demand) filter (down <= 12)", 2, "last_mean")} from (select *, row_number() over (partition by region order by ts) as up,
    row_number() over (partition by region order by ts desc) as down from demand_wide) group by 1""")
def a11(spark, d):
    return settled(A.edge_means(shapes.demand_wide(spark, d), KEYS, TS, DEMAND.total), 2)


@query("a12_annual_mean", with_("gappy") + f"""select region, cast(year(ts) as int) as year,
    {sq("avg(total_demand)", 2, "total_demand")} from gappy group by 1, 2""")
def a12(spark, d):
    return settled(A.annual_mean(shapes.demand_gappy(spark, d), KEYS, TS, DEMAND.total), 2)


@query("a13_hourly_mean_by_series", f"""select event_type, date_trunc('hour', ts) as hour, {sq("avg(value)", 6, "value")}
    from events group by 1, 2""")
def a13(spark, d):
    return settled(shapes.hourly_events(spark, d), 6)
