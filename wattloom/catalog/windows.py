"""Window functions over monthly series (W, X1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.operators import windows as W
from wattloom.plans import shapes
from wattloom.plans.shapes import DEMAND, KEYS, SUPPLY, TS
from wattloom.sources.tables import read_table

_W = "(partition by region order by ts)"
T = DEMAND.total


def _total(spark, d):
    return shapes.demand_gappy(spark, d).select(*KEYS, TS, T)


@query("w1_lags", with_("gappy") + "select region, ts, total_demand, " + ", ".join(
    f"lag(total_demand, {n}) over {_W} as total_demand_lag_{n}" for n in (1, 2, 3, 6, 12)) + " from gappy")
def w1(spark, d):
    return W.lags(_total(spark, d), KEYS, TS, T, (1, 2, 3, 6, 12))


def _roll(col, n, lo, hi):
    frame = f"over (partition by region order by ts rows between {lo} and {hi})"
    return f"case when count({col}) {frame} = {n} then avg({col}) {frame} end"


@query("w2_rolling_mean_shifted", with_("demand_wide") + "select region, ts, " + ", ".join(
    sq(_roll("total_demand", n, f"{n} preceding", "1 preceding"), 2, f"total_demand_roll_mean_{n}") for n in (3, 6, 12)) + " from demand_wide")
def w2(spark, d):
    out = shapes.demand_wide(spark, d).select(*KEYS, TS, T)
    for n in (3, 6, 12):
        out = W.rolling_mean(out, KEYS, TS, T, n, shift=1)
    return settled(out.drop(T), 2)


_YOY = f"""yoy as (select region, ts, p / nullif(lag(p, 12) over {_W}, 0) - 1 as yoy from (
    select region, ts, last_value(total_demand ignore nulls) over (partition by region order by ts
        rows between unbounded preceding and current row) as p from gappy))"""


@query("w3_rolling_yoy", with_("gappy") + f""", {_YOY}
    select region, ts, {sq(_roll("yoy", 3, "2 preceding", "current row"), 6, "yoy_ma3")} from yoy""")
def w3(spark, d):
    yoy = W.pct_change(_total(spark, d), KEYS, TS, T, 12, out="yoy")
    return settled(W.rolling_mean(yoy, KEYS, TS, "yoy", 3, out="yoy_ma3").select(*KEYS, TS, "yoy_ma3"), 6)


@query("w4_pct_change", with_("gappy") + f"""
    , padded as (select region, ts, last_value(total_demand ignore nulls) over (partition by region order by ts
        rows between unbounded preceding and current row) as p from gappy)
    select region, ts, {sq(f"p / nullif(lag(p, 12) over {_W}, 0) - 1", 6, "yoy")},
        {sq(f"p / nullif(lag(p, 1) over {_W}, 0) - 1", 6, "mom")} from padded""")
def w4(spark, d):
    out = W.pct_change_many(_total(spark, d), KEYS, TS, {"yoy": (T, 12), "mom": (T, 1)})
    return settled(out.drop(T), 6)


@query("w5_day_gap", """select o_custkey, day, cast(datediff('day', lag(day) over (partition by o_custkey order by day), day) as int) as gap_days
    from (select distinct o_custkey, cast(o_orderdate as date) as day from orders)""")
def w5(spark, d):
    days = read_table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day")).distinct()
    return W.day_gap(days, ["o_custkey"], "day")


@query("w6_group_mean", with_("gappy") + f"""select region, ts,
    {sq("avg(total_demand) over (partition by region, year(ts))", 2, "year_mean")},
    {sq("avg(total_demand) over (partition by region, month(ts))", 2, "month_mean")} from gappy""")
def w6(spark, d):
    out = W.group_mean(_total(spark, d), [*KEYS, F.year(TS)], T, "year_mean")
    return settled(W.group_mean(out, [*KEYS, F.month(TS)], T, "month_mean").drop(T), 2)


@query("w7_group_weight", with_("gappy") + f"""select region, ts, {sq('''case when coalesce(s, 0) <= 0 then 1/12.0
    else total_demand / nullif(s, 0) end''', 8, "weight")}
    from (select *, sum(total_demand) over (partition by region, year(ts)) as s from gappy)""")
def w7(spark, d):
    return settled(W.group_weight(_total(spark, d), [*KEYS, F.year(TS)], T, out="weight").drop(T), 8)


INTERPOLATED = """
    , pos as (select *, row_number() over (partition by region order by ts) as i from gappy),
    around as (select region, ts, i, {c} as v,
        last_value({c} ignore nulls) over (partition by region order by ts rows between unbounded preceding and current row) as pv,
        last_value(case when {c} is not null then i end ignore nulls) over (partition by region order by ts rows between unbounded preceding and current row) as pi,
        first_value({c} ignore nulls) over (partition by region order by ts rows between current row and unbounded following) as nv,
        first_value(case when {c} is not null then i end ignore nulls) over (partition by region order by ts rows between current row and unbounded following) as ni
        from pos),
    interpolated as (select region, ts, v, coalesce(v, pv + (nv - pv) / nullif(ni - pi, 0) * (i - pi), pv) as filled from around)
"""


@query("w9_interpolate_linear", with_("gappy") + INTERPOLATED.format(c="seg_1") + f"""
    select region, ts, v as seg_1, {sq("filled", 2, "seg_1_interp")} from interpolated""")
def w9(spark, d):
    rows = shapes.demand_gappy(spark, d).select(*KEYS, TS, "seg_1")
    return settled(W.interpolate_linear(rows, KEYS, TS, "seg_1"), 2, ["seg_1_interp"])


@query("x1_densify_months", """
    with m as (select distinct o_custkey, cast(date_trunc('month', o_orderdate) as date) as ts from orders),
    n as (select o_custkey, ts, count(*) as n from (select o_custkey, cast(date_trunc('month', o_orderdate) as date) as ts from orders) group by 1, 2),
    g as (select o_custkey, cast(unnest(generate_series(min(ts), max(ts), interval 1 month)) as date) as ts from m group by 1)
    select o_custkey, ts, n from g left join n using (o_custkey, ts)""")
def x1(spark, d):
    monthly = read_table(spark, d, "orders").groupBy("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias(TS)).agg(
        F.count(F.lit(1)).alias("n"))
    return W.densify_months(monthly, ["o_custkey"], TS)


_HOURLY = "hourly as materialized (select user_id, date_trunc('hour', ts) as hour, avg(value) as value from events group by 1, 2)"
_USER = "over (partition by user_id order by hour rows between 2 preceding and current row)"


@query("w4_hourly_change_per_user", f"""with {_HOURLY} select user_id, hour, {sq("value", 6, "value")},
    {sq("value / nullif(lag(value) over (partition by user_id order by hour), 0) - 1", 6, "change")},
    {sq(f"case when count(value) {_USER} = 3 then avg(value) {_USER} end", 6, "smooth")} from hourly""")
def w4_hourly(spark, d):
    hourly = shapes.hourly_events(spark, d, ["user_id"])
    changed = W.pct_change(hourly, ["user_id"], "hour", "value", 1, out="change")
    return settled(W.rolling_mean(changed, ["user_id"], "hour", "value", 3, out="smooth"), 6)
