"""Joins, sets, sort, de-duplication (J, U, O, and the id and dedup rows of W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.operators import align as J
from wattloom.operators import forecast as FC
from wattloom.operators import stats as A
from wattloom.functions.scalars import clip
from wattloom.plans import shapes
from wattloom.plans.shapes import DEMAND, KEYS, SUPPLY, TS
from wattloom.sources.tables import read_table

_D = ", ".join(DEMAND.columns)
_S = ", ".join(SUPPLY.columns)


@query("j1_outer_on_month", with_("merged") + f"select region, ts, {_D}, {_S} from merged")
def j1(spark, d):
    return shapes.merged(spark, d)


@query("j2_align_common", with_("demand_wide", "supply_wide") + """
    select region, ts, total_demand, total_supply from demand_wide join supply_wide using (region, ts)""")
def j2(spark, d):
    return J.align_common(shapes.demand_wide(spark, d).select(*KEYS, TS, DEMAND.total),
                          shapes.supply_wide(spark, d).select(*KEYS, TS, SUPPLY.total), KEYS)


@query("j3_semi_keep", """select o_orderkey, o_totalprice from orders
    where o_orderkey in (select l_orderkey from lineitem where l_quantity >= 45)""")
def j3(spark, d):
    keep = read_table(spark, d, "lineitem").filter(F.col("l_quantity") >= 45).select(F.col("l_orderkey").alias("o_orderkey"))
    return J.semi_keep(read_table(spark, d, "orders").select("o_orderkey", "o_totalprice"), keep, ["o_orderkey"])


@query("j4_drop_ratio_outliers", with_("merged") + f"""
    select region, ts, total_demand, total_supply from merged
    where not coalesce(total_supply / nullif(total_demand, 0) < 0.8 or total_supply / nullif(total_demand, 0) > 1.2, false)""")
def j4(spark, d):
    return J.drop_ratio_outliers(shapes.merged(spark, d).select(*KEYS, TS, DEMAND.total, SUPPLY.total),
                                 SUPPLY.total, DEMAND.total, 0.8, 1.2)


@query("j5_outer_on", """
    with a as (select o_custkey as k, cast(year(o_orderdate) as int) as year, count(*) as n_orders from orders group by 1, 2),
    b as (select o_custkey as k, cast(year(l_shipdate) as int) as year, count(*) as n_lines
        from lineitem join orders on l_orderkey = o_orderkey group by 1, 2),
    c as (select o_custkey as k, cast(year(o_orderdate) as int) as year, count(*) as n_urgent from orders
        where o_orderpriority = '1-URGENT' group by 1, 2)
    select k, year, n_orders, n_lines, n_urgent from a full join b using (k, year) full join c using (k, year)""")
def j5(spark, d):
    orders = read_table(spark, d, "orders")
    key = F.col("o_custkey").alias("k")
    count = lambda df, ts, n: df.groupBy(key, F.year(ts).alias("year")).agg(F.count(F.lit(1)).alias(n))
    lines = read_table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return J.outer_on([
        count(orders, "o_orderdate", "n_orders"), count(lines, "l_shipdate", "n_lines"),
        count(orders.filter(F.col("o_orderpriority") == "1-URGENT"), "o_orderdate", "n_urgent"),
    ], ["k", "year"])


@query("j6_attach_totals", with_("panel_annual") + f"""
    , tot as (select region, year, sum(m1) as parent from panel_annual group by 1, 2)
    select region, nation, year, m1, {sq("parent", 2, "parent")} from panel_annual left join tot using (region, year)""")
def j6(spark, d):
    panel = shapes.panel_annual(spark, d)
    totals = A.entity_total(panel, ["region", "year"], ["m1"]).withColumnRenamed("m1_sum", "parent")
    return settled(J.attach_totals(panel.select("region", "nation", "year", "m1"), totals, ["region", "year"]), 2, ["parent"])


@query("j7_expand_months", with_("panel_annual", "parent_monthly") + """
    select a.region, a.nation, a.year, p.ts, a.m1 as annual, p.m1 as monthly
    from panel_annual a join parent_monthly p on a.region = p.region and a.year = year(p.ts)""")
def j7(spark, d):
    annual = shapes.panel_annual(spark, d).select("region", "nation", "year", F.col("m1").alias("annual"))
    months = shapes.parent_monthly(spark, d).select("region", TS, F.year(TS).alias("year"), F.col("m1").alias("monthly"))
    return J.expand_months(annual, months, ["region", "year"])


_CLIM = """clim as (select region, m as month, w / sum(w) over (partition by region) as w_m2 from (
    select region, m, avg(case when s <= 0 then 1/12.0 else m2 / nullif(s, 0) end) as w from (
        select region, month(ts) as m, m2, coalesce(sum(m2) over (partition by region, year(ts)), 0) as s
        from parent_monthly where ts >= date '1996-01-01' and ts < date '2001-01-01') group by 1, 2))"""


@query("j8_attach_by_month", with_("parent_monthly") + f""", {_CLIM}
    select region, ts, cast(month(ts) as int) as month, m1, {sq("w_m2", 8, "w_m2")}
    from parent_monthly p left join clim using (region) where month(ts) = clim.month""")
def j8(spark, d):
    monthly = shapes.parent_monthly(spark, d)
    clim = FC.climatology(monthly, KEYS, TS, ["m2"], (1996, 2000))
    return settled(J.attach_by_month(monthly.select("region", TS, "m1"), clim, KEYS), 8, ["w_m2"])


@query("j9_align_forecasts", with_("demand_wide", "supply_wide") + """
    select region, ts, total_demand, total_supply, step from (
        select region, ts, total_demand, total_supply, cast(row_number() over (partition by region order by ts) as int) as step
        from demand_wide join supply_wide using (region, ts)) where step <= 36""")
def j9(spark, d):
    return J.align_forecasts(shapes.demand_wide(spark, d).select(*KEYS, TS, DEMAND.total),
                             shapes.supply_wide(spark, d).select(*KEYS, TS, SUPPLY.total), KEYS, 36)


@query("j10_match_observed", with_("demand_wide", "supply_wide") + """
    select s.region, s.ts, total_supply as predicted, total_demand as observed
    from supply_wide s left join demand_wide d on s.region = d.region and s.ts = d.ts""")
def j10(spark, d):
    predicted = shapes.supply_wide(spark, d).select(*KEYS, TS, F.col(SUPPLY.total).alias("predicted"))
    return J.match_observed(predicted, shapes.demand_wide(spark, d).select(*KEYS, TS, F.col(DEMAND.total).alias("observed")), [*KEYS, TS])


@query("j11_scenario_grid", with_("demand_wide") + """
    select region, ts, total_demand, cast(i * 6 + j * 3 + k as int) as scenario_id, cast(i * 100 as double) as tax,
        cast(j * 0.5 as double) as subsidy, cast(k + 1 as double) as scale
    from demand_wide, range(4) a(i), range(2) b(j), range(3) c(k)""")
def j11(spark, d):
    return J.scenario_grid(shapes.demand_wide(spark, d).select(*KEYS, TS, DEMAND.total),
                           {"tax": [0, 100, 200, 300], "subsidy": [0, 0.5], "scale": [1, 2, 3]})


@query("u1_union_by_name", with_("demand_wide", "supply_wide") + """
    select region, ts, total_demand, seg_1, null::double as total_supply from demand_wide
    union all select region, ts, null, null, total_supply from supply_wide""")
def u1(spark, d):
    return J.union_by_name(shapes.demand_wide(spark, d).select(*KEYS, TS, "total_demand", "seg_1"),
                           shapes.supply_wide(spark, d).select(*KEYS, TS, "total_supply"))


@query("u2_common_keys", """
    select c_nationkey as nationkey, cast(date_trunc('month', o_orderdate) as date) as ts from orders join customer on o_custkey = c_custkey
    intersect
    select s_nationkey, cast(date_trunc('month', l_shipdate) as date) from lineitem join supplier on l_suppkey = s_suppkey""")
def u2(spark, d):
    month = lambda c: F.trunc(F.col(c).cast("date"), "MM").alias(TS)
    bought = read_table(spark, d, "orders").join(read_table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    sold = read_table(spark, d, "lineitem").join(read_table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return J.common_keys(bought.select(F.col("c_nationkey").alias("nationkey"), month("o_orderdate")),
                         sold.select(F.col("s_nationkey").alias("nationkey"), month("l_shipdate")), ["nationkey", TS])


@query("o1_sort_by_keys", with_("panel_annual") + "select region, nation, year, m1 from panel_annual order by year, nation")
def o1(spark, d):
    return shapes.panel_annual(spark, d).select("region", "nation", "year", "m1").orderBy("year", "nation")


@query("o3_date_range", """select o_custkey, cast(min(o_orderdate) as date) as first_ts, cast(max(o_orderdate) as date) as last_ts,
    arg_min(o_totalprice, o_orderdate) as first_value, arg_max(o_totalprice, o_orderdate) as last_value
    from (select o_custkey, o_orderdate, max(o_totalprice) as o_totalprice from orders group by 1, 2) group by 1""")
def o3(spark, d):
    daily = read_table(spark, d, "orders").groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day")).agg(
        F.max("o_totalprice").alias("o_totalprice"))
    return A.date_range(daily, ["o_custkey"], "day", "o_totalprice")


_DEDUP = """select o_custkey, cast(date_trunc('month', o_orderdate) as date) as month, o_orderkey, o_totalprice from (
    select *, row_number() over (partition by o_custkey, date_trunc('month', o_orderdate) order by o_orderdate {0}, o_orderkey {0}) as r
    from orders) where r = 1"""


def _order_rows(spark, d):
    return read_table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderkey", "o_totalprice")


@query("w8_dedup_last", _DEDUP.format("desc"))
def w8_last(spark, d):
    return J.dedup_by(_order_rows(spark, d), ["o_custkey"], "day", "last", ["o_orderkey"], month="month").drop("day")


@query("w8_dedup_first", _DEDUP.format("asc"))
def w8_first(spark, d):
    return J.dedup_by(_order_rows(spark, d), ["o_custkey"], "day", "first", ["o_orderkey"], month="month").drop("day")


@query("w10_ids_per_series", with_("demand_wide") + """select region, ts, total_demand,
    row_number() over (partition by region order by ts) - 1 as id from demand_wide""")
def w10(spark, d):
    return J.with_ids(shapes.demand_wide(spark, d).select(*KEYS, TS, DEMAND.total), [TS], KEYS)


@query("w10_ids_large_groups", """select o_custkey, o_orderkey,
    row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as id from orders""")
def w10_large(spark, d):
    ids = J.with_ids(_order_rows(spark, d), ["day", "o_orderkey"], ["o_custkey"], large_groups=True)
    return ids.select("o_custkey", "o_orderkey", "id")


@query("s11_table_with_ids", """select o_orderkey, o_custkey, o_totalprice,
    row_number() over (order by o_orderdate, o_orderkey) - 1 as id from orders""")
def s11(spark, d):
    return J.with_ids(_order_rows(spark, d), ["day", "o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice", "id")
