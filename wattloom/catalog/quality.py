"""Quality checks (Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.indicators import INDICATOR_CTES, SHARES, indicator_table
from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.operators import quality as Q
from wattloom.operators import stats as A
from wattloom.plans import shapes
from wattloom.plans.shapes import DEMAND, KEYS, SUPPLY, TS
from wattloom.session import materialize
from wattloom.sources.tables import read_table


def rows_sql(source, check, metrics, status, keys="region"):
    """Long rows from one aggregate row per group."""
    return " union all ".join(
        f"select {keys}, '{check}' as \"check\", '{m}' as metric, {sq(f'cast({v} as double)', 6, 'value')}, {status} as status from {source}"
        for m, v in metrics.items())


def pass_if(cond):
    return f"case when coalesce({cond}, false) then 'PASS' else 'WARN' end"


def identity_sql(name, source, total, parts, tol, rate):
    dev = f"abs({total} - ({' + '.join(f'coalesce({p}, 0)' for p in parts)}))"
    agg = f"""select region, max(dev) as mx, avg(dev) as mn, avg(dev / nullif({total}, 0)) as rel,
        count(*) filter (dev / nullif({total}, 0) > {tol}) as bad, count(*) as n
        from (select *, {dev} as dev from {source}) group by 1"""
    return rows_sql(f"({agg})", name, {
        "max_deviation": "round(mx, 2)", "mean_deviation": "round(mn, 2)", "mean_deviation_pct": "rel * 100", "abnormal_count": "bad",
    }, pass_if(f"bad <= n * {rate}"))


def checks_for_comparison(df):
    """Checks carry money and rates in one column: money is cut to cents first."""
    money = F.col("metric").isin("max_deviation", "mean_deviation", "first_mean", "last_mean")
    return settled(df.withColumn("value", F.when(money, F.round("value", 2)).otherwise(F.col("value"))), 6)


_Q1 = identity_sql("generation", "supply_wide", "total_supply", SUPPLY.parts, 0.02, 0.0)
_Q2 = identity_sql("demand", "gappy", "total_demand", DEMAND.parts, 0.10, 0.02)


@query("q1_generation_identity", with_("supply_wide") + _Q1)
def q1(spark, d):
    return checks_for_comparison(Q.check_identity(shapes.supply_wide(spark, d), SUPPLY, "generation", 0.02, keys=KEYS))


@query("q2_demand_identity", with_("gappy") + _Q2)
def q2(spark, d):
    return checks_for_comparison(Q.check_identity(shapes.demand_gappy(spark, d), DEMAND, "demand", 0.10, 0.02, KEYS))


_Q3 = rows_sql("""(select region, avg(r) as mean, min(r) as lo, max(r) as hi, count(*) filter (r >= 0.8 and r <= 1.2) as ok,
    count(*) filter (r < 0.5 or r > 1.5) as bad, count(*) as n from (select region, total_supply / nullif(total_demand, 0) as r from merged) group by 1)""",
    "balance", {"mean": "mean", "min": "lo", "max": "hi", "normal_range_pct": "ok * 100.0 / n", "severe_imbalance_count": "bad"},
    pass_if("bad <= n * 0.15"))


def _balance(spark, d):
    return Q.check_range(shapes.merged(spark, d).select(*KEYS, TS, (F.try_divide(SUPPLY.total, DEMAND.total)).alias("r")), "r",
                         (0.8, 1.2), (0.5, 1.5), keys=KEYS)


@query("q3_balance_range", with_("merged") + _Q3)
def q3(spark, d):
    return checks_for_comparison(_balance(spark, d))


_Q4 = rows_sql("""(select region, max(g) as mx, count(*) filter (g > 31) as gaps, count(*) as n,
    floor(datediff('day', min(ts), max(ts)) / 30.0) + 1 as expected
    from (select region, ts, datediff('day', lag(ts) over (partition by region order by ts), ts) as g from merged) group by 1)""",
    "temporal", {"max_time_gap": "mx", "gaps_over_month": "gaps", "completeness_pct": "n * 100.0 / expected",
                 "expected_months": "expected", "actual_months": "n"}, pass_if("gaps = 0"))


@query("q4_temporal", with_("merged") + _Q4)
def q4(spark, d):
    return checks_for_comparison(Q.check_temporal(shapes.merged(spark, d), KEYS, TS))


_SIDES = {"supply": [f"{p}_share" for p in SUPPLY.parts], "demand": [f"{p}_share" for p in DEMAND.parts]}


def _sum(cols):
    return " + ".join(f"coalesce({c}, 0)" for c in cols)


def _dev(side):
    return f"coalesce(max(case when {side} > 0 then abs({side} - 1) end), 0)"


_IND = with_("merged", **INDICATOR_CTES)
_Q5 = rows_sql(f"""(select region, {_dev('s')} as s, {_dev('d')} as d from (
    select region, {_sum(_SIDES['supply'])} as s, {_sum(_SIDES['demand'])} as d from ind) group by 1)""",
    "shares", {"supply_max_deviation": "s", "demand_max_deviation": "d"}, pass_if("s < 0.05 and d < 0.05"))


@query("q5_shares", _IND + _Q5)
def q5(spark, d):
    return checks_for_comparison(Q.check_shares(indicator_table(spark, d), _SIDES, keys=KEYS))


_YOY = [f"{c}_yoy" for c in (*DEMAND.columns, *SUPPLY.columns)]
_Q6 = rows_sql("(select region, " + ", ".join(f"count(*) filter (abs({c}) > 0.5) as {c}" for c in _YOY) + ", " + " + ".join(
    f"cast(max(abs({c})) > 0.5 as int)" for c in _YOY) + " as bad from ind group by 1)",
    "growth", {"extreme_growth_column_count": "bad", **{c: c for c in _YOY}}, pass_if(f"bad <= {len(_YOY)} * 0.2"))


@query("q6_growth", _IND + _Q6)
def q6(spark, d):
    return checks_for_comparison(Q.check_growth(indicator_table(spark, d), _YOY, 0.5, keys=KEYS))


def _five_checks(table):
    return Q.run_checks(table, [
        Q.identity_check(table, SUPPLY, "generation", 0.02), Q.identity_check(table, DEMAND, "demand", 0.10, 0.02),
        Q.temporal_check(TS), Q.shares_check(table, _SIDES), Q.growth_check(table, _YOY, 0.5),
    ], KEYS, TS)


_ALL = " union all ".join([
    identity_sql("generation", "ind", "total_supply", SUPPLY.parts, 0.02, 0.0),
    identity_sql("demand", "ind", "total_demand", DEMAND.parts, 0.10, 0.02), _Q4.replace("merged", "ind"), _Q5, _Q6])


@query("q7_summary", _IND + f"""select region, count(*) filter (status = 'PASS') as passed, count(*) as total,
    count(*) filter (status = 'WARN') as warnings from (select distinct region, "check", status from ({_ALL})) group by 1""")
def q7(spark, d):
    return Q.summarize_checks(_five_checks(indicator_table(spark, d)), KEYS)


_PROFILE = ["total_demand", "total_supply"]
_Q8 = rows_sql("(select region, count(*) as n, datediff('day', min(ts), max(ts)) as span, max(g) as gap, " + ", ".join(
    f"count(*) - count({c}) as null_{c}, avg({c}) as mean_{c}, min({c}) as min_{c}, max({c}) as max_{c}" for c in _PROFILE) + """
    from (select *, datediff('day', lag(ts) over (partition by region order by ts), ts) as g from merged) group by 1)""", "merge", {
    "rows": "n", "span_days": "span", "max_gap_days": "gap",
    **{k: v for c in _PROFILE for k, v in {f"{c}_null_pct": f"null_{c} * 100.0 / n", f"{c}_mean": f"round(mean_{c}, 1)",
       f"{c}_min": f"round(min_{c}, 1)", f"{c}_max": f"round(max_{c}, 1)"}.items()}}, pass_if("not (coalesce(gap, 0) > 31)"))


@query("q8_merge_profile", with_("merged") + _Q8)
def q8(spark, d):
    out = Q.profile_merge(shapes.merged(spark, d), KEYS, TS, _PROFILE)
    money = F.col("metric").rlike("_(mean|min|max)$")
    return settled(out.withColumn("value", F.when(money, F.round("value", 1)).otherwise(F.col("value"))), 6)


_SANITY_YOY = ["total_demand_yoy", "total_supply_yoy"]
_Q9_METRICS = {"ratio_mean": "ratio_mean", "ratio_min": "ratio_min", "ratio_max": "ratio_max", "ratio_outliers": "ratio_outliers",
               "supply_share_deviation": "s", "demand_share_deviation": "d", **{f"{c}_extreme": f"e_{c}" for c in _SANITY_YOY}}
_Q9 = rows_sql(f"""(select region, avg(supply_demand_ratio) as ratio_mean, min(supply_demand_ratio) as ratio_min,
    max(supply_demand_ratio) as ratio_max, count(*) filter (supply_demand_ratio < 0.5 or supply_demand_ratio > 2) as ratio_outliers,
    max(abs({_sum(_SIDES['supply'])} - 1)) as s, max(abs({_sum(_SIDES['demand'])} - 1)) as d, """ + ", ".join(
    f"count(*) filter (abs({c}) > 1) as e_{c}" for c in _SANITY_YOY) + " from ind group by 1)", "sanity", _Q9_METRICS,
    pass_if("ratio_outliers = 0 and " + " and ".join(f"e_{c} = 0" for c in _SANITY_YOY)))


@query("q9_indicator_sanity", _IND + _Q9)
def q9(spark, d):
    return checks_for_comparison(Q.sanity_indicators(indicator_table(spark, d), "supply_demand_ratio", _SIDES, _SANITY_YOY, keys=KEYS))


@query("q10_alignment_stats", """
    with a as (select l_suppkey as k, cast(date_trunc('month', l_shipdate) as date) as m, l_shipdate as t, l_orderkey, l_linenumber, l_extendedprice as v from lineitem),
    day_a as (select k, m, t, max(v) as v, count(*) as n from a group by 1, 2, 3),
    day_b as (select k, m, t, max(v) as v, count(*) as n from (select o_custkey % 100 as k, cast(date_trunc('month', o_orderdate) as date) as m,
        o_orderdate as t, o_totalprice as v from orders) group by 1, 2, 3),
    ma as (select k, m, cast(sum(n) as bigint) as n, arg_max(v, t) as v from day_a group by 1, 2),
    mb as (select k, m, cast(sum(n) as bigint) as n, arg_max(v, t) as v from day_b group by 1, 2),
    j as (select coalesce(ma.k, mb.k) as k, coalesce(ma.m, mb.m) as m, ma.n as na, mb.n as nb,
        ma.n is not null and mb.n is not null as common,
        ma.n is not null and mb.n is not null and coalesce(ma.v / nullif(mb.v, 0) < 0.2 or ma.v / nullif(mb.v, 0) > 5, false) as bad
        from ma full join mb on ma.k = mb.k and ma.m = mb.m)
    select k, cast(coalesce(sum(na), 0) as bigint) as raw_rows_a, cast(coalesce(sum(nb), 0) as bigint) as raw_rows_b, count(na) as months_a, count(nb) as months_b,
        count(*) filter (common) as common_months, count(*) filter (bad) as dropped_months,
        coalesce(string_agg(strftime(m, '%Y-%m'), ', ' order by m) filter (bad), '') as dropped_list,
        count(*) filter (common and not bad) as final_months, strftime(min(m) filter (common), '%Y-%m') as common_start,
        strftime(max(m) filter (common), '%Y-%m') as common_end from j group by 1""")
def q10(spark, d):
    def daily(df, key, ts, value, out):
        rows = df.groupBy(key.alias("k"), F.col(ts).cast("date").alias(TS)).agg(F.max(value).alias(out), F.count(F.lit(1)).alias("n"))
        return rows

    lines = daily(read_table(spark, d, "lineitem"), F.col("l_suppkey"), "l_shipdate", "l_extendedprice", "supplied")
    orders = daily(read_table(spark, d, "orders"), F.col("o_custkey") % 100, "o_orderdate", "o_totalprice", "ordered")
    return Q.alignment_stats(lines, orders, ["k"], TS, "supplied", "ordered", weight="n")


@query("q11_count_nonzero", "select l_returnflag, count(*) filter (l_discount <> 0) as non_zero from lineitem group by 1")
def q11(spark, d):
    return Q.count_nonzero(read_table(spark, d, "lineitem"), "l_discount", ["l_returnflag"])


_GROUPS = {"demand": ["total_demand_mom", "seg_1_mom", "seg_2_mom"], "supply": ["total_supply_mom", "src_1_mom"], "balance": ["supply_demand_ratio_mom"]}
_VOL = " union all ".join(
    f"select region, 'volatility {g}' as \"check\", arg_max(m, s) as metric, {sq('max(s)', 6, 'value')}, null as status from (" + " union all ".join(
        f"select region, '{c}' as m, stddev_samp(abs({c})) as s from ind group by 1" for c in cols) + ") group by 1"
    for g, cols in _GROUPS.items())


@query("q12_report_table", _IND + f"""select * from ({_ALL}) union all {_VOL}
    union all select region, 'forecast', 'first_mean', {sq("round(avg(total_demand) filter (up <= 12), 2)", 6)}, null from r group by 1
    union all select region, 'forecast', 'last_mean', {sq("round(avg(total_demand) filter (down <= 12), 2)", 6)}, null from r group by 1"""
    .replace("from r group", """from (select *, row_number() over (partition by region order by ts) as up,
        row_number() over (partition by region order by ts desc) as down from demand_wide) group"""))
def q12(spark, d):
    table = materialize(indicator_table(spark, d))
    edges = A.edge_means(table.filter(F.col(DEMAND.total).isNotNull()), KEYS, TS, DEMAND.total)
    return checks_for_comparison(Q.report_table(_five_checks(table), table, _GROUPS, edges, KEYS))
