"""Indicators (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.functions.scalars import select_by_pattern
from wattloom.operators import indicators as K
from wattloom.plans import flows, shapes
from wattloom.plans.shapes import DEMAND, KEYS, SUPPLY, TS

CLEAN = ["src_2", "src_3", "src_4", "src_5"]
MONEY = [*DEMAND.columns, *SUPPLY.columns]
SEASONAL = [DEMAND.total, *SUPPLY.columns]
_RATIO = "total_supply / nullif(total_demand, 0)"
_W = "(partition by region order by ts)"
_STATUS = """case when supply_demand_ratio > 0 and supply_demand_ratio <= 0.95 then 'undersupply'
    when supply_demand_ratio > 0.95 and supply_demand_ratio <= 1.05 then 'balanced'
    when supply_demand_ratio > 1.05 then 'oversupply' end as balance_status"""


def cut(c):
    return f"case when {c} is not null then greatest({c}, 0) end"


def share_sql(parts):
    base = " + ".join(f"coalesce({cut(p)}, 0)" for p in parts)
    return ", ".join(f"coalesce({cut(p)} / nullif({base}, 0), 0) as {p}_share" for p in parts)


def growth_sql(source, cols):
    """CTEs ``q, wz, pd, ch, gr`` adding winsorised growth of ``cols`` to ``source``."""
    lo_hi = ", ".join(f"quantile_cont({c}, 0.01) as lo_{c}, quantile_cont({c}, 0.99) as hi_{c}, count({c}) as n_{c}" for c in cols)
    wins = ", ".join(
        f"case when {c} is null or n_{c} < 24 then {c} else least(greatest({c}, lo_{c}), hi_{c}) end as w_{c}" for c in cols)
    pads = ", ".join(
        f"last_value(w_{c} ignore nulls) over (partition by region order by ts rows between unbounded preceding and current row) as p_{c}"
        for c in cols)
    changes = ", ".join(
        f"p_{c} / nullif(lag(p_{c}, {n}) over {_W}, 0) - 1 as {c}_{name}" for name, n in (("yoy", 12), ("mom", 1)) for c in cols)
    frame = "over (partition by region order by ts rows between 2 preceding and current row)"
    smooth = ", ".join(f"case when count({c}_yoy) {frame} = 3 then avg({c}_yoy) {frame} end as {c}_yoy_ma3" for c in cols)
    return {
        "q": f"select region, {lo_hi} from {source} group by 1",
        "wz": f"select b.*, {wins} from {source} b join q using (region)",
        "pd": f"select *, {pads} from wz",
        "ch": f"select *, {changes} from pd",
        "gr": f"select *, {smooth} from ch",
    }


def grown(cols):
    return [f"{c}_{s}" for s in ("yoy", "mom", "yoy_ma3") for c in cols]


def seasonal_sql(source, cols):
    idx = ", ".join(f"{c} / nullif(avg({c}) over (partition by region, year(ts)), 0) as {c}_seasonal" for c in cols)
    stg = ", ".join(
        f"{c}_seasonal / nullif(avg({c}_seasonal) over (partition by region, month(ts)), 0) as {c}_seasonal_strength" for c in cols)
    return {"si": f"select *, {idx} from {source}", "ss": f"select *, {stg} from si"}


@query("k1_balance", with_("merged") + f"""select region, ts, {sq("supply_demand_ratio", 6, "supply_demand_ratio")}, {_STATUS}
    from (select *, {_RATIO} as supply_demand_ratio from merged)""")
def k1(spark, d):
    out = K.balance(shapes.merged(spark, d), SUPPLY.total, DEMAND.total)
    return settled(out.select(*KEYS, TS, "supply_demand_ratio", "balance_status"), 6)


@query("k2_shares", with_("gappy") + f"select region, ts, {sqs([f'{p}_share' for p in DEMAND.parts], 6)} from (select region, ts, {share_sql(DEMAND.parts)} from gappy)")
def k2(spark, d):
    out = K.shares(shapes.demand_gappy(spark, d), DEMAND)
    return settled(out.select(*KEYS, TS, *[f"{p}_share" for p in DEMAND.parts]), 6)


@query("k2_shares_of_total", with_("gappy") + "select region, ts, " + ", ".join(
    sq(f"coalesce({p} / nullif(total_demand, 0), 0)", 6, f"{p}_share") for p in DEMAND.parts) + " from gappy")
def k2_total(spark, d):
    out = K.shares(shapes.demand_gappy(spark, d), DEMAND, of_total=True)
    return settled(out.select(*KEYS, TS, *[f"{p}_share" for p in DEMAND.parts]), 6)


_G = ["total_demand", "seg_1", "seg_2"]


@query("k3_growth", with_("gappy", **growth_sql("gappy", _G)) + f"select region, ts, {sqs(grown(_G), 6)} from gr")
def k3(spark, d):
    out = K.growth(shapes.demand_gappy(spark, d).select(*KEYS, TS, *_G), KEYS, TS)
    return settled(out.drop(*_G), 6)


@query("k4_seasonal_index", with_("merged", **seasonal_sql("merged", SEASONAL)) + f"select region, ts, {sqs([f'{c}_seasonal' for c in SEASONAL], 6)} from si")
def k4(spark, d):
    out = K.seasonal_index(shapes.merged(spark, d), KEYS, TS, SEASONAL)
    return settled(out.select(*KEYS, TS, *[f"{c}_seasonal" for c in SEASONAL]), 6)


@query("k5_seasonal_strength", with_("merged", **seasonal_sql("merged", SEASONAL)) + f"select region, ts, {sqs([f'{c}_seasonal_strength' for c in SEASONAL], 6)} from ss")
def k5(spark, d):
    out = K.seasonal_strength(K.seasonal_index(shapes.merged(spark, d), KEYS, TS, SEASONAL), KEYS, TS, SEASONAL)
    return settled(out.select(*KEYS, TS, *[f"{c}_seasonal_strength" for c in SEASONAL]), 6)


_EFFICIENCY = "total_demand / nullif(total_supply * 1.1, 0)"
_CLEAN = " + ".join(f"coalesce({c}, 0)" for c in CLEAN)


@query("k6_efficiency", with_("merged") + f"select region, ts, {sq(_EFFICIENCY, 6, 'system_efficiency')} from merged")
def k6(spark, d):
    return settled(K.efficiency(shapes.merged(spark, d), SUPPLY.total, DEMAND.total).select(*KEYS, TS, "system_efficiency"), 6)


@query("k7_clean_share", with_("merged") + f"""select region, ts, {sq(f"({_CLEAN}) / nullif(total_supply, 0)", 6, "renewable_share")},
    {sq(f"({_CLEAN}) / nullif(total_supply, 0)", 6, "clean_energy_share")} from merged""")
def k7(spark, d):
    out = K.clean_share(shapes.merged(spark, d), CLEAN, SUPPLY.total)
    return settled(out.select(*KEYS, TS, "renewable_share", "clean_energy_share"), 6)


SHARES = [f"{p}_share" for p in (*SUPPLY.parts, *DEMAND.parts)]
NUMERIC = [*MONEY, "supply_demand_ratio", *SHARES]
INDICATOR_CTES = {
    "b": f"""select *, {share_sql(SUPPLY.parts)}, {share_sql(DEMAND.parts)} from (
        select *, {_RATIO} as supply_demand_ratio from merged)""",
    **growth_sql("b", NUMERIC), **seasonal_sql("gr", SEASONAL),
    "ind": f"""select *, {_STATUS}, {_EFFICIENCY} as system_efficiency, ({_CLEAN}) / nullif(total_supply, 0) as renewable_share,
        ({_CLEAN}) / nullif(total_supply, 0) as clean_energy_share from ss""",
}
DERIVED = ["supply_demand_ratio", *SHARES, *grown(NUMERIC), *[f"{c}_seasonal" for c in SEASONAL],
           *[f"{c}_seasonal_strength" for c in SEASONAL], "system_efficiency", "renewable_share", "clean_energy_share"]


def indicator_table(spark, d):
    return K.indicators(shapes.merged(spark, d), KEYS, TS, DEMAND, SUPPLY, CLEAN)


@query("k8_indicators", with_("merged", **INDICATOR_CTES) + f"select region, ts, balance_status, {sqs(MONEY, 2)}, {sqs(DERIVED, 6)} from ind")
def k8(spark, d):
    return settled(settled(indicator_table(spark, d), 2, MONEY), 6, DERIVED)


_SIMPLE = "p / nullif(lag(p, 12) over (partition by region order by ts), 0) - 1"


@query("k9_simple_indicators", with_("merged") + f"""select region, ts, {", ".join(
    sq(f"coalesce({p} / nullif(total_supply, 0), 0)", 6, f"{p}_share") for p in SUPPLY.parts)}, {sq(_SIMPLE, 6, "total_supply_yoy")}
    from (select *, last_value(total_supply ignore nulls) over (partition by region order by ts
        rows between unbounded preceding and current row) as p from merged)""")
def k9(spark, d):
    out = K.shares(shapes.merged(spark, d), SUPPLY, of_total=True)
    out = K.growth(out, KEYS, TS, [SUPPLY.total], limit_outliers=False)
    return settled(out.select(*KEYS, TS, *[f"{p}_share" for p in SUPPLY.parts], f"{SUPPLY.total}_yoy"), 6)


@query("p21_balance_extract", with_("merged", **INDICATOR_CTES) + f"""select region, ts, {", ".join(MONEY)},
    {sq("supply_demand_ratio", 6, "supply_demand_ratio")}, balance_status from ind""")
def p21(spark, d):
    return settled(flows.extracts(indicator_table(spark, d), KEYS, TS, DEMAND, SUPPLY)["balance"], 6, ["supply_demand_ratio"])


@query("p20_indicator_columns", with_("merged", **INDICATOR_CTES) + f"select region, ts, {sqs(DERIVED, 6)} from ind")
def p20(spark, d):
    patterns = ["_ratio", "_share", "_yoy", "_mom", "_seasonal", "_efficiency"]
    return settled(select_by_pattern(indicator_table(spark, d), [*KEYS, TS], patterns), 6)
