"""Market analytics (M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.operators import market as M
from wattloom.operators.align import scenario_grid
from wattloom.operators.forecast import forecast_seasonal_naive
from wattloom.plans import flows, shapes
from wattloom.plans.shapes import DEMAND, KEYS, TS
from wattloom.session import materialize

TECHS = M.TECHS
SECTORS = list(DEMAND.parts)
WEIGHTS = (0.2, 0.4, 0.2, 0.1, 0.1)
AXES = {"tax": [0, 75, 150, 225, 300], "subsidy": [0, 0.25, 0.5, 1], "scale": [0.05, 0.5, 1, 2, 5]}
_TAX, _SUB, _SCALE = ("select unnest({}::double[]) as {}".format([float(x) for x in AXES[a]], a) for a in AXES)

_TECH = "tech_table as (select * from (values " + ", ".join(
    f"('{t}', {c}::double, {f}::double, {m}::double)" for t, (c, f, m, *_) in M.TECHNOLOGIES.items()) + ") v(tech, cost, carbon, markup))"
_LONG = f"long as (select region, ts, demand, supply, tech, generation from market unpivot include nulls (generation for tech in ({', '.join(TECHS)})))"
_PENALTY = "least(greatest((tax - 50) / 250, 0), 0.7)"


def long_rows(spark, d):
    rows = shapes.market_months(spark, d)
    return M.by_technology(rows, ["region", TS, "demand", "supply"])


def price_sql(scale="1", demand="demand", supply="supply"):
    return f"greatest(100, 100 * ({demand} / greatest({supply}, 0.0001)) * {scale})"


@query("m1_bid_price", with_("market") + f""", {_TECH}, {_LONG}
    select region, ts, tech, tax, {sq("(cost * (1 + markup) + carbon * tax) * case when tech in ('wind', 'solar') then 0.95 else 1 end", 6, "bid_price")}
    from long join tech_table using (tech), ({_TAX})""")
def m1(spark, d):
    rows = M.by_technology(scenario_grid(shapes.market_months(spark, d), {"tax": AXES["tax"]}), ["region", TS, "tax"])
    return settled(M.bid_price(rows, M.technology_table(spark)).select("region", TS, "tech", "tax", "bid_price"), 6)


@query("m2_clear_market", with_("market") + f"""select region, ts, {sq("supply - demand", 2, "gap")},
    {sq("demand / greatest(supply, 0.0001)", 6, "tightness")}, {sq(price_sql(), 4, "price")} from market""")
def m2(spark, d):
    out = M.clear_market(shapes.market_months(spark, d)).select("region", TS, "gap", "tightness", "price")
    return settled(settled(settled(out, 2, ["gap"]), 6, ["tightness"]), 4, ["price"])


@query("m3_settlement", with_("market") + f""", {_TECH}, {_LONG}, priced as (select *, {price_sql()} as price from long)
    select region, ts, tech, {sq("generation * price", 0, "revenue")}, {sq("generation * carbon", 2, "emission")},
    {sq("generation * price - generation * cost", 0, "profit")} from priced join tech_table using (tech)""")
def m3(spark, d):
    out = M.settlement(M.clear_market(long_rows(spark, d)), M.technology_table(spark)).select("region", TS, "tech", "revenue", "emission", "profit")
    return settled(settled(out, 0, ["revenue", "profit"]), 2, ["emission"])


def _realloc(source):
    f = {t: "1" for t in TECHS}
    f["thermal"] = f"(1 - {_PENALTY})"
    f["wind"] = f["solar"] = "(1 + 0.9 * greatest(subsidy, 0))"
    old = " + ".join(f"coalesce({t}, 0)" for t in TECHS)
    new = " + ".join(f"coalesce({t} * {f[t]}, 0)" for t in TECHS)
    moved = ", ".join(f"case when o > 0 then {t} * {f[t]} * case when n > 0 then o / n else 1 end else {t} end as {t}" for t in TECHS)
    return f"select * replace ({moved}) from (select *, {old} as o, {new} as n from {source})"


@query("m4_policy_reallocate", with_("market", grid=f"select * from market, ({_TAX}), ({_SUB})", moved=_realloc("grid"))
       + f"select region, ts, tax, subsidy, {sqs(TECHS, 2)} from moved")
def m4(spark, d):
    grid = scenario_grid(shapes.market_months(spark, d), {k: AXES[k] for k in ("tax", "subsidy")})
    return settled(M.policy_reallocate(grid).select("region", TS, "tax", "subsidy", *TECHS), 2, list(TECHS))


@query("m5_market_share", with_("market") + f""", {_LONG} select region, ts, tech,
    {sq("generation / greatest(demand, 0.0001)", 6, "market_share")} from long""")
def m5(spark, d):
    return settled(M.market_share(shapes.market_months(spark, d), ["region", TS]), 6)


_STEPS = f"""select region, ts, demand, supply, cast(row_number() over (partition by region order by ts) as int) as step,
    count(*) over (partition by region) as horizon from market"""


def _mix(source):
    return f"""select * exclude (w, s, h, n, t), w / (w + s + h + n + t) as share_wind, s / (w + s + h + n + t) as share_solar,
        h / (w + s + h + n + t) as share_hydro, n / (w + s + h + n + t) as share_nuclear, t / (w + s + h + n + t) as share_thermal
        from (select *, greatest(0.03, greatest(0.05, 1 - w - s - h - n) * (1 - {_PENALTY})) as t from (
            select *, least(0.35, 0.2 + cast(step as double) / horizon * 0.08 * priority) as w, least(0.30, 0.15 + cast(step as double) / horizon * 0.10 * priority) as s,
            cast(0.2 as double) as h, least(0.25, 0.2 + cast(step as double) / horizon * 0.02 * priority) as n from {source}))"""


_STEP_GRID = f"select s.*, tax, cast(1 + subsidy as double) as raw_priority, least(greatest(1 + subsidy, 0.5), 1.5) as priority, subsidy from steps s, ({_TAX}), ({_SUB})"
_MIXED = [f"share_{t}" for t in TECHS]


def _step_rows(spark, d):
    from pyspark.sql import Window
    series = Window.partitionBy("region")
    rows = shapes.market_months(spark, d).select("region", TS, "demand", "supply").withColumns({
        "step": F.row_number().over(series.orderBy(TS)), "horizon": F.count(F.lit(1)).over(series)})
    grid = scenario_grid(rows, {k: AXES[k] for k in ("tax", "subsidy")})
    return grid.withColumn("priority", 1 + F.col("subsidy"))


@query("m6_forecast_mix", with_("market", steps=_STEPS, grid=_STEP_GRID, mix=_mix("grid")) + f"select region, ts, step, tax, subsidy, {sqs(_MIXED, 6)} from mix")
def m6(spark, d):
    return settled(M.forecast_mix(_step_rows(spark, d), "horizon").select("region", TS, "step", "tax", "subsidy", *_MIXED), 6, _MIXED)


def _anchored(source, anchor):
    first = ", ".join(f"greatest({anchor}, 0) * share_{t} as {t}" for t in TECHS)
    total = " + ".join(TECHS)
    k = f"((0.35 * greatest({anchor}, 0) + 0.65 * ({total})) / greatest({total}, 0.0001))"
    pulled = ", ".join(f"{t} * {k} as {t}" for t in TECHS)
    return f"select * exclude ({', '.join(TECHS)}), {pulled} from (select *, {first} from {source})"


@query("m7_anchor_supply", with_("market", steps=_STEPS, grid=_STEP_GRID, mix=_mix("grid"), anchored=_anchored("mix", "supply"))
       + f"select region, ts, tax, subsidy, {sqs(TECHS, 2)}, {sq(' + '.join(TECHS), 2, 'supply')} from anchored")
def m7(spark, d):
    rows = _step_rows(spark, d).withColumnRenamed("supply", "anchor")
    out = M.anchor_supply(M.forecast_mix(rows, "horizon")).select("region", TS, "tax", "subsidy", *TECHS, "supply")
    return settled(out, 2, [*TECHS, "supply"])


_LAST = "select region, " + ", ".join(f"arg_max(coalesce({s}, 0), ts) as {s}" for s in SECTORS) + " from demand_wide group by 1"
_SECTOR_SUM = " + ".join(f"l.{s}" for s in SECTORS)


@query("m8_split_sectors", with_("demand_wide", last=_LAST) + "select d.region, d.ts, " + ", ".join(
    sq(f"greatest(total_demand, 0) * case when {_SECTOR_SUM} > 0 then l.{s} / ({_SECTOR_SUM}) else {w} end", 2, s)
    for s, w in zip(SECTORS, WEIGHTS)) + " from demand_wide d join last l on d.region = l.region")
def m8(spark, d):
    demand = shapes.demand_wide(spark, d)
    weights = M.sector_weights(demand, KEYS, TS, SECTORS, WEIGHTS)
    base = demand.select(*KEYS, TS, F.col(DEMAND.total).alias("demand"))
    return settled(M.split_sectors(base, weights, KEYS, SECTORS).drop("demand"), 2)


@query("m9_grow_demand", with_("market", steps=_STEPS) + f"select region, ts, step, {sq('demand * pow(1.05, step / 12.0)', 2, 'demand')} from steps")
def m9(spark, d):
    rows = _step_rows(spark, d).filter((F.col("tax") == 0) & (F.col("subsidy") == 0)).select("region", TS, "step", "demand")
    return settled(M.grow_demand(rows, ["demand"], adj=1.05), 2)


_FIXED = " + ".join(f"demand * {s}" for s in M.FIXED_SHARES.values())


@query("m10_clear_fixed", with_("market") + f"""select region, ts, {", ".join(sq(f"demand * {s}", 2, t) for t, s in M.FIXED_SHARES.items())},
    {sq(_FIXED, 2, "supply")}, {sq(f"round({_FIXED} - demand, 4)", 2, "gap")}, {sq(f"demand / greatest({_FIXED}, 0.0001)", 6, "tightness")},
    {sq(f"greatest(100, 100 * (demand / greatest({_FIXED}, 0.0001)))", 4, "price")} from market""")
def m10(spark, d):
    out = M.clear_fixed(shapes.market_months(spark, d).select("region", TS, "demand")).drop("demand")
    out = out.withColumn("gap", F.round("gap", 4))
    return settled(settled(settled(out, 2, [*TECHS, "supply", "gap"]), 6, ["tightness"]), 4, ["price"])


_PROXY = "least(greatest(100 * (greatest(demand, 1e-6) / greatest(supply, 1e-6)), 100), 5000)"
# Only half of the regions have observations in this case.
_SEEN = "case when region in ('ASIA', 'EUROPE') and month(ts) = 6 then 300.0 end"


@query("m11_scarcity_proxy", with_("market") + f"""select region, ts, {sq(f'''case when count({_SEEN}) over (partition by region) = 0
    then {_PROXY} else {_SEEN} end''', 4, "observed")} from market""")
def m11(spark, d):
    seen = F.when(F.col("region").isin("ASIA", "EUROPE") & (F.month(TS) == 6), F.lit(300.0))
    rows = shapes.market_months(spark, d).withColumn("observed", seen)
    return settled(M.scarcity_proxy(rows, KEYS).select("region", TS, "observed"), 4)


# Observed prices for calibration: the cleared price at scale 2.
_OBSERVED = f"select region, ts, {price_sql('2')} as observed from market where month(ts) <= 9"
_OBSERVED_YEAR = "select region, year(ts) as year, avg(observed) as observed from obs group by 1, 2"


def observed_prices(months):
    return M.clear_market(months.withColumn("scale", F.lit(2.0))).filter(F.month(TS) <= 9).select("region", TS, F.col("price").alias("observed"))


@query("m12_calibration_error", with_("market", obs=_OBSERVED, obs_year=_OBSERVED_YEAR) + f"""
    select region, 'monthly' as mode, {sq("coalesce(sum(pow(price - observed, 2)), 0)", 2, "sse")}, count(observed) as pairs
        from (select region, ts, {price_sql()} as price from market) left join obs using (region, ts) group by 1
    union all select region, 'annual', {sq("coalesce(sum(pow(price - observed, 2)), 0)", 2)}, count(observed)
        from (select region, year(ts) as year, avg({price_sql()}) as price from market group by 1, 2) left join obs_year using (region, year) group by 1""")
def m12(spark, d):
    months = materialize(shapes.market_months(spark, d))
    obs = observed_prices(months)
    yearly = obs.groupBy("region", F.year(TS).alias("year")).agg(F.avg("observed").alias("observed"))
    cleared = M.clear_market(months)
    both = [M.calibration_error(cleared, o, KEYS, TS, mode).withColumn("mode", F.lit(mode)) for mode, o in (("monthly", obs), ("annual", yearly))]
    return settled(both[0].unionByName(both[1]), 2)


@query("m13_calibrate_grid", with_("market", obs=_OBSERVED, errs=f"""select region, tax, subsidy, scale, coalesce(sum(pow(price - observed, 2)), 0) as sse,
        count(observed) as pairs from (select region, ts, tax, subsidy, scale, {price_sql('scale')} as price from market, ({_TAX}), ({_SUB}), ({_SCALE}))
        left join obs using (region, ts) group by 1, 2, 3, 4""") + f"""
    select region, tax, subsidy, scale, {sq("sse", 2, "sse")}, pairs from errs qualify row_number() over (partition by region order by round(sse, 6), tax, subsidy, scale) = 1""")
def m13(spark, d):
    months = materialize(shapes.market_months(spark, d))
    return settled(M.calibrate_grid(months, observed_prices(months), KEYS, TS, AXES), 2, ["sse"])


#: Axes of the search over everything that moves the price, with one round of refinement.
PRICE_GRID = {"tax": [0, 100], "sensitivity": [0.5, 1, 1.5], "price_factor": [0.8, 1, 1.2], "scale": [0.5, 1, 3]}
_BOX = [n for n in PRICE_GRID if n != "tax"]


def _annual_errors(points: str) -> str:
    """SQL for the yearly error of every point of ``points``, month by month."""
    price = "greatest(100, 100 * (demand / greatest(supply, 0.0001)) * sensitivity * price_factor * scale)"
    return f"""select region, sensitivity, price_factor, scale, sum(pow(price - observed, 2)) as sse, count(observed) as pairs, sum(observed * observed) as total
        from (select p.region, year(ts) as year, sensitivity, price_factor, scale, avg({price}) as price from {points} p join market m on m.region = p.region group by all)
        join obs_year using (region, year) group by all"""


_LEAST = "qualify row_number() over (partition by region order by round(sse / total, 10), sensitivity, price_factor, scale) = 1"


@query("m13_calibrate_box", with_(
    "market", obs=_OBSERVED, obs_year=_OBSERVED_YEAR,
    points="select region, a, b, c from (select distinct region from market), " + ", ".join(f"(select unnest({[float(x) for x in PRICE_GRID[n]]}::double[]) as {c})" for n, c in zip(_BOX, "abc")),
    grid="select region, a as sensitivity, b as price_factor, c as scale from points", errs=_annual_errors("grid"), start=f"select * from errs {_LEAST}",
    box="select distinct region, " + ", ".join(
        f"least(greatest({n} + {c} * {(max(PRICE_GRID[n]) - min(PRICE_GRID[n])) / (len(PRICE_GRID[n]) - 1) / 4}, {min(PRICE_GRID[n])}), {max(PRICE_GRID[n])})::double as {n}"
        for n, c in zip(_BOX, "xyz")) + " from start, " + ", ".join(f"(select unnest(range(-4, 5)) as {c})" for c in "xyz"),
    near=_annual_errors("box")) + f"""select region, 0::double as tax, sensitivity, price_factor, scale, {sq("sse", 2, "sse")}, pairs from near {_LEAST}""")
def m13_box(spark, d):
    months = materialize(shapes.market_months(spark, d))
    yearly = observed_prices(months).groupBy("region", F.year(TS).alias("year")).agg(F.avg("observed").alias("observed"))
    return settled(M.calibrate_grid(months, yearly, KEYS, TS, PRICE_GRID, mode="annual", rounds=1), 2, ["sse"])


@query("m13_calibrate_exact", with_(
    "market", obs=_OBSERVED, pairs="select region, 100 * (demand / greatest(supply, 0.0001)) as price, observed + 40 as seen from market join obs using (region, ts)",
    turns="select distinct region, greatest(100 / price, 0.05) as low from pairs where price > 0 and 100 / price < 5 union select distinct region, 0.05 from pairs",
    ranges="select region, low, lead(low, 1, 5) over (partition by region order by low) as high from turns",
    sums="""select r.region, low, high, sum(case when 100 / price <= low then price * price else 0 end) as a, sum(case when 100 / price <= low then price * seen else 0 end) as b
        from ranges r join pairs p using (region) group by all""",
    ends="select region, case when a > 0 then least(greatest(b / a, low), high) else low end as scale from sums",
    errs="""select e.region, e.scale, sum(pow(greatest(100, price * e.scale) - seen, 2)) as sse, count(*) as pairs, sum(seen * seen) as total
        from ends e join pairs p using (region) group by all""")
       + f"""select region, {sq("scale", 6, "scale")}, {sq("sse", 2, "sse")}, pairs from errs qualify row_number() over (partition by region order by round(sse / total, 10), scale) = 1""")
def m13_exact(spark, d):
    months = materialize(shapes.market_months(spark, d))
    above = observed_prices(months).withColumn("observed", F.col("observed") + 40)
    return settled(settled(M.calibrate_exact(months, above, KEYS, TS, 0.05, 5.0), 6, ["scale"]), 2, ["sse"])


_NEW = " + ".join(TECHS)


@query("m14_compare_scenarios", with_("market", grid=f"select * from market, ({_TAX}), ({_SUB}), ({_SCALE})", moved=_realloc("grid")) + f"""
    select region, ts, tax, subsidy, scale, {sq("price", 4, "price")}, {sq("coalesce(renewables * 100 / nullif(total, 0), 0)", 6, "renewable_share")},
        {sq("total - demand", 2, "balance")}, {sq("abs(price - 376.28)", 4, "objective")}
    from (select *, {price_sql('scale', supply='total')} as price from (
        select *, {' + '.join(f'coalesce({t}, 0)' for t in TECHS)} as total, {' + '.join(f'coalesce({t}, 0)' for t in M.CLEAN)} as renewables from moved))""")
def m14(spark, d):
    out = M.compare_scenarios(shapes.market_months(spark, d), AXES).select(
        "region", TS, "tax", "subsidy", "scale", "price", "renewable_share", "balance", "objective")
    return settled(settled(settled(out, 4, ["price", "objective"]), 6, ["renewable_share"]), 2, ["balance"])


@query("m14_forecast_months", with_("market", steps=_STEPS, grid=_STEP_GRID, mix=_mix("grid"), anchored=_anchored("mix", "supply"), moved=_realloc("anchored"))
       + f"""select region, ts, tax, subsidy, {sqs(TECHS, 2)}, {sq(_NEW, 2, "supply")}, {sq(price_sql(supply='(' + _NEW + ')'), 4, "price")} from moved""")
def m14_forecast(spark, d):
    rows = _step_rows(spark, d).withColumnRenamed("supply", "anchor")
    out = flows.market_forecast(rows, "horizon").select("region", TS, "tax", "subsidy", *TECHS, "supply", "price")
    return settled(settled(out, 2, [*TECHS, "supply"]), 4, ["price"])


@query("m15_class_breaks", with_("panel_annual") + """select region, nation, year, case when m1 is null then null when hi <= lo then 7
    else cast(least(floor(least(greatest((m1 - lo) / (hi - lo), 0), 1) * 14), 13) as int) end as class
    from panel_annual, (select min(m1) as lo, max(m1) as hi from panel_annual)""")
def m15(spark, d):
    return M.class_breaks(shapes.panel_annual(spark, d).select("region", "nation", "year", "m1"), "m1").drop("m1")
