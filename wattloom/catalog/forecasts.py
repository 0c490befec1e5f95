"""Forecasting and disaggregation (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.operators import forecast as FC
from wattloom.operators import stats as A
from wattloom.plans import flows, shapes
from wattloom.plans.shapes import DEMAND, KEYS, TS
from wattloom.session import materialize

STEPS = 48
#: The last complete year of orders, and the last to forecast.
HIST_LAST, LAST = 2000, 2004
TARGETS = list(range(HIST_LAST + 1, LAST + 1))
BOUNDS = ((0.10, 0.95), (0.01, 0.80))
SINCE = 1996
CLIM = (1996, 2000)


def _naive(source, value, steps):
    """CTE body of the seasonal naive path of ``value`` in ``source``."""
    return f"""select region, cast(date_trunc('month', last + to_months(cast(h as int))) as date) as ts, y + ceil(h / m) * drift as forecast
        from (select *, unnest(generate_series(m + 1 - r, {steps}, m)) as h from (
            select *, coalesce(avg(d) over (partition by region), 0) as drift, max(ts) over (partition by region) as last,
                least(count(*) over (partition by region), 12) as m from (
                select region, ts, {value} as y, row_number() over (partition by region order by ts desc) as r,
                    {value} - lag({value}, 12) over (partition by region order by ts) as d from {source} where {value} is not null))
            where r <= m and m + 1 - r <= {steps})"""


def _trend(x, y, source, keys, targets):
    """CTE body of the line through ``y`` over ``x`` at the target years."""
    return f"""select {keys}, cast(t as int) as {x}, case when n = 0 then 0.0 when n < 4 then last_y else coalesce(my + b * (t - mx), last_y) end as prediction
        from (select {keys}, count({y}) as n, arg_max({y}, {x}) filter ({y} is not null) as last_y,
            regr_slope({y}, {x}) as b, regr_avgx({y}, {x}) as mx, regr_avgy({y}, {x}) as my from {source} group by {keys}) f,
        (select unnest({list(targets)}) as t)"""


@query("f1_forecast_sarima")
def f1(spark, d):
    return FC.forecast_sarima(shapes.demand_wide(spark, d), KEYS, TS, DEMAND.total, 120)


@query("f1_forecast_calendar", with_("demand_wide") + """select region, cast(last + to_months(cast(h as int)) as date) as ts, true as known
    from (select region, max(ts) as last from demand_wide group by 1), (select unnest(generate_series(1, 120)) as h)""")
def f1_calendar(spark, d):
    path = FC.forecast_sarima(shapes.demand_wide(spark, d), KEYS, TS, DEMAND.total, 120)
    return path.select(*KEYS, TS, (F.col("forecast").isNotNull() & ~F.isnan("forecast")).alias("known"))


#: Coefficients whose path SQL can follow: the filter of the model, month by month, over lists.
GIVEN = (0.4, -0.3, -0.5, -0.6)


def _given_path(source: str, value: str, steps: int) -> dict[str, str]:
    """CTEs of the forecast of ``value`` under ``GIVEN``: filter the doubly differenced months, then add them up again."""
    ar, sar, ma, sma = GIVEN
    n = FC.STATES
    past, shock = [0.0] * n, [0.0] * n
    past[0], past[11], past[12], shock[0], shock[1], shock[12], shock[13] = ar, sar, -ar * sar, 1.0, ma, sma, ma * sma
    inner = f"p[(k // {n} + 1) * {n} + k % {n} + 2] - p[(k // {n} + 1) * {n} + 1] * p[(k % {n} + 1) * {n} + 1] / p[1]"
    shared = f"{shock}[k // {n} + 1] * {shock}[k % {n} + 1]"
    return {
        "series": f"select region, max(ts) as last, list(cast({value} as double) order by ts) as y from {source} where {value} is not null group by region",
        "changes": "select region, list_transform(range(14, len(y) + 1), lambda i: y[i] - y[i - 1] - y[i - 12] + y[i - 13]) as w from series",
        "filtered": f"""with recursive run as (select region, w, 0 as t, list_transform(range({n}), lambda k: 0.0::double) as a,
                list_transform(range({n * n}), lambda k: case when k // {n} = k % {n} then 1e6::double else 0.0::double end) as p from changes
            union all select region, w, t + 1,
                list_transform(range({n}), lambda k: {past}[k + 1] * w[t + 1] +
                    case when k < {n - 1} then a[k + 2] + p[(k + 1) * {n} + 1] / p[1] * (w[t + 1] - a[1]) else 0 end),
                list_transform(range({n * n}), lambda k: {shared} + case when k // {n} < {n - 1} and k % {n} < {n - 1} then {inner} else 0 end)
            from run where t < len(w)) select region, a from run where t = len(w)""",
        "path": f"""with recursive run as (select region, 0 as h, a, list_slice(y, len(y) - 12, len(y)) as tail from filtered join series using (region)
            union all select region, h + 1, list_transform(range({n}), lambda k: {past}[k + 1] * a[1] + case when k < {n - 1} then a[k + 2] else 0 end),
                list_append(list_slice(tail, 2, 13), a[1] + tail[13] + tail[2] - tail[1]) from run where h < {steps})
            select region, h, tail[13] as forecast from run where h > 0""",
    }


@query("f1_path_given", with_("demand_wide", **_given_path("demand_wide", "total_demand", 36)) + f"""
    select region, cast(last + to_months(cast(h as int)) as date) as ts, {sq("forecast / 1000", 0, "thousands")} from path join series using (region)""")
def f1_given(spark, d):
    path = FC.forecast_sarima(shapes.demand_wide(spark, d), KEYS, TS, DEMAND.total, 36, given=GIVEN)
    return settled(path.select(*KEYS, TS, (F.col("forecast") / 1000).alias("thousands")), 0)


@query("f2_seasonal_naive", with_("gappy", fc=_naive("gappy", "total_demand", 120)) + f"select region, ts, {sq('forecast', 2, 'forecast')} from fc")
def f2(spark, d):
    return settled(FC.forecast_seasonal_naive(shapes.demand_gappy(spark, d), KEYS, TS, DEMAND.total, 120), 2)


@query("f3_trend_predict", with_("panel_annual", tr=_trend("year", "m1", "panel_annual", "region, nation", range(2001, 2006)))
       + f"select region, nation, year, {sq('prediction', 2, 'prediction')} from tr")
def f3(spark, d):
    return settled(FC.trend_predict(shapes.panel_annual(spark, d), ["region", "nation"], "year", "m1", range(2001, 2006)), 2)


_OBS = "select * from parent_monthly"
_PATH = f"""select region, ts, m1 from obs union all select region, ts, forecast from fc
    join (select region, max(ts) as seen from obs group by 1) using (region) where ts > seen and ts < date '{LAST + 1}-01-01'"""
_TOTALS = "select region, cast(year(ts) as int) as year, coalesce(sum(m1), 0) as m1_annual from path group by 1, 2"
_SHARES = """select region, part, year, share from (select region, cast(year(ts) as int) as year,
        coalesce(sum(m2), 0) / nullif(coalesce(sum(m1), 0), 0) as m2, coalesce(sum(m3), 0) / nullif(coalesce(sum(m1), 0), 0) as m3
        from obs group by 1, 2) unpivot include nulls (share for part in (m2, m3))"""
_TARGET = f"""select region, year, m1_annual, m1_annual * a * k as m2_annual, m1_annual * b * k as m3_annual from (
        select *, case when a + b > 0.98 then 0.98 / (a + b) else 1 end as k from (
            select region, year, max(case when part = 'm2' then least(greatest(prediction, {BOUNDS[0][0]}), {BOUNDS[0][1]}) end) as a,
                max(case when part = 'm3' then least(greatest(prediction, {BOUNDS[1][0]}), {BOUNDS[1][1]}) end) as b from tr group by 1, 2)
        join totals using (region, year))"""
FUTURE = {
    "obs": _OBS, "fc": _naive("obs", "m1", STEPS), "path": _PATH, "totals": _TOTALS, "shares": _SHARES,
    "tr": _trend("year", "share", "shares", "region, part", TARGETS), "future": _TARGET,
}


def _observed(spark, d):
    # Read several times below: the orders are aggregated once and the panel written.
    return materialize(shapes.parent_monthly(spark, d))


def _path(observed):
    fc = FC.forecast_seasonal_naive(observed, KEYS, TS, "m1", STEPS).withColumnRenamed("forecast", "m1")
    return FC.splice(observed.select(*KEYS, TS, "m1"), fc, KEYS, TS, LAST)


def _future(observed, path):
    return FC.forecast_share_targets(observed, A.annual_sum(path, KEYS, TS, ["m1"]), KEYS, TS, "m1", ["m2", "m3"], TARGETS, BOUNDS)


_ANNUAL = ["m1_annual", "m2_annual", "m3_annual"]


@query("f4_share_targets", with_("parent_monthly", **FUTURE) + f"select region, year, {sqs(_ANNUAL, 1)} from future")
def f4(spark, d):
    observed = _observed(spark, d)
    return settled(_future(observed, _path(observed)), 1)


ENTITY = {
    "past": f"""select region, cast(year(ts) as int) as year, coalesce(sum(m1), 0) as m1_annual, coalesce(sum(m2), 0) as m2_annual,
        coalesce(sum(m3), 0) as m3_annual from obs where ts < date '{HIST_LAST + 1}-01-01' group by 1, 2""",
    "parent": "select * from past union all select region, year, m1_annual, m2_annual, m3_annual from future",
    "parent_long": "select region, year, metric, parent from parent unpivot include nulls (parent for metric in (m1_annual, m2_annual, m3_annual))",
    "hist": f"""select region, nation, year, coalesce(m1, 0) as m1_annual, coalesce(m2, 0) as m2_annual, coalesce(m3, 0) as m3_annual
        from panel_annual where year <= {HIST_LAST}""",
    "ent": f"""select region, nation, metric, year, case when year >= {SINCE} then value / nullif(parent, 0) end as share
        from hist unpivot include nulls (value for metric in (m1_annual, m2_annual, m3_annual))
        left join parent_long using (region, year, metric)""",
    "etr": _trend("year", "share", "ent", "region, nation, metric", TARGETS),
    "epos": "select * replace (greatest(prediction, 0) as prediction) from etr",
    "enorm": """select *, case when s <= 0 then 1.0 / n else prediction / nullif(s, 0) end as sh from epos join (
        select region, metric, year, sum(prediction) as s, count(*) as n from epos group by 1, 2, 3) using (region, metric, year)""",
    "efut": """select region, nation, year, max(case when metric = 'm1_annual' then sh * parent end) as m1_annual,
        max(case when metric = 'm2_annual' then sh * parent end) as m2_annual, max(case when metric = 'm3_annual' then sh * parent end) as m3_annual
        from enorm left join parent_long using (region, year, metric) group by 1, 2, 3""",
}


@query("f5_entity_shares", with_("panel_annual", "parent_monthly", **FUTURE, **ENTITY) + f"select region, nation, year, {sqs(_ANNUAL, 1)} from efut")
def f5(spark, d):
    annual, observed = shapes.annual_and_monthly(spark, d)
    future = _future(observed, _path(observed))
    past = A.annual_sum(observed, KEYS, TS, ["m1", "m2", "m3"]).filter(F.col("year") <= HIST_LAST)
    hist = annual.select("region", "nation", "year", *[F.coalesce(m, F.lit(0.0)).alias(f"{m}_annual") for m in ("m1", "m2", "m3")])
    out = FC.forecast_entity_shares(hist.filter(F.col("year") <= HIST_LAST), past.unionByName(future), KEYS, "nation", _ANNUAL, TARGETS, SINCE)
    return settled(out, 1)


@query("f6_splice", with_("parent_monthly", **{k: FUTURE[k] for k in ("obs", "fc", "path")}) + f"select region, ts, {sq('m1', 2, 'm1')} from path")
def f6(spark, d):
    return settled(_path(_observed(spark, d)), 2)


CLIM_CTES = {
    "wts": f"""select region, month(ts) as month, case when coalesce(s2, 0) <= 0 then 1/12.0 else m2 / nullif(s2, 0) end as w2,
        case when coalesce(s3, 0) <= 0 then 1/12.0 else m3 / nullif(s3, 0) end as w3 from (
        select *, sum(m2) over (partition by region, year(ts)) as s2, sum(m3) over (partition by region, year(ts)) as s3 from obs)
        where year(ts) between {CLIM[0]} and {CLIM[1]}""",
    "clim": """select region, cast(month as int) as month, a2 / nullif(sum(a2) over (partition by region), 0) as w_m2,
        a3 / nullif(sum(a3) over (partition by region), 0) as w_m3
        from (select region, month, avg(w2) as a2, avg(w3) as a3 from wts group by 1, 2)""",
}


@query("f7_climatology", with_("parent_monthly", obs=_OBS, **CLIM_CTES) + f"select region, month, {sqs(['w_m2', 'w_m3'], 8)} from clim")
def f7(spark, d):
    return settled(FC.climatology(_observed(spark, d), KEYS, TS, ["m2", "m3"], CLIM), 8)


MONTHS = {
    **CLIM_CTES,
    "months": f"""select region, ts, m1, m2, m3 from obs union all
        select p.region, p.ts, p.m1, w_m2 * m2_annual, w_m3 * m3_annual from path p join future f on p.region = f.region and year(p.ts) = f.year
        left join clim c on p.region = c.region and month(p.ts) = c.month anti join obs o on p.region = o.region and p.ts = o.ts""",
}


@query("f8_monthly_targets", with_("parent_monthly", **FUTURE, **MONTHS) + f"select region, ts, {sqs(['m1', 'm2', 'm3'], 1)} from months")
def f8(spark, d):
    observed = _observed(spark, d)
    path = _path(observed)
    clim = FC.climatology(observed, KEYS, TS, ["m2", "m3"], CLIM)
    return settled(FC.monthly_targets(observed, path, _future(observed, path), clim, KEYS, TS, "m1", ["m2", "m3"]), 1)


def _split(annual, months, extra=""):
    share = lambda m: f"coalesce(a.{m}_annual / nullif(s.{m}, 0), 0)"
    values = ", ".join(sq(f"{share(m)} * p.{m}", 1, m) for m in ("m1", "m2", "m3"))
    return f"""select a.region, a.nation, make_date(year(p.ts), month(p.ts), 1) as ts, a.year, cast(month(p.ts) as int) as month, {extra}{values}
        from {annual} a join (select region, year, sum(m1_annual) as m1, sum(m2_annual) as m2, sum(m3_annual) as m3 from {annual} group by 1, 2) s
        on a.region = s.region and a.year = s.year join {months} p on a.region = p.region and a.year = year(p.ts)"""


@query("f9_disaggregate", with_("panel_annual", "parent_monthly", ann="select region, nation, year, m1 as m1_annual, m2 as m2_annual, m3 as m3_annual from panel_annual")
       + _split("ann", "parent_monthly"))
def f9(spark, d):
    annual, monthly = shapes.annual_and_monthly(spark, d)
    annual = annual.select("region", "nation", "year", *[F.col(m).alias(f"{m}_annual") for m in ("m1", "m2", "m3")])
    out = FC.disaggregate(annual, monthly, KEYS, "nation", TS, {f"{m}_annual": m for m in ("m1", "m2", "m3")})
    return settled(out, 1)


@query("f10_build_panel", with_("panel_annual", "parent_monthly", **FUTURE, **ENTITY, **MONTHS, everything=f"""
    select *, 'historical_disaggregated' as data_flag from hist union all select region, nation, year, m1_annual, m2_annual, m3_annual,
    'forecast_share_based' from efut""") + _split("everything", "months", "a.data_flag, "))
def f10(spark, d):
    annual, observed = shapes.annual_and_monthly(spark, d)
    annual = annual.select("region", "nation", "year", *[F.col(m).alias(f"{m}_annual") for m in ("m1", "m2", "m3")])
    out = flows.build_panel(
        annual, observed, FC.forecast_seasonal_naive(observed, KEYS, TS, "m1", STEPS), KEYS, "nation", TS, "m1", ["m2", "m3"],
        HIST_LAST, LAST, SINCE, CLIM, BOUNDS)
    return settled(out, 1)
