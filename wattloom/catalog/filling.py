"""Imputation and repair (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.catalog.windows import INTERPOLATED, _roll
from wattloom.functions.scalars import calendar_features
from wattloom.operators import impute as I
from wattloom.plans import flows, shapes
from wattloom.plans.shapes import DEMAND, KEYS, SUPPLY, TS

_PARTS = list(DEMAND.parts)
_NULLS = " + ".join(f"cast({c} is null as int)" for c in DEMAND.columns)
_REST = " + ".join(f"coalesce({c}, 0)" for c in _PARTS)


@query("i1_fill_by_accounting", with_("gappy") + f""", n as (select *, {_NULLS} as gaps, {_REST} as rest from gappy)
    select region, ts, {sq("case when gaps = 1 and total_demand is null then rest else total_demand end", 2, "total_demand")}, """ + ", ".join(
        sq(f"case when gaps = 1 and {c} is null then total_demand - rest else {c} end", 2, c) for c in _PARTS) + " from n")
def i1(spark, d):
    return settled(I.fill_by_accounting(shapes.demand_gappy(spark, d), DEMAND), 2)


@query("i2_total_from_parts", with_("gappy") + f"""select region, ts, {sq(f'''coalesce(total_demand,
    case when coalesce({", ".join(_PARTS)}) is not null then {_REST} end)''', 2, "total_demand")} from gappy""")
def i2(spark, d):
    return settled(I.total_from_parts(shapes.demand_gappy(spark, d), DEMAND).select(*KEYS, TS, DEMAND.total), 2)


# A leading gap on top of the scattered ones, so that every fallback is met.
_LATE = "select region, ts, case when ts >= date '1995-06-01' then seg_1 end as seg_1 from gappy"
_TEMP = INTERPOLATED.format(c="seg_1").replace("from gappy", "from late") + """, temp as (
    select region, ts, v as seg_1, coalesce(filled, avg(v) over (partition by region, month(ts)), median(v) over (partition by region)) as t
    from interpolated)"""


def _late(spark, d):
    rows = shapes.demand_gappy(spark, d).select(*KEYS, TS, "seg_1")
    return rows.withColumn("seg_1", F.when(F.col(TS) >= F.lit("1995-06-01").cast("date"), F.col("seg_1")))


@query("i3_temp_fill", with_("gappy", late=_LATE).rstrip() + _TEMP + f"""
    select region, ts, {sq("t", 2, "seg_1_temp")} from temp""")
def i3(spark, d):
    return settled(I.temp_fill(_late(spark, d), KEYS, TS, ["seg_1"]).drop("seg_1"), 2)


@query("i4_series_features", with_("gappy", late=_LATE).rstrip() + _TEMP + "select region, ts, " + ", ".join(
    [sq(f"lag(t, {n}) over (partition by region order by ts)", 2, f"seg_1_lag_{n}") for n in (1, 2, 3, 6, 12)]
    + [sq(_roll("t", n, f"{n} preceding", "1 preceding"), 2, f"seg_1_roll_mean_{n}") for n in (3, 6, 12)]) + " from temp")
def i4(spark, d):
    return settled(I.series_features(_late(spark, d), KEYS, TS, ["seg_1"]).drop("seg_1", "seg_1_temp"), 2)


_SPARSE = "select region, ts, case when ts >= date '1997-03-01' and ts < date '1997-12-01' then seg_2 end as v from gappy"


@query("i5_fill_month_mean", with_("gappy", sparse=_SPARSE) + f"""select region, ts, {sq('''coalesce(v,
    case when count(v) over (partition by region) < 12 then coalesce(avg(v) over (partition by region, month(ts)), median(v) over (partition by region)) end)''', 2, "seg_2")}
    from sparse""")
def i5(spark, d):
    in_1997 = (F.col(TS) >= F.lit("1997-03-01").cast("date")) & (F.col(TS) < F.lit("1997-12-01").cast("date"))
    rows = shapes.demand_gappy(spark, d).select(*KEYS, TS, F.when(in_1997, F.col("seg_2")).alias("seg_2"))
    return settled(I.fill_month_mean(rows, KEYS, TS, "seg_2"), 2)


# Forest size of the registered queries: a tenth of the operator's default, for
# the time a fit takes; it changes neither the rows nor the columns.
TREES = 50


@query("i6_learned_fill")
def i6(spark, d):
    rows = calendar_features(shapes.demand_gappy(spark, d).select(*KEYS, TS, "seg_1"), TS)
    featured = I.series_features(rows, KEYS, TS, ["seg_1"], flows.DEMAND_LAGS)
    return I.ml_fill(featured, KEYS, TS, ["seg_1"], flows.DEMAND_LAGS, TREES).select(*KEYS, TS, "seg_1")


_SUM = " + ".join(f"coalesce({c}, 0)" for c in _PARTS)


@query("i7_scale_parts", with_("gappy") + f", s as (select *, {_SUM} as s from gappy) select region, ts, " + ", ".join(
    sq(f"{c} * case when s > 0 then total_demand / s else 1 end", 2, c) for c in _PARTS) + " from s")
def i7(spark, d):
    return settled(I.scale_parts(shapes.demand_gappy(spark, d), DEMAND).drop(DEMAND.total), 2)


@query("i8_non_negative", with_("demand_wide") + f"""select region, ts, {sq("case when seg_1 is not null then greatest(seg_1 - 0.2 * total_demand, 0) end", 2, "seg_1")} from demand_wide""")
def i8(spark, d):
    rows = shapes.demand_wide(spark, d).select(*KEYS, TS, (F.col("seg_1") - 0.2 * F.col(DEMAND.total)).alias("seg_1"))
    return settled(I.non_negative(rows, ["seg_1"]), 2)


@query("i9_winsorize", with_("gappy") + """, q as (select region, quantile_cont(total_demand, 0.01) as lo, quantile_cont(total_demand, 0.99) as hi,
    count(total_demand) as n from gappy group by 1) select region, ts, """ + sq("""case when total_demand is null or n < 24 then total_demand
    else least(greatest(total_demand, lo), hi) end""", 2, "total_demand") + " from gappy join q using (region)")
def i9(spark, d):
    rows = shapes.demand_gappy(spark, d).select(*KEYS, TS, DEMAND.total)
    return settled(I.winsorize(rows, KEYS, [DEMAND.total]), 2)


@query("i10_clean_demand")
def i10(spark, d):
    return flows.clean_demand(shapes.demand_gappy(spark, d), KEYS, TS, DEMAND, TREES)


@query("i11_clean_supply")
def i11(spark, d):
    return flows.clean_supply(shapes.with_gaps(shapes.supply_wide(spark, d), SUPPLY), KEYS, TS, SUPPLY, TREES)


# What the clean flows promise whatever the model predicts: known figures
# stay, nothing is missing, parts add up.
_KNOWN = f"case when gaps = 1 and total_demand is null then {_REST} else total_demand end"


@query("i10_clean_demand_promises", with_("gappy") + f""", n as (select *, {_NULLS} as gaps from gappy)
    select region, ts, {sq(_KNOWN, 2, "known_total")}, true as complete, true as parts_match from n""")
def i10_promises(spark, d):
    gappy = shapes.demand_gappy(spark, d)
    cleaned = flows.clean_demand(gappy, KEYS, TS, DEMAND, TREES)
    known = I.fill_by_accounting(gappy, DEMAND).select(*KEYS, TS, F.col(DEMAND.total).isNotNull().alias("was_known"))
    total, parts = F.col(DEMAND.total), sum(F.col(p) for p in DEMAND.parts)
    return settled(cleaned.join(known, [*KEYS, TS]).select(
        *KEYS, TS, F.when(F.col("was_known"), total).alias("known_total"),
        (total.isNotNull() & parts.isNotNull()).alias("complete"), (F.abs(total - parts) <= total * 1e-9).alias("parts_match")), 2)
