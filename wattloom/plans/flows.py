"""End-to-end flows composed from the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import (
    calendar_features, drop_header_rows, filter_years, flag, map_codes, parse_ts, row_sum, to_double,
)
from wattloom.model import Family
from wattloom.operators.align import outer_on_month, union_by_name
from wattloom.operators.forecast import (
    CLIMATOLOGY_YEARS, HISTORICAL, PROJECTED, SHARE_BOUNDS, SHARE_HISTORY_FROM, climatology, disaggregate,
    forecast_entity_shares, forecast_share_targets, monthly_targets, splice,
)
from wattloom.operators.impute import (
    fill_by_accounting, ml_fill, non_negative, scale_parts, series_features, total_from_parts,
)
from wattloom.operators.market import anchor_supply, clear_market, forecast_mix, policy_reallocate
from wattloom.operators.stats import annual_sum
from wattloom.session import materialize

DEMAND_LAGS = (1, 2, 3, 6, 12)
SUPPLY_LAGS = (1, 2, 3, 12)

# Modelling window and header literal of the raw demand table.
MODEL_YEARS = (2010, 2025)
HEADER_LITERAL = "date"


def load_demand(raw: DataFrame, ts: str, fam: Family, years=MODEL_YEARS) -> DataFrame:
    """Typed rows of a raw text table: header repeats, bad dates and other years go."""
    rows = parse_ts(drop_header_rows(raw, ts, HEADER_LITERAL), ts)
    return filter_years(rows.withColumns({c: to_double(c) for c in fam.columns}), ts, *years)


def clean_demand(df: DataFrame, keys, ts, fam: Family, trees: int | None = None, lag_steps=DEMAND_LAGS) -> DataFrame:
    """Accounting fill, learned fill of the rest, parts scaled to the total."""
    rows = fill_by_accounting(calendar_features(df, ts), fam)
    featured = series_features(rows, keys, ts, fam.columns, lag_steps)
    filled = scale_parts(ml_fill(featured, keys, ts, fam.columns, lag_steps, trees), fam)
    return filled.select(*keys, ts, *fam.columns)


def clean_supply(df: DataFrame, keys, ts, fam: Family, trees: int | None = None, lag_steps=SUPPLY_LAGS) -> DataFrame:
    """As for demand, after total fallback and de-duplication, negatives cut last."""
    whole = total_from_parts(df, fam)
    # Of a date's duplicates the one with the fewest unknown values stays, then the smallest, whatever the input order.
    unknown = sum((F.col(c).isNull().cast("int") for c in fam.columns), F.lit(0)).alias("__unknown")
    single = whole.groupBy(*keys, ts).agg(F.min(F.struct(unknown, *fam.columns)).alias("__row")).select(*keys, ts, "__row.*").drop("__unknown")
    return non_negative(clean_demand(single, keys, ts, fam, trees, lag_steps), fam.columns)


def merge_panels(demand: DataFrame | None, supply: DataFrame | None, keys, ts) -> DataFrame:
    return outer_on_month(demand, supply, keys, ts)


def build_panel(
    annual_hist: DataFrame, monthly_hist: DataFrame, total_forecast: DataFrame, keys, entity: str, ts: str,
    total: str, parts: Sequence[str], hist_last: int, last_year: int,
    since: int = SHARE_HISTORY_FROM, clim_years=CLIMATOLOGY_YEARS, bounds=SHARE_BOUNDS, codes: DataFrame | None = None,
) -> DataFrame:
    """Monthly values of every entity, past and projected.

    ``annual_hist`` has ``(keys, entity, year, <metric>_annual)`` up to
    ``hist_last``, its last complete year; ``monthly_hist`` the parent's months,
    all of which are kept; ``total_forecast`` its total ``(keys, ts, forecast)``,
    used after the last month of each series.  All three are panels, as long as
    the calendar, and read several times: give written tables.
    """
    metrics = [total, *parts]
    annual_names = [f"{m}_annual" for m in metrics]
    targets = list(range(hist_last + 1, last_year + 1))
    hist = annual_hist.filter(F.col("year") <= hist_last).fillna(0.0, annual_names)
    if codes is not None:
        hist = map_codes(hist, codes, entity)
    extra = [c for c in hist.columns if c not in (*keys, entity, "year", *annual_names)]
    names = hist.select(*keys, entity, *extra).distinct() if extra else None

    observed = monthly_hist
    path = splice(observed.select(*keys, ts, total), total_forecast.withColumnRenamed("forecast", total), keys, ts, last_year)
    parent_future = materialize(forecast_share_targets(
        observed, annual_sum(path, keys, ts, [total]), keys, ts, total, parts, targets, bounds
    ))
    parent_past = annual_sum(observed, keys, ts, metrics).filter(F.col("year") <= hist_last)
    parent_annual = union_by_name(parent_past, parent_future)
    future = forecast_entity_shares(hist, parent_annual, keys, entity, annual_names, targets, since)
    if names is not None:
        future = future.join(names, [*keys, entity])
    everything = union_by_name(hist, materialize(future)).withColumn("data_flag", flag(F.col("year") <= hist_last, HISTORICAL, PROJECTED))
    months = monthly_targets(
        observed, path, parent_future, climatology(observed, keys, ts, parts, clim_years), keys, ts, total, parts
    )
    return disaggregate(everything, months, keys, entity, ts, dict(zip(annual_names, metrics)))


def market_forecast(df: DataFrame, limit: int | str, policy: bool = True) -> DataFrame:
    """Forecast months ``(step, demand, anchor, parameters…)`` through the market.

    Mix, anchoring and clearing, then policy dispatch a second time on the
    anchored generation, as the live policy switch does.
    """
    out = anchor_supply(forecast_mix(df, limit, policy=policy))
    if policy:
        out = policy_reallocate(out).withColumn("supply", row_sum(["thermal", "hydro", "nuclear", "wind", "solar"]))
    return clear_market(out)


def extracts(indicators: DataFrame, keys, ts, demand: Family, supply: Family) -> Mapping[str, DataFrame]:
    """The demand, generation and balance tables cut from the indicator table."""
    derived = ["supply_demand_ratio", "balance_status"]
    pick = lambda cols: indicators.select(*keys, ts, *[c for c in cols if c in indicators.columns])
    return {
        "demand": pick(demand.columns), "generation": pick(supply.columns),
        "balance": pick([*demand.columns, *supply.columns, *derived]),
    }
