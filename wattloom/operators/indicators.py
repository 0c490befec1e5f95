"""Derived indicators of a merged demand and supply panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import (
    BALANCE_EDGES, BALANCE_LABELS, bin_labels, numeric_columns, row_sum, safe_ratio,
)
from wattloom.model import Family
from wattloom.operators.impute import winsorize
from wattloom.operators.windows import over, pct_change_many, q, rolling_mean_sql

LOSS_FACTOR = 1.1
CALENDAR = ("year", "month", "quarter", "month_sin", "month_cos")


def balance(df: DataFrame, supply: str, demand: str) -> DataFrame:
    ratio = safe_ratio(supply, demand)
    return df.withColumn("supply_demand_ratio", ratio).withColumn(
        "balance_status", bin_labels("supply_demand_ratio", BALANCE_EDGES, BALANCE_LABELS)
    )


def shares(df: DataFrame, fam: Family, of_total: bool = False) -> DataFrame:
    """Share of each part, unknown counting 0.

    By default negatives are cut to 0 and the base is the sum of the parts;
    ``of_total`` divides the plain parts by the family's total instead.
    """
    if of_total:
        return df.withColumns({f"{p}_share": safe_ratio(p, fam.total, fill=0.0) for p in fam.parts})
    cut = lambda p: f"if({q(p)} is null, 0D, greatest({q(p)}, 0D))"
    base = " + ".join(cut(p) for p in fam.parts)
    return df.selectExpr("*", *[f"coalesce(try_divide({cut(p)}, {base}), 0D) as {q(f'{p}_share')}" for p in fam.parts])


def growth(df: DataFrame, keys, ts, cols: Sequence[str] | None = None, limit_outliers: bool = True) -> DataFrame:
    """Year and month changes of every numeric column, and the smoothed yearly one."""
    cols = list(cols or numeric_columns(df, skip=(*keys, ts, *CALENDAR)))
    src = "__w" if limit_outliers else ""
    base = winsorize(df, keys, cols, suffix=src) if limit_outliers else df
    spec = {}
    for c in cols:
        spec[f"{c}_yoy"] = (f"{c}{src}", 12)
        spec[f"{c}_mom"] = (f"{c}{src}", 1)
    changed = pct_change_many(base, keys, ts, spec)
    smooth = [f"{rolling_mean_sql(keys, ts, f'{c}_yoy', 3)} as {q(f'{c}_yoy_ma3')}" for c in cols]
    return changed.selectExpr(*[q(c) for c in (*df.columns, *spec)], *smooth)


def _relative_to_mean(df: DataFrame, keys, part: str, names: dict[str, str]) -> DataFrame:
    by = ", ".join([*[q(k) for k in keys], part])
    return df.selectExpr("*", *[
        f"try_divide({q(c)}, avg({q(c)}) over (partition by {by})) as {q(out)}" for c, out in names.items()
    ])


def seasonal_index(df: DataFrame, keys, ts, cols: Sequence[str]) -> DataFrame:
    """Value relative to the mean of its calendar year."""
    return _relative_to_mean(df, keys, f"year({q(ts)})", {c: f"{c}_seasonal" for c in cols})


def seasonal_strength(df: DataFrame, keys, ts, cols: Sequence[str]) -> DataFrame:
    """Seasonal index relative to its mean for that calendar month."""
    return _relative_to_mean(df, keys, f"month({q(ts)})", {f"{c}_seasonal": f"{c}_seasonal_strength" for c in cols})


def efficiency(df: DataFrame, supply: str, demand: str, loss: float = LOSS_FACTOR) -> DataFrame:
    return df.withColumn("system_efficiency", safe_ratio(demand, F.col(supply) * loss))


def clean_share(df: DataFrame, cols: Sequence[str], total: str) -> DataFrame:
    """Non-thermal share of the total, under both of its names."""
    share = safe_ratio(row_sum(cols), total)
    return df.withColumns({"renewable_share": share, "clean_energy_share": share})


def indicators(df: DataFrame, keys, ts, demand: Family, supply: Family, clean: Sequence[str]) -> DataFrame:
    """The whole indicator table from a merged panel.

    One exchange on the series keys serves every window: winsorising, padding,
    lags, smoothing and the two seasonal partitions.
    """
    out = balance(df, supply.total, demand.total)
    out = shares(shares(out, supply), demand)
    out = growth(out, keys, ts)
    seasonal = [demand.total, *supply.columns]
    out = seasonal_strength(seasonal_index(out, keys, ts, seasonal), keys, ts, seasonal)
    return clean_share(efficiency(out, supply.total, demand.total), clean, supply.total)
