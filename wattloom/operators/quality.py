"""Data-quality checks as rows ``(keys…, check, metric, value, status)``.

Checks are described first and evaluated together: one aggregation per group
of series (or over everything when ``keys`` is empty) serves any number of
them.  A check whose columns are absent yields a single ``SKIPPED`` row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import to_month
from wattloom.model import Family
from wattloom.operators.align import ratio_is_outlier
from wattloom.operators.stats import count_where, volatility_top
from wattloom.operators.windows import day_gap, q

PASS, WARN, SKIPPED = "PASS", "WARN", "SKIPPED"


@dataclass(frozen=True)
class Check:
    """Aggregates (SQL text over the panel), and the rows read off them.

    Aggregates are named ``<check>__<name>`` so that any number of checks can
    share one aggregation.  ``gaps`` asks for the day gap to the previous row.
    """

    name: str
    aggs: Mapping[str, str]
    metrics: Mapping[str, str]
    ok: str
    gaps: bool = False


def _skip(name: str) -> Check:
    return Check(name, {}, {}, "")


def run_checks(df: DataFrame, checks: Sequence[Check], keys=(), ts: str | None = None) -> DataFrame:
    """Evaluate checks together: one pass over ``df``, one row per metric."""
    if any(c.gaps for c in checks):
        df = day_gap(df, keys, ts)
    return check_rows(df.groupBy(*keys).agg(*check_aggregates(checks)), checks, keys)


def check_aggregates(checks: Sequence[Check]) -> list[Column]:
    """All aggregates the checks need, named ``<check>__<name>``."""
    return [F.expr(e).alias(f"{c.name}__{a}") for c in checks for a, e in c.aggs.items()] or [F.count(F.lit(1)).alias("__n")]


def check_rows(row: DataFrame, checks: Sequence[Check], keys=()) -> DataFrame:
    """The rows of all checks, read off their aggregates."""
    items = []
    for c in checks:
        local = lambda text: re.sub(r"\{(\w+)\}", lambda m: q(f"{c.name}__{m.group(1)}"), text)
        status = f"if(coalesce({local(c.ok)}, false), '{PASS}', '{WARN}')" if c.metrics else f"'{SKIPPED}'"
        for metric, value in (c.metrics or {"columns": "null"}).items():
            items.append(f"struct('{c.name}' as check, '{metric}' as metric, cast({local(value)} as double) as value, {status} as status)")
    return row.selectExpr(*[q(k) for k in keys], f"inline(array({', '.join(items)}))")


def _has(df: DataFrame, cols: Sequence[str]) -> bool:
    return all(c in df.columns for c in cols)


def _sum_sql(cols: Sequence[str]) -> str:
    return "(" + " + ".join(f"coalesce({q(c)}, 0D)" for c in cols) + ")"


def identity_check(df: DataFrame, fam: Family, name: str, tol: float, max_rate: float = 0.0) -> Check:
    """Deviation of the total from its parts; passes while few rows exceed ``tol``."""
    if not _has(df, fam.columns):
        return _skip(name)
    dev = f"abs({q(fam.total)} - {_sum_sql(fam.parts)})"
    rel = f"try_divide({dev}, {q(fam.total)})"
    return Check(name, {
        "max": f"max({dev})", "mean": f"avg({dev})", "rel": f"avg({rel})",
        "abnormal": f"count_if({rel} > {tol}D)", "rows": "count(1)",
    }, {
        "max_deviation": "{max}", "mean_deviation": "{mean}", "mean_deviation_pct": "{rel} * 100",
        "abnormal_count": "{abnormal}",
    }, f"{{abnormal}} <= {{rows}} * {max_rate}D")


def range_check(
    df: DataFrame, col: str, normal=(0.10, 0.45), severe=(0.05, 0.65), max_rate: float = 0.15, name: str = "balance"
) -> Check:
    """Share of rows in the normal band and count of severe ones; NULL rows count in the denominator."""
    if not _has(df, [col]):
        return _skip(name)
    c = q(col)
    return Check(name, {
        "mean": f"avg({c})", "min": f"min({c})", "max": f"max({c})", "rows": "count(1)",
        "normal": f"count_if({c} between {normal[0]}D and {normal[1]}D)",
        "severe": f"count_if({c} < {severe[0]}D or {c} > {severe[1]}D)",
    }, {
        "mean": "{mean}", "min": "{min}", "max": "{max}",
        "normal_range_pct": "try_divide({normal} * 100D, {rows})", "severe_imbalance_count": "{severe}",
    }, f"{{severe}} <= {{rows}} * {max_rate}D")


def temporal_check(ts: str, name: str = "temporal") -> Check:
    """Date gaps and completeness per series, a month counting 30 days in the expectation."""
    return Check(name, {
        "gap": "max(gap_days)", "gaps": "count_if(gap_days > 31)", "rows": "count(1)",
        "expected": f"floor(datediff(max({q(ts)}), min({q(ts)})) / 30) + 1",
    }, {
        "max_time_gap": "{gap}", "gaps_over_month": "{gaps}",
        "completeness_pct": "try_divide({rows} * 100D, {expected})",
        "expected_months": "{expected}", "actual_months": "{rows}",
    }, "{gaps} = 0", gaps=True)


def shares_check(df: DataFrame, sides: Mapping[str, Sequence[str]], tol: float = 0.05, name: str = "shares") -> Check:
    """Largest distance of a share sum from 1 per side, over rows with a positive sum."""
    present = {s: [c for c in cols if c in df.columns] for s, cols in sides.items()}
    present = {s: _sum_sql(cols) for s, cols in present.items() if cols}
    if not present:
        return _skip(name)
    return Check(
        name, {s: f"coalesce(max(if({v} > 0, abs({v} - 1), null)), 0D)" for s, v in present.items()},
        {f"{s}_max_deviation": f"{{{s}}}" for s in present}, " and ".join(f"{{{s}}} < {tol}D" for s in present),
    )


def growth_check(df: DataFrame, cols: Sequence[str], limit: float = 3.0, max_rate: float = 0.20, name: str = "growth") -> Check:
    """Columns holding changes beyond ``limit``; passes while few columns do."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return _skip(name)
    bad = "(" + " + ".join(f"cast({{{c}}} > 0 as int)" for c in cols) + ")"
    return Check(
        name, {c: f"count_if(abs({q(c)}) > {limit}D)" for c in cols},
        {"extreme_growth_column_count": bad, **{c: f"{{{c}}}" for c in cols}}, f"{bad} <= {len(cols)} * {max_rate}D",
    )


def merge_check(ts: str, cols: Sequence[str], name: str = "merge") -> Check:
    """Rows, range, gaps and per-column NULL share, mean and extremes of a merged panel."""
    aggs = {"rows": "count(1)", "gap": "max(gap_days)", "span": f"datediff(max({q(ts)}), min({q(ts)}))"}
    metrics = {"rows": "{rows}", "span_days": "{span}", "max_gap_days": "{gap}"}
    for c in cols:
        aggs |= {f"{c}_null": f"count_if({q(c)} is null)", **{f"{c}_{m}": f"{f}({q(c)})" for m, f in
                 (("mean", "avg"), ("min", "min"), ("max", "max"))}}
        metrics |= {f"{c}_null_pct": f"try_divide({{{c}_null}} * 100D, {{rows}})",
                    **{f"{c}_{m}": f"{{{c}_{m}}}" for m in ("mean", "min", "max")}}
    return Check(name, aggs, metrics, "not (coalesce({gap}, 0) > 31)", gaps=True)


def sanity_check(
    ratio: str, sides: Mapping[str, Sequence[str]], yoy: Sequence[str], band=(0.5, 2.0), limit: float = 1.0, name: str = "sanity"
) -> Check:
    """Ratios out of band, share-sum distance from 1 and large yearly changes."""
    r = q(ratio)
    aggs = {
        "ratio_mean": f"avg({r})", "ratio_min": f"min({r})", "ratio_max": f"max({r})",
        "ratio_outliers": f"count_if({r} < {band[0]}D or {r} > {band[1]}D)",
        **{f"{s}_share_deviation": f"max(abs({_sum_sql(cols)} - 1))" for s, cols in sides.items()},
        **{f"{c}_extreme": f"count_if(abs({q(c)}) > {limit}D)" for c in yoy},
    }
    quiet = ["{ratio_outliers} = 0", *[f"{{{c}_extreme}} = 0" for c in yoy]]
    return Check(name, aggs, {a: f"{{{a}}}" for a in aggs}, " and ".join(quiet))


def check_identity(df: DataFrame, fam: Family, check: str, tol: float, max_rate: float = 0.0, keys=()) -> DataFrame:
    return run_checks(df, [identity_check(df, fam, check, tol, max_rate)], keys)


def check_range(df: DataFrame, col: str, normal=(0.10, 0.45), severe=(0.05, 0.65), max_rate: float = 0.15, keys=()) -> DataFrame:
    return run_checks(df, [range_check(df, col, normal, severe, max_rate)], keys)


def check_temporal(df: DataFrame, keys, ts) -> DataFrame:
    return run_checks(df.select(*keys, ts), [temporal_check(ts)], keys, ts)


def check_shares(df: DataFrame, sides: Mapping[str, Sequence[str]], tol: float = 0.05, keys=()) -> DataFrame:
    return run_checks(df, [shares_check(df, sides, tol)], keys)


def check_growth(df: DataFrame, cols: Sequence[str], limit: float = 3.0, max_rate: float = 0.20, keys=()) -> DataFrame:
    return run_checks(df, [growth_check(df, cols, limit, max_rate)], keys)


def profile_merge(df: DataFrame, keys, ts, cols: Sequence[str]) -> DataFrame:
    return run_checks(df, [merge_check(ts, cols)], keys, ts)


def sanity_indicators(df: DataFrame, ratio: str, sides, yoy, band=(0.5, 2.0), limit: float = 1.0, keys=()) -> DataFrame:
    return run_checks(df, [sanity_check(ratio, sides, yoy, band, limit)], keys)


def summarize_checks(checks: DataFrame, keys=()) -> DataFrame:
    """Checks passed, warned and counted in all; skipped ones are left out."""
    one = checks.filter(F.col("status") != SKIPPED).select(*keys, "check", "status").distinct()
    return one.groupBy(*keys).agg(
        F.count_if(F.col("status") == PASS).alias("passed"), F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == WARN).alias("warnings"),
    )


def alignment_stats(
    a: DataFrame, b: DataFrame, keys, ts, num: str, den: str, lo: float = 0.2, hi: float = 5.0, weight: str | None = None
) -> DataFrame:
    """How two raw tables align on months, per series.

    Each side is reduced to one row per month first (the last by date), so
    the join and the list of dropped months are bounded by the calendar.
    ``weight`` names a row count where the tables are already condensed.
    """
    rows = F.sum(weight) if weight else F.count(F.lit(1))

    def monthly(d: DataFrame, col: str, tag: str) -> DataFrame:
        # Bad dates count as raw rows but form no month.
        return d.groupBy(*keys, to_month(ts).alias("__m")).agg(
            rows.alias(f"rows_{tag}"), F.max_by(col, ts).alias(col)
        )

    left, right = monthly(a, num, "a"), monthly(b, den, "b")
    both = left.join(right, [*keys, "__m"], "full_outer")
    real = F.col("__m").isNotNull()
    common = real & F.col("rows_a").isNotNull() & F.col("rows_b").isNotNull()
    bad = common & ratio_is_outlier(num, den, lo, hi)
    label = F.date_format("__m", "yyyy-MM")
    agg = both.groupBy(*keys).agg(
        F.coalesce(F.sum("rows_a"), F.lit(0)).alias("raw_rows_a"), F.coalesce(F.sum("rows_b"), F.lit(0)).alias("raw_rows_b"),
        F.count_if(real & F.col("rows_a").isNotNull()).alias("months_a"),
        F.count_if(real & F.col("rows_b").isNotNull()).alias("months_b"),
        F.count_if(common).alias("common_months"), F.count_if(bad).alias("dropped_months"),
        F.array_join(F.array_sort(F.collect_list(F.when(bad, label))), ", ").alias("dropped_list"),
        F.count_if(common & ~bad).alias("final_months"),
        F.min(F.when(common, label)).alias("common_start"), F.max(F.when(common, label)).alias("common_end"),
    )
    return agg


def count_nonzero(df: DataFrame, col: str, keys=()) -> DataFrame:
    if col not in df.columns:
        raise ValueError(f"column {col} is absent")
    return count_where(df, {"non_zero": F.col(col) != 0}, keys)


def report_table(checks: DataFrame, changes: DataFrame, groups: Mapping[str, Sequence[str]], edges: DataFrame, keys=()) -> DataFrame:
    """Checks, volatility leaders and the forecast level shift in one table."""
    top = volatility_top(changes, groups, keys).select(
        *keys, F.concat(F.lit("volatility "), F.col("group")).alias("check"), F.col("column").alias("metric"),
        F.col("std").alias("value"), F.lit(None).cast("string").alias("status"),
    )
    note = edges.select(*keys, F.inline(F.array(*[
        F.struct(F.lit("forecast").alias("check"), F.lit(m).alias("metric"), F.col(m).alias("value"),
                 F.lit(None).cast("string").alias("status")) for m in ("first_mean", "last_mean")
    ])))
    return checks.select(*keys, "check", "metric", "value", "status").unionByName(top).unionByName(note)
