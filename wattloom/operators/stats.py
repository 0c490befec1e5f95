"""Aggregations: grouped sums, profiles, quantiles and scales.

``keys`` may be empty for a whole-table figure.  Sums, counts, extremes and
moments combine on the map side.  The exact ``percentile`` aggregate holds the
values of a group in one task, which suits one series of months per group
(bounded by the calendar).  For groups without such a bound ``large_quantiles``
is exact by distributed ranks, and ``approx`` uses a mergeable sketch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.scalars import to_month
from wattloom.session import materialize

QUARTILES = [0.25, 0.5, 0.75]
SKETCH_ACCURACY = 10_000


def monthly_mean(df: DataFrame, keys, ts, cols: Sequence[str]) -> DataFrame:
    """Average duplicates of a month; ``ts`` becomes the earliest date seen."""
    return (
        df.groupBy(*keys, F.year(ts).alias("year"), F.month(ts).alias("month"))
        .agg(F.min(ts).alias(ts), *[F.avg(c).alias(c) for c in cols])
    )


def annual_sum(df: DataFrame, keys, ts, cols: Sequence[str], suffix: str = "_annual") -> DataFrame:
    """Yearly sums; a year without any value sums to 0."""
    return df.groupBy(*keys, F.year(ts).alias("year")).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(f"{c}{suffix}") for c in cols]
    )


def entity_total(df: DataFrame, by: Sequence[str], cols: Sequence[str], suffix: str = "_sum") -> DataFrame:
    return df.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(f"{c}{suffix}") for c in cols])


def _stack(row: DataFrame, keys, entries: Sequence[tuple[str, Mapping[str, Column]]], name: str) -> DataFrame:
    """Turn one wide aggregate row per group into one row per entry."""
    structs = [F.struct(F.lit(label).alias(name), *[c.alias(k) for k, c in cols.items()]) for label, cols in entries]
    return row.select(*keys, F.inline(F.array(*structs)))


def _percentile(c: str, probs: Sequence[float], approx: bool) -> Column:
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    return F.approx_percentile(c, wanted, SKETCH_ACCURACY) if approx else F.percentile(c, wanted)


def describe_cols(df: DataFrame, cols: Sequence[str], keys=(), approx: bool = False) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, one row per column."""
    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
            F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"), _percentile(c, QUARTILES, approx).alias(f"{c}__q"),
        ]
    row = df.groupBy(*keys).agg(*aggs)
    q = lambda c, i: F.col(f"{c}__q")[i]
    return _stack(row, keys, [
        (c, {
            "n": F.col(f"{c}__n"), "mean": F.col(f"{c}__mean"), "std": F.col(f"{c}__std"),
            "min": F.col(f"{c}__min"), "q25": q(c, 0), "q50": q(c, 1), "q75": q(c, 2), "max": F.col(f"{c}__max"),
        }) for c in cols
    ], "column")


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys=(), approx: bool = False) -> DataFrame:
    row = df.groupBy(*keys).agg(*[_percentile(c, probs, approx).alias(f"{c}__q") for c in cols])
    return _stack(row, keys, [
        (c, {"prob": F.lit(float(p)), "value": F.col(f"{c}__q")[i]}) for c in cols for i, p in enumerate(probs)
    ], "column")


def ranked_values(df: DataFrame, col: str, keys=()) -> DataFrame:
    """Distinct values of ``col`` per group with the first rank (from 0) and number of their rows, and the group's ``__n``.

    Rows are counted by value before they are dealt out, so a value that most
    rows hold is one row; ranges of distinct values are then dealt over the
    tasks.  Ranks are prefix sums in two levels: over the counts of a group's
    ranges (as many as there are tasks), then over the values of one range.
    """
    counted = df.filter(F.col(col).isNotNull()).groupBy(*keys, F.col(col).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__rows"))
    ranged = materialize(counted.repartitionByRange(*keys, "__v").withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy(*keys, "__part").agg(F.sum("__rows").alias("__sum"))
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(k).alias(f"__of_{k}") for k in keys], F.col("__part").alias("__of"),
                         F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"), F.sum("__sum").over(whole).alias("__n"))
    same = reduce(lambda a, b: a & b, [ranged[k].eqNullSafe(sizes[f"__of_{k}"]) for k in keys], F.col("__part") == F.col("__of"))
    upto = Window.partitionBy("__part", *keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("__before") + F.col("__upto") - F.col("__rows")
    return ranged.withColumn("__upto", F.sum("__rows").over(upto)).join(sizes, same).select(
        *keys, "__v", "__rows", first.alias("__first"), "__n")


def large_quantiles(df: DataFrame, col: str, probs: Sequence[float], keys=()) -> DataFrame:
    """Exact interpolated quantiles of groups of any size, from ``ranked_values``; no task sees a whole group or a whole tie."""
    ranked = ranked_values(df, col, keys)
    at = {p: F.lit(float(p)) * (F.col("__n") - 1) for p in probs}
    holds = lambda rank: (F.col("__first") <= rank) & (rank < F.col("__first") + F.col("__rows"))
    picked = ranked.filter(reduce(lambda a, b: a | b, [holds(f(x)) for x in at.values() for f in (F.floor, F.ceil)]))
    aggs = []
    for i, x in enumerate(at.values()):
        aggs += [F.max(F.when(holds(F.floor(x)), F.col("__v"))).alias(f"__lo_{i}"), F.max(F.when(holds(F.ceil(x)), F.col("__v"))).alias(f"__hi_{i}")]
    row = picked.groupBy(*keys).agg(F.max("__n").alias("__n"), *aggs)
    part = lambda p: at[p] - F.floor(at[p])
    return _stack(row, keys, [
        (col, {"prob": F.lit(float(p)), "value": F.col(f"__lo_{i}") + (F.col(f"__hi_{i}") - F.col(f"__lo_{i}")) * part(p)})
        for i, p in enumerate(probs)
    ], "column")


def null_profile(df: DataFrame, cols: Sequence[str], keys=()) -> DataFrame:
    """NULL count and percentage of rows, one row per column."""
    row = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(f"{c}__null") for c in cols]
    )
    return _stack(row, keys, [
        (c, {"nulls": F.col(f"{c}__null"), "pct": F.try_divide(F.col(f"{c}__null") * 100.0, F.col("__rows"))}) for c in cols
    ], "column")


def count_where(df: DataFrame, conds: Mapping[str, Column], keys=()) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in conds.items()])


def value_profile(df: DataFrame, col: str, keys=()) -> DataFrame:
    return df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("n"))


def range_profile(df: DataFrame, col: str, ts: str, keys=()) -> DataFrame:
    """Rows, distinct values of ``col`` and the date range."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(col).alias("distinct_values"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
    )


def metric_scale(df: DataFrame, metric: str, ts: str = "ts") -> DataFrame:
    """Mean per month next to the extremes over all months.

    The extremes come from the monthly extremes, a table as long as the
    calendar, so the second pass never touches the input rows.
    """
    monthly = df.groupBy(ts).agg(F.avg(metric).alias("mean"), F.min(metric).alias("__lo"), F.max(metric).alias("__hi"))
    everything = Window.partitionBy()
    return monthly.select(
        ts, "mean", F.min("__lo").over(everything).alias("scale_min"), F.max("__hi").over(everything).alias("scale_max")
    )


def volatility_top(df: DataFrame, groups: Mapping[str, Sequence[str]], keys=()) -> DataFrame:
    """Per group of columns, the one whose absolute change varies most."""
    cols = [c for cs in groups.values() for c in cs]
    row = df.groupBy(*keys).agg(*[F.stddev_samp(F.abs(c)).alias(f"{c}__std") for c in cols])

    def best(cs: Sequence[str]) -> Column:
        # Largest deviation first, then the first listed column.
        items = F.array(*[
            F.struct(F.col(f"{c}__std").alias("std"), F.lit(-i).alias("rank"), F.lit(c).alias("column"))
            for i, c in enumerate(cs)
        ])
        return F.array_max(F.filter(items, lambda x: x["std"].isNotNull()))

    return _stack(row, keys, [
        (g, {"column": best(cs)["column"], "std": best(cs)["std"]}) for g, cs in groups.items()
    ], "group")


def edge_means(df: DataFrame, keys, ts, col: str, n: int = 12) -> DataFrame:
    """Mean of the first and of the last ``n`` points, of all points if fewer."""
    up = Window.partitionBy(*keys).orderBy(ts)
    down = Window.partitionBy(*keys).orderBy(F.desc(ts))
    ranked = df.withColumns({"__up": F.row_number().over(up), "__down": F.row_number().over(down)})
    return ranked.groupBy(*keys).agg(
        F.avg(F.when(F.col("__up") <= n, F.col(col))).alias("first_mean"),
        F.avg(F.when(F.col("__down") <= n, F.col(col))).alias("last_mean"),
    )


def annual_mean(df: DataFrame, keys, ts, col: str) -> DataFrame:
    return df.groupBy(*keys, F.year(ts).alias("year")).agg(F.avg(col).alias(col))


def date_range(df: DataFrame, keys, ts, col: str) -> DataFrame:
    """First and last month with the values they hold."""
    return df.groupBy(*keys).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.min_by(col, ts).alias("first_value"), F.max_by(col, ts).alias("last_value"),
    )


def month_counts(df: DataFrame, keys, ts) -> DataFrame:
    return df.groupBy(*keys, to_month(ts).alias("month")).agg(F.count(F.lit(1)).alias("n"))
