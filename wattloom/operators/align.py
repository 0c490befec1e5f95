"""Joins, unions, de-duplication and ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.scalars import safe_ratio, to_month
from wattloom.session import materialize


# -- joins on month ----------------------------------------------------------

def outer_on_month(a: DataFrame | None, b: DataFrame | None, keys, ts="ts") -> DataFrame:
    """Full outer join of two panels; either side may be absent."""
    if a is None and b is None:
        raise ValueError("at least one panel is required")
    if a is None or b is None:
        return a if b is None else b
    return a.join(b, [*keys, ts], "full_outer")


def align_common(a: DataFrame, b: DataFrame, keys, ts="ts") -> DataFrame:
    """Rows of both panels for the months they share."""
    return a.join(b, [*keys, ts], "inner")


def semi_keep(df: DataFrame, keep: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keep, list(on), "left_semi")


def ratio_is_outlier(num: str, den: str, lo: float, hi: float) -> Column:
    ratio = safe_ratio(num, den)
    return F.coalesce((ratio < lo) | (ratio > hi), F.lit(False))


def drop_ratio_outliers(df: DataFrame, num: str, den: str, lo: float = 0.2, hi: float = 5.0) -> DataFrame:
    """Drop months whose ratio leaves [lo, hi]; an unknown ratio is kept."""
    return df.filter(~ratio_is_outlier(num, den, lo, hi))


def outer_on(dfs: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Chained full outer join of tables with distinct value columns.

    Expressed as one union and one aggregation: a single shuffle on ``on``
    however many tables come in.  Each table holds at most one row per key.
    """
    values = [c for d in dfs for c in d.columns if c not in on]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    return stacked.groupBy(*on).agg(*[F.max(c).alias(c) for c in values])


def combine_metrics(frames: Mapping[str, DataFrame | None], keys=(), ts="ts", value="value") -> DataFrame:
    """One wide table from per-metric ``(keys, ts, value)`` tables, absent ones skipped.

    A month given twice within one metric keeps its smallest value.
    """
    present = {name: d for name, d in frames.items() if d is not None}
    long = reduce(
        DataFrame.unionByName,
        [d.select(*keys, ts, F.lit(name).alias("metric"), F.col(value).alias("value")) for name, d in present.items()],
    )
    return long.groupBy(*keys, ts).agg(*[F.min(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in present])


def attach_totals(df: DataFrame, totals: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a table of totals (the optimizer broadcasts it when small)."""
    return df.join(totals, list(on), "left")


def expand_months(annual: DataFrame, monthly: DataFrame, on: Sequence[str]) -> DataFrame:
    return annual.join(monthly, list(on), "inner")


def attach_by_month(df: DataFrame, climatology: DataFrame, keys=(), ts="ts") -> DataFrame:
    """Left join on the calendar month of ``ts``."""
    return df.withColumn("month", F.month(ts)).join(climatology, [*keys, "month"], "left")


def align_forecasts(a: DataFrame, b: DataFrame, keys, limit: int, ts="ts") -> DataFrame:
    """Months present in both paths, at most ``limit`` per series in date order."""
    both = a.join(b, [*keys, ts], "inner")
    w = Window.partitionBy(*keys).orderBy(ts)
    return both.withColumn("step", F.row_number().over(w)).filter(F.col("step") <= limit)


def match_observed(pred: DataFrame, obs: DataFrame, on: Sequence[str]) -> DataFrame:
    return pred.join(obs, list(on), "left")


def scenario_grid(df: DataFrame, axes: Mapping[str, Sequence[float]]) -> DataFrame:
    """Every row of ``df`` under every combination of parameter values.

    The axes are literals exploded in place one after the other, so there is no
    join, no shuffle and no bound on the number of combinations; ``scenario_id`` numbers the combinations with the last axis
    fastest.
    """
    sizes = [len(v) for v in axes.values()]
    total = reduce(lambda a, b: a * b, sizes, 1)
    if not total:
        raise ValueError("an axis has no values")
    out, scenario, left = df, F.lit(0).cast("long"), total
    for name, values in axes.items():
        left //= len(values)
        out = out.select("*", F.posexplode(F.array(*[F.lit(float(v)) for v in values])).alias(f"__i_{name}", name))
        scenario = scenario + F.col(f"__i_{name}") * left
    return out.select(*df.columns, scenario.cast("int" if total < 2**31 else "long").alias("scenario_id"), *axes)


# -- sets --------------------------------------------------------------------

def union_by_name(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def common_keys(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    return a.select(*on).intersect(b.select(*on))


# -- duplicates and ids ------------------------------------------------------

def dedup_by(df: DataFrame, keys, ts: str, keep: str = "last", tie: Sequence[str] = (), month: str = "ts") -> DataFrame:
    """One row per (keys, month): the last or first by ``ts`` then ``tie``.

    An aggregation rather than ``row_number``: map tasks send one candidate
    row per group, so a key holding most rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys and c not in (ts, *tie)]
    row = F.struct(F.col(ts), *[F.col(t) for t in tie], *[F.col(c) for c in rest])
    order = F.struct(F.col(ts), *[F.col(t) for t in tie])
    pick = F.max_by(row, order) if keep == "last" else F.min_by(row, order)
    picked = (
        df.groupBy(*keys, to_month(ts).alias("__month")).agg(pick.alias("__row"))
        .select(*keys, "__month", "__row.*")
    )
    source = [c for c in picked.columns if c != "__month"] if month != ts else [c for c in picked.columns if c not in ("__month", ts)]
    return picked.select(*source, F.col("__month").alias(month))


def with_ids(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), out: str = "id", large_groups: bool = False
) -> DataFrame:
    """Sequential ids from 0 in the given order, restarting per ``keys`` if given.

    A panel series is bounded by the calendar and numbered by one window.
    Without ``keys``, or with ``large_groups``, the table is range partitioned
    and written once; each partition numbers its own rows and adds the row
    count of the partitions before it, so no task sees a whole group.  ``order``
    must be unique (within ``keys``) for the ids to be reproducible.
    """
    if keys and not large_groups:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))
    order = [*keys, *order]
    ranged = materialize(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition of the table: bounded by the partition count.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local = Window.partitionBy("__part").orderBy(*order)
    numbered = ranged.join(offsets, "__part").withColumn(out, F.col("__off") + F.row_number().over(local) - 1)
    if keys:
        # Rows of a key are consecutive; its first id is the rows of all keys before it.
        first = numbered.groupBy(*keys).agg(F.min(out).alias("__first"))
        numbered = numbered.join(first, list(keys)).withColumn(out, F.col(out) - F.col("__first"))
    return numbered.select(*df.columns, out)
