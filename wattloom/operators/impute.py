"""Gap filling and consistency repair for accounting families."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.scalars import clip, row_sum, safe_ratio
from wattloom.model import Family
from wattloom.operators.windows import interpolate_linear_many, over, q, rolling_mean_sql
from wattloom.session import materialize

# Fixed values of the learned fill.
FOREST = {"numTrees": 500, "maxDepth": 8, "minInstancesPerNode": 2, "seed": 42}
MIN_TRAINING_ROWS = 12
# Room for split statistics per pass over the data: more nodes per pass, fewer passes.
FIT_MEMORY_MB = 1024
ROLLING_SPANS = (3, 6, 12)
CALENDAR_COLUMNS = ("year", "month", "quarter", "month_sin", "month_cos")


def _null_count(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols])


def fill_by_accounting(df: DataFrame, fam: Family) -> DataFrame:
    """Derive the one missing member of ``total = sum(parts)``.

    A filled row has no gap left and a row with two gaps matches no rule, so
    one projection is the fixpoint.
    """
    one_gap = _null_count(fam.columns) == 1
    rest = row_sum(fam.parts)
    fills = {fam.total: F.when(one_gap & F.col(fam.total).isNull(), rest).otherwise(F.col(fam.total))}
    for part in fam.parts:
        # The missing part counts 0 in ``rest``.
        fills[part] = F.when(one_gap & F.col(part).isNull(), F.col(fam.total) - rest).otherwise(F.col(part))
    return df.withColumns(fills)


def total_from_parts(df: DataFrame, fam: Family) -> DataFrame:
    """A missing total takes the sum of whatever parts are present."""
    return df.withColumn(fam.total, F.coalesce(fam.total, row_sum(fam.parts, min_count=1)))


def _month_mean_or_median(col: str, keys, ts) -> Column:
    by_month = F.avg(col).over(Window.partitionBy(*keys, F.month(ts)))
    return F.coalesce(by_month, F.median(col).over(Window.partitionBy(*keys)))


def temp_fill(df: DataFrame, keys, ts, cols: Sequence[str], suffix: str = "_temp") -> DataFrame:
    """Interpolation, then the month mean, then the series median."""
    filled = interpolate_linear_many(df, keys, ts, cols, suffix)
    return filled.withColumns({
        f"{c}{suffix}": F.coalesce(f"{c}{suffix}", _month_mean_or_median(c, keys, ts)) for c in cols
    })


def series_features(
    df: DataFrame, keys, ts, cols: Sequence[str], lag_steps: Sequence[int] = (1, 2, 3, 6, 12),
    spans: Sequence[int] = ROLLING_SPANS,
) -> DataFrame:
    """Lags and shifted rolling means of the temporarily filled columns."""
    filled = temp_fill(df, keys, ts, cols)
    made = []
    for c in cols:
        temp = f"{c}_temp"
        made += [f"lag({q(temp)}, {n}) {over(keys, ts)} as {q(f'{c}_lag_{n}')}" for n in lag_steps]
        made += [f"{rolling_mean_sql(keys, ts, temp, n, shift=1)} as {q(f'{c}_roll_mean_{n}')}" for n in spans]
    return filled.selectExpr("*", *made)


def feature_names(col: str, lag_steps: Sequence[int], spans: Sequence[int] = ROLLING_SPANS) -> list[str]:
    return [
        *CALENDAR_COLUMNS, *[f"{col}_lag_{n}" for n in lag_steps], *[f"{col}_roll_mean_{n}" for n in spans]
    ]


def fill_month_mean(df: DataFrame, keys, ts, col: str, below: int = MIN_TRAINING_ROWS) -> DataFrame:
    """Series with fewer than ``below`` known values: month mean, else median."""
    known = F.count(col).over(Window.partitionBy(*keys))
    fill = F.when(known < below, _month_mean_or_median(col, keys, ts))
    return df.withColumn(col, F.coalesce(F.col(col), fill))


def _fit_forest(rows: DataFrame, target: str, names: Sequence[str], trees: int | None) -> PipelineModel | None:
    """Median filling, assembly and forest for one target; None when nothing is to be filled or learned."""
    learnable = rows.filter(F.col(f"{target}__known") >= MIN_TRAINING_ROWS).select(*names, target)
    train = learnable.filter(F.col(target).isNotNull())
    if not learnable.filter(F.col(target).isNull()).take(1) or not train.take(1):
        return None
    filled = [f"__f_{i}" for i in range(len(names))]
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(names), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="__x", handleInvalid="keep"),
        RandomForestRegressor(
            **{**FOREST, **({"numTrees": trees} if trees else {})}, featuresCol="__x", labelCol=target, predictionCol="__p",
            featureSubsetStrategy="all", maxBins=256, maxMemoryInMB=FIT_MEMORY_MB,
        ),
    ]).fit(train)


def ml_fill(df: DataFrame, keys, ts, targets: Sequence[str], lag_steps: Sequence[int], trees: int | None = None) -> DataFrame:
    """Random-forest fill of the gaps left in ``targets``.

    ``df`` carries the calendar and series features.  One forest per target
    learns from all series together, the mean of the series standing for its
    level, so the number of fits does not grow with the number of series.
    The features are written once; the fits read them back side by side.
    """
    extra = {}
    for t in targets:
        extra[f"{t}__level"] = F.expr(f"avg({q(t)}) {over(keys)}")
        extra[f"{t}__known"] = F.expr(f"count({q(t)}) {over(keys)}")
    names = {t: [*feature_names(t, lag_steps), f"{t}__level"] for t in targets}
    numeric = {n: F.col(n).cast("double") for n in dict.fromkeys(n for t in targets for n in names[t])}
    rows = materialize(df.withColumns(extra).withColumns(numeric))
    with ThreadPoolExecutor(len(targets)) as pool:
        models = dict(zip(targets, pool.map(lambda t: _fit_forest(rows, t, names[t], trees), targets)))
    out = rows
    for target, model in models.items():
        if model is not None:
            fill = F.when(F.col(f"{target}__known") >= MIN_TRAINING_ROWS, F.col("__p"))
            out = model.transform(out).withColumn(target, F.coalesce(F.col(target), fill)).select(*rows.columns)
    few = {
        t: F.coalesce(F.col(t), F.when(F.col(f"{t}__known") < MIN_TRAINING_ROWS, _month_mean_or_median(t, keys, ts)))
        for t in targets
    }
    return out.withColumns(few).drop(*extra)


def scale_parts(df: DataFrame, fam: Family) -> DataFrame:
    """Scale the parts so that they add up to the total."""
    parts_sum = row_sum(fam.parts)
    ratio = F.when(parts_sum > 0, F.col(fam.total) / parts_sum).otherwise(F.lit(1.0))
    return df.withColumns({p: F.col(p) * ratio for p in fam.parts})


def non_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clip(c, lo=0.0) for c in cols})


def winsorize(
    df: DataFrame, keys, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99, min_n: int = 24, suffix: str = ""
) -> DataFrame:
    """Clip every series at its own quantiles when it has enough values.

    The quantiles are window aggregates, so they share the exchange of the
    series windows that follow instead of adding an aggregate and a join.
    """
    w = over(keys)
    ranged = df.selectExpr(
        "*", *[f"percentile({q(c)}, array({lo}D, {hi}D)) {w} as {q('__q_' + c)}" for c in cols],
        *[f"count({q(c)}) {w} as {q('__n_' + c)}" for c in cols],
    )

    def bounded(c: str) -> str:
        lim = q("__q_" + c)
        cut = f"least(greatest({q(c)}, {lim}[0]), {lim}[1])"
        return f"case when {q(c)} is null or {q('__n_' + c)} < {min_n} then {q(c)} else {cut} end as {q(c + suffix)}"

    kept = [q(c) for c in df.columns if suffix or c not in cols]
    return ranged.selectExpr(*kept, *[bounded(c) for c in cols])
