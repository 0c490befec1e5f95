"""Forecasts per series, share trends and disaggregation of parent totals."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.scalars import clip, month_start, safe_ratio
from wattloom.operators.align import attach_by_month, attach_totals, expand_months, union_by_name
from wattloom.operators.stats import annual_sum
from wattloom.operators.windows import group_weight_expr

SEASON = 12

# Bounds of the two leading shares and of their sum.
SHARE_BOUNDS = ((0.10, 0.95), (0.01, 0.80))
SHARE_SUM_LIMIT = 0.98
SHARE_HISTORY_FROM = 2015
CLIMATOLOGY_YEARS = (2018, 2024)
HISTORICAL, PROJECTED = "historical_disaggregated", "forecast_share_based"


# -- trajectories ------------------------------------------------------------

def forecast_seasonal_naive(df: DataFrame, keys, ts, value, steps: int) -> DataFrame:
    """Last season repeated, shifted by the mean change over a season.

    Each of the last 12 rows of a series emits every horizon it stands for,
    so the forecast needs no join.  Shorter series repeat what they have.
    """
    w = Window.partitionBy(*keys)
    known = df.filter(F.col(value).isNotNull()).select(*keys, ts, F.col(value).cast("double").alias("__y"))
    steps_back = known.select(
        "*",
        F.row_number().over(w.orderBy(F.desc(ts))).alias("__r"),
        (F.col("__y") - F.lag("__y", SEASON).over(w.orderBy(ts))).alias("__d"),
    ).select(
        "*",
        F.coalesce(F.avg("__d").over(w), F.lit(0.0)).alias("__drift"),
        F.max(ts).over(w).alias("__last"),
        F.least(F.count(F.lit(1)).over(w), F.lit(SEASON)).cast("int").alias("__m"),
    )
    first = F.col("__m") + 1 - F.col("__r")
    tail = steps_back.filter((F.col("__r") <= F.col("__m")) & (first <= steps))
    horizons = tail.select(
        *keys, "__y", "__drift", "__last", "__m",
        F.explode(F.sequence(first.cast("int"), F.lit(steps), F.col("__m"))).alias("__h"),
    )
    seasons = F.ceil(F.col("__h") / F.col("__m"))
    return horizons.select(
        *keys,
        F.trunc(F.add_months("__last", F.col("__h")), "MM").alias(ts),
        (F.col("__y") + seasons * F.col("__drift")).alias("forecast"),
    )


#: States of the model: an autoregression and a moving average of 13 lags each, in companion form.
STATES = SEASON + 2
#: Variance of the states before the first month, against 1 for a shock: they are as good as unknown.
DIFFUSE = 1e6
#: Starting points of the search (autoregressive, seasonal, moving average, seasonal), and series that are fitted side by side.
STARTS = ((0.1, 0.1, -0.1, -0.1), (0.3, 0.0, -0.7, -0.7), (-0.3, -0.3, 0.3, 0.3))
SIDE_BY_SIDE = 128


def _model(coefs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of a state's own past and of a shock, for coefficients along the last axis."""
    ar, sar, ma, sma = np.moveaxis(coefs, -1, 0)
    past, shock = np.zeros((*coefs.shape[:-1], STATES)), np.zeros((*coefs.shape[:-1], STATES))
    past[..., 0], past[..., SEASON - 1], past[..., SEASON] = ar, sar, -ar * sar
    shock[..., 0], shock[..., 1], shock[..., SEASON], shock[..., SEASON + 1] = 1.0, ma, sma, ma * sma
    return past, shock


def kalman(w: np.ndarray, length: np.ndarray, coefs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood and the state after the last month, for many series and coefficients at once.

    ``w`` holds a series per row, ending in the last column, ``length`` how
    many of its last columns count.  ``coefs`` is series x candidates x 4.
    The first ``STATES`` months settle the diffuse start and do not count; the
    shock's variance is the one that fits best.  As the first state is what
    is observed, it is known after each month and only the others carry on.
    """
    past, shock = _model(coefs)
    spread = shock[..., :, None] * shock[..., None, :]
    state = np.zeros(shock.shape)
    cov = np.broadcast_to(DIFFUSE * np.eye(STATES), spread.shape).copy()
    squares, logs = np.zeros(coefs.shape[:2]), np.zeros(coefs.shape[:2])
    first = w.shape[1] - length
    for t in range(int(first.min(initial=w.shape[1])), w.shape[1]):
        value = w[:, t, None]
        error, var = value - state[..., 0], cov[..., 0, 0]
        known = cov[..., 1:, 0]
        gain = known / var[..., None]
        new_state, new_cov = past * value[..., None], spread.copy()
        new_state[..., :-1] += state[..., 1:] + gain * error[..., None]
        new_cov[..., :-1, :-1] += cov[..., 1:, 1:] - gain[..., :, None] * known[..., None, :]
        on = (t >= first)
        if on.all():
            state, cov = new_state, new_cov
        else:
            state = np.where(on[:, None, None], new_state, state)
            cov = np.where(on[:, None, None, None], new_cov, cov)
        counts = (t >= first + STATES)[:, None]
        squares += np.where(counts, error ** 2 / var, 0.0)
        logs += np.where(counts, np.log(var), 0.0)
    n = np.maximum(length - STATES, 1)[:, None]
    with np.errstate(divide="ignore"):
        fit = -0.5 * (n * (np.log(2 * np.pi * squares / n) + 1) + logs)
    return fit, state


def likelihood(w: np.ndarray, length: np.ndarray, coefs: np.ndarray) -> np.ndarray:
    """The log-likelihood of ``kalman`` without its matrices, for the search.

    Given the unknown states before the first month, shocks follow from the
    changes one by one.  The states move them linearly, by shifted copies of
    one response, so the best states are a least-squares fit, and integrating
    over them costs a determinant.
    """
    ar, sar, ma, sma = np.moveaxis(coefs, -1, 0)
    count, size = coefs.shape[:2], w.shape[1]
    first = (size - length)[:, None]
    begin = np.arange(size) >= first  # series end in the last column; nothing stands before their first month
    past = lambda n: np.concatenate([np.zeros((len(w), n)), w[:, :-n]], axis=1)[:, None, :]
    own = w[:, None, :] - ar[..., None] * past(1) - sar[..., None] * past(SEASON) + (ar * sar)[..., None] * past(SEASON + 1)
    shocks = np.moveaxis(own * begin[:, None, :], -1, 0).copy()
    response = np.zeros((size, *count))
    response[0] = 1.0
    for x in (shocks, response):
        for t in range(1, size):
            x[t] -= ma * x[t - 1]
        for t in range(SEASON, size):
            x[t] -= sma * x[t - SEASON]
    # each series' shocks from its first month on
    at = np.minimum(np.arange(size)[:, None] + (size - length), size - 1)
    shocks = np.take_along_axis(shocks, at[:, :, None], axis=0) * (np.arange(size)[:, None] < length)[:, :, None]
    moved = np.stack([(response[:size - i] * shocks[i:]).sum(axis=0) for i in range(STATES)], axis=-1)
    gram = np.zeros((*count, STATES, STATES))
    for d in range(STATES):
        sums = np.cumsum(response[:size - d] * response[d:], axis=0)
        for i in range(STATES - d):
            last = np.maximum(length - 1 - i - d, 0)
            gram[..., i, i + d] = gram[..., i + d, i] = np.take_along_axis(sums, last[None, :, None], axis=0)[0]
    with np.errstate(all="ignore"):
        _, logs = np.linalg.slogdet(gram)
        squares = (shocks ** 2).sum(axis=0) - (moved * np.linalg.solve(gram, moved[..., None])[..., 0]).sum(axis=-1)
        n = np.maximum(length - STATES, 1)[:, None]
        return -0.5 * (n * (np.log(2 * np.pi * squares / n) + 1) + logs)


def fit_sarima(w: np.ndarray, length: np.ndarray, iterations: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of the largest likelihood found, and whether the search converged, by series.

    Coefficients are hyperbolic tangents of what is searched, so all lie
    inside (-1, 1) without a bound.  Every series starts at several points; all
    searches (quasi-Newton, central differences, six step lengths a round) run
    side by side.  Converged: no slope over 1e-4 per month and unit is left.
    """
    count = len(STARTS)
    w, length = np.repeat(w, count, axis=0), np.repeat(length, count)
    months = np.maximum(length - STATES, 1)
    u = np.tile(np.arctanh(np.array(STARTS)), (len(w) // count, 1))
    offsets = np.concatenate([np.eye(4), -np.eye(4)]) * 1e-5
    lengths = np.array([1.0, 0.5, 0.25, 0.1, 0.02, 0.002])

    def cost(rows, points):
        value = -likelihood(w[rows], length[rows], np.tanh(points)) / months[rows, None]
        return np.where(np.isfinite(value), value, np.inf)

    def slope(rows):
        around = cost(rows, u[rows, None, :] + offsets)
        return np.nan_to_num((around[:, :4] - around[:, 4:]) / 2e-5)

    rows = np.arange(len(w))
    best = cost(rows, u[:, None, :])[:, 0]
    grad, metric = slope(rows), np.tile(np.eye(4), (len(w), 1, 1))
    for _ in range(iterations):
        rows = rows[np.abs(grad[rows]).max(axis=1) > 1e-6]
        if not len(rows):
            break
        step = -np.einsum("sij,sj->si", metric[rows], grad[rows])
        uphill = (step * grad[rows]).sum(axis=1) >= 0
        metric[rows[uphill]] = np.eye(4)
        step[uphill] = -grad[rows[uphill]]
        step /= np.maximum(1.0, np.abs(step).max(axis=1))[:, None]
        tried = cost(rows, u[rows, None, :] + lengths[:, None] * step[:, None, :])
        pick = tried.argmin(axis=1)
        better = tried[np.arange(len(rows)), pick] < best[rows]
        stuck = ~better & ((metric[rows] == np.eye(4)).all(axis=(1, 2)))
        metric[rows[~better]] = np.eye(4)  # once more along the slope itself
        moved = rows[better]
        change = lengths[pick[better]][:, None] * step[better]
        u[moved] += change
        best[moved] = tried[better, pick[better]]
        if len(moved):
            new = slope(moved)
            turn = new - grad[moved]
            grad[moved] = new
            inner = (change * turn).sum(axis=1)
            good = inner > 1e-12
            s, y, rho = change[good], turn[good], 1 / inner[good]
            left = np.eye(4) - rho[:, None, None] * s[:, :, None] * y[:, None, :]
            h = left @ metric[moved[good]] @ left.transpose(0, 2, 1) + rho[:, None, None] * s[:, :, None] * s[:, None, :]
            metric[moved[good]] = h
        rows = rows[~stuck]
    pick = best.reshape(-1, count).argmin(axis=1) + np.arange(len(w) // count) * count
    return np.tanh(u[pick]), np.abs(grad[pick]).max(axis=1) < 1e-4


def _paths(series: list[np.ndarray], coefs: np.ndarray, state: np.ndarray, steps: int) -> np.ndarray:
    """Forecasts of the series themselves: expected changes added to the last months."""
    past, _ = _model(coefs)
    tail = np.array([y[-SEASON - 1:] for y in series])
    out = np.concatenate([tail, np.zeros((len(series), steps))], axis=1)
    for h in range(steps):
        t, change = SEASON + 1 + h, state[:, 0].copy()
        out[:, t] = change + out[:, t - 1] + out[:, t - SEASON] - out[:, t - SEASON - 1]
        state = past * change[:, None] + np.concatenate([state[:, 1:], np.zeros((len(state), 1))], axis=1)
    return out[:, SEASON + 1:]


def _naive_path(y: np.ndarray, steps: int) -> np.ndarray:
    """``forecast_seasonal_naive`` for one series already in memory."""
    m = min(SEASON, len(y))
    drift = (y[SEASON:] - y[:-SEASON]).mean() if len(y) > SEASON else 0.0
    h = np.arange(steps)
    return y[len(y) - m + h % m] + (h // m + 1) * drift


def _forecast(series: list[np.ndarray], steps: int, given: Sequence[float] | None) -> list[dict]:
    """One result per series; those that the model is identified for run side by side."""
    out = [{"path": _naive_path(y, steps), "method": "seasonal_naive", "converged": None, "loglik": None, "coefs": None} for y in series]
    changes = [np.diff(y)[SEASON:] - np.diff(y)[:-SEASON] if len(y) > SEASON + 1 else np.empty(0) for y in series]
    able = [i for i, (w, y) in enumerate(zip(changes, series))
            if len(w) > STATES + 5 and np.isfinite(w).all() and np.ptp(w) > 1e-12 * max(1.0, np.abs(y).max())]
    for a in range(0, len(able), SIDE_BY_SIDE):
        rows = able[a:a + SIDE_BY_SIDE]
        length = np.array([len(changes[i]) for i in rows])
        scale = np.array([changes[i].std() for i in rows])
        w = np.zeros((len(rows), length.max()))
        for j, i in enumerate(rows):
            w[j, -length[j]:] = changes[i] / scale[j]
        if given is None:
            coefs, converged = fit_sarima(w, length)
        else:
            coefs, converged = np.tile(np.array(given, float), (len(rows), 1)), [None] * len(rows)
        fit, state = (x[:, 0] for x in kalman(w, length, coefs[:, None]))
        paths = _paths([series[i] for i in rows], coefs, state * scale[:, None], steps)
        for j, i in enumerate(rows):
            if np.isfinite(paths[j]).all():
                months = length[j] - STATES
                out[i] = {"path": paths[j], "method": "sarima", "converged": None if given is not None else bool(converged[j]),
                          "loglik": float(fit[j] - months * np.log(scale[j])), "coefs": coefs[j]}
    return out


_FITTED = "struct<path:array<double>,method:string,converged:boolean,loglik:double,coefs:array<double>>"


def fit_series(df: DataFrame, keys, ts, value, steps: int = 120, given: Sequence[float] | None = None) -> DataFrame:
    """One row per series: the last month, the forecast ``path``, and how it was found.

    The seasonal model (1,1,1)(1,1,1)12 is fitted by the likelihood of a
    Kalman filter with diffuse start.  ``converged`` says whether the search
    ended at a flat point, ``loglik`` and ``coefs`` (autoregressive, seasonal,
    moving average, seasonal) what it found; all three are null where the
    model is not identified (no more than five months count after the start,
    or changes that do not vary) and the method is ``seasonal_naive``.
    ``given`` coefficients take the place of the search.  Null values are left
    out, as if the months around them were neighbours.

    A series' months become one row (bounded by the calendar); rows are dealt
    over all shuffle partitions, and a task fits its series side by side.
    """
    spark = df.sparkSession
    known = df.filter(F.col(value).isNotNull()).select(*keys, F.struct(F.col(ts), F.col(value).cast("double").alias("y")).alias("__month"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = known.repartition(parts, *keys).groupBy(*keys).agg(F.array_sort(F.collect_list("__month")).alias("__months"))

    @F.arrow_udf(_FITTED)
    def fitted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_forecast([np.array(y, float) for y in batch.to_pylist()], steps, given), pa.struct([
                ("path", pa.list_(pa.float64())), ("method", pa.string()), ("converged", pa.bool_()), ("loglik", pa.float64()),
                ("coefs", pa.list_(pa.float64()))]))
    last = F.element_at("__months", -1)[ts]
    return rows.select(*keys, last.alias(ts), fitted(F.transform("__months", lambda m: m["y"])).alias("__fit")).select(*keys, ts, "__fit.*")


def forecast_sarima(df: DataFrame, keys, ts, value, steps: int = 120, given: Sequence[float] | None = None) -> DataFrame:
    """Seasonal ARIMA point forecast per series, from the month after its last value; see ``fit_series``."""
    found = fit_series(df, keys, ts, value, steps, given)
    months = found.select(*keys, F.col(ts).alias("__last"), "method", "converged", F.posexplode("path").alias("__at", "forecast"))
    return months.select(*keys, F.trunc(F.add_months("__last", F.col("__at") + 1), "MM").alias(ts), "forecast", "method", "converged")


# -- trends ------------------------------------------------------------------

def trend_predict(df: DataFrame, keys, x: str, y: str, targets: Sequence[int], out: str = "prediction") -> DataFrame:
    """Least-squares line evaluated at ``targets``; short histories fall back.

    No known value gives 0, fewer than four give the last known one.
    """
    known_x = F.when(F.col(y).isNotNull(), F.col(x).cast("double"))
    fit = df.groupBy(*keys).agg(
        F.count(y).alias("__n"), F.max_by(y, known_x).alias("__last"),
        F.regr_slope(F.col(y), known_x).alias("__b"), F.regr_avgx(F.col(y), known_x).alias("__x"),
        F.regr_avgy(F.col(y), known_x).alias("__y"),
    )
    years = fit.select("*", F.explode(F.array(*[F.lit(int(t)) for t in targets])).alias(x))
    # Through the centre of the points: an intercept at year 0 would cost digits.
    line = F.coalesce(F.col("__y") + F.col("__b") * (F.col(x) - F.col("__x")), F.col("__last"))
    return years.select(
        *keys, x,
        F.when(F.col("__n") == 0, F.lit(0.0)).when(F.col("__n") < 4, F.col("__last")).otherwise(line).alias(out),
    )


def forecast_share_targets(
    hist: DataFrame, totals: DataFrame, keys, ts, total: str, parts: Sequence[str], targets: Sequence[int],
    bounds=SHARE_BOUNDS, sum_limit: float = SHARE_SUM_LIMIT,
) -> DataFrame:
    """Annual values of two leading parts from the trend of their shares.

    ``hist`` is monthly; ``totals`` holds ``(keys, year, <total>_annual)``.
    """
    yearly = annual_sum(hist, keys, ts, [total, *parts])
    share = yearly.select(*keys, "year", *[safe_ratio(f"{p}_annual", f"{total}_annual").alias(p) for p in parts])
    long = share.select(*keys, "year", F.inline(F.array(*[
        F.struct(F.lit(p).alias("part"), F.col(p).alias("share")) for p in parts
    ])))
    trend = trend_predict(long, [*keys, "part"], "year", "share", targets)
    limited = reduce(
        lambda acc, item: acc.when(F.col("part") == item[0], clip("prediction", item[1][0], item[1][1])),
        list(zip(parts, bounds))[1:],
        F.when(F.col("part") == parts[0], clip("prediction", bounds[0][0], bounds[0][1])),
    )
    wide = trend.groupBy(*keys, "year").agg(*[F.max(F.when(F.col("part") == p, limited)).alias(p) for p in parts])
    both = reduce(lambda a, b: a + b, [F.col(p) for p in parts])
    squeeze = F.when(both > sum_limit, sum_limit / both).otherwise(F.lit(1.0))
    joined = totals.filter(F.col("year").isin([int(t) for t in targets])).join(wide, [*keys, "year"])
    return joined.select(
        *keys, "year", f"{total}_annual",
        *[(F.col(f"{total}_annual") * F.col(p) * squeeze).alias(f"{p}_annual") for p in parts],
    )


def _melt_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str], name: str) -> DataFrame:
    return df.select(*ids, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias(name)) for m in metrics
    ])))


def forecast_entity_shares(
    annual: DataFrame, national: DataFrame, keys, entity: str, metrics: Sequence[str], targets: Sequence[int],
    since: int = SHARE_HISTORY_FROM,
) -> DataFrame:
    """Annual values of every entity from the trend of its share in the parent.

    Shares are cut at 0 and normalised to 1 per metric and year, split evenly
    when none is positive.  The normaliser is an aggregate joined back, since
    a parent may have any number of entities.
    """
    parent = _melt_metrics(national, [*keys, "year"], metrics, "parent")
    history = attach_totals(_melt_metrics(annual, [*keys, entity, "year"], metrics, "value"), parent, [*keys, "year", "metric"])
    recent = F.when(F.col("year") >= since, safe_ratio("value", "parent"))
    trend = trend_predict(
        history.select(*keys, entity, "metric", "year", recent.alias("share")),
        [*keys, entity, "metric"], "year", "share", targets,
    ).withColumn("prediction", clip("prediction", lo=0.0))
    group = [*keys, "metric", "year"]
    sums = trend.groupBy(*group).agg(F.sum("prediction").alias("__sum"), F.count(F.lit(1)).alias("__n"))
    share = F.when(F.col("__sum") <= 0, 1.0 / F.col("__n")).otherwise(safe_ratio("prediction", "__sum"))
    valued = trend.join(sums, group).join(parent, group, "left").select(
        *keys, entity, "year", "metric", (share * F.col("parent")).alias("value")
    )
    return valued.groupBy(*keys, entity, "year").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    )


# -- monthly targets ---------------------------------------------------------

def splice(hist: DataFrame, fc: DataFrame, keys, ts: str, last_year: int) -> DataFrame:
    """History, then the forecast after the last month of each series up to ``last_year``."""
    end = F.lit(f"{last_year + 1:04d}-01-01").cast("date")
    seen = hist.groupBy(*keys).agg(F.max(ts).alias("__seen"))
    after = fc.filter(F.col(ts) < end).join(seen, list(keys), "left").filter(F.col("__seen").isNull() | (F.col(ts) > F.col("__seen")))
    return union_by_name(hist, after.drop("__seen"))


def climatology(df: DataFrame, keys, ts, cols: Sequence[str], years=CLIMATOLOGY_YEARS) -> DataFrame:
    """Mean monthly weight of the year over ``years``, renormalised to 1."""
    year, month = F.year(ts).alias("year"), F.month(ts).alias("month")
    lo, hi = (F.lit(f"{years[0]:04d}-01-01").cast("date"), F.lit(f"{years[1] + 1:04d}-01-01").cast("date"))
    # A weight needs its own year only, so other years can go before the window.
    rows = df.filter((F.col(ts) >= lo) & (F.col(ts) < hi)).select(*keys, year, month, *cols)
    weighted = rows.select(*keys, "month", *[group_weight_expr([*keys, "year"], c).alias(f"w_{c}") for c in cols])
    mean = weighted.groupBy(*keys, "month").agg(*[F.avg(f"w_{c}").alias(f"w_{c}") for c in cols])
    series = Window.partitionBy(*keys)
    return mean.select(*keys, "month", *[safe_ratio(f"w_{c}", F.sum(f"w_{c}").over(series)).alias(f"w_{c}") for c in cols])


def monthly_targets(
    hist: DataFrame, total_path: DataFrame, annual: DataFrame, clim: DataFrame, keys, ts, total: str, parts: Sequence[str],
) -> DataFrame:
    """Monthly parent values: observed, then annual targets spread by climatology.

    ``total_path`` is the spliced monthly total; ``annual`` holds
    ``<part>_annual`` for the years of its months that ``hist`` lacks.
    """
    future = attach_by_month(total_path.join(hist.select(*keys, ts), [*keys, ts], "left_anti"), clim, keys, ts)
    future = future.withColumn("year", F.year(ts)).join(
        annual.select(*keys, "year", *[f"{p}_annual" for p in parts]), [*keys, "year"]
    )
    spread = future.select(*keys, ts, total, *[(F.col(f"w_{p}") * F.col(f"{p}_annual")).alias(p) for p in parts])
    return hist.select(*keys, ts, total, *parts).unionByName(spread)


def disaggregate(annual: DataFrame, monthly: DataFrame, keys, entity: str, ts, metrics: Mapping[str, str]) -> DataFrame:
    """Split monthly parent values by annual entity shares.

    ``metrics`` maps the annual column to the monthly one.  An entity's share
    is 0 where the parent's entities sum to nothing.
    """
    sums = annual.groupBy(*keys, "year").agg(*[F.sum(a).alias(f"__sum_{a}") for a in metrics])
    shared = attach_totals(annual, sums, [*keys, "year"])
    share: dict[str, Column] = {a: safe_ratio(a, f"__sum_{a}", fill=0.0) for a in metrics}
    extra = [c for c in annual.columns if c not in (*keys, entity, "year", *metrics)]
    shared = shared.select(*keys, entity, "year", *extra, *[c.alias(f"__share_{a}") for a, c in share.items()])
    months = monthly.select(*keys, ts, F.year(ts).alias("year"), F.month(ts).alias("month"), *metrics.values())
    return expand_months(shared, months, [*keys, "year"]).select(
        *keys, entity, month_start("year", "month").alias(ts), "year", "month", *extra,
        *[(F.col(f"__share_{a}") * F.col(m)).alias(m) for a, m in metrics.items()],
    )
