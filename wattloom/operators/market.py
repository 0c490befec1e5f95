"""Market-clearing formulas as expressions over months and parameter sets.

Wide rows carry one column per technology plus ``demand``; parameters
(``tax``, ``subsidy``, ``scale`` …) are columns of the same row, normally put
there by ``scenario_grid``.  Random factors are columns too and default to 1.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.functions.scalars import clip, row_sum, safe_ratio
from wattloom.operators.align import match_observed, scenario_grid
from wattloom.session import materialize

# Technologies (variable cost, carbon factor, bid markup, merit
# priority, smallest and largest share).
TECHNOLOGIES = {
    "thermal": (0.35, 0.80, 0.12, 5, 0.35, 0.80),
    "hydro": (0.18, 0.02, 0.06, 2, 0.10, 0.30),
    "nuclear": (0.25, 0.01, 0.08, 3, 0.02, 0.12),
    "wind": (0.20, 0.0, 0.05, 1, 0.02, 0.25),
    "solar": (0.22, 0.0, 0.05, 1, 0.01, 0.20),
}
RENEWABLE_BIDDERS = ("wind", "solar")
CLEAN = ("hydro", "nuclear", "wind", "solar")
# Policy, price and mix constants.
DEFAULT_TAX = 50.0
DEFAULT_PRIORITY = 1.0
BASE_PRICE = 100.0
PRICE_FLOOR = 100.0
PROXY_CEILING = 5000.0
TARGET_PRICE = 376.28
PRIORITY_DISCOUNT = 0.05
TAX_FREE, TAX_SPAN, MAX_PENALTY = 50.0, 250.0, 0.70
SUBSIDY_GAIN = 0.9
TINY_SUPPLY = 0.0001
PULL = 0.35
FIXED_SHARES = {"wind": 0.20, "solar": 0.15, "hydro": 0.20, "nuclear": 0.20, "thermal": 0.25}
# Start share, growth over the horizon, cap.
MIX_PATH = {"wind": (0.20, 0.08, 0.35), "solar": (0.15, 0.10, 0.30), "nuclear": (0.20, 0.02, 0.25)}
HYDRO_SHARE, THERMAL_MIN, THERMAL_MIN_TAXED = 0.20, 0.05, 0.03
SECTOR_WEIGHTS = (0.2, 0.4, 0.2, 0.2)
COLOUR_CLASSES, DEGENERATE_CLASS = 14, 7

TECHS = tuple(TECHNOLOGIES)


def technology_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(name, *values) for name, values in TECHNOLOGIES.items()],
        "tech string, variable_cost double, carbon_factor double, bid_markup double, priority int, "
        "min_share double, max_share double",
    )


def _param(df: DataFrame, name: str, default: float) -> Column:
    return F.col(name) if name in df.columns else F.lit(default)


def thermal_penalty(tax: Column) -> Column:
    return clip((tax - TAX_FREE) / TAX_SPAN, 0.0, MAX_PENALTY)


def by_technology(df: DataFrame, ids: Sequence[str], techs: Sequence[str] = TECHS) -> DataFrame:
    """Wide generation columns to rows ``(ids, tech, generation)``."""
    return df.select(*ids, F.inline(F.array(*[
        F.struct(F.lit(t).alias("tech"), F.col(t).alias("generation")) for t in techs
    ])))


def bid_price(df: DataFrame, tech: DataFrame) -> DataFrame:
    """Cost with markup plus carbon cost, wind and solar with a priority discount."""
    tax, priority = _param(df, "tax", DEFAULT_TAX), _param(df, "priority", DEFAULT_PRIORITY)
    cost = F.col("variable_cost") * (1 + F.col("bid_markup")) + F.col("carbon_factor") * tax
    discount = F.when(F.col("tech").isin(*RENEWABLE_BIDDERS), 1 - PRIORITY_DISCOUNT * priority).otherwise(F.lit(1.0))
    # The technology table is a handful of literal rows.
    costs = F.broadcast(tech.select("tech", "variable_cost", "carbon_factor", "bid_markup"))
    return df.join(costs, "tech").select(*df.columns, (cost * discount).alias("bid_price"))


def clear_market(df: DataFrame, demand: str = "demand", supply: str = "supply", sensitivity: float = 1.0) -> DataFrame:
    """Gap, tightness and price of a month."""
    tightness = F.col(demand) / F.greatest(F.col(supply), F.lit(TINY_SUPPLY))
    price = (F.lit(BASE_PRICE) * tightness * _param(df, "sensitivity", sensitivity)
             * _param(df, "price_factor", 1.0) * _param(df, "scale", 1.0))
    return df.withColumns({
        "gap": F.col(supply) - F.col(demand),
        "tightness": F.when(F.col(supply).isNotNull(), tightness),
        "price": F.when(F.col(supply).isNotNull(), clip(price, lo=PRICE_FLOOR)),
    })


def settlement(df: DataFrame, tech: DataFrame) -> DataFrame:
    """Revenue, emission and profit per technology row with ``generation`` and ``price``."""
    costs = F.broadcast(tech.select("tech", "variable_cost", "carbon_factor"))
    revenue = F.col("generation") * F.col("price")
    return df.join(costs, "tech").select(
        *df.columns, revenue.alias("revenue"), (F.col("generation") * F.col("carbon_factor")).alias("emission"),
        (revenue - F.col("generation") * F.col("variable_cost")).alias("profit"),
    )


def policy_reallocate(df: DataFrame, techs: Sequence[str] = TECHS) -> DataFrame:
    """Carbon tax cuts thermal, subsidy lifts wind and solar, the total stays."""
    tax, subsidy = _param(df, "tax", DEFAULT_TAX), _param(df, "subsidy", 0.0)
    boost = 1 + SUBSIDY_GAIN * F.greatest(subsidy, F.lit(0.0))
    factor = {t: F.lit(1.0) for t in techs}
    factor["thermal"] = 1 - thermal_penalty(tax)
    for t in RENEWABLE_BIDDERS:
        factor[t] = boost
    old, new = row_sum(techs), row_sum([F.col(t) * factor[t] for t in techs])
    keep = F.when(new > 0, old / new).otherwise(F.lit(1.0))
    return df.withColumns({t: F.when(old > 0, F.col(t) * factor[t] * keep).otherwise(F.col(t)) for t in techs})


def market_share(df: DataFrame, ids: Sequence[str], demand: str = "demand", techs: Sequence[str] = TECHS) -> DataFrame:
    """Generation of each technology relative to demand, one row per technology."""
    base = clip(demand, TINY_SUPPLY)
    return by_technology(df, [*ids, demand], techs).select(
        *ids, "tech", (F.col("generation") / base).alias("market_share")
    )


def forecast_mix(df: DataFrame, limit: int | str, step: str = "step", policy: bool = True) -> DataFrame:
    """Technology shares along the forecast horizon, adding up to 1.

    ``limit``: the horizon in steps, or the column that holds each row's.
    """
    priority = F.greatest(F.least(_param(df, "priority", DEFAULT_PRIORITY), F.lit(1.5)), F.lit(0.5))
    horizon = F.col(limit) if isinstance(limit, str) else F.lit(limit)
    progress = F.col(step) / F.greatest(horizon, F.lit(1)).cast("double")
    raw = {t: F.least(F.lit(cap), start + progress * rise * priority) for t, (start, rise, cap) in MIX_PATH.items()}
    raw["hydro"] = HYDRO_SHARE * _param(df, "hydro_factor", 1.0)
    thermal = F.greatest(F.lit(THERMAL_MIN), 1 - raw["wind"] - raw["solar"] - raw["hydro"] - raw["nuclear"])
    if policy:
        tax = _param(df, "tax", DEFAULT_TAX)
        thermal = F.greatest(F.lit(THERMAL_MIN_TAXED), thermal * (1 - thermal_penalty(tax)))
    raw["thermal"] = thermal
    total = row_sum(list(raw.values()))
    return df.withColumns({f"share_{t}": raw[t] / total for t in TECHS})


def anchor_supply(df: DataFrame, anchor: str = "anchor", pull: float = PULL) -> DataFrame:
    """Generation from shares and availability, pulled part of the way back to the anchor."""
    target = clip(anchor, 0.0)
    factor = _param(df, "supply_factor", 1.0)
    available = {t: factor for t in TECHS}
    available["thermal"] = factor * _param(df, "thermal_availability", 1.0)
    for t in RENEWABLE_BIDDERS:
        available[t] = factor * _param(df, "renewable_availability", 1.0)
    first = df.withColumns({t: target * F.col(f"share_{t}") * available[t] for t in TECHS})
    total = row_sum(TECHS)
    k = (pull * target + (1 - pull) * total) / F.greatest(total, F.lit(TINY_SUPPLY))
    pulled = first.withColumns({t: F.col(t) * k for t in TECHS})
    return pulled.withColumn("supply", row_sum(TECHS))


def sector_weights(hist: DataFrame, keys, ts, sectors: Sequence[str], defaults: Sequence[float] = SECTOR_WEIGHTS) -> DataFrame:
    """Demand composition of the last historical month of every series."""
    last = hist.groupBy(*keys).agg(F.max_by(F.struct(*sectors), ts).alias("__last"))
    values = [F.coalesce(F.col("__last")[s], F.lit(0.0)) for s in sectors]
    total = row_sum(values)
    return last.select(*keys, *[
        F.when(total > 0, v / total).otherwise(F.lit(float(d))).alias(f"weight_{s}")
        for s, v, d in zip(sectors, values, defaults)
    ])


def split_sectors(df: DataFrame, weights: DataFrame, keys, sectors: Sequence[str], demand: str = "demand") -> DataFrame:
    """Split baseline demand by the weights of its series (one row per series)."""
    base = clip(demand, 0.0) * _param(df, "demand_factor", 1.0)
    joined = df.join(weights, list(keys))
    return joined.select(*df.columns, *[(base * F.col(f"weight_{s}")).alias(s) for s in sectors])


def grow_demand(df: DataFrame, cols: Sequence[str], step: str = "step", adj: float = 1.0) -> DataFrame:
    """Demand after ``step`` months of constant yearly growth, in closed form."""
    rate = F.greatest(_param(df, "growth_adj", adj), F.lit(0.5))
    factor = F.pow(rate, F.col(step) / F.lit(12.0))
    return df.withColumns({c: F.col(c) * factor for c in cols})


def clear_fixed(df: DataFrame, demand: str = "demand", shares: Mapping[str, float] = FIXED_SHARES) -> DataFrame:
    """Clearing with fixed technology shares of demand."""
    generated = df.withColumns({t: F.col(demand) * s for t, s in shares.items()})
    supplied = generated.withColumn("supply", row_sum(list(shares)))
    tightness = F.col(demand) / F.greatest(F.col("supply"), F.lit(TINY_SUPPLY))
    return supplied.withColumns({
        "gap": F.col("supply") - F.col(demand), "tightness": tightness,
        "price": clip(BASE_PRICE * tightness, lo=PRICE_FLOOR),
    })


def scarcity_proxy(
    df: DataFrame, keys, demand: str = "demand", supply: str = "supply", observed: str = "observed",
    enabled: bool = True, annual_anchor: bool = False,
) -> DataFrame:
    """Stand-in price for series in which nothing observed matched any month."""
    if not enabled or annual_anchor:
        return df
    floor = lambda c: clip(c, 1e-6)  # unknown stays unknown: no price is invented from it
    proxy = clip(BASE_PRICE * (floor(demand) / floor(supply)), PRICE_FLOOR, PROXY_CEILING)
    matched = F.count(observed).over(Window.partitionBy(*keys))
    return df.withColumn(observed, F.when(matched == 0, proxy).otherwise(F.col(observed)))


def squared_error(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    error = F.col("price") - F.col("observed")
    return pairs.groupBy(*by).agg(
        F.coalesce(F.sum(error * error), F.lit(0.0)).alias("sse"), F.count(error).alias("pairs")
    )


def calibration_error(pred: DataFrame, obs: DataFrame, keys, ts, mode: str = "monthly", by=()) -> DataFrame:
    """Squared error and pair count of predicted against observed prices.

    ``pred`` has ``price``, ``obs`` has ``observed``.  Monthly mode matches on
    the month, annual mode compares the mean predicted month of a year with
    the observed year (``obs`` then has ``year`` instead of ``ts``).
    ``by`` keeps parameter columns of ``pred`` apart.
    """
    if mode == "annual":
        yearly = pred.groupBy(*keys, *by, F.year(ts).alias("year")).agg(F.avg("price").alias("price"))
        pairs = match_observed(yearly, obs, [*keys, "year"])
    else:
        pairs = match_observed(pred, obs, [*keys, ts])
    return squared_error(pairs, [*keys, *by])


#: Parameters that multiply the price, and those that leave it alone because dispatch keeps total supply.
PRICE_AXES, FLAT_AXES = ("sensitivity", "price_factor", "scale"), ("tax", "subsidy", "priority")


def error_pieces(df: DataFrame, obs: DataFrame, keys, ts, mode: str = "monthly", moving: Sequence[str] = PRICE_AXES) -> DataFrame:
    """The calibration error of each series as a function of what multiplies its prices, piece by piece.

    With ``m`` the product of the ``moving`` parameters, a month's price is
    the floor up to ``m = onset`` and proportional to ``m`` beyond, so the
    error from one onset to the next is ``a m^2 + b m + c``.  Running sums over
    a series' months in the order of their onsets give all pieces at once.
    Rows: keys, ``onset`` (-1 for the first piece, which every series has),
    ``a``, ``b``, ``c``, ``pairs`` and ``total``, the sum of squared
    observations.  ``obs`` has one ``observed`` a month, or a ``year`` in
    annual mode; parameters that are not moving are read from ``df``.
    """
    factor = F.lit(BASE_PRICE) * F.col("demand") / F.greatest(F.col("supply"), F.lit(TINY_SUPPLY))
    for name in PRICE_AXES:
        if name not in moving:
            factor = factor * _param(df, name, 1.0)
    cell, seen = (F.year(ts), "year") if mode == "annual" else (F.col(ts), ts)
    months = df.select(*keys, cell.alias("__cell"), F.when(F.col("supply").isNotNull(), factor).alias("__price"))
    seen = obs.select(*keys, F.col(seen).alias("__cell"), F.col("observed").cast("double").alias("__seen"))
    rows = match_observed(months, seen, [*keys, "__cell"]).filter("__price is not null and __seen is not null")
    rows = rows.withColumn("onset", F.when(F.col("__price") > 0, F.lit(PRICE_FLOOR) / F.col("__price")))
    if mode == "annual":
        by = Window.partitionBy(*keys, "__cell")
        ordered = by.orderBy(F.col("onset").asc_nulls_last(), "__price").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumns({"__n": F.count(F.lit(1)).over(by), "__k": F.count(F.lit(1)).over(ordered), "__sum": F.sum("__price").over(ordered)})
    else:
        rows = rows.withColumns({"__n": F.lit(1), "__k": F.lit(1), "__sum": F.col("__price")})

    def line(k: Column, total: Column) -> tuple[Column, Column]:
        """Mean price less the observed one with ``k`` months above the floor: slope in m, and the rest."""
        return total / F.col("__n"), F.lit(PRICE_FLOOR) * (F.col("__n") - k) / F.col("__n") - F.col("__seen")
    slope, rest = line(F.col("__k"), F.col("__sum"))
    slope_before, rest_before = line(F.col("__k") - 1, F.col("__sum") - F.col("__price"))
    once = F.col("__k") == 1
    start = rows.groupBy(*keys).agg(
        F.sum(F.when(once, (F.lit(PRICE_FLOOR) - F.col("__seen")) ** 2)).alias("__floor"),
        F.sum(F.when(once, F.col("__seen") ** 2)).alias("total"), F.count(F.when(once, True)).alias("pairs"))
    start = df.select(*keys).distinct().join(start, list(keys), "left").select(
        *keys, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("__floor", "total")], F.coalesce("pairs", F.lit(0)).alias("pairs"))
    upto = Window.partitionBy(*keys).orderBy("onset").rangeBetween(Window.unboundedPreceding, 0)
    turns = rows.filter("onset is not null").select(*keys, "onset", *[F.sum(x).over(upto).alias(n) for n, x in (
        ("a", slope * slope - slope_before * slope_before), ("b", 2 * (slope * rest - slope_before * rest_before)),
        ("c", rest * rest - rest_before * rest_before))]).distinct()
    pieces = turns.join(start, list(keys)).select(*keys, "onset", "a", "b", (F.col("__floor") + F.col("c")).alias("c"), "pairs", "total")
    zero = F.lit(0.0)
    return pieces.unionByName(start.select(*keys, F.lit(-1.0).alias("onset"), zero.alias("a"), zero.alias("b"), F.col("__floor").alias("c"), "pairs", "total"))


def _errors_at(pieces: DataFrame, points: DataFrame, keys) -> DataFrame:
    """``points`` (keys, ``m``, ...) with ``sse``, ``pairs`` and ``total`` of the piece that holds ``m``."""
    piece = F.struct("a", "b", "c", "pairs", "total")
    both = points.withColumn("__turn", F.lit(None).cast("struct<a:double,b:double,c:double,pairs:bigint,total:double>")) \
        .unionByName(pieces.select(*keys, F.col("onset").alias("m"), piece.alias("__turn")), allowMissingColumns=True)
    upto = Window.partitionBy(*keys).orderBy("m", F.col("__turn").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    held = both.withColumn("__at", F.last("__turn", ignorenulls=True).over(upto)).filter("__turn is null")
    sse = F.greatest(F.lit(0.0), (F.col("__at.a") * F.col("m") + F.col("__at.b")) * F.col("m") + F.col("__at.c"))
    return held.select(*points.columns, sse.alias("sse"), "__at.pairs", "__at.total")


def calibrate_grid(
    df: DataFrame, obs: DataFrame, keys, ts, axes: Mapping[str, Sequence[float]], mode: str = "monthly",
    rounds: int = 0,
) -> DataFrame:
    """Parameters with the smallest calibration error per series.

    ``sensitivity``, ``price_factor`` and ``scale`` multiply the price; tax,
    subsidy and priority leave total supply, and so the error, as it is and
    take their smallest value.  Other names raise, as do negative values of
    axes that move the price.  The error of a combination comes from the
    pieces of ``error_pieces``, so months are read once and never multiplied
    by parameters.  Errors that differ by less than 1e-10 of the squared
    observations are ties, which go to the smallest parameters in the order of
    ``axes``.  Each of ``rounds`` looks at a box of nine values along every
    axis that moves the price, around the best so far, with a quarter of the
    last round's step.
    """
    if unknown := [n for n in axes if n not in (*PRICE_AXES, *FLAT_AXES)]:
        raise ValueError(f"unknown axes {unknown}")
    moving = {n: sorted(map(float, v)) for n, v in axes.items() if n in PRICE_AXES}
    if any(v[0] < 0 for v in moving.values()):
        raise ValueError("negative values of an axis that moves the price")
    pieces = materialize(error_pieces(df, obs, keys, ts, mode, list(moving)))
    series = pieces.filter("onset < 0").select(*keys)

    def best(points: DataFrame) -> DataFrame:
        product = reduce(lambda x, y: x * y, [F.col(n) for n in moving], F.lit(1.0))
        errors = _errors_at(pieces, points.withColumn("m", product), keys)
        close = F.round(F.col("sse") / F.greatest("total", F.lit(TINY_SUPPLY)), 10)
        order = F.struct(close.alias("__sse"), *moving)
        return errors.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in (*moving, "sse", "pairs")])

    found = best(scenario_grid(series, moving).drop("scenario_id"))
    step = {n: (v[-1] - v[0]) / max(1, len(v) - 1) for n, v in moving.items()}
    for _ in range(rounds):
        step = {n: s / 4 for n, s in step.items()}
        around = found.select(*keys, *moving)
        for n, v in moving.items():
            if step[n]:
                near = [F.least(F.greatest(F.col(n) + k * step[n], F.lit(v[0])), F.lit(v[-1])) for k in range(-4, 5)]
                around = around.withColumn(n, F.explode(F.array_distinct(F.array(*near))))
        found = best(around)
    flat = {n: F.lit(float(min(v))) for n, v in axes.items() if n in FLAT_AXES}
    return found.select(*keys, *[(flat[n] if n in flat else F.col(n)).alias(n) for n in axes], "sse", "pairs")


def calibrate_exact(df: DataFrame, obs: DataFrame, keys, ts, low: float, high: float, mode: str = "monthly") -> DataFrame:
    """The multiplier within ``[low, high]`` with the smallest error per series, without a grid: the least of all pieces' minima.

    Columns: keys, ``scale``, ``sse``, ``pairs``; errors within 1e-10 of the
    squared observations are ties, which go to the smallest multiplier.
    """
    pieces = error_pieces(df, obs, keys, ts, mode)
    until = F.lead("onset", 1, float("inf")).over(Window.partitionBy(*keys).orderBy("onset"))
    inside = pieces.withColumns({"__from": F.greatest("onset", F.lit(float(low))), "__to": F.least(until, F.lit(float(high)))}).filter("__from <= __to")
    lowest = F.when(F.col("a") > 0, F.least(F.greatest(-F.col("b") / (2 * F.col("a")), "__from"), "__to")).otherwise(F.col("__from"))
    at = inside.withColumn("scale", lowest).withColumn("sse", F.greatest(F.lit(0.0), (F.col("a") * F.col("scale") + F.col("b")) * F.col("scale") + F.col("c")))
    order = F.struct(F.round(F.col("sse") / F.greatest("total", F.lit(TINY_SUPPLY)), 10), "scale")
    return at.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in ("scale", "sse", "pairs")])


def compare_scenarios(df: DataFrame, axes: Mapping[str, Sequence[float]], target: float = TARGET_PRICE, demand: str = "demand") -> DataFrame:
    """Price, renewable share, balance and price objective per month and scenario.

    Rows are historical months with observed generation or forecast months
    with anchored generation; policy dispatch is applied in both.
    """
    out = policy_reallocate(scenario_grid(df, axes))
    out = clear_market(out.withColumn("supply", row_sum(TECHS)), demand, "supply")
    return out.withColumns({
        "renewable_share": F.coalesce(safe_ratio(row_sum(CLEAN) * 100, "supply"), F.lit(0.0)),
        "balance": F.col("supply") - F.col(demand),
        "objective": F.abs(F.col("price") - target),
    })


def class_breaks(df: DataFrame, metric: str, n: int = COLOUR_CLASSES) -> DataFrame:
    """Equal-width class of a metric on the scale of the whole table, 0 to n-1."""
    scale = df.agg(F.struct(F.min(metric).alias("lo"), F.max(metric).alias("hi")).alias("scale"))
    ranged = df.withColumn("__scale", scale.scalar())
    lo, hi = F.col("__scale.lo"), F.col("__scale.hi")
    spread = hi - lo
    t = clip(safe_ratio(F.col(metric) - lo, spread), 0.0, 1.0)
    cls = F.least(F.floor(t * n), F.lit(n - 1)).cast("int")
    return ranged.withColumn(
        "class", F.when(F.col(metric).isNull(), F.lit(None).cast("int"))
        .when(spread <= 0, F.lit(min(DEGENERATE_CLASS, n - 1))).otherwise(cls)
    ).drop("__scale")
