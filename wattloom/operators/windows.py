"""Positional window operators over one series ordered by month.

All windows partition by the series keys.  Windows over ``keys`` plus a
calendar part reuse the hash partitioning on ``keys``: placed after a
``keys`` window they cost a sort, never another exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattloom.functions.scalars import safe_ratio


def require_keys(keys: Sequence[str]) -> None:
    """Positional windows without a series key would gather the table in one task."""
    if not keys:
        raise ValueError("at least one series key is required; give a single series a constant key column")


def series(keys: Sequence[str], ts: str) -> WindowSpec:
    require_keys(keys)
    return Window.partitionBy(*keys).orderBy(ts)


def q(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def over(keys: Sequence[str], ts: str | None = None, lo: str = "", hi: str = "current row") -> str:
    """SQL text of a window clause.

    Operators over many columns are written as SQL expressions: one call per
    column instead of one per node keeps plan building fast on wide panels.
    """
    require_keys(keys)
    order = f" order by {q(ts)}" if ts else ""
    frame = f" rows between {lo} and {hi}" if lo else ""
    return f"over (partition by {', '.join(q(k) for k in keys)}{order}{frame})"


PAST = "unbounded preceding"


def lags(df: DataFrame, keys, ts, col, ns: Sequence[int], prefix: str | None = None) -> DataFrame:
    w = series(keys, ts)
    return df.withColumns({f"{prefix or col}_lag_{n}": F.lag(col, n).over(w) for n in ns})


def rolling_mean_sql(keys, ts, col: str, n: int, shift: int = 0) -> str:
    """Mean of ``n`` rows ending ``shift`` rows back; NULL unless all are known."""
    hi = f"{shift} preceding" if shift else "current row"
    frame = over(keys, ts, f"{n - 1 + shift} preceding", hi)
    return f"case when count({q(col)}) {frame} = {n} then avg({q(col)}) {frame} end"


def rolling_mean(df: DataFrame, keys, ts, col, n: int, shift: int = 0, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{col}_roll_mean_{n}", F.expr(rolling_mean_sql(keys, ts, col, n, shift)))


def pct_change_many(df: DataFrame, keys, ts, spec: dict[str, tuple[str, int]], pad: bool = True) -> DataFrame:
    """Several percent changes at once: ``{output: (column, rows back)}``.

    Two projections whatever the number of columns: forward fill, then lag.
    """
    sources = list(dict.fromkeys(c for c, _ in spec.values()))
    fill = (lambda c: f"last({q(c)}) ignore nulls {over(keys, ts, PAST)}") if pad else q
    base = df.selectExpr("*", *[f"{fill(c)} as {q('__fill_' + c)}" for c in sources])
    return base.selectExpr(*[q(c) for c in df.columns], *[
        f"try_divide({q('__fill_' + c)}, lag({q('__fill_' + c)}, {n}) {over(keys, ts)}) - 1 as {q(out)}"
        for out, (c, n) in spec.items()
    ])


def pct_change(df: DataFrame, keys, ts, col, n: int, pad: bool = True, out: str | None = None) -> DataFrame:
    return pct_change_many(df, keys, ts, {out or f"{col}_chg_{n}": (col, n)}, pad)


def day_gap(df: DataFrame, keys, ts, out: str = "gap_days") -> DataFrame:
    return df.withColumn(out, F.datediff(ts, F.lag(ts).over(series(keys, ts))))


def group_mean(df: DataFrame, by: Sequence[str | Column], col: str, out: str) -> DataFrame:
    """Group mean on every row; ``by`` holds the series keys and a calendar part."""
    return df.withColumn(out, F.avg(col).over(Window.partitionBy(*by)))


def group_weight_expr(by: Sequence[str | Column], col: str, fallback: float = 1.0 / 12.0) -> Column:
    total = F.coalesce(F.sum(col).over(Window.partitionBy(*by)), F.lit(0.0))
    return F.when(total <= 0, F.lit(fallback)).otherwise(safe_ratio(col, total))


def group_weight(df: DataFrame, by, col, fallback: float = 1.0 / 12.0, out: str | None = None) -> DataFrame:
    """Share of the group total; a total that is not positive gives ``fallback``."""
    return df.withColumn(out or f"w_{col}", group_weight_expr(by, col, fallback))


def interpolate_linear_many(df: DataFrame, keys, ts, cols: Sequence[str], suffix: str) -> DataFrame:
    """Linear interpolation by row position for several columns.

    Leading gaps stay NULL, trailing gaps take the last value.  The look-ahead
    runs over the reversed order, where it is a running frame; a frame reaching
    to the end of the partition would be re-read for every row.
    """
    past = over(keys, ts, PAST)
    ahead = past.replace(f"order by {q(ts)}", f"order by {q(ts)} desc")
    known = lambda c: f"if({q(c)} is not null, struct(__pos as p, {q(c)} as v), null)"
    side = lambda name, w: [f"last({known(c)}) ignore nulls {w} as {q(name + c)}" for c in cols]
    base = df.selectExpr("*", f"row_number() {over(keys, ts)} as __pos")
    base = base.selectExpr("*", *side("__prev_", past)).selectExpr("*", *side("__next_", ahead))

    def blend(c: str) -> str:
        prev, nxt = q("__prev_" + c), q("__next_" + c)
        slope = f"try_divide({nxt}.v - {prev}.v, cast({nxt}.p - {prev}.p as double))"
        return f"coalesce({q(c)}, {prev}.v + {slope} * (__pos - {prev}.p), {prev}.v) as {q(c + suffix)}"

    return base.selectExpr(*[q(c) for c in df.columns], *[blend(c) for c in cols])


def interpolate_linear(df: DataFrame, keys, ts, col: str, suffix: str = "_interp") -> DataFrame:
    return interpolate_linear_many(df, keys, ts, [col], suffix)


def densify_months(df: DataFrame, keys, ts) -> DataFrame:
    """Add the absent months between the first and last month of every series."""
    span = df.groupBy(*keys).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    grid = span.select(*keys, F.explode(F.sequence("__lo", "__hi", F.expr("interval 1 month"))).alias(ts))
    return grid.join(df, [*keys, ts], "left")
