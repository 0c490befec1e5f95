"""Row-wise expressions and projections.

Every function here is a pure Catalyst expression (or a projection built from
column names), so it fuses into the surrounding whole-stage-codegen span.

Null policy: a result that would be infinite or not-a-number is NULL.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
MISSING_MARKS = ["", "-", "--", "…"]
DEFAULT_UNIT_HINT = 400.0
BALANCE_EDGES = [0.0, 0.95, 1.05, math.inf]
BALANCE_LABELS = ["undersupply", "balanced", "oversupply"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- parsing -----------------------------------------------------------------

def to_date_or_null(c: Column | str) -> Column:
    """Generic date parse; anything unreadable is NULL."""
    text = F.trim(_col(c).cast("string"))
    return F.coalesce(
        text.try_cast("date"), F.try_to_date(text, "yyyy/M/d"), F.try_to_date(text, "yyyy-M-d"), F.try_to_date(text, "yyyyMMdd"),
    )


def parse_ts(df: DataFrame, col: str) -> DataFrame:
    """Replace ``col`` by its DATE value and drop rows that do not parse."""
    return df.withColumn(col, to_date_or_null(col)).filter(F.col(col).isNotNull())


def parse_cn_month(c: Column | str) -> Column:
    """``YYYY年M月`` becomes the 15th of that month; other text parses generically."""
    text = F.trim(_col(c).cast("string"))
    return F.coalesce(
        F.try_to_date(F.concat(text, F.lit("15日")), "yyyy年M月d日"),
        F.try_to_date(text, "yyyy年M月d日"),
        to_date_or_null(text),
    )


def to_double(c: Column | str) -> Column:
    """Numeric coercion: unreadable or not-a-number becomes NULL."""
    value = _col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def parse_dirty_number(c: Column | str) -> Column:
    """Strip tabs and thousands commas; missing marks and junk become NULL."""
    text = F.trim(F.regexp_replace(_col(c).cast("string"), "[\t,]", ""))
    return F.when(~text.isin(MISSING_MARKS), to_double(text))


def parse_year(c: Column | str) -> Column:
    """Decimal comma allowed, rounded half to even, unreadable is NULL."""
    value = to_double(F.replace(_col(c).cast("string"), F.lit(","), F.lit(".")))
    return F.bround(value, 0).try_cast("int")


# -- column lists and schema guards ------------------------------------------

def drop_header_rows(df: DataFrame, col: str, literal: str) -> DataFrame:
    """Drop rows that repeat the header; NULL is not a header and stays."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(literal)))


def first_columns(df: DataFrame, n: int) -> DataFrame:
    return df.select(df.columns[:n])


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace("\ufeff", "").strip().lower() for c in df.columns])


def validate_headers(df: DataFrame, roles: Mapping[str, str], required: Sequence[str] = ("year",)) -> DataFrame:
    """Rename columns to their roles; unknown, duplicate or absent roles raise."""
    named = normalize_columns(df)
    unknown = [c for c in named.columns if c not in roles]
    if unknown:
        raise ValueError(f"unknown columns {unknown}; allowed: {sorted(roles)}")
    found = [roles[c] for c in named.columns]
    twice = sorted({r for r in found if found.count(r) > 1})
    if twice:
        raise ValueError(f"roles given more than once: {twice}")
    absent = [r for r in required if r not in found]
    if absent:
        raise ValueError(f"required roles missing: {absent}")
    return named.toDF(*found)


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    return df


def ensure_columns(df: DataFrame, cols: Sequence[str], dtype: str = "double") -> DataFrame:
    absent = {c: F.lit(None).cast(dtype) for c in cols if c not in df.columns}
    return df.withColumns(absent) if absent else df


def select_available(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select([c for c in cols if c in df.columns])


def select_by_pattern(df: DataFrame, keep: Sequence[str], patterns: Sequence[str]) -> DataFrame:
    """``keep`` columns plus every column whose name contains one of the patterns."""
    picked = [c for c in df.columns if c not in keep and any(p in c for p in patterns)]
    return df.select(*keep, *picked)


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    kinds = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [n for n, t in df.dtypes if (t in kinds or t.startswith("decimal")) and n not in skip]


# -- calendar ----------------------------------------------------------------

def filter_years(df: DataFrame, ts: str, lo: int, hi: int) -> DataFrame:
    """Keep years lo..hi with a range predicate, which Parquet scans can push."""
    day = F.col(ts).cast("date")
    return df.filter(
        (day >= F.lit(f"{lo:04d}-01-01").cast("date")) & (day < F.lit(f"{hi + 1:04d}-01-01").cast("date"))
    )


def to_month(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "MM")


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_col(year), _col(month), F.lit(1))


def calendar_features(df: DataFrame, ts: str) -> DataFrame:
    """Year, month, quarter and the cyclic month encoding."""
    angle = F.month(ts) * F.lit(2 * math.pi / 12)
    return df.withColumns({
        "year": F.year(ts),
        "month": F.month(ts),
        "quarter": F.quarter(ts),
        "month_sin": F.sin(angle),
        "month_cos": F.cos(angle),
    })


# -- arithmetic --------------------------------------------------------------

def clip(c: Column | str, lo=None, hi=None) -> Column:
    """Bound a value; NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    c = _col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    return F.when(c.isNotNull(), out)


def row_sum(cols: Sequence[Column | str], min_count: int = 0) -> Column:
    """Sum across columns skipping NULL; fewer than ``min_count`` values gives NULL."""
    total = reduce(lambda a, b: a + b, [F.coalesce(_col(c), F.lit(0.0)) for c in cols])
    if min_count <= 0:
        return total
    present = reduce(lambda a, b: a + b, [_col(c).isNotNull().cast("int") for c in cols])
    return F.when(present >= min_count, total)


def safe_ratio(a: Column | str, b: Column | str, fill: float | None = None) -> Column:
    """``a / b`` with a zero denominator giving NULL, optionally filled."""
    ratio = F.try_divide(_col(a), _col(b))
    return ratio if fill is None else F.coalesce(ratio, F.lit(fill))


def bin_labels(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins; values outside every bin are NULL."""
    c = _col(c)
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        inside = c > F.lit(lo)
        if not math.isinf(hi):
            inside = inside & (c <= F.lit(hi))
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def flag(cond: Column, yes: str, no: str) -> Column:
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def round_cols(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c in cols})


# -- codes -------------------------------------------------------------------

def map_codes(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Attach codes from a dimension and keep only known names.

    No broadcast hint: Spark's own size threshold picks broadcast for a small
    dimension and a shuffled join for one that has outgrown it.
    """
    return df.join(dim, on, "inner")


def normalize_region_key(c: Column | str, country: str = "CN", long_country: str = "CHN") -> Column:
    """Bring region codes to ``CN-dd``; text that is no code comes back upper-cased."""
    text = F.translate(F.upper(F.trim(_col(c))), "_.", "--")
    text = F.replace(text, F.lit(f"{long_country}-"), F.lit(f"{country}-"))
    text = F.replace(text, F.lit(long_country), F.lit(country))
    digits = F.regexp_replace(F.substring(text, len(country) + 1, 1000), "[^0-9]", "")
    coded = text.startswith(country) & ((F.length(text) >= len(country) + 2)) & (F.length(digits) >= 1)
    code = lambda d: F.concat(F.lit(f"{country}-"), F.when(F.length(d) == 1, F.lpad(d, 2, "0")).otherwise(F.left(d, F.lit(2))))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", F.lit(""))
        .when(coded, code(digits))
        .when(text.rlike("^[0-9]{1,2}$"), code(text))
        .otherwise(text)
    )


# -- price units -------------------------------------------------------------

def row_unit_hint(cols: Sequence[Column | str]) -> Column:
    """Upper median of the plausible per-MWh levels among ``cols``."""
    def level(c: Column) -> Column:
        size = F.abs(c)
        return F.when((size > 0) & (size < 2), c * 1000).when((size > 80) & (size < 900), size)

    found = F.array_sort(F.filter(F.array(*[level(_col(c)) for c in cols]), lambda x: x.isNotNull()))
    middle = F.floor(F.size(found) / 2).cast("int") + 1
    return F.when(F.size(found) > 0, F.element_at(found, middle)).otherwise(F.lit(DEFAULT_UNIT_HINT))


def normalize_unit(c: Column | str, hint: Column | str | float) -> Column:
    """Repair a price quoted per kWh, per MWh or in cents to per MWh."""
    c = _col(c)
    hint = F.lit(hint) if isinstance(hint, (int, float)) else _col(hint)
    hint = F.coalesce(hint, F.lit(DEFAULT_UNIT_HINT))
    size = F.abs(c)
    per_thousand = c / 1000
    return (
        F.when((size > 0) & (size < 2), c * 1000)
        .when((size > 5) & (size < 2000) & (hint < 80),
              F.when(F.abs(per_thousand) < 2, per_thousand * 1000).otherwise(per_thousand))
        .when(size > 2500, per_thousand)
        .otherwise(c)
    )
