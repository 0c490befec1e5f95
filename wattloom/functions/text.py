"""Figures out of bulletin pages, in Spark string and array expressions.

Works on any table with one row per page.  Windows of a page stay an array
inside the row, so extraction needs neither an explode nor a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Field aliases in order of preference, units, and the prefixes
# that open a monthly or a cumulative passage ({m} is the month number).
FIELD_ALIASES = {
    "total_demand": ["全社会用电量"],
    "primary_demand": ["第一产业用电量", "第一产业"],
    "secondary_demand": ["第二产业用电量", "第二产业"],
    "tertiary_demand": ["第三产业用电量", "第三产业"],
    "residential_demand": ["城乡居民生活用电量", "城乡居民生活", "居民生活用电量", "城乡居民用电量"],
}
TOTAL_FIELD = "total_demand"
LARGE_UNIT, LARGE_FACTOR = "万亿", 10000
QUANTITY = r"[^0-9]{0,8}([0-9]+(?:\.[0-9]+)?)\s*(万亿|亿)千瓦时"
MONTHLY_PREFIXES = ["{m}月份", "{m}月", "当月", "本月"]
CUMULATIVE_PREFIXES = ["1[-—~至到]{m}月累计", "1[-—~至到]{m}月"]
YEAR_END_PREFIXES = ["全年", "1-12月", "1—12月", "1至12月"]
MONTHLY_SPAN, CUMULATIVE_SPAN = 320, 420
NO_URL = ["", "nan", "无"]
#: Named references with their semicolon; those of most pages are looked up first, in a short map.
NAMED = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}
FREQUENT = ("nbsp", "amp", "lt", "gt", "quot", "apos", "copy", "mdash", "ndash", "hellip", "middot", "ldquo", "rdquo", "lsquo", "rsquo",
            "ensp", "emsp", "thinsp", "times", "deg", "bull", "yen", "permil")
#: Numbers that old pages take from the Windows code page, as browsers read them.
WINDOWS = {i: char for i in range(128, 160) if (char := bytes([i]).decode("cp1252", "ignore"))}
_REFERENCE = r"&(?:#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6})|[A-Za-z][A-Za-z0-9]*);"


def _map(entries: Mapping) -> Column:
    """A literal map with string keys, folded from one string."""
    return F.str_to_map(F.lit("\u0002".join(f"{k}\u0001{v}" for k, v in entries.items())), F.lit("\u0002"), F.lit("\u0001"))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _character(ref: Column) -> Column:
    """What a reference stands for, NULL if it is none."""
    inner = F.substring(ref, 2, F.length(ref) - 2)
    digits = F.substring(inner, 2, 8)
    code = F.when(digits.rlike("^[xX]"), F.conv(F.substring(digits, 2, 8), 16, 10)).otherwise(digits).try_cast("int")
    valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    plain = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(63))), 8, "0")), "UTF-32")
    number = F.when(code.between(128, 159), F.coalesce(F.try_element_at(_map(WINDOWS), code.cast("string")), plain)).when(valid, plain)
    name = F.coalesce(F.try_element_at(_map({n: NAMED[n] for n in FREQUENT}), inner), F.try_element_at(_map(NAMED), inner))
    return F.when(F.substring(inner, 1, 1) == "#", number).otherwise(name)


def decode_references(text: Column) -> Column:
    """Character references, numbers and names, replaced in one pass from left to right; what is no reference stays."""
    def decoded(t: Column) -> Column:
        refs = F.regexp_extract_all(t, F.lit(_REFERENCE), F.lit(0))
        parts = F.zip_with(F.split(t, _REFERENCE, -1), refs, lambda part, ref: F.when(ref.isNull(), part).otherwise(
            F.concat(part, F.coalesce(_character(ref), ref))))
        return F.when(t.contains("&"), F.array_join(parts, "")).otherwise(t)
    return _once(text, decoded)


def html_to_text(c: Column | str) -> Column:
    """Text of a page: one line per text node, blanks and newlines collapsed."""
    out = F.col(c) if isinstance(c, str) else c
    for pattern, by in [
        (r"(?s)<!--.*?-->", ""),
        (r"(?is)<(script|style)\b.*?</(script|style)\s*>", "\n"),
        (r"(?s)<[^>]*>", "\n"),
    ]:
        out = F.regexp_replace(out, pattern, by)
    out = decode_references(out)
    out = F.regexp_replace(out, "[ \t\r\u00a0]+", " ")
    out = F.regexp_replace(out, "\n+", "\n")
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def extract_quantity(c: Column | str, aliases: Sequence[str]) -> Column:
    """First alias followed closely by a quantity, in units of 亿千瓦时."""
    text = F.col(c) if isinstance(c, str) else c

    def one(alias: str) -> Column:
        pattern = re.escape(alias) + QUANTITY
        number = F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("double")
        factor = F.when(F.regexp_extract(text, pattern, 2) == LARGE_UNIT, LARGE_FACTOR).otherwise(1)
        return F.round(number * factor, 3)

    return F.coalesce(*[one(a) for a in aliases])


def _with_month(template: str, month: Column) -> Column:
    if "{m}" not in template:
        return F.lit(template)
    before, after = template.split("{m}")
    return F.concat(F.lit(before), month.cast("string"), F.lit(after))


def text_windows(text: Column, prefixes: Sequence[Column], n: int) -> Column:
    """All passages of up to ``n`` characters that open with a prefix, prefix by prefix.

    Zero-width matches find every start, so passages may overlap.
    """
    found = [
        F.regexp_extract_all(text, F.concat(F.lit("(?s)(?="), p, F.lit(f")(?=(.{{1,{n}}}))")), F.lit(1))
        for p in prefixes
    ]
    return F.concat(*found)


def monthly_windows(text: Column, month: Column) -> Column:
    return text_windows(text, [_with_month(p, month) for p in MONTHLY_PREFIXES], MONTHLY_SPAN)


def cumulative_windows(text: Column, month: Column) -> Column:
    usual = text_windows(text, [_with_month(p, month) for p in CUMULATIVE_PREFIXES], CUMULATIVE_SPAN)
    year_end = text_windows(text, [F.lit(p) for p in YEAR_END_PREFIXES], CUMULATIVE_SPAN)
    return F.when(month == 12, F.concat(usual, year_end)).otherwise(usual)


def _marked(fields: Mapping[str, Sequence[str]]) -> str:
    """One pattern for all that figures are read by, found where it starts: quantities after an alias, months, words."""
    names = sorted({a for aliases in fields.values() for a in aliases}, key=len, reverse=True)
    quantity = f"((?:{'|'.join(map(re.escape, names))}))" + QUANTITY
    month = r"(1[-—~至到])?(1[0-2]|[1-9])月(份|累计)?"
    first = "".join(sorted({re.escape(n[0]) for n in names} | set("当本全累")))  # most places fail at their first character
    return f"(?=[1-9{first}])(?=({quantity})|{month}|(当月|本月|全年|累计))"


_START, _FIELD, _END = "\u0001", "\u0002", "\u0003"
_MARK = "struct<at:int,stop:int,alias:string,value:double,opens:boolean,month:int,closes:string,word:string>"
# A segment after a mark: the mark's parts (whole quantity, alias, number, unit; opening, month, closing; word), then text.
_READ = f"""transform(array(split(substring_index(s, '{_END}', 1), '{_FIELD}', -1)), p -> named_struct('at', acc.at,
    'stop', acc.at + char_length(p[0]) + char_length(p[4]) + char_length(p[5]) + if(p[5] = '', 0, 1) + char_length(p[7]), 'alias', p[1],
    'value', round(try_cast(nullif(p[2], '') as double) * if(p[3] = '{LARGE_UNIT}', {LARGE_FACTOR}, 1), 3),
    'opens', p[4] <> '', 'month', try_cast(p[5] as int), 'closes', p[6], 'word', p[7]))"""


def page_marks(pages: DataFrame, text: str, out: str, fields: Mapping[str, Sequence[str]] = FIELD_ALIASES) -> DataFrame:
    """Add all marks of a page with their places, from one match over its text.

    The match writes each mark's parts into the text where it starts; split
    there, what follows a mark adds up to the places of the later ones.
    Array of ``(at, stop, alias, value, opens, month, closes, word)``, places
    from 0; ``value`` is in 亿千瓦时, ``opens`` is set for a span of months
    from January, ``closes`` is what follows the month.
    """
    clean = F.translate(F.col(text), _START + _FIELD + _END, "   ")
    parts = _FIELD.join(f"${i}" for i in (1, 2, 3, 4, 5, 6, 7, 8))
    split = F.split(F.regexp_replace(clean, _marked(fields), f"{_START}{parts}{_END}"), _START, -1)
    none = f"cast(array() as array<{_MARK}>)"
    marks = f"""aggregate(slice(__split, 2, greatest(size(__split) - 1, 0)), named_struct('at', char_length(__split[0]), 'all', {none}),
        (acc, s) -> named_struct('at', acc.at + char_length(substring_index(s, '{_END}', -1)), 'all', concat(acc.all, {_READ}))).all"""
    return pages.select("*", split.alias("__split")).select(*pages.columns, F.expr(marks).alias(out))


def extract_figures(pages: DataFrame, ts: str = "ts", text: str = "text", fields=FIELD_ALIASES) -> DataFrame:
    """Add ``<field>`` from monthly and ``<field>_cum`` from cumulative passages.

    A page is matched once; passages select its marks by their places.  They
    are read prefix by prefix; in a passage the first alias counts, then the
    first place.  Parts of the total are read only where a monthly passage does
    not look cumulative.
    """
    span = "(m.opens and m.month = __month)"
    marked = page_marks(pages.withColumn("__month", F.month(ts)), text, "__marks", fields)
    staged = marked.selectExpr(
        "*", "filter(__marks, m -> m.alias <> '') as __figures",
        f"filter(__marks, m -> coalesce({span}, false) or m.word in ('累计', '全年')) as __hints",
        """transform(filter(__marks, m -> coalesce(not m.opens and m.month = __month, false) or m.word in ('当月', '本月')), m -> named_struct(
            'rank', case when m.closes = '份' then 0 when m.word = '' then 1 when m.word = '当月' then 2 else 3 end, 'at', m.at)) as __monthly""",
        f"""transform(filter(__marks, m -> coalesce({span}, false) or (__month = 12 and m.word = '全年')), m -> named_struct(
            'rank', case when m.word <> '' then 2 when m.closes = '累计' then 0 else 1 end, 'at', m.at)) as __cumulative""")
    staged = staged.selectExpr("*", f"filter(__monthly, s -> not exists(__hints, h -> h.at >= s.at and h.stop <= s.at + {MONTHLY_SPAN})) as __direct")

    def figure(field: str, aliases: Sequence[str], starts: str, reach: int, name: str) -> str:
        listed = ", ".join("'" + a.replace("\\", "\\\\").replace("'", "\\'") + "'" for a in aliases)
        return f"""array_min(flatten(transform({starts}, s -> transform(
            filter(__figures, f -> f.at >= s.at and f.stop <= s.at + {reach} and f.alias in ({listed})), f -> named_struct(
            'rank', s.rank, 'start', s.at, 'alias', array_position(array({listed}), f.alias), 'at', f.at, 'value', f.value))))).value as `{name}`"""
    monthly = [figure(f, a, "__monthly" if f == TOTAL_FIELD else "__direct", MONTHLY_SPAN, f) for f, a in fields.items()]
    cumulative = [figure(f, a, "__cumulative", CUMULATIVE_SPAN, f"{f}_cum") for f, a in fields.items()]
    return staged.selectExpr(*[f"`{c}`" for c in pages.columns], *monthly, *cumulative)


def uncumulate(df: DataFrame, keys, ts, fields: Sequence[str], total: str = TOTAL_FIELD) -> DataFrame:
    """``<field>_diff``: cumulative less the latest earlier one of the same year.

    A page counts only when it has a cumulative total.  Pages of one date
    follow each other by their cumulative values.
    """
    has_total = F.col(f"{total}_cum").isNotNull()
    current = F.struct(*[F.col(f"{f}_cum").alias(f) for f in fields])
    before = Window.partitionBy(*keys, F.year(ts)).orderBy(ts, current).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.last(F.when(has_total, current), ignorenulls=True).over(before)
    staged = df.select("*", prev.alias("__prev"))
    return staged.select(
        *df.columns,
        *[F.when(has_total, F.round(F.col(f"{f}_cum") - F.col("__prev")[f], 3)).alias(f"{f}_diff") for f in fields],
    )


def coalesce_direct(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Direct figures first, differenced ones where absent."""
    extra = [f"{f}{s}" for f in fields for s in ("_cum", "_diff")]
    return df.withColumns({f: F.coalesce(f, f"{f}_diff") for f in fields}).drop(*extra)


def read_bulletins(sources: DataFrame, pages: DataFrame, keys, ts="ts", url="url", html="html", fields=FIELD_ALIASES) -> DataFrame:
    """One row per source: figures of its page, all NULL without a usable page.

    ``sources`` lists ``(keys, ts, url)``; ``pages`` holds ``(url, html)``.
    Sources without an address get one that no page has, each its own, so they
    do not meet in one task of the join.
    """
    clean = F.trim(F.coalesce(url, F.lit("")))
    nowhere = F.concat(F.lit("\u0001"), F.xxhash64(*keys, ts).cast("string"))
    usable = sources.withColumn(url, F.when(~F.lower(clean).isin(NO_URL), clean).otherwise(nowhere))
    joined = usable.join(pages.select(url, html_to_text(html).alias("text")), url, "left")
    names = list(fields)
    figures = extract_figures(joined, ts, "text", fields)
    return coalesce_direct(uncumulate(figures, keys, ts, names), names).select(*keys, ts, *names)
