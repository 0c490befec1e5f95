"""Text extraction (T).

Pages of the star schema are prose without figures, so bulletins are written
from the demand panel itself: one page per region and month, and the SQL
counterpart predicts what must be read back.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.functions import text as T
from wattloom.plans import shapes
from wattloom.plans.shapes import KEYS, TS
from wattloom.sources.tables import read_table

FIELDS = list(T.FIELD_ALIASES)
_ENTITIES = [(n, T.NAMED[n]) for n in T.FREQUENT if n != "amp"] + [("#39", "'"), ("amp", "&")]


def _text_sql(col):
    out = f"regexp_replace({col}, '(?s)<!--.*?-->', '', 'g')"
    out = f"regexp_replace({out}, '(?is)<(script|style)\\b.*?</(script|style)\\s*>', chr(10), 'g')"
    out = f"regexp_replace({out}, '(?s)<[^>]*>', chr(10), 'g')"
    for name, char in _ENTITIES:
        out = f"replace({out}, '&{name};', {'chr(39)' if char == chr(39) else 'chr(160)' if char == chr(160) else repr(char)})"
    out = f"regexp_replace({out}, '[ \\t\\r\\x{{A0}}]+', ' ', 'g')"
    out = f"regexp_replace({out}, '\\n+', chr(10), 'g')"
    return f"regexp_replace({out}, '^\\s+|\\s+$', '', 'g')"


@query("t1_html_to_text", f"select page_id, {_text_sql('html')} as text from pages")
def t1(spark, d):
    return read_table(spark, d, "pages").select("page_id", T.html_to_text("html").alias("text"))


@query("t1_references", r"""select page_id, 'A&lt;B < &#38;#60; – é€ < < &unknown; &#1114112; "' || page_id || '"' as text from pages""")
def t1_references(spark, d):
    """References inside references, old code pages, names, what is none: decoded once each."""
    html = F.concat(F.lit("<p>A&#38;lt;B &#x3C; &amp;#38;#60; &#150; &eacute;&euro; &lt; &#60; &unknown; &#1114112; &quot;"), F.col("page_id"), F.lit("&#34;</p>"))
    return read_table(spark, d, "pages").select("page_id", T.html_to_text(html).alias("text"))


# Figures are whole tenths; page kinds by (year + month) % 4: 0 monthly only,
# 1 cumulative only, 2 both, 3 no page.
BULLETIN_CTES = {
    "tenths": """select region, ts, cast(floor(total_demand / 1000) as bigint) as n0, cast(floor(seg_1 / 1000) as bigint) as n1,
        cast(floor(seg_2 / 1000) as bigint) as n2, cast(floor(seg_3 / 1000) as bigint) as n3, cast(floor(seg_4 / 1000) as bigint) as n4, (year(ts) + month(ts)) % 4 as kind from demand_wide""",
    "cum": """select *, cast(sum(n0) over w as bigint) as c0, cast(sum(n1) over w as bigint) as c1, cast(sum(n2) over w as bigint) as c2,
        cast(sum(n3) over w as bigint) as c3, cast(sum(n4) over w as bigint) as c4
        from tenths window w as (partition by region, year(ts) order by ts)""",
    "seen": """select region, ts, kind, n0, n1, n2, n3, n4, """ + ", ".join(f"case when kind in (1, 2) then c{i} end as c{i}" for i in range(5)) + " from cum",
    "prior": "select *, " + ", ".join(f"last_value(c{i} ignore nulls) over w as b{i}" for i in range(5)) + """
        from seen window w as (partition by region, year(ts) order by ts rows between unbounded preceding and 1 preceding)""",
}


def bulletins(spark, d):
    """(region, ts, url, html) written from the demand panel."""
    tenth = lambda c: F.floor(F.col(c) / 1000)
    rows = shapes.demand_wide(spark, d).select(
        *KEYS, TS, tenth("total_demand").alias("n0"), tenth("seg_1").alias("n1"), tenth("seg_2").alias("n2"),
        tenth("seg_3").alias("n3"), tenth("seg_4").alias("n4"))
    year = Window.partitionBy(*KEYS, F.year(TS)).orderBy(TS).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.sum(f"n{i}").over(year).alias(f"c{i}") for i in range(5)])
    month, kind = F.month(TS), (F.year(TS) + F.month(TS)) % 4

    def figure(label, col):
        n = F.col(col)
        whole = F.floor(n / 10).cast("string")
        return F.coalesce(F.concat(F.lit(label), whole, F.lit("."), (n % 10).cast("string"), F.lit("亿千瓦时，")), F.lit(""))

    direct = F.concat(month.cast("string"), F.lit("月份，"), figure("全社会用电量", "n0"), figure("第一产业用电量", "n1"), figure("第三产业用电量", "n3"))
    second = F.concat(figure("第二产业", "n2"), figure("城乡居民生活用电量", "n4"))
    opening = F.when(month == 12, F.lit("全年，")).otherwise(F.concat(F.lit("1-"), month.cast("string"), F.lit("月累计，")))
    total = F.concat(opening, figure("全社会用电量", "c0"), figure("第一产业用电量", "c1"), figure("第二产业", "c2"),
                     figure("第三产业", "c3"), figure("居民生活用电量", "c4"))
    filler = F.lit("<p>" + "说明文字。" * 80 + "</p>")
    body = (
        F.when(kind == 0, F.concat(direct, second)).when(kind == 1, total)
        .when(kind == 2, F.concat(direct, filler, total))
    )
    url = F.when(kind == 3, F.lit("无")).otherwise(F.concat(F.lit("http://bulletin/"), "region", F.lit("/"), F.col(TS).cast("string")))
    html = F.concat(F.lit("<html><body><div>"), body, F.lit("</div></body></html>"))
    return rows.select(*KEYS, TS, url.alias("url"), html.alias("html"))


def _figures(spark, d):
    pages = bulletins(spark, d).filter(F.col("html").isNotNull())
    return T.extract_figures(pages.withColumn("text", T.html_to_text("html")), TS)


_DIRECT = {
    "total_demand": "case when kind in (0, 2) then n0 / 10 when kind = 1 and month(ts) <> 12 then c0 / 10 end",
    "primary_demand": "case when kind in (0, 2) then n1 / 10 end",
    "secondary_demand": "case when kind = 0 then n2 / 10 end",
    "tertiary_demand": "case when kind in (0, 2) then n3 / 10 end",
    "residential_demand": "case when kind = 0 then n4 / 10 end",
}
_CUM = {f: f"c{i} / 10" for i, f in enumerate(FIELDS)}
_DIFF = {f: f"case when c0 is not null then (c{i} - b{i}) / 10 end" for i, f in enumerate(FIELDS)}
_B = with_("demand_wide", **BULLETIN_CTES)


@query("t2_extract_quantity", with_("demand_wide", **BULLETIN_CTES) + f"""select region, ts, {sq("case when kind in (0, 2) then n0 / 10 else c0 / 10 end", 3, "total")},
    {sq("case kind when 0 then n1 / 10 when 2 then coalesce(n1, c1) / 10 else c1 / 10 end", 3, "first")} from prior where kind <> 3""")
def t2(spark, d):
    pages = bulletins(spark, d).filter(F.col("html").isNotNull())
    text = T.html_to_text("html")
    return settled(pages.select(
        *KEYS, TS, T.extract_quantity(text, T.FIELD_ALIASES["total_demand"]).alias("total"),
        T.extract_quantity(text, T.FIELD_ALIASES["primary_demand"]).alias("first")), 3)


@query("t3_unit_scaling", """select o_orderkey, floor((floor(o_totalprice) / 100 * case when o_orderkey % 2 = 0 then 10000 else 1 end) * 1e3 + 0.5003) / 1e3 as value from orders""")
def t3(spark, d):
    n = F.floor("o_totalprice")
    number = F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))
    unit = F.when(F.col("o_orderkey") % 2 == 0, "万亿千瓦时").otherwise("亿千瓦时")
    text = F.concat(F.lit("截至本月底，全社会用电量达到"), number, F.lit(" "), unit, F.lit("。"))
    return settled(read_table(spark, d, "orders").select(
        "o_orderkey", T.extract_quantity(text, T.FIELD_ALIASES["total_demand"]).alias("value")), 3)


@query("t4_text_windows", with_("demand_wide", **BULLETIN_CTES) + """select region, ts,
    cast(case kind when 0 then 2 when 1 then case when month(ts) = 12 then 0 else 1 end else case when month(ts) = 12 then 2 else 3 end end as int) as monthly,
    cast(case when kind = 0 then 0 when month(ts) = 12 then 1 else 2 end as int) as cumulative from prior where kind <> 3""")
def t4(spark, d):
    pages = bulletins(spark, d).filter(F.col("html").isNotNull()).withColumn("text", T.html_to_text("html"))
    return pages.select(*KEYS, TS, F.size(T.monthly_windows(F.col("text"), F.month(TS))).alias("monthly"),
                        F.size(T.cumulative_windows(F.col("text"), F.month(TS))).alias("cumulative"))


@query("t5_extract_figures", _B + "select region, ts, " + ", ".join(
    [sq(_DIRECT[f], 3, f) for f in FIELDS] + [sq(_CUM[f], 3, f"{f}_cum") for f in FIELDS]) + " from prior where kind <> 3")
def t5(spark, d):
    return settled(_figures(spark, d).drop("url", "html", "text"), 3)


@query("t6_uncumulate", _B + "select region, ts, " + ", ".join(sq(_DIFF[f], 3, f"{f}_diff") for f in FIELDS) + " from prior where kind <> 3")
def t6(spark, d):
    return settled(T.uncumulate(_figures(spark, d), KEYS, TS, FIELDS).select(*KEYS, TS, *[f"{f}_diff" for f in FIELDS]), 3)


def _either(f):
    return f"coalesce({_DIRECT[f]}, {_DIFF[f]})"


@query("t7_coalesce_direct", _B + "select region, ts, " + ", ".join(sq(_either(f), 3, f) for f in FIELDS) + " from prior where kind <> 3")
def t7(spark, d):
    merged = T.coalesce_direct(T.uncumulate(_figures(spark, d), KEYS, TS, FIELDS), FIELDS)
    return settled(merged.select(*KEYS, TS, *FIELDS), 3)


@query("t8_read_bulletins", _B + "select region, ts, " + ", ".join(
    sq(f"case when kind <> 3 then {_either(f)} end", 3, f) for f in FIELDS) + " from prior")
def t8(spark, d):
    table = bulletins(spark, d)
    pages = table.filter(F.col("html").isNotNull()).select("url", "html")
    return settled(T.read_bulletins(table.select(*KEYS, TS, "url"), pages, KEYS), 3)
