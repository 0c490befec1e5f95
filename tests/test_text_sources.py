from datetime import date

from pyspark.sql import functions as F

from helpers import near, rows, series
from wattloom.functions import text as T
from wattloom.sources import sheets, sinks
from wattloom.sources.tables import first_available, read_csv


def test_html_to_text(spark):
    html = "<!DOCTYPE html><html><head><style>p{}</style><script>var t='</p>';</script></head><body><p>A&amp;B  &nbsp;C</p>\n\n<!-- no --><b>1&lt;2</b></body></html>"
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(T.html_to_text("h")).first()[0] == "A&B C\n1<2"


def test_quantity_aliases_and_units(spark):
    cases = [
        ("第一产业用电量为120.5亿千瓦时", "primary_demand", 120.5), ("第一产业120亿千瓦时", "primary_demand", 120.0),
        ("全社会用电量达到 1.2345 万亿千瓦时", "total_demand", 12345.0), ("全社会用电量同比增长速度继续放缓达到5亿千瓦时", "total_demand", None),
        ("居民生活用电量9亿千瓦时", "residential_demand", 9.0), ("全社会用电量5亿度", "total_demand", None),
    ]
    for text, field, want in cases:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(T.extract_quantity("t", T.FIELD_ALIASES[field])).first()[0] == want, text


def _page(body):
    return f"<html><body><p>{body}</p></body></html>"


FILL = "。" * 330


def test_bulletins(spark):
    sources = [
        (date(2020, 3, 1), "u3"), (date(2020, 4, 1), "无"), (date(2020, 5, 1), "u5"), (date(2020, 6, 1), "missing"), (date(2020, 7, 1), "u7"),
        (date(2020, 12, 1), "u12"), (date(2021, 1, 1), "u1"), (date(2021, 2, 1), None),
    ]
    pages = [
        ("u3", _page("3月份，全社会用电量100亿千瓦时，第一产业用电量10亿千瓦时" + FILL + "1-3月累计，全社会用电量280亿千瓦时，第一产业用电量28亿千瓦时，第二产业150亿千瓦时")),
        ("u5", _page("1-5月累计，全社会用电量500亿千瓦时，第一产业用电量55亿千瓦时，第二产业260.5亿千瓦时")),
        ("u7", _page("本月，第三产业用电量30亿千瓦时")),
        ("u12", _page("全年，全社会用电量1300亿千瓦时，第一产业130亿千瓦时")),
        ("u1", _page("11月回顾，全社会用电量90亿千瓦时")),
    ]
    out = T.read_bulletins(
        spark.createDataFrame([("cn", d, u) for d, u in sources], "k string, ts date, url string"),
        spark.createDataFrame(pages, "url string, html string"), ["k"])
    got = {r.ts: (r.total_demand, r.primary_demand, r.secondary_demand, r.tertiary_demand) for r in out.collect()}
    assert len(got) == 8
    assert got[date(2020, 3, 1)] == (100.0, 10.0, None, None)
    # Cumulative only: the passage opening with the month gives the total as printed, parts are differenced.
    assert got[date(2020, 5, 1)] == (500.0, 27.0, 110.5, None)
    assert got[date(2020, 7, 1)] == (None, None, None, 30.0)
    # The year total is differenced from May, the latest page with a cumulative total.
    assert got[date(2020, 12, 1)] == (800.0, 75.0, None, None)
    # Month 1 also matches inside month 11.
    assert got[date(2021, 1, 1)][0] == 90.0
    for empty in (date(2020, 4, 1), date(2020, 6, 1), date(2021, 2, 1)):
        assert got[empty] == (None, None, None, None)


def _plain_figures(text, month):
    """Passages cut out and searched one by one."""
    import re

    def passages(patterns, span):
        return [text[m.start():m.start() + span] for p in patterns for m in re.finditer(f"(?={p})", text)]

    def first(blocks, aliases):
        for b in blocks:
            for alias in aliases:
                if m := re.search(re.escape(alias) + T.QUANTITY, b):
                    return round(float(m[1]) * (10000 if m[2] == "万亿" else 1), 3)
        return None
    monthly = passages([p.format(m=month) for p in T.MONTHLY_PREFIXES], T.MONTHLY_SPAN)
    cumulative = passages([p.format(m=month) for p in T.CUMULATIVE_PREFIXES] + (T.YEAR_END_PREFIXES if month == 12 else []), T.CUMULATIVE_SPAN)
    direct = [b for b in monthly if not re.search(f"1[-—~至到]{month}月|累计|全年", b)]
    return [first(monthly if f == T.TOTAL_FIELD else direct, a) for f, a in T.FIELD_ALIASES.items()] + \
        [first(cumulative, a) for a in T.FIELD_ALIASES.values()]


def test_one_match_a_page_equals_passages_searched_one_by_one(spark):
    import random

    r = random.Random(5)
    aliases = [a for aliases in T.FIELD_ALIASES.values() for a in aliases]
    pieces = [*(f"{{}}{m}月份" for m in (1, 2, 11, 12)), *(f"{{}}{m}月" for m in (1, 2, 11, 12)), *(f"{{}}1{d}{m}月累计" for d in "-至~" for m in (1, 2, 12)),
              "{}1-2月", "{}1—12月", "{}当月", "{}本月", "{}全年", "{}累计", "{}\u0001x\u0003", "{}\n", "{}" + "填" * 90, "{}12", "{}3.5亿千瓦时", *(f"{{}}{a}" for a in aliases)]
    number = lambda: r.choice(["120.5亿千瓦时", "1.2345 万亿千瓦时", "7亿千瓦时", "达到99\n亿千瓦时", "同比增长速度继续放缓达到5亿千瓦时", "8亿度", "为6.亿千瓦时"])
    texts = []
    for i in range(400):
        text = ""
        for _ in range(r.randint(0, 40)):
            text = r.choice(pieces).format(text)
            if r.random() < 0.5:
                text += r.choice(aliases) + number()
        texts.append((i, date(2020, r.choice([1, 2, 11, 12]), 1), text))
    texts.append((400, date(2020, 1, 1), None))
    names = [*T.FIELD_ALIASES, *(f"{f}_cum" for f in T.FIELD_ALIASES)]
    got = T.extract_figures(spark.createDataFrame(texts, "i int, ts date, text string")).orderBy("i").collect()
    filled = 0
    for (i, ts, text), row in zip(texts, got):
        want = _plain_figures(text, ts.month) if text is not None else [None] * 10
        assert [row[n] for n in names] == want, (text, ts, row, want)
        filled += sum(v is not None for v in want)
    assert filled > 800


def test_references_are_decoded_once(spark):
    cases = {"&#38;lt;": "&lt;", "&#38;#60; and &#60;": "&#60; and <", "&#150;&#x80;": "–€", "&eacute;&euro;&NotEqualTilde;": "é€\u2242\u0338",
             "&amp;amp;": "&amp;", "a & b &; &nosuch; &lt &#x110000;": "a & b &; &nosuch; &lt &#x110000;", "&#0;&#129;x": "&#0;\x81x", "&lt;b&gt;": "<b>"}
    got = spark.createDataFrame(list(cases.items()), "h string, w string").select("h", "w", T.html_to_text("h").alias("t")).collect()
    assert [(r.h, r.t) for r in got] == [(r.h, r.w) for r in got]


def test_sources_without_a_page_do_not_meet(spark):
    many = spark.range(2000).select(F.col("id").alias("k"), F.lit(date(2020, 1, 1)).alias("ts"), F.when(F.col("id") % 2 == 0, "无").alias("url"))
    pages = spark.createDataFrame([("u", "x")], "url string, html string")
    out = T.read_bulletins(many, pages, ["k"])
    assert out.count() == 2000 and out.filter("total_demand is not null").count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan


def test_csv_with_bom_and_bad_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿date,total,part\n2010-01-01,3531.0,\n2010-02-01,x,5\n", encoding="utf-8")
    df = read_csv(spark, str(tmp_path / "a.csv"), "date date, total double, part double")
    assert rows(df, "date") == [(date(2010, 1, 1), 3531.0, None), (date(2010, 2, 1), None, 5.0)]
    found = first_available(lambda: spark.read.parquet(str(tmp_path / "nope")), lambda: df)
    assert found is df and first_available(lambda: spark.read.parquet(str(tmp_path / "nope"))) is None


def test_ragged_year_sheet(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "﻿标题\n说明,,\n地区\t,2019年\t,2020年,备注\n北京市\t,\"1,234.5\"\t,--,x\n上海市,7\n,9,9\n数据来源：某处\n广东省,1,2\n", encoding="utf-8")
    data = sheets.read_with_header_marker(spark, str(tmp_path / "s.csv"), "地区", "数据来源")
    assert rows(sheets.melt_year_cells(data, "name").drop("file"), "name", "year") == [
        ("上海市", 2019, 7.0), ("上海市", 2020, None), ("北京市", 2019, 1234.5), ("北京市", 2020, None)]


def test_header_found_by_words(spark, tmp_path):
    (tmp_path / "u.csv").write_text("some,list\nno,Date,URL\n1,2020-01-01,http://a\n2,2020-02-01,无\n", encoding="utf-8")
    data = sheets.read_with_header_marker(spark, str(tmp_path / "u.csv"), ["date", "url"])
    named = sheets.rows_to_columns(data, ["date", "url", "type"]).drop("file")
    assert rows(named, "date") == [("2020-01-01", "http://a", None), ("2020-02-01", "无", None)]


def test_order_holds_when_a_file_spans_splits(spark, tmp_path):
    body = "".join(f"p{i},{i}\n" for i in range(4000))
    (tmp_path / "big.csv").write_text("intro\n地区,2019\n" + body + "数据来源\nlate,1\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        data = sheets.read_with_header_marker(spark, str(tmp_path / "big.csv"), "地区", "数据来源")
        assert sheets.read_lines(spark, str(tmp_path / "big.csv")).select("block").distinct().count() > 3
        assert sheets.melt_year_cells(data).agg(F.count("value"), F.sum("value")).first() == (4000, sum(range(4000)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_line_numbers_hold_in_blocks_of_a_few_lines(spark, tmp_path):
    """Headers, footers and layouts beyond the first block, a file without a header, one without lines."""
    body = [f"p{i},{i}" for i in range(300)]
    (tmp_path / "a.csv").write_text("\n".join(["x" * 90, "", "y", "地区,2019", *body, "数据来源", "late,1", "数据来源"]), encoding="utf-8")
    (tmp_path / "b.csv").write_text("one\n数据来源\n地区,2020\nq,5\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("no,header\nhere,1\n", encoding="utf-8")
    (tmp_path / "d.csv").write_text("", encoding="utf-8")
    months = ",".join(f"2026年{m}月" for m in range(1, 13))
    (tmp_path / "wide.txt").write_text("t\n" * 9 + f"指标,{months}\n累计值,1\n" + "z,0\n" * 40 + "当期值," + ",".join(map(str, range(12))), encoding="utf-8")
    (tmp_path / "tall.txt").write_text("a" * 200 + "\nb\nc\n" + "".join(f"{2000 + i // 12}年{i % 12 + 1}月,{i}\n" for i in range(200)), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        lines = sheets.read_lines(spark, str(tmp_path / "*.csv"))
        numbers = {}
        for r in sheets._numbered(lines).collect():
            numbers.setdefault(r.file.rsplit("/", 1)[1], []).append((r.line_no, r.line))
        for name, got in numbers.items():
            assert sorted(got) == list(enumerate((tmp_path / name).read_text(encoding="utf-8").splitlines()))
        assert set(numbers) == {"a.csv", "b.csv", "c.csv"}
        assert sheets.block_index(lines).filter("file like '%a.csv'").count() > 20
        for marker, want in (("地区", [("a", i) for i in range(300)] + [("b", 5)]), (3, [("a", i) for i in range(300)])):
            data = sheets.with_header_marker(lines, marker, "数据来源")
            cells = sheets.melt_year_cells(data).filter("value is not null")
            got = cells.select(F.regexp_extract("file", "([a-z]).csv", 1).alias("f"), F.col("value").cast("int").alias("v")).collect()
            assert sorted((r.f, r.v) for r in got) == sorted(want)
            plan = data._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin [file" in plan and "hashpartitioning(file#" not in plan.split("AdaptiveSparkPlan")[1].split("Initial Plan")[0]
        metric = sheets.read_lines(spark, str(tmp_path / "*.txt"))
        got = sheets.melt_sheets(metric).groupBy(F.regexp_extract("file", "([a-z]+).txt", 1).alias("f")).agg(F.count("value"), F.sum("value")).collect()
        assert sorted(map(tuple, got)) == [("tall", 200, float(sum(range(200)))), ("wide", 12, 66.0)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_metric_sheets_in_both_layouts(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("数据库\n指标,2026年3月,2026年2月,2026年1月,合计\n累计值,9,9,9,9\n当期值(亿),3.5,,1.5,5\n", encoding="utf-8")
    (tmp_path / "tall.csv").write_text("标题\n说明\n时间,发电量\n2026年2月,20\n2026年1月,10\nx,5\n2025年12月,--\n", encoding="utf-8")
    lines = sheets.read_lines(spark, str(tmp_path))
    layout = {r.file.rsplit("/", 1)[1]: r.layout for r in sheets.detect_layout(lines).collect()}
    assert layout == {"wide.csv": "horizontal", "tall.csv": "vertical"}
    got = rows(sheets.melt_sheets(lines).select(F.regexp_extract("file", "([a-z]+).csv", 1).alias("f"), "ts", "value"), "f", "ts")
    assert got == [("tall", date(2026, 1, 15), 10.0), ("tall", date(2026, 2, 15), 20.0), ("wide", date(2026, 1, 15), 1.5), ("wide", date(2026, 3, 15), 3.5)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, 1 / 3), (1, None)], "n int, v double")
    sinks.write_csv(df, str(tmp_path / "c"), 6)
    assert {(r.n, r.v) for r in spark.read.csv(str(tmp_path / "c"), header=True).collect()} == {("2", "0.333333"), ("1", None)}
    for _ in range(2):
        assert sinks.write_with_ids(df, str(tmp_path / "t"), ["n"]) == 2
    assert rows(spark.read.parquet(str(tmp_path / "t")).select("n", "id"), "n") == [(1, 0), (2, 1)]
    both = sinks.export_combined({"a": df, "b": df.select("n")})
    assert both.count() == 4 and {r.kind for r in both.collect()} == {"a", "b"}


def test_a_pair_of_tables_is_replaced_together_or_not_at_all(spark, tmp_path):
    import pytest

    path = str(tmp_path / "db")
    table = lambda vs: spark.createDataFrame([("k", v) for v in vs], "k string, v int")
    read = lambda: {n: rows(t.select("id", "v"), "id") for n, t in sinks.read_tables(spark, path).items()}
    assert sinks.read_tables(spark, path) == {}
    assert sinks.replace_tables(spark, path, {"a": table([3, 1]), "b": table([7])}, ["v"]) == {"a": 2, "b": 1}
    old = {"a": [(0, 1), (1, 3)], "b": [(0, 7)]}
    assert read() == old
    held = sinks.read_tables(spark, path)["a"]
    broken = table([1, 2]).withColumn("v", F.when(F.col("v") > 1, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_tables(spark, path, {"a": table([9]), "b": broken}, ["v"])
    assert read() == old
    for i in range(3):
        sinks.replace_tables(spark, path, {"a": table([i, i + 1]), "b": table([])}, ["v"], ["k"])
        if i == 0:
            assert held.count() == 2  # readers of the tables before go on
    assert read() == {"a": [(0, 2), (1, 3)], "b": []}
    kept = [p.name for p in (tmp_path / "db").iterdir() if (p / "a").exists()]
    assert len(kept) <= 3  # this pair, the one before, and what a lost job left


def test_checks_are_observed_by_the_write(spark, tmp_path):
    from wattloom.model import Family
    from wattloom.operators import quality as Q

    reads = spark.sparkContext.accumulator(0)
    fam = Family("t", ("p", "q"))
    df = series(spark, [(10.0, 4.0, 6.0), (12.0, 4.0, 6.0), (None, 1.0, None)], "t double, p double, q double")
    checks = [Q.identity_check(df, fam, "generation", 0.02), Q.temporal_check("ts"), Q.range_check(df, "absent")]
    @F.udf("double")
    def counted(x):
        reads.add(1)
        return x
    once = df.withColumn("t", counted("t"))
    report = sinks.write_checked(once, str(tmp_path / "t"), checks, ["k"], "ts")
    got = sorted(map(tuple, report.collect()), key=str)
    want = Q.run_checks(df, checks[:1], []).unionByName(Q.run_checks(df, checks[1:], ["k"], "ts").drop("k"))
    assert got == sorted(map(tuple, want.collect()), key=str)
    assert reads.value == 3 and spark.read.parquet(str(tmp_path / "t")).columns == df.columns


def test_price_table(spark):
    import pytest
    from wattloom.plans import national as N

    raw = spark.createDataFrame([
        ("2010", "0.38456", "610.82", "43220"), ("2011,0", "384.5", None, "0.4"), ("n/a", "1", "1", "1"), ("2012", "x", "y", "300"),
    ], "Date string, National_Avg_Yuan_Per_MWh string, coal_benchmark_yuan_per_mwh string, nuclear_yuan_per_mwh string")
    out = N.clean_prices(raw).orderBy("year")
    assert out.columns == ["year", *N.PRICE_COLUMNS]
    got = [tuple(r)[:4] for r in out.collect()]
    near(got, [(2010, 384.56, 610.82, 43.22), (2011, 384.5, None, 400.0), (2012, None, None, 300.0)])
    with pytest.raises(ValueError):
        N.clean_prices(raw.withColumnRenamed("Date", "when"))


def test_province_sheet(spark, tmp_path):
    from wattloom.functions.scalars import map_codes
    from wattloom.plans import national as N

    (tmp_path / "p.csv").write_text("a\n地区,2009年,2024年\n北京市,1,\"2,000\"\n某地,3,4\n数据来源\n", encoding="utf-8")
    sheet = N.read_province_sheet(sheets.read_lines(spark, str(tmp_path / "p.csv")), "total_gen_annual")
    assert rows(map_codes(sheet, N.province_codes(spark), "province")) == [("北京市", 2024, 2000.0, "CN-11")]
    assert len(N.PROVINCES) == len(set(N.PROVINCES.values())) == 31


def test_cells(spark):
    cases = {'a,b': ["a", "b"], '"1,2"\t,,x ,': ["1,2", "", "x", ""], '': [""], '5" pipe,3': ["5 pipe", "3"],
             ",".join(f'"{i},{i}"' for i in range(3000)): [f"{i},{i}" for i in range(3000)]}
    for line, want in cases.items():
        assert spark.createDataFrame([(line,)], "l string").select(sheets.split_cells("l")).first()[0] == want


def test_numeric_references_become_characters(spark):
    from wattloom.functions.text import html_to_text

    got = spark.createDataFrame([("用电量&#160;1.5&#x3000;亿&ldquo;x&rdquo;&#128512;",), ("&amp;#65; &#1114112; &#xD800; &#;",), (None,), ("",)], "p string") \
        .select(html_to_text("p").alias("t")).collect()
    assert [r.t for r in got] == ["用电量 1.5　亿“x”😀", "&#65; &#1114112; &#xD800; &#;", None, ""]
