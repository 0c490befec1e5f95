"""Sources and sinks (S).

Ragged sheets are written from the panels as text files, one a sheet, and read
back line by line, so the SQL counterpart is the panel itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.registry import query, settled, sq, sqs, with_
from wattloom.operators import quality as Q
from wattloom.operators.align import combine_metrics
from wattloom.operators.forecast import forecast_seasonal_naive
from wattloom.catalog.forecasts import _naive
from wattloom.catalog.quality import _Q1, checks_for_comparison
from wattloom.plans import shapes
from wattloom.plans.shapes import DEMAND, KEYS, SUPPLY, TS
from wattloom.session import scratch_path
from wattloom.sources import sheets, sinks
from wattloom.sources.tables import first_available, read_csv, read_table

YEARS = list(range(1995, 2002))
ANY_YEAR = r"((?:19|20)\d{2})"


@query("s1_csv_scan", """select o_orderkey, cast(o_orderdate as date) as day, o_totalprice from orders""")
def s1(spark, d):
    path = scratch_path(spark)
    orders = read_table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    sinks.write_csv(orders, path, decimals=2)
    # The first source is absent; the written one is the fallback.
    schema = "o_orderkey bigint, day date, o_totalprice double"
    return first_available(lambda: read_csv(spark, f"{path}-absent", schema), lambda: read_csv(spark, path, schema))


@query("s2_parquet_scan", """select c_mktsegment, count(*) as n, cast(sum(cast(c_acctbal as decimal(18,2))) as double) as balance from customer group by 1""")
def s2(spark, d):
    return read_table(spark, d, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(shapes.money("c_acctbal")).cast("double").alias("balance"))


def as_files(lines):
    """``lines`` written as one text file a sheet (bounded by calendar and entities), and read back from there."""
    spark, path = lines.sparkSession, scratch_path(lines.sparkSession)
    ordered = lines.repartition("file").sortWithinPartitions("file", "block", "line_id")
    ordered.select("file", "line").write.partitionBy("file").text(path)
    name = F.url_decode(F.regexp_extract("file", "/file=([^/]*)/", 1))
    return sheets.read_lines(spark, path).withColumn("file", name)


def _year_panel(spark, d):
    """(region, nation, y1995 … y2001) of the order value."""
    return shapes.panel_annual(spark, d).groupBy("region", "nation").agg(
        *[F.max(F.when(F.col("year") == y, F.col("m1"))).alias(f"y{y}") for y in YEARS])


def annual_sheets(spark, d):
    """One ragged sheet per region: preamble, years across, one line per nation, footer."""
    money = lambda y: F.coalesce(F.concat(F.lit('"'), F.format_number(F.col(f"y{y}").cast("decimal(18,2)"), 2), F.lit('"')), F.lit("--"))
    number = F.regexp_extract("nation", r"(\d+)", 1).cast("long")
    data = _year_panel(spark, d).select(
        F.col("region").alias("file"), F.lit(0).cast("long").alias("block"), (10 + number).alias("line_id"),
        F.concat_ws(",", F.concat(F.col("nation"), F.lit("\t")), *[money(y) for y in YEARS]).alias("line"))
    fixed = {0: "分省年度数据", 1: "指标：用电量,,", 3: "地区," + ",".join(f"{y}年\t" for y in YEARS), 9_000_000: "数据来源：统计局", 9_000_001: "NOTE,1,2,3"}
    frame = shapes.regions(spark, d).select("region").distinct().select(
        F.col("region").alias("file"), F.lit(0).cast("long").alias("block"),
        F.inline(F.array(*[F.struct(F.lit(i).cast("long").alias("line_id"), F.lit(t).alias("line")) for i, t in fixed.items()])))
    return as_files(data.unionByName(frame))


_ALL_YEARS = f"""grid as (select region, nation, cast(y as int) as year from (select distinct region, nation from panel_annual),
    (select unnest({YEARS}) as y))"""


@query("s3_header_marker_sheet", with_("panel_annual") + f""", {_ALL_YEARS}
    select g.region as file, g.nation, g.year, m1 as value from grid g left join panel_annual p using (region, nation, year)
    union all select distinct region, '数据来源：统计局', cast(unnest({YEARS}) as int), null from grid
    union all select distinct region, 'NOTE', cast(y as int), cast(v as double) from grid, (select unnest([1995, 1996, 1997, 1998, 1999, 2000, 2001]) as y, unnest([1, 2, 3, null, null, null, null]) as v)""")
def s3(spark, d):
    return sheets.melt_year_cells(sheets.with_header_marker(annual_sheets(spark, d), "地区"), "nation", ANY_YEAR)


@query("s4_footer_cut", with_("panel_annual") + f""", {_ALL_YEARS}
    select g.region as file, g.nation, g.year, m1 as value from grid g left join panel_annual p using (region, nation, year)""")
def s4(spark, d):
    return sheets.melt_year_cells(sheets.with_header_marker(annual_sheets(spark, d), "地区", "数据来源"), "nation", ANY_YEAR)


@query("s5_melt_years", with_("panel_annual") + f""", {_ALL_YEARS}
    select g.region, g.nation, g.year, m1 as value from grid g left join panel_annual p using (region, nation, year) where g.year between 1996 and 2000""")
def s5(spark, d):
    return sheets.melt_years(_year_panel(spark, d), ["region", "nation"], ANY_YEAR, 1996, 2000)


def month_sheets(spark, d):
    """Demand per region with months across; the months of a region are bounded by the calendar."""
    month = F.concat(F.year(TS), F.lit("年"), F.month(TS), F.lit("月"))
    row = shapes.demand_wide(spark, d).groupBy("region").agg(
        F.array_sort(F.collect_list(F.struct(TS, month.alias("m"), shapes.money(DEMAND.total).cast("string").alias("v")))).alias("x"))
    cells = lambda field: F.array_join(F.transform("x", lambda x: x[field]), ",")
    lines = F.array(F.lit("月度数据"), F.concat(F.lit("指标,"), cells("m")), F.concat(F.lit("用电量累计值,"), F.array_join(F.transform("x", lambda x: F.lit("0")), ",")),
                    F.concat(F.lit("用电量当期值(亿千瓦时),"), cells("v")))
    return row.select(F.concat(F.col("region"), F.lit("-wide")).alias("file"), F.lit(0).cast("long").alias("block"),
                      F.posexplode(lines).alias("pos", "line")).select("file", "block", F.col("pos").cast("long").alias("line_id"), "line")


def vertical_sheets(spark, d):
    """Supply per region with one line per month below three heading lines."""
    month = F.concat(F.year(TS), F.lit("年"), F.month(TS), F.lit("月"))
    data = shapes.supply_wide(spark, d).select(
        F.concat(F.col("region"), F.lit("-tall")).alias("file"), F.lit(0).cast("long").alias("block"),
        (3 + F.year(TS) * 12 + F.month(TS)).cast("long").alias("line_id"),
        F.concat_ws(",", month, shapes.money(SUPPLY.total).cast("string")).alias("line"))
    fixed = ["发电量", "单位,亿千瓦时", "时间,当期值"]
    frame = shapes.regions(spark, d).select("region").distinct().select(
        F.concat(F.col("region"), F.lit("-tall")).alias("file"), F.lit(0).cast("long").alias("block"),
        F.posexplode(F.array(*[F.lit(x) for x in fixed])).alias("pos", "line"))
    return data.unionByName(frame.select("file", "block", F.col("pos").cast("long").alias("line_id"), "line"))


_WIDE = "select region || '-wide' as file, ts + 14 as ts, total_demand as value from demand_wide"
_TALL = "select region || '-tall' as file, ts + 14 as ts, total_supply as value from supply_wide"


@query("s6_melt_months", with_("demand_wide") + _WIDE)
def s6(spark, d):
    return sheets.melt_months(as_files(month_sheets(spark, d)))


@query("s7_melt_vertical", with_("supply_wide") + _TALL)
def s7(spark, d):
    return sheets.melt_vertical(as_files(vertical_sheets(spark, d)))


@query("s8_melt_sheets", with_("demand_wide", "supply_wide") + f"{_WIDE} union all {_TALL}")
def s8(spark, d):
    return sheets.melt_sheets(as_files(month_sheets(spark, d).unionByName(vertical_sheets(spark, d))))


@query("s9_combine_metrics", with_("demand_wide", "supply_wide") + """select coalesce(d.region, s.region) as region, coalesce(d.ts, s.ts) as ts,
    d.total_demand as demand, s.total_supply as supply, s.src_1 as economy from demand_wide d full join supply_wide s on d.region = s.region and d.ts = s.ts""")
def s9(spark, d):
    demand, supply = shapes.demand_wide(spark, d), shapes.supply_wide(spark, d)
    pick = lambda df, c: df.select(*KEYS, TS, F.col(c).alias("value"))
    return combine_metrics({"demand": pick(demand, DEMAND.total), "supply": pick(supply, SUPPLY.total),
                            "economy": pick(supply, "src_1"), "absent": None}, KEYS)


@query("s10_fixed_decimals", """select c_custkey, cast(cast(c_acctbal / 8 as decimal(38,6)) as varchar) as balance from customer""")
def s10(spark, d):
    return sinks.fixed_decimals(read_table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") / 8).alias("balance")), 6)


@query("s11_replaced_pair", with_("demand_wide", "supply_wide") + """select 'demand' as kind, region, ts, total_demand as value,
    row_number() over (partition by region order by ts) - 1 as id, (select count(*) from demand_wide) as n from demand_wide
    union all select 'generation', region, ts, total_supply, row_number() over (partition by region order by ts) - 1, (select count(*) from supply_wide) from supply_wide""")
def s11_pair(spark, d):
    path = scratch_path(spark)
    pick = lambda df, c: df.select(*KEYS, TS, F.col(c).alias("value"))
    demand, supply = pick(shapes.demand_wide(spark, d), DEMAND.total), pick(shapes.supply_wide(spark, d), SUPPLY.total)
    sinks.replace_tables(spark, path, {"demand": demand.limit(1), "generation": supply.limit(1)}, [TS], KEYS)
    n = sinks.replace_tables(spark, path, {"demand": demand, "generation": supply}, [TS], KEYS)
    return sinks.export_combined(sinks.read_tables(spark, path)).withColumn("n", F.when(F.col("kind") == "demand", n["demand"]).otherwise(n["generation"]).cast("long"))


@query("s12_checked_write", with_("supply_wide", supply_all="select 'all' as region, * exclude (region) from supply_wide")
       + f"select * exclude (region) from ({_Q1.replace('supply_wide', 'supply_all')})")
def s12_checked(spark, d):
    path = scratch_path(spark)
    supply = shapes.supply_wide(spark, d)
    return checks_for_comparison(sinks.write_checked(supply, path, [Q.identity_check(supply, SUPPLY, "generation", 0.02)]))


@query("s12_report_sink", with_("supply_wide") + _Q1)
def s12(spark, d):
    path = scratch_path(spark)
    sinks.write_report(Q.check_identity(shapes.supply_wide(spark, d), SUPPLY, "generation", 0.02, keys=KEYS), path)
    return checks_for_comparison(spark.read.parquet(path))


@query("s13_export_combined", with_("demand_wide", "supply_wide", fd=_naive("demand_wide", "total_demand", 24)) + f"""
    select 'demand_forecast' as kind, region, ts, {sq("forecast", 2, "value")} from fd
    union all select 'historical_demand', region, ts, {sq("total_demand", 2)} from demand_wide
    union all select 'historical_supply', region, ts, {sq("total_supply", 2)} from supply_wide""")
def s13(spark, d):
    demand, supply = shapes.demand_wide(spark, d), shapes.supply_wide(spark, d)
    fc = forecast_seasonal_naive(demand, KEYS, TS, DEMAND.total, 24)
    as_value = lambda df, c: df.select(*KEYS, TS, F.col(c).alias("value"))
    return settled(sinks.export_combined({
        "demand_forecast": as_value(fc, "forecast"), "historical_demand": as_value(demand, DEMAND.total),
        "historical_supply": as_value(supply, SUPPLY.total)}), 2)
