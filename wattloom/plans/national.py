"""Ready-made shapes for national electricity tables: names, codes and flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.scalars import normalize_unit, parse_year, row_unit_hint, to_double, validate_headers
from wattloom.model import Family
from wattloom.sources.sheets import melt_year_cells, with_header_marker

# Column families.
DEMAND = Family("total_demand", ("primary_demand", "secondary_demand", "tertiary_demand", "residential_demand"))
SUPPLY = Family("total_supply", ("thermal_supply", "hydro_supply", "nuclear_supply", "wind_supply", "solar_supply"))
CLEAN_SUPPLY = ["hydro_supply", "nuclear_supply", "wind_supply", "solar_supply"]

# Price columns of the annual table, in order.
PRICE_COLUMNS = [
    "national_avg_yuan_per_mwh", "coal_benchmark_yuan_per_mwh", "nuclear_yuan_per_mwh", "thermal_wholesale_yuan_per_mwh",
    "hydro_yuan_per_mwh", "solar_yuan_per_mwh", "wind_yuan_per_mwh", "gas_ccgt_yuan_per_mwh", "biomass_yuan_per_mwh",
    "pv_fit_yuan_per_mwh",
]
PRICE_ROLES = {"year": "year", "date": "year", **{c: c for c in PRICE_COLUMNS}}
HINT_COLUMNS = PRICE_COLUMNS[:2]

# Province names and their region codes.
PROVINCES = {
    "北京市": "CN-11", "天津市": "CN-12", "河北省": "CN-13", "山西省": "CN-14", "内蒙古自治区": "CN-15",
    "辽宁省": "CN-21", "吉林省": "CN-22", "黑龙江省": "CN-23",
    "上海市": "CN-31", "江苏省": "CN-32", "浙江省": "CN-33", "安徽省": "CN-34", "福建省": "CN-35", "江西省": "CN-36", "山东省": "CN-37",
    "河南省": "CN-41", "湖北省": "CN-42", "湖南省": "CN-43", "广东省": "CN-44", "广西壮族自治区": "CN-45", "海南省": "CN-46",
    "重庆市": "CN-50", "四川省": "CN-51", "贵州省": "CN-52", "云南省": "CN-53", "西藏自治区": "CN-54",
    "陕西省": "CN-61", "甘肃省": "CN-62", "青海省": "CN-63", "宁夏回族自治区": "CN-64", "新疆维吾尔自治区": "CN-65",
}
# Markers of the annual province sheets and the years they cover.
PROVINCE_HEADER, PROVINCE_FOOTER = "地区", "数据来源"
PROVINCE_YEARS = (2010, 2024)


def province_codes(spark: SparkSession, name: str = "province") -> DataFrame:
    return spark.createDataFrame(list(PROVINCES.items()), f"{name} string, iso string")


def read_province_sheet(lines: DataFrame, value: str, name: str = "province", years=PROVINCE_YEARS) -> DataFrame:
    """Annual province values ``(province, year, <value>)`` from the lines of ragged sheets."""
    cells = melt_year_cells(with_header_marker(lines, PROVINCE_HEADER, PROVINCE_FOOTER), name)
    return cells.filter(F.col("year").between(*years)).select(name, "year", F.col("value").alias(value))


def clean_prices(raw: DataFrame) -> DataFrame:
    """Annual price table: strict headers, years parsed, units brought to per MWh."""
    named = validate_headers(raw, PRICE_ROLES)
    given = [c for c in PRICE_COLUMNS if c in named.columns]
    typed = named.select(parse_year("year").alias("year"), *[to_double(c).alias(c) for c in given]).filter(F.col("year").isNotNull())
    hinted = typed.withColumn("__hint", row_unit_hint([c for c in HINT_COLUMNS if c in given])) if set(HINT_COLUMNS) & set(given) \
        else typed.withColumn("__hint", F.lit(None).cast("double"))
    price = lambda c: F.round(normalize_unit(c, "__hint"), 4) if c in given else F.lit(None).cast("double")
    return hinted.select("year", *[price(c).alias(c) for c in PRICE_COLUMNS])
