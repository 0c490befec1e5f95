"""Canonical panels built from a star schema of orders and line items.

Demand is the order value of a month by market segment, supply the shipped
value by part type, both per region.  Sums run over whole cents, so they do not
depend on the order of summation.  Each panel is one aggregation after the
joins: parts and total come from conditional sums, not from a pivot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.scalars import to_month
from wattloom.model import Family
from wattloom.operators.align import outer_on_month
from wattloom.session import materialize
from wattloom.sources.tables import read_table

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PRIORITIES = {"m2": "1-URGENT", "m3": "2-HIGH"}
TECH_TYPES = {
    "thermal": ["ECONOMY", "STANDARD"], "hydro": ["LARGE"], "nuclear": ["MEDIUM"], "wind": ["PROMO"], "solar": ["SMALL"],
}

KEYS, TS = ["region"], "ts"
DEMAND = Family("total_demand", tuple(f"seg_{i}" for i in range(1, 6)))
SUPPLY = Family("total_supply", tuple(f"src_{i}" for i in range(1, 7)))


def money(col: str) -> Column:
    return F.col(col).cast("decimal(18,2)")


def cents(col: str) -> Column:
    """Money as whole cents: integer sums are exact in any order and stay in generated code."""
    return F.floor(F.col(col) * 100 + 0.5)


def sum_money(value: Column) -> Column:
    return F.sum(value) / 100.0


def regions(spark: SparkSession, d: str) -> DataFrame:
    nation, region = read_table(spark, d, "nation"), read_table(spark, d, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region")
    )


def orders_by_place(spark: SparkSession, d: str) -> DataFrame:
    """Orders with region, nation, segment.

    Joined table by table, so that each side's size is a file size the
    optimizer can judge when it decides what to broadcast.
    """
    placed = read_table(spark, d, "orders").join(read_table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return placed.join(regions(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))


def shipped_by_place(spark: SparkSession, d: str) -> DataFrame:
    """Line items with region, nation and part type."""
    placed = read_table(spark, d, "lineitem").join(read_table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    typed = placed.join(read_table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return typed.join(regions(spark, d), F.col("s_nationkey") == F.col("n_nationkey"))


def demand_wide(spark: SparkSession, d: str) -> DataFrame:
    value = cents("o_totalprice")
    parts = [sum_money(F.when(F.col("c_mktsegment") == s, value)).alias(c) for s, c in zip(SEGMENTS, DEMAND.parts)]
    return orders_by_place(spark, d).groupBy("region", to_month("o_orderdate").alias(TS)).agg(
        sum_money(value).alias(DEMAND.total), *parts
    )


def supply_wide(spark: SparkSession, d: str) -> DataFrame:
    value = cents("l_extendedprice")
    parts = [sum_money(F.when(F.col("p_type") == t, value)).alias(c) for t, c in zip(PART_TYPES, SUPPLY.parts)]
    return shipped_by_place(spark, d).groupBy("region", to_month("l_shipdate").alias(TS)).agg(
        sum_money(value).alias(SUPPLY.total), *parts
    )


def _month_index() -> Column:
    return F.year(TS) * 12 + F.month(TS)


def with_gaps(df: DataFrame, fam: Family) -> DataFrame:
    """Holes on a fixed calendar pattern: totals, first part, first two parts."""
    i = _month_index()
    first, second = fam.parts[:2]
    return df.withColumns({
        fam.total: F.when(i % 7 != 0, F.col(fam.total)),
        first: F.when((i % 5 != 0) & (i % 11 != 0), F.col(first)),
        second: F.when(i % 11 != 0, F.col(second)),
    })


def demand_gappy(spark: SparkSession, d: str) -> DataFrame:
    return with_gaps(demand_wide(spark, d), DEMAND)


def merged(spark: SparkSession, d: str) -> DataFrame:
    return outer_on_month(demand_wide(spark, d), supply_wide(spark, d), KEYS, TS)


def panel_annual(spark: SparkSession, d: str) -> DataFrame:
    """(region, nation, year, m1, m2, m3): order value in total and for two priorities."""
    value = cents("o_totalprice")
    return orders_by_place(spark, d).groupBy("region", "nation", F.year("o_orderdate").alias("year")).agg(
        sum_money(value).alias("m1"), *[sum_money(F.when(F.col("o_orderpriority") == p, value)).alias(m) for m, p in PRIORITIES.items()]
    )


def parent_monthly(spark: SparkSession, d: str) -> DataFrame:
    """(region, ts, m1, m2, m3): the monthly counterpart of ``panel_annual``."""
    value = cents("o_totalprice")
    return orders_by_place(spark, d).groupBy("region", to_month("o_orderdate").alias(TS)).agg(
        sum_money(value).alias("m1"), *[sum_money(F.when(F.col("o_orderpriority") == p, value)).alias(m) for m, p in PRIORITIES.items()]
    )


def annual_and_monthly(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """``panel_annual`` and ``parent_monthly`` from one scan of the orders and one write.

    Orders are summed by entity and month, the finest figures both panels
    need; grouping sets roll those up to either one.
    """
    value, names = cents("o_totalprice"), ["m1", *PRIORITIES]
    finest = orders_by_place(spark, d).groupBy("region", "nation", to_month("o_orderdate").alias(TS)).agg(
        F.sum(value).alias("m1"), *[F.sum(F.when(F.col("o_orderpriority") == p, value)).alias(m) for m, p in PRIORITIES.items()])
    finest = finest.withColumn("year", F.year(TS))
    both = materialize(finest.groupingSets([["region", "nation", "year"], ["region", TS]], "region", "nation", "year", TS).agg(
        *[F.sum(m).alias(m) for m in names], F.grouping("nation").alias("monthly")))
    money_ = [(F.col(m) / 100.0).alias(m) for m in names]
    return both.filter("monthly = 0").select("region", "nation", "year", *money_), both.filter("monthly = 1").select("region", TS, *money_)


def market_months(spark: SparkSession, d: str) -> DataFrame:
    """(region, ts, demand, seg_1..5, five technologies, supply) for shared months."""
    value = cents("l_extendedprice")
    techs = [sum_money(F.when(F.col("p_type").isin(types), value)).alias(t) for t, types in TECH_TYPES.items()]
    made = shipped_by_place(spark, d).groupBy("region", to_month("l_shipdate").alias(TS)).agg(
        *techs, sum_money(value).alias("supply")
    )
    used = demand_wide(spark, d).withColumnRenamed(DEMAND.total, "demand")
    return used.join(made, [*KEYS, TS])


def hourly_events(spark: SparkSession, d: str, keys=("event_type",)) -> DataFrame:
    """(keys, hour, value): mean event value per series and hour, without a time zone."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    return read_table(spark, d, "events").groupBy(*keys, hour.alias("hour")).agg(F.avg("value").alias("value"))
