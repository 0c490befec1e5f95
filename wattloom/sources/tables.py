"""Columnar and delimited sources, with fallbacks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


# The star schema.  Declaring it saves a footer-reading job per scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A Parquet table; a known or given schema is used as is, any other is inferred."""
    schema = schema or SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """CSV with a header under a declared schema; a leading BOM is skipped and bad cells are NULL."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE", enforceSchema=True)


def first_available(*loaders: Callable[[], DataFrame]) -> DataFrame | None:
    """The first source that exists; None when none does."""
    for load in loaders:
        try:
            return load()
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing.getCondition()):
                raise
    return None
