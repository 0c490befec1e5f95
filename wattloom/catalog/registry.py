"""Query registry and the SQL fragments the counterparts share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattloom.plans import shapes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` computes the same table in plain SQL."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def settled(df: DataFrame, places: int, cols=None) -> DataFrame:
    """Round floating columns for comparison between engines.

    The threshold sits a hair below one half, so a value that is a tie up to
    floating-point noise rounds up everywhere instead of at random.
    """
    cols = cols or [c for c, t in df.dtypes if t == "double"]
    cut = {c: f"floor(`{c}` * 1e{places}D + 0.5003D) / 1e{places}D as `{c}`" for c in cols}
    return df.selectExpr(*[cut.get(c, f"`{c}`") for c in df.columns])


def sq(expr: str, places: int, name: str | None = None) -> str:
    """SQL counterpart of ``settled``."""
    return f"floor(({expr})*1e{places}+0.5003)/1e{places}" + (f" as {name}" if name else "")


def sqs(cols, places: int) -> str:
    return ", ".join(sq(c, places, c) for c in cols)


def _sums(value: str, column: str, groups: dict[str, list[str]]) -> str:
    def one(name, values):
        listed = ", ".join(f"'{v}'" for v in values)
        return f"cast(sum(case when {column} in ({listed}) then {value} end) as double) as {name}"
    return ", ".join(one(n, v) for n, v in groups.items())


_PRICE = "cast(o_totalprice as decimal(18,2))"
_SHIPPED = "cast(l_extendedprice as decimal(18,2))"
_ORDERS = """orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey"""
_LINES = """lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
_SEGMENTS = {c: [s] for c, s in zip(shapes.DEMAND.parts, shapes.SEGMENTS)}
_TYPES = {c: [t] for c, t in zip(shapes.SUPPLY.parts, shapes.PART_TYPES)}
_METRICS = {m: [p] for m, p in shapes.PRIORITIES.items()}

_CTES = {
    "demand_wide": f"""select r_name as region, cast(date_trunc('month', o_orderdate) as date) as ts,
        cast(sum({_PRICE}) as double) as total_demand, {_sums(_PRICE, 'c_mktsegment', _SEGMENTS)}
        from {_ORDERS} group by 1, 2""",
    "supply_wide": f"""select r_name as region, cast(date_trunc('month', l_shipdate) as date) as ts,
        cast(sum({_SHIPPED}) as double) as total_supply, {_sums(_SHIPPED, 'p_type', _TYPES)}
        from {_LINES} group by 1, 2""",
    "market": f"""select d.region, d.ts, total_demand as demand, seg_1, seg_2, seg_3, seg_4, seg_5,
        thermal, hydro, nuclear, wind, solar, supply
        from demand_wide d join (select r_name as region, cast(date_trunc('month', l_shipdate) as date) as ts,
            {_sums(_SHIPPED, 'p_type', shapes.TECH_TYPES)}, cast(sum({_SHIPPED}) as double) as supply
            from {_LINES} group by 1, 2) s on d.region = s.region and d.ts = s.ts""",
    "merged": """select coalesce(d.region, s.region) as region, coalesce(d.ts, s.ts) as ts, d.* exclude (region, ts),
        s.* exclude (region, ts) from demand_wide d full join supply_wide s on d.region = s.region and d.ts = s.ts""",
    "gappy": """select region, ts,
        case when (year(ts)*12+month(ts)) % 7 <> 0 then total_demand end as total_demand,
        case when (year(ts)*12+month(ts)) % 5 <> 0 and (year(ts)*12+month(ts)) % 11 <> 0 then seg_1 end as seg_1,
        case when (year(ts)*12+month(ts)) % 11 <> 0 then seg_2 end as seg_2, seg_3, seg_4, seg_5 from demand_wide""",
    "panel_annual": f"""select r_name as region, n_name as nation, cast(year(o_orderdate) as int) as year,
        cast(sum({_PRICE}) as double) as m1, {_sums(_PRICE, 'o_orderpriority', _METRICS)}
        from {_ORDERS} group by 1, 2, 3""",
    "parent_monthly": f"""select r_name as region, cast(date_trunc('month', o_orderdate) as date) as ts,
        cast(sum({_PRICE}) as double) as m1, {_sums(_PRICE, 'o_orderpriority', _METRICS)}
        from {_ORDERS} group by 1, 2""",
}
_NEEDS = {"market": ["demand_wide"], "merged": ["demand_wide", "supply_wide"], "gappy": ["demand_wide"]}


def with_(*names: str, **more: str) -> str:
    """``WITH`` clause for shared fragments and then local ones, in order."""
    ordered: list[str] = []
    for n in names:
        ordered += [x for x in (*_NEEDS.get(n, []), n) if x not in ordered]
    parts = [f"{n} as materialized ({_CTES[n]})" for n in ordered] + [f"{n} as ({q})" for n, q in more.items()]
    return "with " + ",\n".join(parts) + "\n"
