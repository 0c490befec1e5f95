"""Writers.  Single tables overwrite their folder; ``replace_tables`` switches several at once."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wattloom.operators.align import with_ids
from wattloom.operators.quality import Check, check_aggregates, check_rows
from wattloom.operators.windows import day_gap


def fixed_decimals(df: DataFrame, decimals: int) -> DataFrame:
    """Floating columns as text with exactly ``decimals`` places."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.col(c).cast(f"decimal(38,{decimals})").cast("string") for c in floats})


def write_csv(df: DataFrame, path: str, decimals: int | None = None) -> None:
    """CSV with a header, optionally at fixed precision."""
    out = df if decimals is None else fixed_decimals(df, decimals)
    out.write.mode("overwrite").csv(path, header=True)


def write_with_ids(df: DataFrame, path: str, order: Sequence[str], keys: Sequence[str] = (), out: str = "id") -> int:
    """Replace a keyed table, ids 0..n-1 in ``order``; returns the row count."""
    with_ids(df, order, keys, out).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _current(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest manifest; (0, {}) before the first."""
    files, folder = _folder(spark, f"{path}/manifests")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    last = max((int(n) for n in names if n.isdigit()), default=0)
    return (last, json.loads(spark.read.text(f"{path}/manifests/{last:08d}").first()[0])) if last else (0, {})


def replace_tables(spark: SparkSession, path: str, tables: Mapping[str, DataFrame], order: Sequence[str], keys: Sequence[str] = (), out: str = "id") -> dict[str, int]:
    """Replace several keyed tables under ``path`` together; returns their row counts.

    Every table gets ids 0..n-1 in ``order`` (by ``keys``) and is written to a
    folder of its own, its rows counted by the write itself.  Only when all are
    there does a numbered manifest, moved into place in one step, make them
    the ones that ``read_tables`` finds: a job lost before leaves the old
    tables as they were.  The tables before these stay, for readers that
    still hold them; older ones go.  Of two writers at once the second raises.
    """
    last, before = _current(spark, path)
    version, found = uuid.uuid4().hex, {}
    for name, df in tables.items():
        seen, place = Observation(), f"{path}/{version}/{name}"
        with_ids(df, order, keys, out).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(place)
        found[name] = {"path": f"{version}/{name}", "rows": seen.get["rows"], "schema": df.sparkSession.read.parquet(place).schema.jsonValue()}
    staged, final = f"{path}/{version}/manifest", f"{path}/manifests/{last + 1:08d}"
    spark.createDataFrame([(json.dumps({"version": version, "before": before.get("version"), "tables": found}),)], "line string").coalesce(1).write.text(staged)
    files, to = _folder(spark, final)
    files.mkdirs(to.getParent())
    if files.exists(to) or not files.rename(_folder(spark, staged)[1], to):
        raise RuntimeError(f"another writer has replaced the tables of {path}")
    if before.get("before"):
        files.delete(_folder(spark, f"{path}/{before['before']}")[1], True)
    return {name: t["rows"] for name, t in found.items()}


def read_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables that the newest manifest names, all of one ``replace_tables``; none before the first."""
    from pyspark.sql.types import StructType

    _, found = _current(spark, path)
    return {name: spark.read.schema(StructType.fromJson(t["schema"])).parquet(f"{path}/{t['path']}") for name, t in found.get("tables", {}).items()}


def write_checked(df: DataFrame, path: str, checks: Sequence[Check], keys=(), ts: str | None = None) -> DataFrame:
    """Write ``df`` and return the checks of the whole table, ``(check, metric, value, status)``.

    The figures are observed while the rows are written, so the table is
    computed and read once; ``keys`` only separate the series for date gaps.
    """
    rows = day_gap(df, keys, ts) if any(c.gaps for c in checks) else df
    seen = Observation()
    rows.observe(seen, *check_aggregates(checks)).select(*df.columns).write.mode("overwrite").parquet(path)
    spark, values = df.sparkSession, seen.get
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()])
    return check_rows(row, checks)


def write_report(checks: DataFrame, path: str) -> None:
    checks.write.mode("overwrite").parquet(path)


def export_combined(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Several tables as one, told apart by ``kind``."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [d.withColumn("kind", F.lit(kind)) for kind, d in frames.items()],
    )
