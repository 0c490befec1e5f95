"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wattloom.catalog import QUERIES
from wattloom.session import build_session

HEADLINE = [
    "j1_outer_on_month", "j5_outer_on", "w4_pct_change", "w8_dedup_last", "w9_interpolate_linear", "i1_fill_by_accounting",
    "i4_series_features", "k3_growth", "k8_indicators", "q7_summary", "q10_alignment_stats", "s4_footer_cut", "s8_melt_sheets",
    "s11_table_with_ids", "t1_html_to_text", "t8_read_bulletins", "x1_densify_months", "f1_forecast_sarima", "f10_build_panel",
    "m4_policy_reallocate", "m13_calibrate_grid", "m14_compare_scenarios",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("j1_outer_on_month")  # start-up costs are not a query's
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
