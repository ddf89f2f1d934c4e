"""Time the headline proof queries.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS] (default 8) and prints one JSON
line. Each query is built and run to completion into the no-op sink BENCH_RUNS times (default 2) and the
shortest time counts, so that it is the plan that is timed and not the first compilation of its code;
"first_run_total" gives the sum of the first runs. Writers and streams write under the scratch folder as in
use. One small query warms the JVM up and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.proofs import PLANS, Tables
from tallyloom.session import build_session

HEADLINE = """
agg_basic agg_count_distinct_if agg_percentile_exact agg_sum_with_latest agg_leadtime_stats
jn_left_star jn_full_multiway jn_range_trailing jn_band jn_wildcard_rule jn_temporal_validity
win_dedup_latest win_lag_lead win_running_total win_rows_trailing_30 win_topn_quota
x_scd2_build x_running_balance x_fifo_aging x_rolling_cost x_seasonality_index x_price_waterfall
x_basket_counts x_availability_kpis x_wide_daily_mart x_margin_detail x_replenishment_demand
dq_column_profile dq_json_contract wr_replace_days wr_upsert str_valid_invalid_split
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "tallyloom-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallyloom-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, sf_dir)
    tables.lineitem.join(tables.orders, tables.lineitem.l_orderkey == tables.orders.o_orderkey).groupBy("l_returnflag").count().collect()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times, first_total = {}, 0.0
    for name in names:
        took = []
        for _ in range(runs):
            start = time.perf_counter()
            PLANS[name](Tables(spark, sf_dir)).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(min(took), 3)
        first_total += took[0]
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run_total": round(first_total, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
