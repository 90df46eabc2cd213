"""Time the headline queries: one JSON line with seconds per query, warm, median of three."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from folioflow.queries import QUERIES  # noqa: E402

HEADLINES = (
    "consolidated_positions",
    "weighted_term",
    "net_trades_signed",
    "net_trades_buy_sell",
    "implied_trades",
    "look_through",
    "look_through_positions",
    "fx_convert_by_day",
    "asof_rating",
    "asof_price",
    "fill_forward",
    "latest_dedupe",
    "simple_log_returns",
    "adjusted_nav",
    "business_day_prev",
    "held_quotes",
    "curve_interpolate",
    "scenario_unpivot",
    "rate_union",
    "statement_outer_join",
    "coupon_arrays",
    "month_partitions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("folioflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINES:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
