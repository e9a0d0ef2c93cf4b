"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from alambique.plans.catalog import QUERIES
from alambique.session import with_profile

HEADLINE = (
    "csv_roundtrip",
    "parquet_partitioned",
    "profile_describe",
    "scenario_shares",
    "cleaning_report",
    "dim_tiempo_clean",
    "dim_tienda_clean",
    "dim_producto_clean",
    "price_avg",
    "median_price",
    "outlier_filter",
    "dedup_key",
    "fact_clean",
    "fact_clean_strict",
    "fact_clean_ri",
    "ri_orphans",
    "load_fact_new",
    "load_fact_first",
    "load_log",
    "error_detail",
    "quantiles_value",
    "staging_remainder",
    "value_discrepancy",
    "export_star",
    "profile_distinct_counts",
    "impact_rate",
    "impact_by_month",
    "loss_by_cause",
    "risk_stores",
    "risk_products",
    "risk_map",
)


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("alambique-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    return with_profile(builder, shuffle_partitions=int(cpus)).getOrCreate()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's code paths once, so the first query does not pay for them.
    QUERIES["impact_rate"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
