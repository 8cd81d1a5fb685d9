"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from postmill.plans.registry import QUERIES
from postmill.sources.posts import posts

#: One of each family: category tables, people, years, comparison, text, resolution, data quality.
HEADLINES = (
    "flagship_report", "razors", "soaps", "razor_formats", "razor_blade_combinations", "highest_use_count_per_blade", "users", "user_soap_brand_scent_diversity", "month_metadata", "product_usage",
    "annual_razors", "annual_users", "delta_columns", "rank_history_pivot", "search_index", "extract_fields", "normalize_for_matching", "blade_ctx", "brush_score", "match_stats", "soap_duplicates", "merge_upsert",
)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["exact_lookup"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the JVM's compilers
    began = time.perf_counter()
    posts(spark, sf_dir)  # the view that the others read is written once
    seconds = {"posts_view": round(time.perf_counter() - began, 3)}
    for name in HEADLINES:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
