"""Times the queries: prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores. The headline queries, whose times make up the value, run once to
warm up and then BENCH_RUNS times (best time counts); the other registered queries run once. ``quality_w_3700k`` is the
complete warehouse build with its checks over 3.7 million trips, the given line items several times over.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.plans.queries import all_queries
from tripmart.session import clear_run_folder, local_session

HEADLINE = (
    "stage_trips_w", "silver_trips_l", "fact_trips_w", "fact_trips_l", "daily_revenue_w", "daily_revenue_l",
    "hourly_demand_w", "hourly_demand_l", "borough_stats", "anomaly_flags_w", "anomaly_flags_l", "incremental_fact_w",
    "incremental_counts", "upsert_overlap", "no_future_trips", "score_candidates", "parse_reply_texts", "ai_flags",
    "quality_w", "quality_l", "tolerant_csv_load", "file_stream_once",
)
LARGE_ROWS = 3_724_889


def larger(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The tables that trips come from, with line items repeated under new order keys up to ``LARGE_ROWS``."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    many, last = lineitem.agg(F.count("*"), F.max("l_orderkey")).first()
    times = -(-LARGE_ROWS // many)
    copies = lineitem.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    moved = copies.withColumn("l_orderkey", F.col("l_orderkey") + F.col("_copy") * (last + 1)).drop("_copy")
    moved.limit(LARGE_ROWS).repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{folder}/lineitem.parquet")
    for name in ("nation", "region"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def seconds_of(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    folder = tempfile.mkdtemp(prefix="bench-")
    settings = {"spark.checkpoint.dir": f"{folder}/shared", "spark.sql.warehouse.dir": f"{folder}/warehouse"}
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds, others = all_queries(), {}, {}

    def timed(name: str, where: str) -> float:
        started = time.perf_counter()
        seconds_of(queries[name](spark, where))
        return time.perf_counter() - started

    for name in HEADLINE:
        timed(name, sf_dir)
        seconds[name] = round(min(timed(name, sf_dir) for _ in range(runs)), 3)
    for name in queries.keys() - set(HEADLINE):
        others[name] = round(timed(name, sf_dir), 3)
    others["quality_w_3700k"] = round(timed("quality_w", larger(spark, sf_dir, f"{folder}/large")), 3)
    total = round(sum(seconds.values()), 3)
    result = {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds | others, "sf": sf_dir}
    print(json.dumps(result))
    clear_run_folder(spark)
    spark.stop()


if __name__ == "__main__":
    main()
