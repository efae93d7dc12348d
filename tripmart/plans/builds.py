"""Complete builds of the marts from raw trips, one per rule set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.functions.timestamps import AsOf
from tripmart.operators.anomaly import anomaly_flags
from tripmart.operators.incremental import append_new, raw_after, stored_mark
from tripmart.operators.marts import daily_revenue, fact_trips, hourly_demand
from tripmart.operators.quality import LAKEHOUSE_CHECKS, WAREHOUSE_CHECKS, run_suite
from tripmart.operators.snapshot import store_snapshot
from tripmart.operators.staging import dim_zones, silver_trips, stage_trips, stage_zones
from tripmart.schemas import LAKEHOUSE, WAREHOUSE, Profile
from tripmart.sources.tables import exists, read_fact, write_fact_partitioned, write_table


def _marts(fact: DataFrame, profile: Profile, out: str) -> dict[str, DataFrame]:
    """Aggregates and flags, each from the stored fact, so staging and the zone joins run once per build."""
    spark = fact.sparkSession
    frames = {
        "agg_daily_revenue": daily_revenue(fact, profile),
        "agg_hourly_demand": hourly_demand(fact),
        "anomaly_flags": anomaly_flags(fact),
    }
    for name, frame in frames.items():
        write_table(frame, f"{out}/{name}")
    return {name: spark.read.parquet(f"{out}/{name}") for name in frames}


def grow_fact(
    spark: SparkSession, raw: DataFrame, zones: DataFrame | None, out: str, profile: Profile, as_of: AsOf = None,
    grain: str | None = None, silver_zones: DataFrame | None = None,
) -> DataFrame:
    """One run of the incremental model: adds to ``out``/fct_trips_incremental what is newer than all it holds.

    ``raw`` is what staging needs or, with ``silver_zones``, what silver needs. The mark reaches the raw scan.
    """
    path = f"{out}/fct_trips_incremental"
    target = read_fact(spark, path) if exists(spark, path) else None
    fresh = raw_after(raw, stored_mark(spark, path, grain))
    if silver_zones is not None:
        fresh = silver_trips(fresh, silver_zones, as_of)
    append_new(path, target, stage_trips(fresh, profile, as_of), zones, profile, as_of, grain)
    return read_fact(spark, path)


def build_warehouse(
    spark: SparkSession, raw: DataFrame, zones: DataFrame, out: str, as_of: AsOf = None
) -> dict[str, DataFrame]:
    """Staging stays a view; the zone dimension and its history, the fact and everything after it are stored under
    ``out``. A further build rebuilds them, but adds to the incremental fact and to the history."""
    staged = stage_trips(raw, WAREHOUSE, as_of)
    write_table(dim_zones(stage_zones(zones)), f"{out}/dim_zones")
    dim = spark.read.parquet(f"{out}/dim_zones")
    write_table(fact_trips(staged, dim, WAREHOUSE), f"{out}/fct_trips")
    fact = spark.read.parquet(f"{out}/fct_trips")
    return {
        "taxi_zone_lookup": zones, "stg_yellow_trips": staged, "dim_zones": dim, "fct_trips": fact,
        "fct_trips_incremental": grow_fact(spark, raw, dim, out, WAREHOUSE, as_of),
        "zone_snapshot": store_snapshot(f"{out}/zone_snapshot", dim, as_of),
        **_marts(fact, WAREHOUSE, out),
    }


def build_lakehouse(
    spark: SparkSession, raw: DataFrame, zones: DataFrame, out: str, as_of: AsOf = None, grain: str = "day"
) -> dict[str, DataFrame]:
    """Silver is stored, staging is a view on it, the fact and everything after it are stored under ``out``. A further
    build rebuilds them, but adds to the incremental fact."""
    write_table(silver_trips(raw, zones, as_of), f"{out}/yellow_trips_clean")
    silver = spark.read.parquet(f"{out}/yellow_trips_clean")
    staged = stage_trips(silver, LAKEHOUSE, as_of)
    write_fact_partitioned(fact_trips(staged, None, LAKEHOUSE), f"{out}/fct_trips", grain)
    fact = read_fact(spark, f"{out}/fct_trips")
    return {
        "yellow_trips_clean": silver, "stg_yellow_trips": staged, "fct_trips": fact,
        "fct_trips_incremental": grow_fact(spark, raw, None, out, LAKEHOUSE, as_of, grain, silver_zones=zones),
        **_marts(fact, LAKEHOUSE, out),
    }


def check_build(tables: dict[str, DataFrame], profile: Profile) -> DataFrame:
    return run_suite(tables, WAREHOUSE_CHECKS if profile is WAREHOUSE else LAKEHOUSE_CHECKS)
