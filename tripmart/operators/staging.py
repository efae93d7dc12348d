"""Cleaning and typing of raw trips and zones, under either rule set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.timestamps import (
    AsOf,
    clock,
    elapsed_minutes,
    minute_boundaries,
    safe_timestamp,
    within_years,
)
from tripmart.schemas import LAKEHOUSE, WAREHOUSE, Profile


def _fare_floor(profile: Profile) -> Column:
    fare, floor = F.col("fare_amount"), F.lit(profile.min_fare)
    return fare >= floor if profile.min_fare_inclusive else fare > floor


def _fees(profile: Profile) -> dict[str, Column]:
    return {name: F.coalesce(name, F.lit(0.0)) for name in profile.missing_fee_is_zero}


def stage_trips(trips: DataFrame, profile: Profile, as_of: AsOf = None) -> DataFrame:
    """Staged trips: from raw trips for the warehouse rules, from silver trips for the lakehouse rules."""
    if profile.name == LAKEHOUSE.name:
        return _stage_silver(trips, profile, as_of)
    return _stage_raw(trips, profile, as_of)


def _stage_raw(raw: DataFrame, profile: Profile, as_of: AsOf) -> DataFrame:
    """Filters on raw columns only, so they reach the file scan; unreadable or implausible times become null."""
    kept = raw.filter(
        _fare_floor(profile)
        & (F.col("trip_distance") > 0)
        & F.col("passenger_count").between(1, profile.max_passengers)
    )
    parsed = kept.withColumns(
        {
            "pickup_ts": safe_timestamp(raw, "tpep_pickup_datetime"),
            "dropoff_ts": safe_timestamp(raw, "tpep_dropoff_datetime"),
        }
    )
    masked = parsed.withColumns(
        {name: within_years(F.col(name), profile.first_year, as_of) for name in ("pickup_ts", "dropoff_ts")}
    )
    return masked.withColumns(
        {
            **_fees(profile),
            "trip_duration_mins": minute_boundaries(F.col("pickup_ts"), F.col("dropoff_ts")),
            "_dbt_loaded_at": clock(as_of),
        }
    ).select(*profile.stage_columns)


def silver_trips(raw: DataFrame, zones: DataFrame, as_of: AsOf = None, profile: Profile = LAKEHOUSE) -> DataFrame:
    """Cleaned lakehouse trips: all raw columns, times, duration and the pickup zone.

    ``zones`` keeps a typed key, so a malformed id cannot fail the join. The zone side is broadcast by its measured
    size and otherwise joined by shuffle, where adaptive execution splits a hot pickup zone.
    """
    cleaned = (
        raw.filter(
            (F.col("fare_amount") > 0)
            & (F.col("trip_distance") > 0)
            & F.col("passenger_count").between(1, profile.max_passengers)
        )
        .withColumns(
            {
                "pickup_ts": safe_timestamp(raw, "tpep_pickup_datetime"),
                "dropoff_ts": safe_timestamp(raw, "tpep_dropoff_datetime"),
            }
        )
        .withColumn("trip_duration_mins", elapsed_minutes(F.col("pickup_ts"), F.col("dropoff_ts")))
        .filter(F.col("trip_duration_mins").between(*profile.duration_range))
        .withColumns(_fees(profile))
        .withColumnsRenamed({"pulocationid": "PULocationID", "dolocationid": "DOLocationID"})
    )
    pickup = zones.select(
        F.col("locationid").cast("bigint").alias("PULocationID"),
        F.col("borough").alias("pickup_borough"),
        F.col("zone").alias("pickup_zone"),
        F.col("service_zone"),
    )
    return cleaned.join(pickup, "PULocationID", "left").withColumn("_loaded_at", clock(as_of))


def _stage_silver(silver: DataFrame, profile: Profile, as_of: AsOf) -> DataFrame:
    return (
        silver.filter(_fare_floor(profile) & (F.col("trip_distance") > 0))
        .withColumnsRenamed({"PULocationID": "pulocationid", "DOLocationID": "dolocationid"})
        .withColumns({**_fees(WAREHOUSE), "_dbt_loaded_at": clock(as_of)})
        .select(*profile.stage_columns)
    )


def stage_zones(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("locationid").isNotNull()).select(
        F.col("locationid").alias("location_id"), "borough", "zone", "service_zone"
    )


def dim_zones(staged: DataFrame) -> DataFrame:
    return staged.select("location_id", "borough", "zone", "service_zone")
