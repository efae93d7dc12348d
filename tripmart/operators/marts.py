"""The trip fact and the revenue and demand aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.numeric import exact_avg, exact_sum, round_half_up, safe_ratio
from tripmart.functions.timestamps import day_of_week, day_start, hour_start
from tripmart.schemas import Profile


def payment_label(profile: Profile) -> Column:
    """Name of a payment type; unknown and missing types are 'Other'."""
    branches = reduce(
        lambda chain, pair: chain.when(F.col("payment_type") == pair[0], pair[1]), profile.payment_labels, F
    )
    return branches.otherwise("Other")


def _zones_as(zones: DataFrame, role: str, *columns: str) -> DataFrame:
    return zones.select(
        F.col("location_id").alias(f"{role}_location_id"),
        *[F.col(name).alias(f"{role}_{name}") for name in columns],
    )


def with_zones(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Pickup and dropoff zone names; trips without a zone stay.

    No broadcast hint: Spark broadcasts the dimension when its measured size is below the threshold. Above it both
    joins shuffle, and adaptive execution splits the partitions of a hot zone.
    """
    pickup = _zones_as(zones, "pickup", "borough", "zone", "service_zone")
    dropoff = _zones_as(zones, "dropoff", "borough", "zone")
    return staged.join(pickup, F.col("pulocationid") == F.col("pickup_location_id"), "left").join(
        dropoff, F.col("dolocationid") == F.col("dropoff_location_id"), "left"
    )


def fact_trips(staged: DataFrame, zones: DataFrame | None, profile: Profile) -> DataFrame:
    """One row per staged trip with calendar fields, labels and tip share. Lakehouse trips carry their zone already."""
    located = staged if "pickup_borough" in staged.columns else with_zones(staged, zones)
    pickup = F.col("pickup_ts")
    return located.select(
        "*",
        day_start(pickup).alias("pickup_date"),
        hour_start(pickup).alias("pickup_hour"),
        F.hour(pickup).alias("pickup_hour_of_day"),
        day_of_week(pickup, profile.sunday).alias("pickup_dow"),
        payment_label(profile).alias("payment_type_desc"),
        round_half_up(safe_ratio(F.col("tip_amount"), F.col("fare_amount")) * 100).alias("tip_pct"),
    ).select(*profile.fact_columns)


def daily_revenue(fact: DataFrame, profile: Profile) -> DataFrame:
    """Revenue and averages per pickup day and borough.

    Every aggregate is combined before the shuffle, so a day or borough with a third of all trips sends one row per
    map task; null days and null boroughs form groups of their own.
    """
    measures = [
        F.count(F.lit(1)).alias("total_trips"),
        round_half_up(exact_sum("total_amount")).alias("total_revenue"),
        round_half_up(exact_avg("fare_amount")).alias("avg_fare"),
        round_half_up(exact_avg("tip_amount")).alias("avg_tip"),
        round_half_up(exact_avg("trip_distance")).alias("avg_distance_miles"),
        round_half_up(exact_avg("trip_duration_mins")).alias("avg_duration_mins"),
    ]
    if profile.count_payment_types:
        measures += [
            F.count_if(F.col("payment_type") == 1).alias("card_trips"),
            F.count_if(F.col("payment_type") == 2).alias("cash_trips"),
        ]
    return fact.groupBy(F.col("pickup_date").alias("trip_date"), "pickup_borough").agg(*measures)


def hourly_demand(fact: DataFrame) -> DataFrame:
    """Trips and average fare per hour of day, day of week and borough."""
    return fact.groupBy("pickup_hour_of_day", "pickup_dow", "pickup_borough").agg(
        F.count(F.lit(1)).alias("total_trips"),
        round_half_up(exact_avg("fare_amount")).alias("avg_fare"),
    )
