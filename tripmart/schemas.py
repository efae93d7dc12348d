"""Column contracts and the two rule sets (profiles) that the operators are parameterised by."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LONG, DOUBLE, TEXT, NTZ = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The raw trip columns, in their published order.
TRIPS = _struct(
    ("vendorid", LONG),
    ("tpep_pickup_datetime", NTZ),
    ("tpep_dropoff_datetime", NTZ),
    ("passenger_count", LONG),
    ("trip_distance", DOUBLE),
    ("ratecodeid", LONG),
    ("store_and_fwd_flag", TEXT),
    ("pulocationid", LONG),
    ("dolocationid", LONG),
    ("payment_type", LONG),
    ("fare_amount", DOUBLE),
    ("extra", DOUBLE),
    ("mta_tax", DOUBLE),
    ("tip_amount", DOUBLE),
    ("tolls_amount", DOUBLE),
    ("improvement_surcharge", DOUBLE),
    ("total_amount", DOUBLE),
    ("congestion_surcharge", DOUBLE),
    ("airport_fee", DOUBLE),
    ("cbd_congestion_fee", DOUBLE),
)

# The zone lookup columns.
ZONES = _struct(("locationid", LONG), ("borough", TEXT), ("zone", TEXT), ("service_zone", TEXT))

# The table of scored rows.
AI_FLAGS = _struct(
    ("__ai_row_id", LONG),
    ("pickup_ts", NTZ),
    ("pickup_borough", TEXT),
    ("anomaly_score", DOUBLE),
    ("is_anomaly", T.BooleanType()),
    ("ai_explanation", TEXT),
    ("_dbt_loaded_at", NTZ),
)

# The key an incremental fact row is identified by.
FACT_KEY = ("pickup_ts", "pulocationid", "dolocationid", "fare_amount")


@dataclass(frozen=True)
class Profile:
    """Every rule that differs between the two published pipelines."""

    name: str
    min_fare: float
    min_fare_inclusive: bool
    max_passengers: int
    first_year: int
    duration_range: tuple[int, int]
    payment_labels: tuple[tuple[int, str], ...]
    sunday: int
    stage_columns: tuple[str, ...]
    fact_columns: tuple[str, ...]
    count_payment_types: bool
    missing_fee_is_zero: tuple[str, ...]


# Rule constants, labels and column orders of the warehouse rule set.
WAREHOUSE = Profile(
    name="warehouse",
    min_fare=0.5,
    min_fare_inclusive=True,
    max_passengers=10,
    first_year=2009,
    duration_range=(1, 180),
    payment_labels=(
        (1, "Credit card"),
        (2, "Cash"),
        (3, "No charge"),
        (4, "Dispute"),
        (5, "Unknown"),
        (6, "Voided"),
    ),
    sunday=0,
    stage_columns=(
        "pickup_ts", "dropoff_ts", "trip_distance", "passenger_count", "pulocationid", "dolocationid",
        "ratecodeid", "store_and_fwd_flag", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount",
        "payment_type", "vendorid", "_dbt_loaded_at", "trip_duration_mins",
    ),
    fact_columns=(
        "pickup_ts", "dropoff_ts", "trip_duration_mins", "pickup_date", "pickup_hour", "pickup_hour_of_day",
        "pickup_dow", "pulocationid", "dolocationid", "pickup_borough", "pickup_zone", "pickup_service_zone",
        "dropoff_borough", "dropoff_zone", "trip_distance", "passenger_count", "ratecodeid", "fare_amount",
        "tip_amount", "tolls_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount",
        "payment_type", "payment_type_desc", "tip_pct", "vendorid", "_dbt_loaded_at",
    ),
    count_payment_types=True,
    missing_fee_is_zero=("airport_fee", "cbd_congestion_fee"),
)

# Rule constants, labels and column orders of the lakehouse rule set.
LAKEHOUSE = Profile(
    name="lakehouse",
    min_fare=0.5,
    min_fare_inclusive=False,
    max_passengers=6,
    first_year=2009,
    duration_range=(1, 180),
    payment_labels=((1, "Credit card"), (2, "Cash"), (3, "No charge"), (4, "Dispute")),
    sunday=1,
    stage_columns=(
        "pickup_ts", "dropoff_ts", "trip_duration_mins", "trip_distance", "passenger_count", "pulocationid",
        "dolocationid", "fare_amount", "tip_amount", "tolls_amount", "congestion_surcharge", "airport_fee",
        "cbd_congestion_fee", "total_amount", "payment_type", "pickup_borough", "pickup_zone", "_dbt_loaded_at",
    ),
    fact_columns=(
        "pickup_ts", "dropoff_ts", "trip_duration_mins", "trip_distance", "passenger_count", "pulocationid",
        "dolocationid", "fare_amount", "tip_amount", "tolls_amount", "congestion_surcharge", "airport_fee",
        "cbd_congestion_fee", "total_amount", "payment_type", "pickup_borough", "pickup_zone", "pickup_date",
        "pickup_hour_of_day", "pickup_dow", "payment_type_desc", "tip_pct", "_dbt_loaded_at",
    ),
    count_payment_types=False,
    missing_fee_is_zero=("airport_fee", "cbd_congestion_fee", "congestion_surcharge"),
)
