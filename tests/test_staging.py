import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart.functions.timestamps import elapsed_minutes, hour_start, minute_boundaries, safe_timestamp, within_years
from tripmart.operators.marts import fact_trips
from tripmart.operators.staging import dim_zones, silver_trips, stage_trips, stage_zones
from tripmart.schemas import LAKEHOUSE, TRIPS, WAREHOUSE

AS_OF = "2026-01-01 00:00:00"


def ts(text):
    return dt.datetime.fromisoformat(text) if text else None


def trip(pickup="2024-05-01 10:00:00", dropoff="2024-05-01 10:10:00", **values):
    row = dict.fromkeys(TRIPS.fieldNames())
    row.update(tpep_pickup_datetime=ts(pickup), tpep_dropoff_datetime=ts(dropoff), passenger_count=1, payment_type=1,
               trip_distance=2.0, fare_amount=10.0, tip_amount=1.0, pulocationid=1, dolocationid=2)
    row.update(values)
    return tuple(row[name] for name in TRIPS.fieldNames())


@pytest.fixture
def trips(spark):
    return lambda *rows: spark.createDataFrame(list(rows), TRIPS)


@pytest.fixture
def zones(rows):
    return rows(
        "locationid long, borough string, zone string, service_zone string",
        (1, "Queens", "A", "Boro Zone"), (2, "Bronx", "B", "Boro Zone"), (None, "X", "Y", "Z"),
    )


@pytest.mark.parametrize(
    "start, end, boundaries, minutes",
    [
        ("2024-01-01 10:00:59", "2024-01-01 10:01:01", 1, 2 / 60),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:59", 0, 59 / 60),
        ("2024-01-01 10:05:00", "2024-01-01 10:00:30", -5, -4.5),
        ("2024-01-01 10:05:00", None, None, None),
    ],
)
def test_durations(rows, start, end, boundaries, minutes):
    df = rows("a timestamp_ntz, b timestamp_ntz", (ts(start), ts(end)))
    got = df.select(minute_boundaries(F.col("a"), F.col("b")), elapsed_minutes(F.col("a"), F.col("b"))).first()
    assert tuple(got) == (boundaries, minutes)


def test_times_ignore_the_session_zone(spark, rows):
    df = rows("a timestamp_ntz, b timestamp_ntz", (ts("2024-03-10 02:30:59"), ts("2024-03-10 03:31:01")))
    picked = df.select(
        hour_start(F.col("a")).alias("hour"), minute_boundaries(F.col("a"), F.col("b")).alias("minutes")
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert tuple(picked.first()) == (ts("2024-03-10 02:00:00"), 61)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unreadable_and_implausible_times(rows):
    df = rows("t string", ("corrupt",), ("2008-12-31 23:59:59",), ("2009-01-01 00:00:00",), ("2027-12-31 00:00:00",),
              ("2028-01-01 00:00:00",), (None,))
    masked = df.select(within_years(safe_timestamp(df, "t"), 2009, AS_OF))
    assert [row[0] for row in masked.collect()] == [
        None, None, ts("2009-01-01 00:00:00"), ts("2027-12-31 00:00:00"), None, None,
    ]


def test_warehouse_filters(trips):
    raw = trips(
        trip(fare_amount=0.5), trip(fare_amount=0.49), trip(trip_distance=0.0), trip(passenger_count=0),
        trip(passenger_count=10), trip(passenger_count=11), trip(passenger_count=None), trip(fare_amount=None),
        trip(pickup=None),
    )
    staged = stage_trips(raw, WAREHOUSE, AS_OF)
    assert staged.columns == list(WAREHOUSE.stage_columns)
    kept = staged.select("fare_amount", "passenger_count", "pickup_ts", "airport_fee", "congestion_surcharge").collect()
    assert [(r.fare_amount, r.passenger_count) for r in kept] == [(0.5, 1), (10.0, 10), (10.0, 1)]
    assert kept[2].pickup_ts is None and kept[0].airport_fee == 0.0 and kept[0].congestion_surcharge is None


def test_lakehouse_filters(trips, zones):
    raw = trips(
        trip(fare_amount=0.5), trip(fare_amount=0.51), trip(passenger_count=6), trip(passenger_count=7),
        trip(dropoff="2024-05-01 10:01:00"), trip(dropoff="2024-05-01 10:00:59"), trip(dropoff="2024-05-01 13:00:00"),
        trip(dropoff="2024-05-01 13:00:01"), trip(pickup=None), trip(pulocationid=99),
    )
    silver = silver_trips(raw, zones, AS_OF)
    durations = sorted(row[0] for row in silver.select("trip_duration_mins").collect())
    assert durations == [1.0, 10.0, 10.0, 10.0, 10.0, 180.0]
    assert {"PULocationID", "DOLocationID", "service_zone", "_loaded_at", "vendorid"} <= set(silver.columns)
    assert silver.filter("congestion_surcharge = 0").count() == 6
    staged = stage_trips(silver, LAKEHOUSE, AS_OF)
    assert staged.columns == list(LAKEHOUSE.stage_columns) and staged.count() == 5
    assert staged.filter("pickup_borough is null").count() == 1


def test_zones(zones):
    dim = dim_zones(stage_zones(zones))
    assert dim.columns == ["location_id", "borough", "zone", "service_zone"] and dim.count() == 2


def test_warehouse_fact(trips, zones):
    raw = trips(
        trip(pickup="2024-05-05 10:59:30", payment_type=5), trip(pulocationid=77, payment_type=None),
        trip(payment_type=7, tip_amount=1.005, fare_amount=100.0),
    )
    fact = fact_trips(stage_trips(raw, WAREHOUSE, AS_OF), dim_zones(stage_zones(zones)), WAREHOUSE)
    assert fact.columns == list(WAREHOUSE.fact_columns)
    sunday, lost, other = fact.collect()
    assert (sunday.pickup_dow, sunday.pickup_hour_of_day, sunday.payment_type_desc) == (0, 10, "Unknown")
    assert sunday.pickup_date == ts("2024-05-05 00:00:00") and sunday.pickup_hour == ts("2024-05-05 10:00:00")
    assert (sunday.pickup_borough, sunday.dropoff_zone) == ("Queens", "B")
    assert (lost.pickup_borough, lost.dropoff_borough, lost.payment_type_desc) == (None, "Bronx", "Other")
    assert other.payment_type_desc == "Other" and other.tip_pct == 1.01


def test_lakehouse_fact(trips, zones):
    raw = trips(trip(pickup="2024-05-05 10:00:00", dropoff="2024-05-05 10:30:00", payment_type=5))
    staged = stage_trips(silver_trips(raw, zones, AS_OF), LAKEHOUSE, AS_OF)
    fact = fact_trips(staged, None, LAKEHOUSE)
    assert fact.columns == list(LAKEHOUSE.fact_columns)
    row = fact.first()
    assert (row.pickup_dow, row.payment_type_desc, row.trip_duration_mins) == (1, "Other", 30.0)
