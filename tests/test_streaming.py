import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart.operators.incremental import incremental_fact
from tripmart.operators.staging import dim_zones, silver_trips, stage_zones
from tripmart.schemas import LAKEHOUSE, TRIPS, WAREHOUSE
from tripmart.streaming import ingest

DAY = [dt.datetime(2024, 1, day, 8) for day in range(1, 6)]


def trip(pickup, fare=10.0):
    row = dict.fromkeys(TRIPS.fieldNames())
    row.update(tpep_pickup_datetime=pickup, tpep_dropoff_datetime=pickup and pickup + dt.timedelta(minutes=9),
               passenger_count=1, trip_distance=1.0, fare_amount=fare, pulocationid=1, dolocationid=1, payment_type=1)
    return tuple(row[name] for name in TRIPS.fieldNames())


@pytest.fixture
def zones(rows):
    return dim_zones(stage_zones(raw_zones(rows)))


def raw_zones(rows):
    return rows("locationid long, borough string, zone string, service_zone string", (1, "A", "z", "s"))


def deliver(spark, folder, name, *trips):
    spark.createDataFrame(list(trips), TRIPS).write.parquet(f"{folder}/{name}")


def test_each_file_is_ingested_once(spark, tmp_path):
    landing, raw, state = (str(tmp_path / part) for part in ("landing", "raw", "state"))

    def run():
        files = ingest.trip_files(spark, f"{landing}/*", max_files=1)
        ingest.ingest_stream(files, raw, state, "2024-02-01").awaitTermination()
        return spark.read.parquet(raw).count()

    deliver(spark, landing, "2024-01", trip(DAY[0]), trip(DAY[1]))
    assert run() == 2
    assert run() == 2
    deliver(spark, landing, "2024-02", trip(DAY[2]))
    assert run() == 3


@pytest.mark.parametrize("profile", [WAREHOUSE, LAKEHOUSE], ids=lambda p: p.name)
def test_later_batches_add_only_newer_trips(spark, rows, zones, tmp_path, profile):
    landing, target, state = (str(tmp_path / part) for part in ("landing", "fact", "state"))
    prepare = (lambda batch: silver_trips(batch, raw_zones(rows))) if profile is LAKEHOUSE else (lambda batch: batch)

    def run():
        files = ingest.trip_files(spark, f"{landing}/*")
        ingest.incremental_stream(
            files, zones, profile, target, state, "2024-02-01", prepare
        ).awaitTermination()
        return sorted(row.pickup_ts for row in ingest.read_stream_fact(spark, target).collect())

    deliver(spark, landing, "a", trip(DAY[1]), trip(DAY[2]))
    assert run() == [DAY[1], DAY[2]]
    deliver(spark, landing, "b", trip(DAY[0]), trip(DAY[2]), trip(DAY[3]), trip(DAY[3]))
    assert run() == [DAY[1], DAY[2], DAY[3], DAY[3]]
    deliver(spark, landing, "c", trip(DAY[0]))
    deliver(spark, landing, "d", trip(DAY[4]))
    assert run() == [DAY[1], DAY[2], DAY[3], DAY[3], DAY[4]]


def test_a_repeated_batch_replaces_itself(spark, rows, zones, tmp_path):
    from tripmart.operators.staging import stage_trips

    target = str(tmp_path / "fact")

    def make_fact(earlier, staged):
        return incremental_fact(earlier, staged, zones, WAREHOUSE, "2024-02-01")

    def batch(number, *trips):
        staged = stage_trips(spark.createDataFrame(list(trips), TRIPS), WAREHOUSE, "2024-02-01")
        ingest.load_batch(staged, number, target, "s", make_fact)

    batch(0, trip(DAY[0]))
    batch(1, trip(DAY[1]), trip(DAY[2]))
    batch(1, trip(DAY[1]), trip(DAY[2]))
    assert ingest.read_stream_fact(spark, target).count() == 3


def run_of(spark, zones, landing, target, state, **options):
    files = ingest.trip_files(spark, f"{landing}/*", **options)
    ingest.incremental_stream(files, zones, WAREHOUSE, target, state, "2024-02-01").awaitTermination()
    return sorted(row.pickup_ts for row in ingest.read_stream_fact(spark, target).collect())


def test_a_new_checkpoint_keeps_what_is_stored(spark, zones, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "fact")
    deliver(spark, landing, "a", trip(DAY[1]), trip(DAY[2]))
    assert run_of(spark, zones, landing, target, str(tmp_path / "one")) == [DAY[1], DAY[2]]
    deliver(spark, landing, "b", trip(DAY[0]), trip(DAY[3]))
    assert run_of(spark, zones, landing, target, str(tmp_path / "two")) == [DAY[1], DAY[2], DAY[3]]


def test_batches_do_not_change_the_result(spark, zones, tmp_path):
    landing = str(tmp_path / "landing")
    deliver(spark, landing, "a", trip(DAY[3]), trip(DAY[4]))
    deliver(spark, landing, "b", trip(DAY[0]), trip(DAY[1]))
    every = [DAY[0], DAY[1], DAY[3], DAY[4]]
    for name, options in (("whole", {}), ("cut", {"max_files": 1})):
        assert run_of(spark, zones, landing, str(tmp_path / name), str(tmp_path / f"{name}-state"), **options) == every


def test_a_broken_run_goes_on_with_its_mark(spark, zones, tmp_path):
    landing, target, state = (str(tmp_path / part) for part in ("landing", "fact", "state"))
    deliver(spark, landing, "a", trip(DAY[4]))
    deliver(spark, landing, "b", trip(DAY[0]))
    calls = []

    def failing(batch):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return batch

    files = ingest.trip_files(spark, f"{landing}/*", max_files=1)
    with pytest.raises(Exception, match="stopped"):
        ingest.incremental_stream(files, zones, WAREHOUSE, target, state, "2024-02-01", failing).awaitTermination()
    assert len(run_of(spark, zones, landing, target, state, max_files=1)) == 2


def test_a_batch_of_one_file_is_dealt_over_the_cores(spark, tmp_path):
    spark.range(1000).selectExpr("id as vendorid").coalesce(1).write.parquet(str(tmp_path / "in"))
    schema, spread = spark.read.parquet(str(tmp_path / "in")).schema, []

    def look(batch, _):
        spread.append(batch.groupBy(F.spark_partition_id()).count().collect())

    files = ingest.trip_files(spark, str(tmp_path / "in"), schema, max_files=1)
    files.writeStream.foreachBatch(look).trigger(availableNow=True).start().awaitTermination()
    (batch,) = spread
    assert len(batch) == spark.sparkContext.defaultParallelism and sum(row["count"] for row in batch) == 1000
