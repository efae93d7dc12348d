from tripmart.fixtures import AS_OF, raw_trips, raw_zones
from tripmart.plans.builds import build_lakehouse, build_warehouse, check_build
from tripmart.plans import queries
from tripmart.schemas import LAKEHOUSE, WAREHOUSE

SF_DIR = "/root/testdata/sf0.001"


def test_warehouse_build(spark, tmp_path):
    built = build_warehouse(spark, raw_trips(spark, SF_DIR), raw_zones(spark, SF_DIR), str(tmp_path), AS_OF)
    assert built["fct_trips"].columns == list(WAREHOUSE.fact_columns)
    assert built["fct_trips"].count() == built["anomaly_flags"].count() == built["stg_yellow_trips"].count()
    report = check_build(built, WAREHOUSE)
    assert report.count() == 12
    assert {r.check for r in report.filter("status = 'warn'").collect()} == {"accepted_range_trip_duration_mins"}


def test_lakehouse_build(spark, tmp_path):
    built = build_lakehouse(spark, raw_trips(spark, SF_DIR), raw_zones(spark, SF_DIR), str(tmp_path), AS_OF, "month")
    assert built["fct_trips"].columns == list(LAKEHOUSE.fact_columns)
    assert built["agg_hourly_demand"].count() > 0
    assert check_build(built, LAKEHOUSE).count() == 17


def test_day_partitions_hold_the_whole_fact(spark):
    fact = queries._fact(spark, SF_DIR, WAREHOUSE).selectExpr("cast(pickup_date as date) as day", "payment_type")
    rewritten = "day between '2022-01-10' and '2022-01-12'"
    kept = {r.day: r["count"] for r in fact.groupBy("day").count().collect()}
    kept |= {r.day: r["count"] for r in fact.filter(f"{rewritten} and payment_type = 1").groupBy("day").count().collect()}
    stored = {r.pickup_day: r.trips for r in queries.all_queries()["day_partitions"](spark, SF_DIR).collect()}
    assert stored == kept and None in stored
