import math

import pytest
from pyspark.sql import functions as F

from tripmart.functions.numeric import exact_avg, exact_sum, round_half_up, safe_ratio
from tripmart.operators.anomaly import anomaly_flags, borough_stats
from tripmart.operators.marts import daily_revenue
from tripmart.schemas import WAREHOUSE


@pytest.mark.parametrize(
    "values, total",
    [
        ([0.1] * 10, 1.0),
        ([1e16, 1.0, -1e16, 1.0], None),
        ([None, 2.5], 2.5),
        ([None], None),
        ([-1.005, 1.005], 0.0),
    ],
)
def test_exact_sum(rows, values, total):
    got = rows("x double", *[(v,) for v in values]).agg(exact_sum("x")).first()[0]
    if total is not None or values == [None]:
        assert got == total
    else:
        assert got == pytest.approx(2.0, abs=4)


def test_exact_sum_survives_odd_values(rows):
    assert math.isnan(rows("x double", (float("nan"),), (1.0,)).agg(exact_sum("x")).first()[0])
    assert rows("x double", (float("inf"),), (1.0,)).agg(exact_sum("x")).first()[0] == float("inf")
    assert rows("x double", (3e300,), (1.0,)).agg(exact_sum("x")).first()[0] == 3e300


def test_exact_sum_does_not_depend_on_partitions(spark):
    df = spark.range(20000).select((F.sin("id") * 1000).alias("x"), "id")
    sums = {df.repartition(n, "id").agg(exact_sum("x")).first()[0] for n in (1, 3, 8)}
    assert len(sums) == 1


def test_rounding(rows):
    df = rows("x double", (1.005,), (-1.005,), (2.675,), (None,), (1e20,))
    assert [r[0] for r in df.select(round_half_up(F.col("x"))).collect()] == [1.01, -1.01, 2.68, None, 1e20]


@pytest.mark.parametrize("places", [0, 2, 6])
def test_rounding_is_that_of_decimals_and_mostly_without_them(spark, places):
    some = spark.range(200_000).selectExpr("(rand(7) - 0.5) * pow(10, id % 13) as x")
    ties = spark.range(-20_000, 20_000).selectExpr(f"(id + 0.5) / {10**places}.0 as x")
    close = ties.selectExpr("x + x * 1e-15 as x").union(ties.selectExpr("x - x * 1e-12 as x"))
    odd = spark.sql("select explode(array(double('nan'), double('inf'), -0.0D, -1e-9D, 1e300D, null)) as x")
    df = some.union(ties).union(close).union(odd)
    fixed = F.coalesce(F.round(F.col("x").try_cast("decimal(28,10)"), places).cast("double"), F.col("x"))
    shown = df.select(round_half_up(F.col("x"), places).alias("a"), fixed.alias("b"))
    assert shown.filter(~F.col("a").cast("string").eqNullSafe(F.col("b").cast("string"))).collect() == []


def test_division_by_zero(rows):
    row = rows("a double, b double", (1.0, 0.0)).select(safe_ratio(F.col("a"), F.col("b"))).first()
    assert row[0] is None
    assert rows("a double", (None,)).agg(exact_avg("a")).first()[0] is None


FACT = (
    "pickup_ts timestamp_ntz, pickup_date timestamp_ntz, pickup_borough string, total_amount double,"
    "fare_amount double, tip_amount double, trip_distance double, trip_duration_mins long, payment_type long,"
    "passenger_count long, payment_type_desc string"
)


def fact_row(borough, fare=1.0, distance=1.0, minutes=1, payment=1):
    return (None, None, borough, fare, fare, 0.0, distance, minutes, payment, 1, "Cash")


def test_null_groups_are_groups(rows):
    fact = rows(FACT, fact_row("A"), fact_row(None, payment=2), fact_row(None, payment=None))
    daily = {row.pickup_borough: row for row in daily_revenue(fact, WAREHOUSE).collect()}
    assert daily["A"].total_trips == 1 and daily["A"].card_trips == 1
    assert daily[None].total_trips == 2 and (daily[None].card_trips, daily[None].cash_trips) == (0, 1)


def test_anomaly_corner_cases(rows):
    usual = [fact_row("A", 10.0 + i % 2, 2.0 + i % 2, 5 + i % 2) for i in range(60)]
    far_and_long = fact_row("A", 10.0, 500.0, 900)
    everything = fact_row("A", 5000.0, 500.0, 900)
    fact = rows(
        FACT, *usual, far_and_long, everything, fact_row("one", 9.0), fact_row("flat"), fact_row("flat"),
        *[fact_row(None, 1.0 * i) for i in range(3)],
    )
    flags = anomaly_flags(fact)
    assert flags.count() == fact.count()
    odd = {row.fare_amount: row.anomaly_reason for row in flags.filter("is_anomaly").collect()}
    assert odd == {10.0: "long distance", 5000.0: "high fare + long distance"}
    quiet = flags.filter("pickup_borough is null or pickup_borough in ('one', 'flat')").collect()
    assert len(quiet) == 6
    for row in quiet:
        assert (row.fare_zscore, row.anomaly_score, row.is_anomaly, row.anomaly_reason) == (None, 0.0, False, None)
    stats = {row.pickup_borough: row for row in borough_stats(fact).collect()}
    assert stats["one"].std_fare is None and stats["flat"].std_fare == 0.0 and stats[None].mean_fare == 1.0


def test_flags_join_without_shuffling_the_fact(rows):
    plan = anomaly_flags(rows(FACT, fact_row("A"), fact_row("B")))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
