import datetime as dt

import pytest

from tripmart.operators import quality as q


def test_checks_share_one_report(rows):
    df = rows("id long, v long, r double", (1, 1, 0.5), (1, 2, 200.0), (2, 9, None), (None, None, 1.0), (None, 1, 180.0))
    checks = [
        q.not_null("id"), q.unique("id"), q.accepted_values("v", (1, 2)), q.accepted_range("r", 1, 180, "warn"),
        q.accepted_range("r", 0, None), q.not_null("r"),
    ]
    report = {(row.check): (row.failures, row.severity, row.status) for row in q.run_checks(df, checks[:4]).collect()}
    assert report == {
        "not_null_id": (2, "error", "error"),
        "unique_id": (1, "error", "error"),
        "accepted_values_v": (1, "error", "error"),
        "accepted_range_r": (2, "warn", "warn"),
    }
    assert [(r.failures, r.status) for r in q.run_checks(df, checks[4:]).collect()] == [(0, "pass"), (1, "error")]


def test_row_checks_scan_once(rows, spark, tmp_path):
    rows("a long, b long", (1, 2)).write.parquet(str(tmp_path / "t"))
    report = q.run_checks(spark.read.parquet(str(tmp_path / "t")), [q.not_null("a"), q.not_null("b")])
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_suites_have_the_declared_number_of_checks():
    assert sum(map(len, q.WAREHOUSE_CHECKS.values())) == 12
    assert sum(map(len, q.LAKEHOUSE_CHECKS.values())) == 17


def test_future_trips(rows):
    fact = rows("pickup_ts timestamp_ntz, fare_amount double, pulocationid long",
                (dt.datetime(2024, 1, 1), 1.0, 1), (dt.datetime(2024, 1, 1, 0, 0, 1), 2.0, 2), (None, 3.0, 3))
    offenders = q.future_trips(fact, "2024-01-01 00:00:00")
    assert [row.pulocationid for row in offenders.collect()] == [2]
    assert q.assertion_report(offenders, "future").first().status == "error"
    assert q.assertion_report(offenders.limit(0), "future").first().status == "pass"


@pytest.mark.parametrize("hours, status", [(48, "pass"), (49, "pass"), (50, "warn"), (73, "warn"), (74, "error")])
def test_freshness(rows, hours, status):
    now = dt.datetime(2024, 1, 10)
    df = rows("_loaded_at timestamp_ntz", (now - dt.timedelta(hours=hours),), (now - dt.timedelta(hours=500),))
    row = q.freshness(df, "_loaded_at", str(now)).first()
    assert (row.age_hours, row.status) == (hours, status)


def test_never_loaded_is_an_error(rows):
    row = q.freshness(rows("_loaded_at timestamp_ntz", (None,)).limit(0), "_loaded_at").first()
    assert (row.age_hours, row.status) == (None, "error")
