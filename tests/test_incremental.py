import datetime as dt

import pytest

from tripmart.operators import incremental as inc
from tripmart.sources.tables import LAYOUT_COLUMNS, append_rows, read_fact, write_fact_partitioned, write_table

T0, T1, T2 = (dt.datetime(2024, 1, day, 8) for day in (1, 2, 3))
SCHEMA = "pickup_ts timestamp_ntz, pulocationid long, dolocationid long, fare_amount double, tip double"


def key(ts, fare=1.0, tip=0.0, pu=1):
    return (ts, pu, 2, fare, tip)


def test_first_run_takes_everything(rows):
    staged = rows(SCHEMA, key(T0), key(None))
    assert inc.select_new(None, staged).count() == 2
    assert tuple(inc.load_counts(None, staged).first()) == (2, 0, 0)


def test_mark_splits_new_late_and_null(rows):
    target, staged = rows(SCHEMA, key(T0), key(T1), key(None)), rows(SCHEMA, key(T0), key(T1), key(T2), key(T2), key(None))
    assert [row.pickup_ts for row in inc.select_new(target, staged).collect()] == [T2, T2]
    assert tuple(inc.load_counts(target, staged).first()) == (2, 2, 1)


def test_empty_target_admits_nothing(rows):
    target, staged = rows(SCHEMA, key(T0)).limit(0), rows(SCHEMA, key(T0), key(None))
    assert inc.select_new(target, staged).count() == 0
    counts = inc.load_counts(target, staged).first()
    assert (counts.new, counts.null_ts) == (0, 1)


def test_upsert_overlap_nulls_and_duplicates(rows):
    target = rows(SCHEMA, key(T0, tip=1.0), key(T1, tip=2.0), key(None, tip=3.0), key(T2, pu=None, tip=4.0))
    batch = rows(SCHEMA, key(T0, tip=9.0), key(None, tip=8.0), key(T2, pu=None, tip=7.0), key(T2, tip=6.0),
                 key(T2, tip=5.0))
    tips = sorted(row.tip for row in inc.upsert(target, batch).collect())
    assert tips == [2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]


def test_upsert_into_empty_target(rows):
    batch = rows(SCHEMA, key(T0), key(T0))
    assert inc.upsert(batch.limit(0), batch).count() == 2


def test_two_batch_rows_for_one_target_row_raise(rows):
    target, batch = rows(SCHEMA, key(T0)), rows(SCHEMA, key(T0, tip=1.0), key(T0, tip=2.0))
    with pytest.raises(Exception, match="several batch rows match one target row"):
        inc.upsert(target, batch).collect()


def test_schema_sync(rows):
    old = rows("a long, gone string", (1, "x"))
    like = rows("b double, a long", (1.0, 2))
    synced = inc.sync_schema(old, like)
    assert synced.columns == ["b", "a"] and [tuple(r) for r in synced.collect()] == [(None, 1)]


FACT = SCHEMA + ", pickup_date timestamp_ntz, pickup_borough string, payment_type long"


def fact(ts, **values):
    return (*key(ts, **values), ts and ts.replace(hour=0), "A", 1)


def test_days_are_folders_and_null_days_are_kept(rows, spark, tmp_path):
    path = str(tmp_path / "fact")
    assert write_fact_partitioned(rows(FACT, fact(T0), fact(T1), fact(T1), fact(None)), path) == 4
    days = {p.name for p in (tmp_path / "fact").glob("pickup_day=*")}
    assert days == {"pickup_day=2024-01-01", "pickup_day=2024-01-02", "pickup_day=__HIVE_DEFAULT_PARTITION__"}
    stored = read_fact(spark, path)
    assert stored.count() == 4 and not set(LAYOUT_COLUMNS) & set(stored.columns)
    pruned = read_fact(spark, path, layout=True).filter("pickup_day = date'2024-01-02'")
    assert "PartitionFilters: [isnotnull(pickup_day" in pruned._jdf.queryExecution().executedPlan().toString()


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        many = spark.range(60000).selectExpr(
            "cast(null as timestamp_ntz) pickup_date", "uuid() pickup_borough", "id payment_type"
        )
        assert write_fact_partitioned(many.repartition(6), str(tmp_path / "hot")) == 60000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot").glob("pickup_day=*/*.parquet"))) > 1


def test_merge_rewrites_only_touched_days(rows, spark, tmp_path):
    path = str(tmp_path / "fact")
    write_fact_partitioned(rows(FACT, fact(T0, tip=1.0), fact(T1, tip=2.0), fact(None, tip=3.0)), path)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "fact").glob("pickup_day=2024-01-02/*.parquet")}
    inc.merge_periods(path, rows(FACT, fact(T0, tip=9.0), fact(T2, tip=8.0), fact(None, tip=7.0)))
    assert sorted(row.tip for row in read_fact(spark, path).collect()) == [2.0, 3.0, 7.0, 8.0, 9.0]
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "fact").glob("pickup_day=2024-01-02/*.parquet")}


def test_keys_must_fix_the_period(rows, tmp_path):
    with pytest.raises(ValueError, match="pickup_ts"):
        inc.merge_periods(str(tmp_path / "fact"), rows(FACT, fact(T0)), keys=("pulocationid",))


def test_a_first_run_never_appends_to_a_table(rows, spark, tmp_path):
    path = str(tmp_path / "fact")
    rows(FACT, fact(T0)).write.parquet(path)
    with pytest.raises(ValueError, match="there already"):
        inc.append_new(path, None, rows(FACT, fact(T0)), None, None)


def test_the_mark_reaches_the_raw_scan(rows, spark, tmp_path):
    path, raw = str(tmp_path / "fact"), str(tmp_path / "raw")
    write_fact_partitioned(rows(FACT, fact(T0), fact(T1), fact(None)), path)
    assert inc.stored_mark(spark, path, "day") == T1 and inc.stored_mark(spark, str(tmp_path / "none")) is None
    rows("tpep_pickup_datetime timestamp_ntz, fare double", (T0, 1.0), (T1, 2.0), (T2, 3.0), (None, 4.0)).write.parquet(raw)
    newer = inc.raw_after(spark.read.parquet(raw), inc.stored_mark(spark, path, "day"))
    assert [r.fare for r in newer.collect()] == [3.0]
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(tpep_pickup_datetime" in plan.split("PushedFilters")[1].split("ReadSchema")[0]
    text = rows("tpep_pickup_datetime string", ("2024-01-01",))
    assert inc.raw_after(text, T1) is text


@pytest.mark.parametrize("grain", [None, "day"])
def test_columns_follow_the_last_append(rows, spark, tmp_path, grain):
    path = str(tmp_path / "fact")
    base = "pickup_ts timestamp_ntz, pickup_date timestamp_ntz, pickup_borough string, payment_type long"
    first, second = (T0, T0.replace(hour=0), "A", 1), (T1, T1.replace(hour=0), "A", 1)
    assert append_rows(rows(f"{base}, gone string", (*first, "old")), path, grain) == 1
    assert append_rows(rows(f"fresh double, {base}", (5.0, *second)), path, grain) == 1
    found = read_fact(spark, path)
    assert found.columns[0] == "fresh" and "gone" not in found.columns
    assert {(r.pickup_ts, r.fresh) for r in found.collect()} == {(T0, None), (T1, 5.0)}
    # A column that comes back does not bring back what it held before it left.
    append_rows(rows(f"{base}, gone string, fresh double", (T2, T2.replace(hour=0), "A", 1, "new", 6.0)), path, grain)
    assert {(r.pickup_ts, r.gone) for r in read_fact(spark, path).collect()} == {(T0, None), (T1, None), (T2, "new")}
    with pytest.raises(ValueError, match="fresh was double"):
        append_rows(rows(f"{base}, fresh string", (*second, "x")), path, grain)
    if grain:
        inc.merge_periods(path, rows(f"{base}, gone string, fresh double", (*second, "merged", 7.0)), ("pickup_ts",))
        assert {(r.pickup_ts, r.gone, r.fresh) for r in read_fact(spark, path).collect()} == {
            (T0, None, None), (T1, "merged", 7.0), (T2, "new", 6.0),
        }
        pruned = read_fact(spark, path, layout=True).filter("pickup_day = date'2024-01-02'")
        assert "PartitionFilters: [isnotnull(pickup_day" in pruned._jdf.queryExecution().executedPlan().toString()
        write_fact_partitioned(rows(f"{base}, other long", (*first, 3)), path)
    else:
        write_table(rows(f"{base}, other long", (*first, 3)), path)
    assert read_fact(spark, path).columns[-1] == "other"


def test_a_table_without_contract_gets_one(rows, spark, tmp_path):
    path = str(tmp_path / "fact")
    rows("pickup_ts timestamp_ntz, a long", (T0, 1)).write.parquet(path)
    append_rows(rows("pickup_ts timestamp_ntz, b long", (T1, 2)), path)
    assert {tuple(r) for r in read_fact(spark, path).collect()} == {(T0, None), (T1, 2)}
