import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tripmart.fixtures import damaged_copy
from tripmart.schemas import TRIPS, ZONES
from tripmart.session import shared_dir
from tripmart.sources import footers, months, readers, tables


@pytest.fixture
def zone_file(tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark, Airport","EWR"\n'
        'bad,"Queens","Z","Boro"\n3,"short"\n4,Bronx,"A ""quoted"" B",Boro\n5,a,b,c,long\n,"no id","x","y"\n'
    )
    return str(path)


def test_tolerant_zones_and_their_rejects(spark, zone_file):
    zones = readers.read_zones(spark, zone_file, tolerant=True)
    assert zones.columns == ZONES.fieldNames()
    assert sorted((row.locationid or 0, row.zone) for row in zones.collect()) == [
        (0, "x"), (1, "Newark, Airport"), (4, 'A "quoted" B'),
    ]
    # The same rows are skipped whatever a query selects.
    assert zones.count() == zones.select("zone").count() == 3
    rejected = readers.rejected_rows(spark, zone_file, ZONES)
    assert rejected.count() == 3
    assert {row[readers.REJECTED].split(",")[0] for row in rejected.collect()} == {"bad", "3", "5"}


def test_strict_zones_raise(spark, zone_file):
    with pytest.raises(Exception):
        readers.read_zones(spark, zone_file).collect()


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "trips.csv").write_text("FARE_AMOUNT,VendorID,Passenger_Count,other\n5.5,2,1.0,x\n7,,,y\n")
    trips = readers.read_trips(spark, str(tmp_path / "trips.csv"))
    assert trips.schema == TRIPS
    assert [(r.fare_amount, r.vendorid, r.passenger_count, r.airport_fee) for r in trips.collect()] == [
        (5.5, 2, 1, None), (7.0, None, None, None),
    ]


def test_gzipped_csv_is_csv(spark, tmp_path):
    spark.createDataFrame([(1, 2.5)], "VendorID long, fare_amount double").write.option("header", True).option(
        "compression", "gzip"
    ).csv(str(tmp_path / "trips"))
    assert readers.read_trips(spark, str(tmp_path / "trips" / "*.csv.gz")).first().fare_amount == 2.5


def test_parquet_case_missing_and_narrow_columns(spark, tmp_path):
    path = str(tmp_path / "a.parquet")
    spark.createDataFrame([(1, 2, 3.5)], "VendorID int, PULocationID long, Airport_fee double").write.parquet(path)
    trips = readers.read_trips(spark, path)
    assert trips.columns == TRIPS.fieldNames()
    row = trips.first()
    assert (row.vendorid, row.pulocationid, row.airport_fee, row.cbd_congestion_fee) == (1, 2, 3.5, None)


def test_evolving_parquet_keeps_new_columns_and_casts_drift(spark, tmp_path):
    spark.createDataFrame([(1.0, 2)], "passenger_count double, vendorid long").write.parquet(str(tmp_path / "m1.parquet"))
    spark.createDataFrame([(4.0, "x")], "passenger_count double, extra_text string").write.parquet(
        str(tmp_path / "m2.parquet")
    )
    trips = readers.read_trips(spark, [str(tmp_path / "m1.parquet"), str(tmp_path / "m2.parquet")], evolve=True)
    assert trips.columns == [*TRIPS.fieldNames(), "extra_text"]
    assert sorted((r.passenger_count, r.vendorid, r.extra_text) for r in trips.collect()) == [
        (1, 2, None), (4, None, "x"),
    ]


def test_tolerant_parquet_skips_a_corrupt_file(spark, tmp_path):
    spark.createDataFrame([(1,)], "vendorid long").write.parquet(str(tmp_path / "in"))
    (tmp_path / "in" / "broken.parquet").write_bytes(b"not parquet at all")
    assert readers.read_trips(spark, str(tmp_path / "in"), fmt="parquet", tolerant=True).count() == 1
    with pytest.raises(Exception):
        readers.read_trips(spark, str(tmp_path / "in"), fmt="parquet").count()


def test_damaged_files_keep_their_sound_row_groups(spark, tmp_path):
    rows = spark.range(300).selectExpr("id as vendorid", "cast(id as double) as fare_amount").coalesce(1)
    for name in ("a", "b", "c"):
        rows.write.option("parquet.block.row.count.limit", 100).parquet(str(tmp_path / f"whole-{name}"))
    folder = str(tmp_path / "in")
    damaged_copy(spark, str(tmp_path / "whole-a"), f"{folder}/a", wrong=(60, 160))
    damaged_copy(spark, str(tmp_path / "whole-b"), f"{folder}/b", keep=500)
    damaged_copy(spark, str(tmp_path / "whole-c"), f"{folder}/c")
    spark.createDataFrame([("7", 1.0)], "vendorid string, fare_amount double").write.parquet(f"{folder}/d")
    loaded = readers.read_trips(spark, folder, tolerant=True)
    assert sorted(r.vendorid for r in loaded.collect()) == sorted([*range(300), *range(100, 300), 7])
    # The rows do not depend on the columns that a query takes.
    assert loaded.count() == loaded.select("fare_amount").count() == 501
    found = readers.unreadable_files(spark, folder).collect()
    assert {(r.file.split("/")[-2], r.reason, r.rows_lost) for r in found} == {
        ("a", footers.BAD_GROUPS, 100), ("b", footers.NO_FOOTER, None),
    }
    with pytest.raises(ValueError, match="readable footer"):
        readers.read_trips(spark, folder)


def test_a_footer_is_read_once_however_many_row_groups(spark, tmp_path, monkeypatch):
    rows = spark.range(300).selectExpr("id as vendorid").coalesce(1)
    rows.write.option("parquet.block.row.count.limit", 10).parquet(str(tmp_path / "whole"))
    damaged_copy(spark, str(tmp_path / "whole"), str(tmp_path / "in"), wrong=(30, 40))
    opened = []

    class Counted(footers.pq.ParquetFile):
        def __init__(self, *args, **kwargs):
            opened.append(kwargs.get("metadata") is not None)
            super().__init__(*args, **kwargs)

    monkeypatch.setattr(footers.pq, "ParquetFile", Counted)
    file = f"file:{tmp_path}/in/part.parquet"
    row = footers._row(file, 0, None, True)
    assert row[3:] == (300, [0], footers.BAD_GROUPS, 10)
    assert opened == [True]


def test_a_damaged_copy_keeps_the_other_files(spark, tmp_path):
    spark.range(40).repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "whole"))
    damaged_copy(spark, str(tmp_path / "whole"), str(tmp_path / "in"), keep=20)
    found = footers.catalogue(footers.listed(spark, str(tmp_path / "in")), pages=True).collect()
    assert sorted((r.rows or 0) > 0 for r in found) == [False, True, True, True]


def test_files_of_stores_that_only_spark_reads(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    files = footers.listed(spark, str(tmp_path / "in")).drop("content")
    content = spark.read.format("binaryFile").load(str(tmp_path / "in")).select(F.col("path").alias("file"), "content")
    found = footers.catalogue(files.join(content, "file"), pages=True).collect()
    assert sum(r.rows for r in found) == 10 and all(r.reason is None for r in found)


def test_months():
    assert months.chosen_month("2024-01") == "2024-01"
    assert months.chosen_month() == months.DEFAULT_MONTH == "2025-03"
    assert months.month_glob("/raw/", "2024-06") == "/raw/yellow_tripdata_2024-06.parquet"
    for wrong in ("2024-13", "2024-1", "202401"):
        with pytest.raises(ValueError):
            months.chosen_month(wrong)


def test_target_month(rows):
    days = [dt.date(2024, 3, 31), dt.date(2024, 1, 1), dt.date(2024, 2, 29)]
    df = rows("d date", *[(day,) for day in days])
    assert [r[0] for r in df.select(months.target_month(F.col("d"))).collect()] == ["2024-01", "2023-11", "2023-12"]


def test_month_presence(spark, rows, tmp_path):
    one = spark.createDataFrame([(1,)], "vendorid long")
    one.write.parquet(str(tmp_path / "yellow_tripdata_2024-01.parquet"))
    one.coalesce(1).write.parquet(str(tmp_path / "month=2024-03"))
    wanted = rows("month string", ("2024-01",), ("2024-02",), ("2024-03",))
    found = months.month_presence(spark, str(tmp_path), wanted)
    assert {r.month: (r.files > 0, r.present) for r in found.collect()} == {
        "2024-01": (True, True), "2024-02": (False, False), "2024-03": (True, True),
    }


def test_append_merges_schemas_and_counts(spark, rows, tmp_path):
    path = str(tmp_path / "raw")
    assert tables.append_raw(rows("a long", (1,), (2,)), path, "2024-01-01") == 2
    assert tables.append_raw(rows("a long, b string", (3, "x")), path, "2024-01-02") == 1
    raw = tables.read_raw(spark, path)
    assert set(raw.columns) == {"a", "b", "_loaded_at"} and raw.count() == 3


def test_rebuild_takes_the_new_schema(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_table(rows("a long", (1,)), path)
    assert tables.write_table(rows("b string", ("x",), ("y",)), path) == 2
    assert readers.read_table(spark, path).columns == ["b"]


def test_catalog_tables_and_views(spark, rows, tmp_path):
    tables.register_views({"stg_zones_view": rows("a long", (1,), (2,))})
    assert readers.read_table(spark, "stg_zones_view").filter("a > 1").count() == 1
    for number in (1, 2):
        name = tables.save_as_table(rows("a long", (number,)), "marts", "dim_test")
        assert name == "MARTS.dim_test" and readers.read_table(spark, name).first().a == number


def test_export_and_ai_log(spark, rows, tmp_path):
    path = tables.export_parquet(rows("a long", (1,)), str(tmp_path), "fct_trips", dt.date(2026, 2, 3))
    assert path.endswith("/fct_trips_20260203") and spark.read.parquet(path).count() == 1
    flags = rows("__ai_row_id int, pickup_ts timestamp_ntz, pickup_borough string, anomaly_score double,"
                 "is_anomaly boolean, ai_explanation string, _dbt_loaded_at timestamp_ntz",
                 (1, None, "A", 0.5, True, "x", None))
    for _ in range(2):
        tables.append_ai_flags(flags, str(tmp_path / "ai"))
    log = spark.read.parquet(str(tmp_path / "ai"))
    assert log.count() == 2 and dict(log.dtypes)["__ai_row_id"] == "bigint"


def session_with(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark, "x").startswith(f"{spark.conf.get('spark.checkpoint.dir')}/tripmart/")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    unset = session_with(**{"spark.sql.warehouse.dir": "/shared/warehouse/"})
    unset.sparkContext = SimpleNamespace(applicationId="app-1")
    assert shared_dir(unset, "x").startswith("/shared/warehouse/tripmart/app-1/x-")
