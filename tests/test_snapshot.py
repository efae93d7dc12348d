from tripmart.operators.snapshot import read_history, row_hash, snapshot, store_snapshot

ZONE = "location_id long, borough string, zone string, service_zone string"
DAY1, DAY2, DAY3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def versions(df):
    return sorted(
        (row.location_id, row.borough, row.service_zone or "", str(row.valid_from)[:10], str(row.valid_to)[:10])
        for row in df.collect()
    )


def test_history_of_changes(rows):
    first = snapshot(None, rows(ZONE, (1, "A", "z", "s"), (2, "A", "z", None), (3, "A", "z", "s"), (4, "A", "z", "s")),
                     as_of=DAY1)
    later = rows(ZONE, (1, "B", "z", "s"), (2, "A", "z", "s"), (3, "A", "z", "s"), (5, "E", "z", "s"))
    second = snapshot(first, later, as_of=DAY2)
    assert versions(second) == [
        (1, "A", "s", "2024-01-01", "2024-01-02"),
        (1, "B", "s", "2024-01-02", "None"),
        (2, "A", "", "2024-01-01", "2024-01-02"),
        (2, "A", "s", "2024-01-02", "None"),
        (3, "A", "s", "2024-01-01", "None"),
        (4, "A", "s", "2024-01-01", "None"),
        (5, "E", "s", "2024-01-02", "None"),
    ]
    third = snapshot(second, later, as_of=DAY3)
    assert versions(third) == versions(second)
    closed = snapshot(second, later, as_of=DAY3, close_missing=True)
    assert (4, "A", "s", "2024-01-01", "2024-01-03") in versions(closed)
    assert len({row.row_hash for row in second.collect()}) == 7


def test_hashes_of_rows_that_read_alike_differ(rows):
    df = rows("a string, b string", ("x|=y", "z"), ("x", "y|=z"), (None, "~"), ("~", None), ("", None), (None, ""))
    assert len({r[0] for r in df.select(row_hash(["a", "b"])).collect()}) == 6


def test_a_history_grows_version_by_version(rows, spark, tmp_path):
    path = str(tmp_path / "history")
    assert read_history(spark, path) is None
    for day, borough in ((DAY1, "A"), (DAY2, "B"), (DAY3, "B")):
        store_snapshot(path, rows(ZONE, (1, borough, "z", "s")), day)
    # A version that was never completed does not count.
    rows(ZONE, (1, "C", "z", "s")).write.parquet(f"{path}/v4")
    (tmp_path / "history" / "v4" / "_SUCCESS").unlink()
    assert versions(read_history(spark, path)) == [(1, "A", "s", "2024-01-01", "2024-01-02"), (1, "B", "s", "2024-01-02", "None")]
    assert len(versions(store_snapshot(path, rows(ZONE, (1, "D", "z", "s")), "2024-01-04 00:00:00"))) == 3
