"""Versioned history of a dimension: one row per key and period of unchanged values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.timestamps import AsOf, clock
from tripmart.sources.tables import exists

# Key and compared columns of the zone history.
ZONE_KEY = "location_id"
ZONE_CHECKS = ("borough", "zone", "service_zone")

_HISTORY = ("valid_from", "valid_to", "row_hash")


def row_hash(columns: Sequence[str]) -> Column:
    """Digest of the values, each after its length, so that no two rows spell the same text; ``~`` stands for null."""
    texts = [F.col(name).cast("string") for name in columns]
    parts = [F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")) for text in texts]
    return F.md5(F.concat(*parts))


def snapshot(
    previous: DataFrame | None,
    current: DataFrame,
    key: str = ZONE_KEY,
    check_cols: Sequence[str] = ZONE_CHECKS,
    as_of: AsOf = None,
    close_missing: bool = False,
) -> DataFrame:
    """The history after one more look at the source.

    A changed row closes its open version and opens a new one; an unchanged row keeps its version; a row that left the
    source stays open unless ``close_missing``. One full outer join on the key; each joined pair yields one or two
    versions.
    """
    columns = [key, *check_cols]
    now = clock(as_of)
    fresh = current.select(
        *columns, now.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        row_hash(columns).alias("row_hash"),
    )
    if previous is None:
        return fresh
    names = [*columns, *_HISTORY]
    is_open = F.col("valid_to").isNull()
    was = previous.filter(is_open).select(F.col(key).alias("_was_key"), F.struct(*names).alias("_was"))
    now_rows = fresh.select(F.col(key).alias("_now_key"), F.struct(*names).alias("_now"))
    closed = F.col("_was").withField("valid_to", now)
    same = F.lit(True)
    for name in check_cols:
        same = same & F.col(f"_was.{name}").eqNullSafe(F.col(f"_now.{name}"))
    versions = (
        F.when(F.col("_was").isNull(), F.array("_now"))
        .when(F.col("_now").isNull(), F.array(closed if close_missing else F.col("_was")))
        .when(same, F.array("_was"))
        .otherwise(F.array(closed, F.col("_now")))
    )
    paired = was.join(now_rows, F.col("_was_key") == F.col("_now_key"), "full_outer")
    return paired.select(F.inline(versions)).select(*names).unionByName(previous.filter(~is_open).select(*names))


def _version(spark: SparkSession, path: str) -> int:
    """The number of the newest complete version of a stored history; 0 if there is none.

    Versions are numbered without gaps and are never changed, so doubling and halving finds the last one.
    """

    def complete(number: int) -> bool:
        return exists(spark, f"{path}/v{number}/_SUCCESS")

    if not complete(1):
        return 0
    low, high = 1, 2
    while complete(high):
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if complete(middle) else (low, middle)
    return low


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored history, or None before the first look."""
    number = _version(spark, path)
    return spark.read.parquet(f"{path}/v{number}") if number else None


def store_snapshot(path: str, current: DataFrame, as_of: AsOf = None, **options) -> DataFrame:
    """Takes one more look at the source into the stored history and returns it.

    The new history is written as a version of its own beside the one it is made from. It counts once it is complete:
    a run that breaks off leaves the old version in place, and is repeated as if it had never been.
    """
    spark = current.sparkSession
    number = _version(spark, path)
    previous = spark.read.parquet(f"{path}/v{number}") if number else None
    snapshot(previous, current, as_of=as_of, **options).write.mode("overwrite").parquet(f"{path}/v{number + 1}")
    return spark.read.parquet(f"{path}/v{number + 1}")
