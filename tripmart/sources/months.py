"""Choosing the month to load and checking which months have been delivered."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The month taken when none is given, and the delivery file name.
DEFAULT_MONTH = "2025-03"
FILE_NAME = "yellow_tripdata_{month}.parquet"


def target_month(run_date: Column) -> Column:
    """The month a run on this date loads, as ``yyyy-MM``: two months before the run's own month."""
    return F.date_format(F.add_months(F.trunc(run_date, "MM"), -2), "yyyy-MM")


def chosen_month(month: str | None = None) -> str:
    """An explicit month wins; otherwise the default."""
    if month is None:
        return DEFAULT_MONTH
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", month):
        raise ValueError(f"month must look like yyyy-MM, got {month!r}")
    return month


def month_glob(folder: str, month: str) -> str:
    return f"{folder.rstrip('/')}/{FILE_NAME.format(month=month)}"


def month_presence(spark: SparkSession, folder: str, months: DataFrame) -> DataFrame:
    """``months`` (one text column ``month``) with ``files`` found for each and ``present``.

    Only the wanted months are asked for, by name, whatever else the lake holds: one file per month, or a folder
    ``month=yyyy-MM``. The months of a question are few and known to the driver.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())

    def files(month: str) -> int:
        names = f"{{{FILE_NAME.format(month=month)},month={month}/*.parquet}}"
        return len(system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(where, names)) or ())

    wanted = sorted({row["month"] for row in months.select("month").collect() if row["month"] is not None})
    found = spark.createDataFrame([(month, files(month)) for month in wanted], "month string, files bigint")
    return months.join(found, "month", "left").select(
        "month", F.coalesce("files", F.lit(0)).alias("files"), (F.coalesce("files", F.lit(0)) > 0).alias("present")
    )
