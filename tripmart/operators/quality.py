"""Data checks: declared column rules, a future-trip assertion and source freshness."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.timestamps import AsOf, clock


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    severity: str = "error"
    values: tuple = ()
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"

    def failing(self) -> Column:
        """Condition under which a row breaks the rule. Only ``not_null`` minds a null."""
        column = F.col(self.column)
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return ~column.isin(*self.values)
        if self.kind == "accepted_range":
            within = F.lit(True)
            if self.low is not None:
                within = within & (column >= self.low)
            if self.high is not None:
                within = within & (column <= self.high)
            return ~within
        raise ValueError(f"unknown check {self.kind!r}")


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    return Check("unique", column)


def accepted_values(column: str, values: Iterable) -> Check:
    return Check("accepted_values", column, values=tuple(values))


def accepted_range(column: str, low: float | None, high: float | None, severity: str = "error") -> Check:
    return Check("accepted_range", column, severity, low=low, high=high)


_DURATION = accepted_range("trip_duration_mins", 1, 180, "warn")
_PAYMENT = accepted_values("payment_type", (1, 2, 3, 4, 5, 6))
_FLAG = accepted_values("is_anomaly", (True, False))

# The declared checks of each rule set, by table.
WAREHOUSE_CHECKS = {
    "taxi_zone_lookup": (unique("locationid"), not_null("locationid")),
    "stg_yellow_trips": (_DURATION, not_null("fare_amount"), not_null("trip_distance"), _PAYMENT),
    "dim_zones": (unique("location_id"), not_null("location_id")),
    "fct_trips": (not_null("fare_amount"), not_null("pickup_borough")),
    "agg_daily_revenue": (not_null("total_revenue"),),
    "anomaly_flags": (_FLAG,),
}
LAKEHOUSE_CHECKS = {
    "stg_yellow_trips": (
        not_null("pickup_ts"), not_null("dropoff_ts"), not_null("trip_duration_mins"), _DURATION,
        not_null("fare_amount"), accepted_range("fare_amount", 0.5, 500),
        not_null("trip_distance"), accepted_range("trip_distance", 0, 100), _PAYMENT,
    ),
    "fct_trips": (not_null("pickup_ts"), not_null("fare_amount"), not_null("pickup_borough")),
    "fct_trips_incremental": (not_null("pickup_ts"),),
    "agg_daily_revenue": (not_null("trip_date"), not_null("total_revenue")),
    "anomaly_flags": (not_null("pickup_ts"), _FLAG),
}


def _row(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.column).alias("column"),
        failures.cast("bigint").alias("failures"),
        F.lit(check.severity).alias("severity"),
    )


def _repeated_values(df: DataFrame, column: str) -> DataFrame:
    """How many values occur more than once. Counts are combined before the shuffle, so a hot value is one row."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.count_if(F.col("_n") > 1).alias("_failures"))


def run_checks(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """One row per check with failures and status. All row-level checks share a single pass over the table."""
    checks = list(checks)
    row_level = [check for check in checks if check.kind != "unique"]
    parts = []
    if row_level:
        counted = df.agg(*[F.count_if(check.failing()).alias(f"_c{i}") for i, check in enumerate(row_level)])
        rows = F.array(*[_row(check, F.col(f"_c{i}")) for i, check in enumerate(row_level)])
        parts.append(counted.select(F.inline(rows)))
    for check in checks:
        if check.kind == "unique":
            repeated = _repeated_values(df, check.column)
            parts.append(repeated.select(F.inline(F.array(_row(check, F.col("_failures"))))))
    status = (
        F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("error")
    )
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def run_suite(tables: dict[str, DataFrame], suite: dict[str, Iterable[Check]]) -> DataFrame:
    """Checks of several tables in one report, with the table's name."""
    reports = [
        run_checks(tables[name], checks).select(F.lit(name).alias("table"), "*") for name, checks in suite.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def future_trips(fact: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Trips picked up after 'now'; there should be none."""
    return fact.filter(F.col("pickup_ts") > clock(as_of)).select("pickup_ts", "fare_amount", "pulocationid")


def assertion_report(offenders: DataFrame, name: str, severity: str = "error") -> DataFrame:
    """A query that must return no rows, as one line of a check report."""
    check = Check(name, "", severity)
    failures = F.col("_failures")
    status = F.when(failures == 0, "pass").when(F.lit(severity) == "warn", "warn").otherwise("error")
    return offenders.agg(F.count(F.lit(1)).alias("_failures")).select(
        F.lit(name).alias("check"), F.lit(check.column).alias("column"), failures.alias("failures"),
        F.lit(severity).alias("severity"), status.alias("status"),
    )


def freshness(df: DataFrame, column: str, as_of: AsOf = None, warn_h: int = 49, error_h: int = 73) -> DataFrame:
    """Age of the newest load: warn and error past their hours; a source that was never loaded is an error."""
    newest = df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("max_loaded_at"))
    seconds = F.unix_timestamp(clock(as_of)) - F.unix_timestamp("max_loaded_at")
    return newest.withColumn("age_hours", seconds / 3600).withColumn(
        "status",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_h), "error")
        .when(F.col("age_hours") > warn_h, "warn")
        .otherwise("pass"),
    )
