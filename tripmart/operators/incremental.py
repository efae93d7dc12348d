"""High-water-mark loading, general upsert and schema alignment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.timestamps import AsOf, clock
from tripmart.operators.marts import fact_trips
from tripmart.schemas import FACT_KEY, Profile
from tripmart.sources.tables import (
    GRAINS,
    LAYOUT_COLUMNS,
    append_rows,
    exists,
    period,
    read_fact,
    replace_periods,
    stored,
)


def high_water_mark(target: DataFrame, column: str = "pickup_ts") -> Column:
    """The newest value already stored, as a scalar subquery: one column is read, and the value reaches the scan."""
    return target.agg(F.max(column)).scalar()


def select_new(target: DataFrame | None, staged: DataFrame, column: str = "pickup_ts") -> DataFrame:
    """Everything on the first run; later only rows above the mark.

    A null time is never above the mark, and a target without any time admits nothing.
    """
    if target is None:
        return staged
    return staged.filter(F.col(column) > high_water_mark(target, column))


COUNTS = ("new", "late", "null_ts")


def count_columns(mark: Column | None, first: bool, column: str = "pickup_ts") -> list[Column]:
    """Aggregates that tell how rows split at ``mark``; a first run admits every row."""
    missing = F.col(column).isNull()
    admitted = F.lit(True) if first else F.coalesce(F.col(column) > mark, F.lit(False))
    parts = (admitted, ~admitted & ~missing, ~admitted & missing)
    return [F.count_if(part).alias(name) for name, part in zip(COUNTS, parts, strict=True)]


def load_counts(target: DataFrame | None, staged: DataFrame, column: str = "pickup_ts") -> DataFrame:
    """How a run would split its rows: admitted, late (at or below the mark), and without a time."""
    if target is None:
        return staged.agg(*count_columns(None, True, column))
    marked = staged.select(column, high_water_mark(target, column).alias("_mark"))
    return marked.agg(*count_columns(F.col("_mark"), False, column))


def raw_after(raw: DataFrame, moment: Column | dt.datetime | None) -> DataFrame:
    """Raw trips that can have a pickup after ``moment``. Where the file holds times, the scan skips what is older.

    Staging only ever drops a pickup time or keeps it, so the later filter on ``pickup_ts`` implies this one.
    """
    kind = raw.schema["tpep_pickup_datetime"].dataType
    if moment is None or not isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return raw
    return raw.filter(F.col("tpep_pickup_datetime") > F.lit(moment).cast(kind))


def stored_mark(spark: SparkSession, path: str, grain: str | None = None) -> dt.datetime | None:
    """The newest pickup of a stored fact; of a partitioned one only the last period is read."""
    if not exists(spark, path):
        return None
    target = spark.read.parquet(path)
    if grain:
        layout = F.col(GRAINS[grain][0])
        target = target.filter(layout == target.agg(F.max(layout)).scalar())
    return target.agg(F.max("pickup_ts")).first()[0]


def incremental_fact(
    target: DataFrame | None, staged: DataFrame, zones: DataFrame | None, profile: Profile, as_of: AsOf = None
) -> DataFrame:
    """The fact rows one run adds, stamped with the time of processing."""
    return fact_trips(select_new(target, staged), zones, profile).withColumn("_processed_at", clock(as_of))


def sync_schema(target: DataFrame, like: DataFrame) -> DataFrame:
    """Stored rows in the shape of new ones: added columns are null, vanished columns are dropped."""
    return target.unionByName(like.limit(0), allowMissingColumns=True).select(*like.columns)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str] = FACT_KEY) -> DataFrame:
    """Target rows without a match plus all batch rows, in the batch's schema.

    A key with a null part matches nothing. Batch rows that match no target row are all kept, duplicates included; two
    batch rows for one target row are an error. The batch is reduced to one row per key first, so the join cannot fan
    out, whatever one key's share of the batch is.
    """
    keys = list(keys)
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    matches = (
        batch.filter(complete)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_matches"))
        .withColumnsRenamed({key: f"_batch_{key}" for key in keys})
    )
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(key) == F.col(f"_batch_{key}"))
    ambiguous = F.raise_error(F.lit("several batch rows match one target row")).cast("boolean")
    kept = (
        target.join(matches, same, "left")
        .filter(F.when(F.col("_matches") > 1, ambiguous).otherwise(F.col("_matches").isNull()))
        .select(*target.columns)
    )
    return sync_schema(kept, batch).unionByName(batch)


def append_new(
    path: str,
    target: DataFrame | None,
    staged: DataFrame,
    zones: DataFrame | None,
    profile: Profile,
    as_of: AsOf = None,
    grain: str | None = None,
    extend: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """The production load: admitted rows are strictly newer than every stored row, so an append is the upsert.

    ``extend`` changes the columns that a run stores. ``grain`` partitions the table by pickup time. The table's columns follow the run: earlier rows are null in a new
    column, and a column that the run lacks is gone (``sources.tables.sync_contract``). Returns the number of rows added. A first run, without a target, must
    not find a table at ``path``: it would append everything once more.
    """
    if target is None and exists(staged.sparkSession, path):
        raise ValueError(f"{path} is there already; give it as the target")
    rows = incremental_fact(target, staged, zones, profile, as_of)
    if extend is not None:
        rows = extend(rows)
    return append_rows(rows, path, grain)


def merge_periods(path: str, batch: DataFrame, keys: Sequence[str] = FACT_KEY, grain: str = "day") -> None:
    """Upserts a batch into a partitioned fact, reading and rewriting only the periods the batch touches.

    Matching rows share a pickup time and hence a period. The batch is stored first, so it is computed once and joined
    by its real size; its first and last period are subqueries that prune the partitions of the target before the exact
    semi join. The merged periods are stored as well: a folder must not be overwritten while it is read, and after a
    failure the last step can simply be repeated. The keys must hold the pickup time, which fixes the period.
    """
    if not {"pickup_ts", "pickup_date"} & set(keys):
        raise ValueError("without pickup_ts among the keys a match may lie in another period")
    batch = stored(batch, "merge-batch")
    periods = batch.select(period(grain).alias("_period"))
    layout = F.col(GRAINS[grain][0])
    first, last = periods.agg(F.min("_period")).scalar(), periods.agg(F.max("_period")).scalar()
    has_null = periods.agg(F.count_if(F.col("_period").isNull()) > 0).scalar()
    target = read_fact(batch.sparkSession, path, layout=True)
    in_reach = target.filter(((layout >= first) & (layout <= last)) | (layout.isNull() & has_null))
    touched = in_reach.join(periods.distinct(), layout.eqNullSafe(F.col("_period")), "left_semi")
    merged = upsert(touched.drop(*LAYOUT_COLUMNS), batch, keys)
    replace_periods(stored(merged, "merged-periods"), path, grain)
