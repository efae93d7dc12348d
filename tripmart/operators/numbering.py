"""Row numbers over a whole table, without bringing it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.sources.tables import stored

# monotonically_increasing_id() keeps the task above, and the row within the task in, its lower 33 bits.
_TASK_BITS = 33


def numbered(
    df: DataFrame, order: Sequence[Column], name: str = "row_id", keep: Sequence[str] | None = None
) -> DataFrame:
    """``df`` with numbers from 1 in this order; rows that tie in all of it are numbered in any order.

    The table is split into ranges of the order, each task sorts its range, and the sizes of the ranges, one row each,
    give the offsets. The sorted table is stored first, so that sizes and rows cannot disagree after a retry; of it only
    the columns in ``keep``, if they are given, for the order needs its own no more.
    """
    local = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ordered.select(*(keep or ["*"]), F.shiftright(local, _TASK_BITS).alias("_task"), local.alias("_local"))
    placed = stored(placed, "numbered", compression="zstd")
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    number = F.col("_offset") + F.col("_local").bitwiseAND((1 << _TASK_BITS) - 1) + 1
    return placed.join(stored(offsets, "numbered-offsets"), "_task").withColumn(name, number).drop(
        "_task", "_local", "_offset"
    )
