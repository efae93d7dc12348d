"""Z-score anomaly flags against each pickup borough's own mean and spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.numeric import round_half_up, safe_ratio
from tripmart.sources.tables import stored

# Measure -> short name used in the statistics and z-score columns.
MEASURES = {"fare_amount": "fare", "trip_distance": "distance", "trip_duration_mins": "duration"}

# Reasons in the order in which the first match wins.
REASONS = (
    (("fare", "distance"), "high fare + long distance"),
    (("fare", "duration"), "high fare + long duration"),
    (("fare",), "high fare"),
    (("distance",), "long distance"),
    (("duration",), "long duration"),
)

KEPT = (
    "pickup_ts", "fare_amount", "trip_distance", "trip_duration_mins", "passenger_count", "pickup_borough",
    "payment_type_desc",
)


def borough_stats(fact: DataFrame) -> DataFrame:
    """Mean and sample deviation per pickup borough, combined map-side: one row per borough leaves each task."""
    return fact.groupBy("pickup_borough").agg(
        *[F.avg(column).alias(f"mean_{short}") for column, short in MEASURES.items()],
        *[F.stddev_samp(column).alias(f"std_{short}") for column, short in MEASURES.items()],
    )


def _z(short: str) -> Column:
    return F.col(f"{short}_zscore")


def anomaly_flags(fact: DataFrame, threshold: float = 3.0, stats: DataFrame | None = None) -> DataFrame:
    """Z-scores, their rounded mean, the flag and its reason, one row per fact row.

    Two passes over the fact: the statistics (four columns), then the scores. The statistics are stored between the
    passes, which tells the optimiser their real size; with a handful of boroughs the second pass is then a broadcast
    join and shuffles nothing. The join uses plain equality, so trips without a borough get no score.
    """
    if stats is None:
        stats = stored(borough_stats(fact), "borough-stats")
    by_borough = stats.withColumnRenamed("pickup_borough", "stats_borough")
    scored = fact.join(by_borough, F.col("pickup_borough") == F.col("stats_borough"), "left").select(
        *KEPT,
        *[
            safe_ratio(F.abs(F.col(column) - F.col(f"mean_{short}")), F.col(f"std_{short}")).alias(f"{short}_zscore")
            for column, short in MEASURES.items()
        ],
    )
    total = sum((F.coalesce(_z(short), F.lit(0.0)) for short in MEASURES.values()), F.lit(0.0))
    high = {short: _z(short) > threshold for short in MEASURES.values()}
    reason = F
    for shorts, text in REASONS:
        matched = high[shorts[0]]
        for short in shorts[1:]:
            matched = matched & high[short]
        reason = reason.when(matched, text)
    return scored.withColumns(
        {
            "anomaly_score": round_half_up(total / 3),
            "is_anomaly": F.coalesce(F.greatest(*high.values()), F.lit(False)),
            "anomaly_reason": reason.otherwise(F.lit(None)),
        }
    )
