"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.fixtures import AS_OF, damaged_copy, raw_trips, raw_zones, trips_from_lineitem
from tripmart.functions.numeric import round_half_up
from tripmart.operators import anomaly, incremental, marts, quality, scoring, snapshot, staging
from tripmart.operators.replies import parse_replies
from tripmart.plans.builds import build_lakehouse, build_warehouse, check_build, grow_fact
from tripmart.schemas import FACT_KEY, LAKEHOUSE, TRIPS, WAREHOUSE, Profile
from tripmart.session import scratch, shared_dir, shuffles_dropped
from tripmart.sources import months, readers, tables
from tripmart.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

FUTURE_AS_OF = "2025-06-01 00:00:00"
SECOND_RUN = "2026-01-02 00:00:00"
CUT = "2024-06-01 00:00:00"

_QUERIES: dict[str, Query] = {}


def _wide_integers(df: DataFrame) -> DataFrame:
    """Integer columns as bigint, the one integer type both engines of the comparison share."""
    narrow = {f.name: F.col(f.name).cast("bigint") for f in df.schema if isinstance(f.dataType, T.IntegerType)}
    return df.withColumns(narrow) if narrow else df


def query(make: Query) -> Query:
    _QUERIES[make.__name__] = lambda spark, sf_dir: _wide_integers(make(spark, sf_dir))
    return make


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.dim_zones(staging.stage_zones(raw_zones(spark, sf_dir)))


def _staged(spark: SparkSession, sf_dir: str, profile: Profile, spread: bool = False) -> DataFrame:
    trips = raw_trips(spark, sf_dir, spread)
    if profile is LAKEHOUSE:
        trips = staging.silver_trips(trips, raw_zones(spark, sf_dir), AS_OF)
    return staging.stage_trips(trips, profile, AS_OF)


def _fact(spark: SparkSession, sf_dir: str, profile: Profile, spread: bool = False) -> DataFrame:
    return marts.fact_trips(_staged(spark, sf_dir, profile, spread), _zones(spark, sf_dir), profile)


@query
def stage_trips_w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, WAREHOUSE)


@query
def silver_trips_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.silver_trips(raw_trips(spark, sf_dir), raw_zones(spark, sf_dir), AS_OF)


@query
def stage_trips_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, LAKEHOUSE)


@query
def stage_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_zones(raw_zones(spark, sf_dir))


@query
def dim_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zones(spark, sf_dir)


@query
def fact_trips_w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, WAREHOUSE)


@query
def fact_trips_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, LAKEHOUSE)


@query
def daily_revenue_w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_revenue(_fact(spark, sf_dir, WAREHOUSE), WAREHOUSE)


@query
def daily_revenue_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_revenue(_fact(spark, sf_dir, LAKEHOUSE), LAKEHOUSE)


@query
def hourly_demand_w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hourly_demand(_fact(spark, sf_dir, WAREHOUSE))


@query
def hourly_demand_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hourly_demand(_fact(spark, sf_dir, LAKEHOUSE))


@query
def borough_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = anomaly.borough_stats(_fact(spark, sf_dir, WAREHOUSE))
    return stats.select("pickup_borough", *[round_half_up(F.col(c), 6).alias(c) for c in stats.columns[1:]])


def _shown_flags(flags: DataFrame) -> DataFrame:
    """Scores are doubles whose last digits depend on summation order; six places are compared."""
    shown = ("fare_zscore", "distance_zscore", "duration_zscore")
    return flags.withColumns({name: round_half_up(F.col(name), 6) for name in shown})


@query
def anomaly_flags_w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_flags(anomaly.anomaly_flags(tables.stored(_fact(spark, sf_dir, WAREHOUSE), "fact-w")))


@query
def anomaly_flags_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_flags(anomaly.anomaly_flags(tables.stored(_fact(spark, sf_dir, LAKEHOUSE), "fact-l")))


def _first_delivery(staged: DataFrame) -> DataFrame:
    """Early trips of payment types 1-4, unreadable times included. The rest arrives later, partly too late."""
    pickup = F.col("pickup_ts")
    return staged.filter((F.col("payment_type") <= 4) & (pickup.isNull() | (pickup <= F.lit(CUT).cast("timestamp_ntz"))))


def _two_runs(spark: SparkSession, sf_dir: str, profile: Profile, grain: str | None) -> DataFrame:
    staged, zones = _staged(spark, sf_dir, profile), _zones(spark, sf_dir)
    path = shared_dir(spark, f"incremental-{profile.name}") + "/fct_trips_incremental"
    incremental.append_new(path, None, _first_delivery(staged), zones, profile, AS_OF, grain)
    target = tables.read_fact(spark, path)
    incremental.append_new(path, target, staged, zones, profile, SECOND_RUN, grain)
    return tables.read_fact(spark, path)


@query
def incremental_fact_w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_runs(spark, sf_dir, WAREHOUSE, None)


@query
def incremental_fact_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_runs(spark, sf_dir, LAKEHOUSE, "month")


@query
def incremental_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(spark, sf_dir, WAREHOUSE)
    return incremental.load_counts(_first_delivery(staged), staged)


def _corrections(fact: DataFrame) -> DataFrame:
    """One corrected row per key for payment types 3-5: some keys are stored already, some are new."""
    corrected = fact.filter(F.col("payment_type").between(3, 5))
    return corrected.groupBy(*FACT_KEY).agg(
        (F.max("tip_amount") + 1).alias("tip_amount"),
        F.max("total_amount").alias("total_amount"),
        F.max("pickup_date").alias("pickup_date"),
    )


def _stored_part(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("payment_type") <= 4).select(*FACT_KEY, "tip_amount", "total_amount", "pickup_date")


@query
def upsert_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _fact(spark, sf_dir, WAREHOUSE)
    return incremental.upsert(_stored_part(fact), _corrections(fact))


@query
def merge_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of one year merged into a stored fact; the partitions of other years stay untouched."""
    fact = _fact(spark, sf_dir, WAREHOUSE)
    path = shared_dir(spark, "merge-periods") + "/fct_trips"
    tables.write_fact_partitioned(fact.filter(F.col("payment_type") <= 4), path, "month")
    batch = _corrections(fact.filter(F.year("pickup_ts") == 2022))
    incremental.merge_periods(path, incremental.sync_schema(batch, fact), grain="month")
    return tables.read_fact(spark, path).select(*FACT_KEY, "tip_amount", "total_amount", "pickup_date")


@query
def schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _fact(spark, sf_dir, WAREHOUSE)
    old = fact.select(*FACT_KEY, "vendorid", F.col("ratecodeid").alias("legacy_code"))
    like = fact.select("vendorid", *FACT_KEY, "tip_pct", "payment_type_desc")
    return incremental.sync_schema(old, like)


def _evolved(spark: SparkSession, sf_dir: str, grain: str | None) -> DataFrame:
    """The incremental fact over two runs, of which the second brings one new column and lacks one of the first."""
    staged, zones = _staged(spark, sf_dir, WAREHOUSE), _zones(spark, sf_dir)
    path = shared_dir(spark, "evolved") + "/fct_trips_incremental"
    incremental.append_new(path, None, _first_delivery(staged), zones, WAREHOUSE, AS_OF, grain)

    def changed(rows: DataFrame) -> DataFrame:
        return rows.drop("store_and_fwd_flag", "ratecodeid").withColumn("fare_per_mile", F.col("fare_amount") / F.col("trip_distance"))

    incremental.append_new(path, tables.read_fact(spark, path), staged, zones, WAREHOUSE, SECOND_RUN, grain, changed)
    return tables.read_fact(spark, path)


@query
def evolving_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evolved(spark, sf_dir, None)


@query
def evolving_fact_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evolved(spark, sf_dir, "month")


def _two_looks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    zones, key = _zones(spark, sf_dir), F.col("location_id")
    earlier = zones.filter(key % 7 != 3).select(
        "location_id",
        F.when(key % 5 == 0, "OLD").otherwise(F.col("borough")).alias("borough"),
        "zone",
        F.when(key % 4 != 1, F.col("service_zone")).alias("service_zone"),
    )
    later = zones.filter(key % 11 != 10)
    return earlier, later


@query
def zone_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier, later = _two_looks(spark, sf_dir)
    return snapshot.snapshot(snapshot.snapshot(None, earlier, as_of=AS_OF), later, as_of=SECOND_RUN)


@query
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone history stored look by look; a third look at unchanged zones adds nothing."""
    path = shared_dir(spark, "snapshot") + "/zone_snapshot"
    earlier, later = _two_looks(spark, sf_dir)
    snapshot.store_snapshot(path, earlier, AS_OF)
    snapshot.store_snapshot(path, later, SECOND_RUN)
    snapshot.store_snapshot(path, later, "2026-01-03 00:00:00")
    return snapshot.read_history(spark, path)


def _early_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first delivery, as raw trips."""
    pickup = F.col("tpep_pickup_datetime").try_cast("timestamp_ntz")
    early = pickup.isNull() | (pickup <= F.lit(CUT).cast("timestamp_ntz"))
    return raw_trips(spark, sf_dir).filter((F.col("payment_type") <= 4) & early)


@query
def quality_w(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "build-warehouse")
    grow_fact(spark, _early_raw(spark, sf_dir), _zones(spark, sf_dir), out, WAREHOUSE, AS_OF)
    built = build_warehouse(spark, raw_trips(spark, sf_dir), raw_zones(spark, sf_dir), out, AS_OF)
    future = quality.assertion_report(quality.future_trips(built["fct_trips"], FUTURE_AS_OF), "assert_no_future_trips")
    return check_build(built, WAREHOUSE).unionByName(future.withColumn("table", F.lit("fct_trips")))


@query
def quality_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, zones = shared_dir(spark, "build-lakehouse"), raw_zones(spark, sf_dir)
    grow_fact(spark, _early_raw(spark, sf_dir), None, out, LAKEHOUSE, AS_OF, "month", silver_zones=zones)
    return check_build(build_lakehouse(spark, raw_trips(spark, sf_dir), zones, out, AS_OF, "month"), LAKEHOUSE)


@query
def grown_fact_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental model as the builds run it: two runs on silver, the table partitioned by month."""
    out, zones = shared_dir(spark, "grown-lakehouse"), raw_zones(spark, sf_dir)
    grow_fact(spark, _early_raw(spark, sf_dir), None, out, LAKEHOUSE, AS_OF, "month", silver_zones=zones)
    return grow_fact(spark, raw_trips(spark, sf_dir), None, out, LAKEHOUSE, AS_OF, "month", silver_zones=zones)


@query
def unique_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return quality.run_checks(lineitem, [quality.unique("l_orderkey"), quality.unique("l_linenumber")])


@query
def no_future_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = incremental.raw_after(raw_trips(spark, sf_dir), F.lit(FUTURE_AS_OF))
    fact = marts.fact_trips(staging.stage_trips(raw, WAREHOUSE, AS_OF), _zones(spark, sf_dir), WAREHOUSE)
    return quality.future_trips(fact, FUTURE_AS_OF)


@query
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    looks = [
        ("events", quality.freshness(events, "ts", "2024-02-01 00:00:00")),
        ("events_later", quality.freshness(events, "ts", "2024-02-02 06:00:00")),
        ("orders", quality.freshness(orders, "o_orderdate", AS_OF)),
        ("orders_never", quality.freshness(orders.filter(F.col("o_orderkey") < 0), "o_orderdate", AS_OF)),
    ]
    first, *rest = [look.withColumn("source", F.lit(name)) for name, look in looks]
    for look in rest:
        first = first.unionByName(look)
    return first.withColumn("age_hours", round_half_up(F.col("age_hours"), 6))


@query
def target_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.groupBy(months.target_month(F.col("o_orderdate")).alias("month")).agg(
        F.count(F.lit(1)).alias("runs")
    )


@query
def month_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips delivered in monthly folders, checked against the months that runs on the order dates would load."""
    folder = shared_dir(spark, "months") + "/raw"
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    delivered = lineitem.select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    delivered.repartition("month").write.partitionBy("month").parquet(folder)
    runs = spark.read.parquet(f"{sf_dir}/orders.parquet")
    wanted = runs.select(months.target_month(F.col("o_orderdate")).alias("month")).distinct()
    return months.month_presence(spark, folder, wanted)


def _two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as two loads left it: trips of an odd vendor came a day later. It is made for scoring, by all cores."""
    fact = _fact(spark, sf_dir, WAREHOUSE, spread=True)
    later = F.lit(SECOND_RUN).cast("timestamp_ntz")
    return fact.withColumn("_dbt_loaded_at", F.when(F.col("vendorid") % 2 == 1, later).otherwise(F.col("_dbt_loaded_at")))


def _stored_loads(spark: SparkSession, sf_dir: str, *others: str) -> DataFrame:
    """The same, stored: what scoring reads of it, and ``others``."""
    with shuffles_dropped(spark):
        fact = _two_loads(spark, sf_dir).select(*scoring.READ_COLUMNS, *others)
        return tables.stored(fact, "scored-fact", compression="zstd")


@query
def score_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.prompts(scoring.candidates(_two_loads(spark, sf_dir))).select("row_id", "prompt")


@query
def score_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thousand rows of the newest load that a run with a budget would score."""
    return scoring.prompts(scoring.candidates(_two_loads(spark, sf_dir), 1000)).select("row_id", "prompt")


@query
def score_row_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored row end to end: its number, its prompt, and what the scorer says."""
    row = scoring.row_k(_two_loads(spark, sf_dir), 777)
    return scoring.score_rows(row, scoring.rule_scorer, batch_size=1).select(
        "row_id", "prompt", "score", "is_anomaly", "explanation", "failed"
    )


@query
def score_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fact(spark, sf_dir, LAKEHOUSE, spread=True).select("pickup_ts", *scoring.FEATURES)
    return scoring.score_rows(rows, scoring.rule_scorer).drop("reply")


# Reply shapes by remainder of the part key; {n} is the line number.
REPLY_SHAPES = (
    '{"score": 0.{n}, "is_anomaly": true, "explanation": "fare {n}"}',
    '"{"score": {n}, "is_anomaly": false, "explanation": "quoted"}"',
    '{"anomaly_score": "0.{n}", "anomaly": "false", "reason": "alias"}',
    '{"score": 0, "anomaly_score": 0.{n}, "is_anomaly": 0, "anomaly": 1}',
    '[{"score": 0.{n}, "is_anomaly": true}]',
    '{"score": 0.{n}, "is_anomaly": yes, "explanation": "broken"',
    "SCORE: .{n} yes, unusual\nsecond line",
    "this looks anomalous, score = {n}",
    "",
    '{"score": "high", "is_anomaly": true}',
    '  {"score": {n}e-1, "explanation": "", "reason": "spaced"}  \n',
    '{"score": 0.{n}} trailing words',
    "null",
    '{"is_anomaly": {}, "anomaly": [], "score": true}',
)


@query
def parse_reply_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies in every shape, one per line item, plus all documents and conversation turns as free text."""
    lineitem, documents, turns = (
        spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in ("lineitem", "documents", "conversations")
    )
    shapes = F.array(*[F.lit(shape) for shape in REPLY_SHAPES])
    shaped = lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.replace(
            F.get(shapes, (F.col("l_partkey") % len(REPLY_SHAPES)).cast("int")),
            F.lit("{n}"),
            F.col("l_linenumber").cast("string"),
        ).alias("reply"),
    )
    texts = documents.select(F.col("doc_id").alias("id"), F.col("text").alias("reply"))
    spoken = turns.select(
        F.col("conv_id").alias("id"), F.concat(F.lit("turn\nscore="), "turn", F.lit(" "), "text").alias("reply")
    )
    return parse_replies(shaped.unionByName(texts).unionByName(spoken)).drop("reply")


@query
def ai_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows scored and logged in two runs; the second run takes only what the first did not log."""
    fact = _stored_loads(spark, sf_dir)
    path = shared_dir(spark, "ai-flags") + "/ai_anomaly_flags"

    def run(rows: DataFrame, as_of: str) -> None:
        with scratch(spark):
            chosen = scoring.prompts(scoring.in_batches(scoring.candidates(rows)))
            tables.append_ai_flags(scoring.ai_flags(scoring.score_batches(chosen, scoring.rule_scorer), as_of), path)

    run(fact.filter(F.col("_dbt_loaded_at") == F.lit(AS_OF).cast("timestamp_ntz")), AS_OF)
    run(scoring.unscored(fact, tables.read_ai_flags(spark, path, beside=True)), SECOND_RUN)
    return tables.read_ai_flags(spark, path)


@query
def ai_flags_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads scored by runs of which the second broke off halfway and was repeated, and a third that finds nothing."""
    fact = _stored_loads(spark, sf_dir, "payment_type")
    path = shared_dir(spark, "ai-flags-repeated") + "/ai_anomaly_flags"
    first = fact.filter(F.col("_dbt_loaded_at") == F.lit(AS_OF).cast("timestamp_ntz"))
    scoring.score_run(first, path, scoring.rule_scorer, "one", AS_OF)
    scoring.score_run(fact.filter("payment_type < 4"), path, scoring.rule_scorer, "two", "2026-01-04 00:00:00")
    scoring.score_run(fact, path, scoring.rule_scorer, "two", SECOND_RUN)
    scoring.score_run(fact, path, scoring.rule_scorer, "three", "2026-01-03 00:00:00")
    return tables.read_ai_flags(spark, path)


def _csv_trips(spark: SparkSession, sf_dir: str) -> str:
    """Trips as CSV lines under a header, some with an unreadable number, some too long, some too short."""
    path = shared_dir(spark, "csv") + "/trips"
    trips = raw_trips(spark, sf_dir)
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in trips.columns]
    passengers = trips.columns.index("passenger_count")
    unreadable = [*fields[:passengers], F.lit("n/a"), *fields[passengers + 1 :]]
    kind = F.col("dolocationid") % 13
    line = (
        F.when(kind == 1, F.concat_ws(",", *unreadable))
        .when(kind == 2, F.concat_ws(",", *fields, F.lit("surplus")))
        .when(kind == 3, F.concat_ws(",", *fields[:-1]))
        .otherwise(F.concat_ws(",", *fields))
    )
    # One column named like the whole header: the writer then puts the header line on top of every file.
    lines = trips.select(line.alias(",".join(trips.columns)))
    lines.write.option("header", True).option("sep", "\u0001").csv(path)
    return path


@query
def tolerant_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_trips(spark, _csv_trips(spark, sf_dir), fmt="csv", tolerant=True)


@query
def rejected_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.rejected_rows(spark, _csv_trips(spark, sf_dir), TRIPS, fmt="csv").drop(readers.REJECTED)


@query
def mixed_header_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two CSV deliveries in one folder, the second with its columns the other way round and one column less."""
    folder = shared_dir(spark, "headers")
    trips = raw_trips(spark, sf_dir).filter("tpep_pickup_datetime <> 'corrupt'")
    first, second = (trips.filter(F.col("vendorid") == vendor) for vendor in (1, 2))
    first.write.option("header", True).csv(f"{folder}/2024-01.csv")
    turned = second.select(*reversed(second.drop("extra").columns))
    turned.withColumnsRenamed({"vendorid": "VendorID"}).write.option("header", True).csv(f"{folder}/2024-02.csv")
    return readers.read_trips(spark, folder)


def _drifting_trips(spark: SparkSession, sf_dir: str, passengers: str) -> str:
    """Parquet deliveries in a plain folder: passengers as bigint in one, as ``passengers`` in the other."""
    folder = shared_dir(spark, "drift") + "/raw"
    trips = raw_trips(spark, sf_dir).withColumns(
        {name: F.col(name).try_cast("timestamp_ntz") for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    )
    trips.filter("vendorid = 1").write.parquet(f"{folder}/2024-01")
    second = trips.filter("vendorid = 2").withColumn("passenger_count", F.expr(passengers))
    second.withColumn("fare_amount", F.col("fare_amount").cast("string")).write.parquet(f"{folder}/2024-02")
    return folder


@query
def drifted_parquet_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_trips(spark, _drifting_trips(spark, sf_dir, "cast(passenger_count as double)"))


_ODD_PASSENGERS = "case when pulocationid % 5 = 0 then 'many' else cast(passenger_count as string) end"


@query
def tolerant_parquet_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_trips(spark, _drifting_trips(spark, sf_dir, _ODD_PASSENGERS), tolerant=True)


@query
def rejected_parquet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.rejected_rows(spark, _drifting_trips(spark, sf_dir, _ODD_PASSENGERS), TRIPS).drop(readers.REJECTED)


# Rows of a row group of the damaged delivery; the bytes overwritten lie within its first one.
GROUP_ROWS, WRONG_BYTES = 50, (200, 600)
# Rows of a file of that delivery, about.
FILE_ROWS = 20_000


def _damaged_trips(spark: SparkSession, sf_dir: str) -> str:
    """Deliveries in one folder: a plain one, one whose types drifted, one cut off, one with a damaged page in its first
    file."""
    made = shared_dir(spark, "damage")
    folder = f"{made}/raw"
    trips = raw_trips(spark, sf_dir).withColumns(
        {name: F.col(name).try_cast("timestamp_ntz") for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    )
    trips.filter("vendorid = 1").write.parquet(f"{folder}/2024-01")
    drifted = trips.filter("payment_type in (1, 3)").withColumn("passenger_count", F.col("passenger_count").cast("double"))
    drifted.write.parquet(f"{folder}/2024-02")
    trips.filter("payment_type = 5").repartition(1).write.parquet(f"{made}/whole-03")
    damaged_copy(spark, f"{made}/whole-03", f"{folder}/2024-03", keep=4000)
    order = ["total_amount", "tip_amount", F.asc_nulls_first("tpep_pickup_datetime"), "pulocationid", "dolocationid", "trip_distance"]
    last = trips.filter("payment_type = 7")
    parts = last.count() // FILE_ROWS + 1
    last = last.repartition(1) if parts == 1 else last.repartitionByRange(parts, *order)
    last.sortWithinPartitions(*order).write.option("parquet.block.row.count.limit", GROUP_ROWS).parquet(f"{made}/whole-04")
    damaged_copy(spark, f"{made}/whole-04", f"{folder}/2024-04", wrong=WRONG_BYTES)
    return folder


@query
def damaged_parquet_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sound rows of deliveries that drift, break off, or hold a damaged page."""
    return readers.read_trips(spark, _damaged_trips(spark, sf_dir), tolerant=True)


@query
def damaged_parquet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What that load leaves out: delivery, reason, and rows lost where a footer tells."""
    found = readers.unreadable_files(spark, _damaged_trips(spark, sf_dir))
    return found.select(F.regexp_extract("file", "/(20[0-9-]+)/", 1).alias("delivery"), "reason", "rows_lost")


@query
def zones_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "zones") + "/taxi_zone_lookup.csv"
    zones = raw_zones(spark, sf_dir).withColumnsRenamed({"locationid": "LocationID", "borough": "Borough"})
    zones.write.option("header", True).csv(path)
    return staging.dim_zones(staging.stage_zones(readers.read_zones(spark, path)))


@query
def read_table_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact saved as a catalog table, twice with another schema, and read by its name."""
    fact = _fact(spark, sf_dir, WAREHOUSE)
    name = f"fct_trips_{uuid.uuid4().hex[:12]}"
    tables.save_as_table(fact.select(*FACT_KEY), "marts", name)
    return readers.read_table(spark, tables.save_as_table(fact, "marts", name))


@query
def schema_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rebuild with other columns takes the place of the old table; the counts written are returned with it."""
    path = shared_dir(spark, "rebuild") + "/agg_hourly_demand"
    fact = _fact(spark, sf_dir, WAREHOUSE)
    tables.write_table(fact.select("pickup_ts", "fare_amount"), path)
    written = tables.write_table(marts.hourly_demand(fact), path)
    tables.register_views({"hourly_view": readers.read_table(spark, path)})
    return spark.sql("select * from hourly_view").withColumn("rows_written", F.lit(written).cast("bigint"))


@query
def day_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fact by day, trips without a day included, a few days rewritten, and rows per stored day."""
    path = shared_dir(spark, "days") + "/fct_trips"
    fact = _fact(spark, sf_dir, WAREHOUSE)
    tables.write_fact_partitioned(fact, path, "day")
    tables.replace_periods(fact.filter("pickup_date between '2022-01-10' and '2022-01-12' and payment_type = 1"), path, "day")
    return tables.read_fact(spark, path, layout=True).groupBy("pickup_day").agg(F.count(F.lit(1)).alias("trips"))


@query
def name_matched_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet with other letter case and column order, without one optional column."""
    path = shared_dir(spark, "names") + "/trips.parquet"
    trips = raw_trips(spark, sf_dir).drop("cbd_congestion_fee")
    typed = trips.withColumns(
        {name: F.col(name).try_cast("timestamp_ntz") for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    )
    typed.select(*[F.col(name).alias(name.title()) for name in reversed(typed.columns)]).write.parquet(path)
    return readers.read_trips(spark, path)


@query
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, the second with one more column, appended and read as one table."""
    path = shared_dir(spark, "bronze") + "/yellow_trips_raw"
    trips = raw_trips(spark, sf_dir)
    tables.append_raw(trips.filter(F.col("vendorid") == 1).drop("airport_fee"), path, AS_OF)
    tables.append_raw(trips.filter(F.col("vendorid") == 2), path, AS_OF)
    return tables.read_raw(spark, path)


@query
def partitioned_fact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "partitioned") + "/fct_trips"
    tables.write_fact_partitioned(_fact(spark, sf_dir, WAREHOUSE), path, "month")
    return tables.read_fact(spark, path, layout=True)


@query
def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "export")
    fact = _fact(spark, sf_dir, LAKEHOUSE)
    return spark.read.parquet(tables.export_parquet(fact, folder, "fct_trips", dt.date(2026, 1, 1)))


@query
def file_stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line item files as a trip stream, ingested twice; the second run finds nothing to add."""
    folder = shared_dir(spark, "stream")
    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    # As a glob, the name fits a single file as well as a folder of part files.
    source = ingest.trip_files(spark, f"{sf_dir}/lineitem.parque[t]", schema)
    for _ in range(2):
        ingest.ingest_stream(
            trips_from_lineitem(source), f"{folder}/raw", f"{folder}/checkpoint", AS_OF
        ).awaitTermination()
    return spark.read.parquet(f"{folder}/raw")


def _delivered(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, DataFrame]:
    """Trips as two deliveries, the early ones and the rest, to land one by one."""
    trips = raw_trips(spark, sf_dir)
    pickup = F.col("tpep_pickup_datetime").try_cast("timestamp_ntz")
    early = (F.col("payment_type") <= 4) & pickup.between(
        F.lit("2009-01-01").cast("timestamp_ntz"), F.lit(CUT).cast("timestamp_ntz")
    )
    return {"early": trips.filter(early), "rest": trips.filter(F.coalesce(~early, F.lit(True)))}


def _stream_run(
    spark: SparkSession, sf_dir: str, folder: str, checkpoint: str, max_files: int | None = None
) -> DataFrame:
    schema = raw_trips(spark, sf_dir).schema
    files = ingest.trip_files(spark, f"{folder}/landing/*", schema, max_files)
    target = f"{folder}/fact"
    ingest.incremental_stream(
        files, _zones(spark, sf_dir), WAREHOUSE, target, f"{folder}/{checkpoint}", AS_OF
    ).awaitTermination()
    return ingest.read_stream_fact(spark, target)


@query
def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries land one after the other; the stream stores what is newer than the first."""
    folder = shared_dir(spark, "stream-incremental")
    for name, delivery in _delivered(spark, sf_dir, folder).items():
        delivery.write.parquet(f"{folder}/landing/{name}")
        stored = _stream_run(spark, sf_dir, folder, "checkpoint")
    return stored


@query
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each micro-batch of ``stream_incremental`` are new, late, or without a time."""
    folder = shared_dir(spark, "stream-counts")
    for name, delivery in _delivered(spark, sf_dir, folder).items():
        delivery.write.parquet(f"{folder}/landing/{name}")
        _stream_run(spark, sf_dir, folder, "checkpoint")
    return ingest.read_stream_counts(spark, f"{folder}/fact").drop("stream_id")


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery comes to a stream that starts anew: old rows stay, only newer ones are added."""
    folder = shared_dir(spark, "stream-restart")
    for name, delivery in _delivered(spark, sf_dir, folder).items():
        delivery.write.parquet(f"{folder}/landing/{name}")
        stored = _stream_run(spark, sf_dir, folder, f"checkpoint-{name}")
    return stored


@query
def stream_incremental_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later trips land before earlier ones and are read file by file; the result is that of one batch."""
    folder = shared_dir(spark, "stream-batched")
    for name, delivery in reversed(_delivered(spark, sf_dir, folder).items()):
        delivery.write.parquet(f"{folder}/landing/{name}")
    return _stream_run(spark, sf_dir, folder, "checkpoint", max_files=1)
