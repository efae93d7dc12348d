"""Writers: append, rebuild, partitioned facts, exports, catalog tables and views."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.timestamps import AsOf, clock
from tripmart.schemas import AI_FLAGS
from tripmart.session import shared_dir

# The database of each layer.
LAYERS = {"raw": "RAW", "staging": "STAGING", "marts": "MARTS", "ai": "MARTS", "snapshots": "SNAPSHOTS"}

# Layout column and truncation unit of each partition grain; the column exists in the stored folders only.
GRAINS = {"day": ("pickup_day", "DD"), "month": ("pickup_month", "MM")}
MAX_ROWS_PER_FILE = 20_000_000
LAYOUT_COLUMNS = [column for column, _ in GRAINS.values()]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, asked of the file system it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _contract_path(path: str) -> str:
    return path.rstrip("/") + ".contract"


_CONTRACT = "version int, position int, name string, stored_as string, field string"


def _versions(spark: SparkSession, path: str) -> list:
    """All versions of a table's contract, a row per column; none for a table without one."""
    where = _contract_path(path)
    if not exists(spark, where):
        return []
    return spark.read.schema(_CONTRACT).parquet(where).orderBy("version", "position").collect()


def contract(spark: SparkSession, path: str) -> dict[str, tuple[str, T.DataType]] | None:
    """The columns of a growing table: name -> (name in the files, type). None if the table was always written whole."""
    rows = _versions(spark, path)
    last = max((row["version"] for row in rows), default=None)
    if last is None:
        return None
    return {r["name"]: (r["stored_as"], T.StructField.fromJson(json.loads(r["field"])).dataType) for r in rows if r["version"] == last}


def sync_contract(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, tuple[str, T.DataType]]:
    """Brings the contract of the table at ``path`` to ``schema``: added columns join, vanished ones leave.

    Values of a column that left stay in old files but are reached no more: should it come back, it gets another name
    there. A changed type is an error, for old files could not be read by it.
    """
    rows = _versions(spark, path)
    version = max((row["version"] for row in rows), default=0)
    now = contract(spark, path) or {}
    if not rows and exists(spark, path):
        grown = spark.read.option("mergeSchema", True).parquet(path).drop(*LAYOUT_COLUMNS).schema
        now = {f.name: (f.name, f.dataType) for f in grown}
    used = {row["stored_as"] for row in rows} | {stored for stored, _ in now.values()}
    synced = {}
    for field in schema:
        if field.name in now:
            if now[field.name][1] != field.dataType:
                raise ValueError(f"column {field.name} was {now[field.name][1].simpleString()}, is {field.dataType.simpleString()}")
            synced[field.name] = now[field.name]
        else:
            synced[field.name] = (f"{field.name}__{version + 1}" if field.name in used else field.name, field.dataType)
    if synced != now or not rows:
        made = [
            (version + 1, k, name, stored, T.StructField(stored, kind).json())
            for k, (name, (stored, kind)) in enumerate(synced.items())
        ]
        spark.createDataFrame(made, _CONTRACT).coalesce(1).write.mode("append").parquet(_contract_path(path))
    return synced


def _by_contract(df: DataFrame, columns: dict[str, tuple[str, T.DataType]]) -> DataFrame:
    return df.select(*[F.col(f"`{name}`").alias(stored) for name, (stored, _) in columns.items()])


def stamp(df: DataFrame, column: str = "_loaded_at", as_of: AsOf = None) -> DataFrame:
    return df.withColumn(column, clock(as_of))


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Counts rows while they are written, so that no second job has to read them back."""
    seen = Observation("written")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append_raw(df: DataFrame, path: str, as_of: AsOf = None) -> int:
    """Appends to the raw layer; new columns are welcome, readers merge them with ``read_raw``."""
    return append_table(stamp(df, as_of=as_of), path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def write_table(df: DataFrame, path: str) -> int:
    """Full rebuild, taking over the new schema. ``df`` must not read from ``path`` itself."""
    remove(df.sparkSession, _contract_path(path))
    counted, seen = _counted(df)
    counted.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def append_table(df: DataFrame, path: str) -> int:
    counted, seen = _counted(df)
    counted.write.mode("append").parquet(path)
    return seen.get["rows"]


def save_as_table(df: DataFrame, layer: str, name: str) -> str:
    """Full rebuild as a catalog table in the layer's database."""
    table = f"{LAYERS[layer]}.{name}"
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {LAYERS[layer]}")
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    return table


def register_views(frames: dict[str, DataFrame]) -> None:
    """Staging as views: nothing is computed until a mart reads them, and filters reach the files."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def period(grain: str = "day") -> Column:
    """The first day of a row's partition."""
    day = F.col("pickup_date").cast("date")
    return day if grain == "day" else F.trunc(day, GRAINS[grain][1])


def _gathered(fact: DataFrame, grain: str) -> DataFrame:
    """Rows gathered by period, ready for a writer partitioned by it.

    ``rebalance`` lets adaptive execution cut a period that is far larger than the rest (the null period of unreadable
    timestamps, say) over several tasks and pack small ones together. The sort starts with the period, so the writer
    adds none of its own and keeps one file open at a time; borough and payment type cluster the row groups.
    """
    column = GRAINS[grain][0]
    return (
        fact.withColumn(column, period(grain))
        .hint("rebalance", F.col(column))
        .sortWithinPartitions(column, "pickup_borough", "payment_type")
    )


def _write_gathered(
    fact: DataFrame, path: str, grain: str, mode: str, columns: dict[str, tuple[str, T.DataType]] | None = None,
    **options: str | int,
) -> int:
    counted, seen = _counted(fact)
    rows = _gathered(counted, grain)
    if columns:
        rows = _by_contract(rows, columns | {GRAINS[grain][0]: (GRAINS[grain][0], T.DateType())})
    writer = rows.write.mode(mode).options(**options)
    writer.partitionBy(GRAINS[grain][0]).parquet(path)
    return seen.get["rows"]


def write_fact_partitioned(fact: DataFrame, path: str, grain: str = "day", max_rows_per_file: int = MAX_ROWS_PER_FILE) -> int:
    """Full rebuild of a fact, partitioned by day and clustered by borough and payment type.

    A coarser ``grain`` suits a history whose days are smaller than one good file.
    """
    remove(fact.sparkSession, _contract_path(path))
    return _write_gathered(fact, path, grain, "overwrite", maxRecordsPerFile=max_rows_per_file)


def append_rows(df: DataFrame, path: str, grain: str | None = None) -> int:
    """Appends to a growing table, flat or partitioned, whose columns follow the batch: see ``sync_contract``."""
    columns = sync_contract(df.sparkSession, path, df.schema)
    if grain is None:
        return append_table(_by_contract(df, columns), path)
    return _write_gathered(df, path, grain, "append", columns, maxRecordsPerFile=MAX_ROWS_PER_FILE)


def replace_periods(
    fact: DataFrame, path: str, grain: str = "day", max_rows_per_file: int = MAX_ROWS_PER_FILE
) -> None:
    """Replaces exactly the periods present in ``fact``; others are neither read nor rewritten."""
    kept = contract(fact.sparkSession, path) and sync_contract(fact.sparkSession, path, fact.schema)
    _write_gathered(
        fact, path, grain, "overwrite", kept, partitionOverwriteMode="dynamic", maxRecordsPerFile=max_rows_per_file
    )


def read_fact(spark: SparkSession, path: str, layout: bool = False) -> DataFrame:
    """A stored fact; ``layout`` keeps the layout column, for filters that prune whole partitions.

    A growing one is read by its contract, which also spares a look at footers: columns that a file lacks are null.
    """
    columns = contract(spark, path)
    if not columns:
        fact = spark.read.parquet(path)
        return fact if layout else fact.drop(*LAYOUT_COLUMNS)
    files = T.StructType([T.StructField(stored, kind) for stored, kind in columns.values()])
    fact = spark.read.schema(files).parquet(path)
    named = [F.col(f"`{stored}`").alias(name) for name, (stored, _) in columns.items()]
    return fact.select(*named, *[c for c in LAYOUT_COLUMNS if layout and c in fact.columns])


def export_parquet(df: DataFrame, folder: str, name: str, day: dt.date) -> str:
    """A dated copy of a mart, ``<name>_<yyyymmdd>``."""
    path = f"{folder.rstrip('/')}/{name}_{day:%Y%m%d}"
    df.write.mode("overwrite").parquet(path)
    return path


# Layout of the log of scored rows: month of the pickup, and the run that scored them.
LOG_LAYOUT = ("pickup_month", "run_id")


def pickup_month() -> Column:
    return F.date_format("pickup_ts", "yyyy-MM")


def append_ai_flags(flags: DataFrame, path: str, run: str | None = None) -> None:
    """Log of scored rows; columns beyond the log's shape are stored beside it.

    With the name of a ``run`` rows are filed by month and run, and a run that is repeated replaces its own rows. The prints
    are random digits, which only a codec with entropy coding makes smaller.
    """
    shape = [F.col(f.name).cast(f.dataType).alias(f.name) for f in AI_FLAGS]
    others = [name for name in flags.columns if name not in AI_FLAGS.fieldNames()]
    rows = flags.select(*shape, *others)
    if run is None:
        rows.write.mode("append").option("compression", "zstd").parquet(path)
        return
    filed = rows.withColumns(dict(zip(LOG_LAYOUT, (pickup_month(), F.lit(run)), strict=True))).hint("rebalance", F.col("pickup_month"))
    writer = filed.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd")
    writer.partitionBy(*LOG_LAYOUT).parquet(path)


def read_ai_flags(spark: SparkSession, path: str, beside: bool = False) -> DataFrame:
    """The log of scored rows; ``beside`` keeps the columns stored beside it, those of the layout included."""
    log = spark.read.option("mergeSchema", True).parquet(path)
    return log if beside else log.select(*AI_FLAGS.fieldNames())


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder, with the writer's ``options``, and read back.

    Lineage ends at the files, which survive a lost executor, and the optimiser plans with their measured size: a
    small table is broadcast, one above ``autoBroadcastJoinThreshold`` is joined by shuffle with skew handling.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.mode("overwrite").options(**options).parquet(path)
    kept = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    return df.sparkSession.read.schema(kept).parquet(path)
