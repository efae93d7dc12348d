"""File streams into the raw layer and into the incremental fact."""

from __future__ import annotations

import json
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripmart.functions.timestamps import AsOf, clock
from tripmart.operators.incremental import COUNTS, count_columns, incremental_fact
from tripmart.operators.staging import stage_trips
from tripmart.schemas import TRIPS, Profile
from tripmart.sources.tables import exists, remove


def trip_files(
    spark: SparkSession, source: str, schema: T.StructType = TRIPS, max_files: int | None = None
) -> DataFrame:
    """A stream over Parquet files as they arrive. ``max_files`` bounds one micro-batch when a backlog is large.

    A file is often one row group and thus one task, whatever its size. Batches of fewer files than there are cores are
    dealt over all of them, so that only decoding is left to that task.
    """
    reader, cores = spark.readStream.schema(schema), spark.sparkContext.defaultParallelism
    if not max_files:
        return reader.parquet(source)
    files = reader.option("maxFilesPerTrigger", max_files).parquet(source)
    return files.repartition(cores, *files.columns) if max_files < cores else files


def ingest_stream(trips: DataFrame, target: str, checkpoint: str, as_of: AsOf = None) -> StreamingQuery:
    """Appends each delivered file exactly once and stops when none is left.

    The checkpoint remembers the files, the file sink's log the batches: running again adds nothing, and a run that was
    cut off continues without duplicates.
    """
    return (
        trips.withColumn("_loaded_at", clock(as_of))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


# Layout of a stream's fact: rows by month, stream and batch; the mark of a run that has not ended, by stream.
LAYOUT = ("pickup_month", "stream_id", "batch_id")


def stored_mark(spark: SparkSession, target: str) -> DataFrame | None:
    """The newest time stored, as one row, whoever stored it; None if nothing is. Only the last month is read."""
    if not exists(spark, f"{target}/rows"):
        return None
    rows = spark.read.parquet(f"{target}/rows")
    last = rows.agg(F.max("pickup_month")).scalar()
    return rows.filter(F.col("pickup_month") == last).agg(F.max("pickup_ts").alias("pickup_ts"))


def run_mark(spark: SparkSession, target: str, stream: str) -> DataFrame | None:
    """The mark that all batches of a run are compared with: what was stored when the run began.

    It is kept until the run ends, so that neither the cut into batches nor a run that breaks off and goes on later
    changes what is admitted.
    """
    folder = f"{target}/runs/{stream}"
    if not exists(spark, f"{folder}/_SUCCESS"):
        mark = stored_mark(spark, target)
        if mark is None:
            mark = spark.sql("select cast(null as timestamp_ntz) as pickup_ts, true as first")
        else:
            mark = mark.withColumn("first", F.lit(False))
        mark.write.mode("overwrite").parquet(folder)
    mark = spark.read.schema("pickup_ts timestamp_ntz, first boolean").parquet(folder)
    return None if mark.first()["first"] else mark.select("pickup_ts")


def _observed(seen: Observation, rows: DataFrame, columns: list[Column]) -> tuple[int, ...]:
    try:
        found = seen.get
    except Py4JJavaError:
        # Where nothing can be admitted, Spark does not run the part that is observed.
        found = rows.agg(*columns).first().asDict()
    return tuple(found[name] for name in COUNTS)


def load_batch(
    staged: DataFrame,
    batch_id: int,
    target: str,
    stream: str,
    make_fact: Callable[[DataFrame | None, DataFrame], DataFrame],
) -> None:
    """Stores one micro-batch under its stream and number, so a repeated batch replaces itself and nothing else.

    How its rows split (new, late, without a time) is observed while they are written and filed in the same way.
    Rows are filed by month first; readers prune by time, and the next mark comes from the last month alone.
    """
    mark = run_mark(staged.sparkSession, target, stream)
    split = count_columns(mark and F.lit(mark.first()["pickup_ts"]).cast("timestamp_ntz"), mark is None)
    seen = Observation("load")
    fact = make_fact(mark, staged.observe(seen, *split))
    month = F.date_format("pickup_ts", "yyyy-MM")
    dealt = fact.withColumns(dict(zip(LAYOUT, (month, F.lit(stream), F.lit(batch_id)), strict=True)))
    writer = dealt.hint("rebalance", F.col("pickup_month")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*LAYOUT).parquet(f"{target}/rows")
    counts = staged.sparkSession.createDataFrame([_observed(seen, staged, split)], ", ".join(f"{name} long" for name in COUNTS))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{target}/counts/stream_id={stream}/batch_id={batch_id}")


class IncrementalRun:
    """A started run. ``awaitTermination`` waits until all files are stored and ends the run."""

    def __init__(self, query: StreamingQuery, end: Callable[[], None]):
        self.query, self._end = query, end

    def awaitTermination(self) -> None:  # noqa: N802 - named as in Spark
        self.query.awaitTermination()
        self._end()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Spark's own id of the stream, which a new checkpoint gets anew, even one in the place of an old one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def incremental_stream(
    trips: DataFrame,
    zones: DataFrame | None,
    profile: Profile,
    target: str,
    checkpoint: str,
    as_of: AsOf = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> IncrementalRun:
    """Stages each micro-batch and stores the trips newer than everything stored before this run.

    ``prepare`` turns a micro-batch of files into what staging expects, silver trips for the lakehouse rules. A new
    checkpoint on a target with rows reads all files again and adds only what is newer.
    """
    spark = trips.sparkSession

    def make_fact(earlier: DataFrame | None, staged: DataFrame) -> DataFrame:
        return incremental_fact(earlier, staged, zones, profile, as_of)

    def load(batch: DataFrame, batch_id: int) -> None:
        stream = _stream_id(batch.sparkSession, checkpoint)
        load_batch(stage_trips(prepare(batch), profile, as_of), batch_id, target, stream, make_fact)

    query = (
        trips.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return IncrementalRun(query, lambda: remove(spark, f"{target}/runs/{_stream_id(spark, checkpoint)}"))


def read_stream_counts(spark: SparkSession, target: str) -> DataFrame:
    """stream_id, batch_id, new, late, null_ts: how each micro-batch split."""
    columns = ", ".join(f"{name} long" for name in (*COUNTS, "batch_id"))
    return spark.read.schema(f"{columns}, stream_id string").parquet(f"{target}/counts")


def read_stream_fact(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/rows").drop(*LAYOUT)
