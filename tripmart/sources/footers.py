"""A catalogue of Parquet files, made by executors: schema, rows, and what of a file cannot be read.

The files are a table. Executors read each file's footer and, if asked, every page of it; groups of files with one schema
come from an aggregation. Spark reads the sound files. Of a damaged one its sound row groups are read, one by one.

Executors open files of common stores themselves and read only what they need. In any other store, one that only Spark's
readers reach, files come whole through the ``binaryFile`` source, which bounds them to 2 GB.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tripmart.sources.tables import stored

#: Stores that an executor opens without Spark.
DIRECT = ("file", "s3", "s3a", "gs", "abfs", "abfss")
NO_FOOTER, BAD_GROUPS = "no readable footer", "damaged row groups"
_TAIL, _MAGIC, _BATCH_ROWS = 8, b"PAR1", 16_384
_SCHEMA = "file string, bytes long, print string, rows long, damaged array<int>, reason string, rows_lost long"


def listed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, bytes and, where executors cannot open the file themselves, its content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    direct = F.regexp_extract("path", "^([a-z0-9]+):", 1).isin(*DIRECT)
    names = found.select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    near = names.filter(F.regexp_extract("file", "^([a-z0-9]+):", 1).isin(*DIRECT)).withColumn("content", F.lit(None).cast("binary"))
    far = found.filter(~direct).select(F.col("path").alias("file"), F.col("length").alias("bytes"), "content")
    return near.union(far)


def named_parquet(files: DataFrame) -> DataFrame:
    return files.filter(F.lower("file").rlike(r"\.(parquet|parq)$"))


def _opened(file: str, content: bytes | None) -> pa.NativeFile:
    if content is not None:
        return pa.BufferReader(content)
    scheme, rest = file.split(":", 1)
    if scheme == "file":
        return pafs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    store, inner = pafs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:{rest}")
    return store.open_input_file(inner)


def _metadata(source: pa.NativeFile) -> pq.FileMetaData | None:
    """The footer, or None if there is none that can be understood. That the store fails is another matter and raises."""
    size = source.size()
    if size < _TAIL + len(_MAGIC):
        return None
    tail = source.read_at(_TAIL, size - _TAIL)
    length = int.from_bytes(tail[:4], "little")
    if tail[4:] != _MAGIC or length + _TAIL + len(_MAGIC) > size:
        return None
    footer = source.read_at(length + _TAIL, size - length - _TAIL)
    try:
        return pq.read_metadata(pa.BufferReader(_MAGIC + footer))
    except (pa.ArrowException, OSError):
        return None


def _checked(source: pa.NativeFile, found: pq.FileMetaData) -> pq.ParquetFile:
    """The file under its footer, which is as long as the file has row groups and therefore read once, not for each."""
    return pq.ParquetFile(source, metadata=found, page_checksum_verification=True)


def _is_damaged(file: pq.ParquetFile, group: int) -> bool:
    """Whether a page of the row group cannot be decoded or contradicts its checksum."""
    try:
        for _ in file.iter_batches(_BATCH_ROWS, row_groups=[group]):
            pass
    except (pa.ArrowException, OSError) as error:
        # The store's own failures carry a number of the operating system.
        if getattr(error, "errno", None) is not None:
            raise
        return True
    return False


def _row(file: str, size: int, content: bytes | None, pages: bool) -> tuple:
    with _opened(file, content) as source:
        found = _metadata(source)
        if found is None:
            return file, size, None, None, [], NO_FOOTER, None
        columns = [found.schema.column(i) for i in range(found.num_columns)]
        print_ = "|".join(f"{c.path}:{c.physical_type}:{c.logical_type}:{c.max_repetition_level}" for c in columns)
        checked = _checked(source, found)
        damaged = [g for g in range(found.num_row_groups) if pages and _is_damaged(checked, g)]
        lost = sum(found.row_group(g).num_rows for g in damaged)
        return file, size, print_, found.num_rows, damaged, BAD_GROUPS if damaged else None, lost


def catalogue(files: DataFrame, pages: bool = False) -> DataFrame:
    """A row for each of the ``listed`` Parquet files: file, bytes, schema print, rows, damaged row groups, reason, rows lost.

    ``reason`` is null for a sound file; rows lost are null where no footer tells them. ``pages`` decodes every page, which
    reads the data once; otherwise only footers are read.
    """

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(*(batch.column(c)[k].as_py() for c in ("file", "bytes", "content")), pages) for k in range(batch.num_rows)]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    target = to_arrow_schema(T.StructType.fromDDL(_SCHEMA))
    names, kinds = target.names, target.types
    spark = files.sparkSession
    # Opening a file is the work, whatever its size: dealt by name, not by the bytes that a scan would cost.
    dealt = files.repartition(spark.sparkContext.defaultParallelism * 4, "file")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, 1 if files.filter("content is not null").limit(1).count() else before)
    try:
        return stored(dealt.mapInArrow(examine, _SCHEMA), "parquet-files")
    finally:
        spark.conf.set(key, before)


def report(files: DataFrame) -> DataFrame:
    """file, reason and rows_lost of the files of a catalogue that cannot be read whole."""
    return files.filter("reason is not null").select("file", "reason", "rows_lost")


def _sound_groups(spark: SparkSession, damaged: list[tuple[str, list[int]]], schema: T.StructType) -> DataFrame:
    """The sound row groups of damaged files of one schema."""
    skipped = dict(damaged)
    target = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file = batch.column("file")[k].as_py()
                with _opened(file, batch.column("content")[k].as_py()) as source:
                    found, left_out = _metadata(source), set(skipped[file])
                    sound = [group for group in range(found.num_row_groups) if group not in left_out]
                    for rows in _checked(source, found).iter_batches(_BATCH_ROWS, row_groups=sound):
                        table = pa.Table.from_batches([rows]).select(target.names)
                        yield from table.cast(target, safe=False).to_batches()

    files = listed(spark, list(skipped)).repartition(len(skipped), "file")
    return files.mapInArrow(read, schema)


def frames(spark: SparkSession, files: DataFrame) -> list[DataFrame]:
    """The readable rows of a catalogue's files, a frame for each schema.

    Only names come to the driver, as they do for any scan that Spark plans, grouped by the executors.
    """
    whole = F.struct("file", "damaged")
    groups = files.filter("print is not null").groupBy("print").agg(
        F.array_sort(F.collect_list(F.when(F.size("damaged") == 0, F.col("file")))).alias("sound"),
        F.array_sort(F.collect_list(F.when(F.size("damaged") > 0, whole))).alias("damaged"),
    )
    found = []
    for group in groups.orderBy("print").collect():
        damaged = [(row["file"], row["damaged"]) for row in group["damaged"]]
        if group["sound"]:
            found.append(spark.read.parquet(*group["sound"]))
        if damaged:
            found.append(_sound_groups(spark, damaged, spark.read.parquet(damaged[0][0]).schema))
    return found
