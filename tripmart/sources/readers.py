"""Trip and zone readers: by file type, by column name ignoring case, strict or error-tolerant."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schemas import TRIPS, ZONES
from tripmart.sources import footers

REJECTED = "_rejected_record"
# Conditions under which files have different schemas, or a footer cannot be read: the catalogue tells which.
_DRIFT = ("CANNOT_MERGE_SCHEMAS", "AMBIGUOUS_REFERENCE", "COLUMN_ALREADY_EXISTS", "CANNOT_READ_FILE_FOOTER")


def match_columns(df: DataFrame, contract: T.StructType, extras: bool = False, strict: bool = True) -> DataFrame:
    """Selects the contract's columns by name ignoring case; absent ones become null.

    ``strict`` raises on a value that does not fit its type, otherwise the value becomes null. ``extras`` keeps
    columns outside the contract at the end.
    """
    found = {name.lower(): name for name in df.columns}
    picked = []
    for field in contract:
        source = found.pop(field.name.lower(), None)
        if source is None:
            column = F.lit(None).cast(field.dataType)
        elif df.schema[source].dataType == field.dataType:
            column = F.col(f"`{source}`")
        else:
            raw = F.col(f"`{source}`")
            column = raw.cast(field.dataType) if strict else raw.try_cast(field.dataType)
        picked.append(column.alias(field.name))
    if extras:
        picked += [F.col(f"`{name}`") for name in found.values()]
    return df.select(*picked)


def _found_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The data files below files, folders or globs. Names only; no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return sorted(row["path"] for row in listed.select("path").collect())


def _by_header(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Header line -> CSV files that begin with it. Only the first block of each file is read."""
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    first = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("line"),
    ).filter("start = 0")
    found: dict[str, list[str]] = {}
    for row in first.groupBy("file").agg(F.min_by("value", "line").alias("header")).orderBy("file").collect():
        found.setdefault(row["header"], []).append(unquote(row["file"]))
    return found


def _csv_texts(spark: SparkSession, path: str | list[str], mode: str) -> list[DataFrame]:
    """Headed CSV with optional quotes, every field as text; a row of the wrong length fills ``_rejected_record``.

    Files may have different headers; those with one header are read together. Values are typed by expressions
    afterwards. Spark's own typed reader looks only at the columns a query selects, so which rows count as bad would
    change from query to query.
    """
    frames = []
    for header, files in _by_header(spark, [path] if isinstance(path, str) else list(path)).items():
        reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
        names = next(csv.reader([header.lstrip("\ufeff")]), [])
        fields = [T.StructField(name.strip(), T.StringType()) for name in names]
        if mode == "PERMISSIVE":
            fields.append(T.StructField(REJECTED, T.StringType()))
            reader = reader.option("columnNameOfCorruptRecord", REJECTED)
        reader = reader.schema(T.StructType(fields)).option("columnPruning", False).option("mode", mode)
        frames.append(reader.csv(files))
    return frames


def _parsed(text: Column, kind: T.DataType) -> Column:
    """Text as a value, null if unreadable. Whole numbers may be written with decimals."""
    if isinstance(kind, T.LongType):
        return F.round(text.try_cast("decimal(38,6)")).try_cast("bigint")
    return text.try_cast(kind)


def _typed(raw: DataFrame, contract: T.StructType) -> dict[str, tuple[Column, Column]]:
    """For each contract column its value and whether what the file has for it is unreadable."""
    found = {name.lower(): name for name in raw.columns}
    typed = {}
    for field in contract:
        name = found.get(field.name.lower())
        if name is None:
            typed[field.name] = (F.lit(None).cast(field.dataType), F.lit(False))
            continue
        source = F.col(f"`{name}`")
        if raw.schema[name].dataType == field.dataType:
            value = source
        elif isinstance(raw.schema[name].dataType, T.StringType):
            value = _parsed(source, field.dataType)
        else:
            value = source.try_cast(field.dataType)
        typed[field.name] = (value, source.isNotNull() & value.isNull())
    return typed


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def _bad(raw: DataFrame, typed: dict[str, tuple[Column, Column]]) -> Column:
    wrong_length = F.col(REJECTED).isNotNull() if REJECTED in raw.columns else F.lit(False)
    return wrong_length | _any(unreadable for _, unreadable in typed.values())


def _accepted(raw: DataFrame, contract: T.StructType, tolerant: bool, extras: bool = False) -> DataFrame:
    """``raw`` in the contract's columns. ``tolerant`` skips rows with an unreadable value, otherwise they raise."""
    typed = _typed(raw, contract)
    known = {field.name.lower() for field in contract}
    others = [F.col(f"`{name}`") for name in raw.columns if extras and name.lower() not in known]
    if tolerant:
        return raw.filter(~_bad(raw, typed)).select(*[v.alias(name) for name, (v, _) in typed.items()], *others)
    return raw.select(
        *[
            F.when(unreadable, F.raise_error(F.lit(f"unreadable value in column {name}")).cast(contract[name].dataType))
            .otherwise(value)
            .alias(name)
            for name, (value, unreadable) in typed.items()
        ],
        *others,
    )


def _together(frames: list[DataFrame], spark: SparkSession, contract: T.StructType) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], contract)
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def read_csv(spark: SparkSession, path: str | list[str], contract: T.StructType, tolerant: bool = False) -> DataFrame:
    """CSV in the contract's columns. ``tolerant`` skips rows that are short, long or unreadable, else they raise."""
    texts = _csv_texts(spark, path, "PERMISSIVE" if tolerant else "FAILFAST")
    return _together([_accepted(text, contract, tolerant) for text in texts], spark, contract)


def _parquet_groups(spark: SparkSession, files: list[str], tolerant: bool) -> list[DataFrame]:
    """Parquet files, together if their schemas merge, else by schema, each group under its own.

    Merging is one distributed pass over the footers. If types drifted between files, or any file may be damaged, executors
    make a catalogue of the files.
    """
    if not tolerant:
        try:
            merged = spark.read.option("mergeSchema", True).parquet(*files)
            merged.select(*[F.col(f"`{name}`") for name in merged.columns])
            return [merged]
        except (PySparkException, Py4JJavaError) as error:
            if not any(condition in str(error) for condition in _DRIFT):
                raise
    found = footers.catalogue(footers.listed(spark, files), pages=tolerant)
    if not tolerant and (bad := footers.report(found).limit(3).collect()):
        raise ValueError(f"files without a readable footer, such as {[row['file'] for row in bad]}")
    return footers.frames(spark, found)


def unreadable_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, reason and rows_lost of what a tolerant load leaves out of the Parquet files below ``path``."""
    return footers.report(footers.catalogue(footers.named_parquet(footers.listed(spark, path)), pages=True))


def _parquet_files(files: list[str]) -> list[str]:
    return [file for file in files if file.lower().endswith((".parquet", ".parq"))]


def _raw_frames(spark: SparkSession, path: str | list[str], fmt: str | None, tolerant: bool, permissive: bool) -> list[DataFrame]:
    """The files below ``path`` as they are, Parquet by its own types and CSV as text; the kind goes by each file."""
    paths = [path] if isinstance(path, str) else list(path)
    files = _found_files(spark, paths)
    parquet = files if fmt == "parquet" else [] if fmt == "csv" else _parquet_files(files)
    texts = [file for file in files if file not in set(parquet)]
    frames = _parquet_groups(spark, parquet, tolerant) if parquet else []
    if texts:
        frames += _csv_texts(spark, texts, "PERMISSIVE" if permissive else "FAILFAST")
    return frames


def rejected_rows(
    spark: SparkSession, path: str | list[str], contract: T.StructType, fmt: str | None = None
) -> DataFrame:
    """The rows a tolerant load skips: what could be read, and the row's text as ``_rejected_record``."""
    frames = []
    for raw in _raw_frames(spark, path, fmt, tolerant=True, permissive=True):
        typed = _typed(raw, contract)
        fields = [F.col(f"`{name}`") for name in raw.columns if name != REJECTED]
        text = F.to_csv(F.struct(*fields))
        frames.append(
            raw.filter(_bad(raw, typed)).select(
                *[value.alias(name) for name, (value, _) in typed.items()],
                (F.coalesce(REJECTED, text) if REJECTED in raw.columns else text).alias(REJECTED),
            )
        )
    return _together(frames, spark, T.StructType([*contract, T.StructField(REJECTED, T.StringType())]))


def read_trips(
    spark: SparkSession,
    path: str | list[str],
    fmt: str | None = None,
    tolerant: bool = False,
    evolve: bool = False,
) -> DataFrame:
    """Raw trips from files, folders or globs, by column name ignoring case, absent columns as null.

    Without ``fmt`` each file's name tells Parquet from CSV. A column may have different types in different files;
    values are cast to the contract, and one that does not fit raises, or with ``tolerant`` its row is left out (see
    ``rejected_rows``). What cannot be read of a damaged Parquet file, a tolerant load leaves out as well, by row groups,
    and ``unreadable_files`` names it; for that every page is read before the load. ``evolve`` keeps unknown columns.
    """
    frames = _raw_frames(spark, path, fmt, tolerant, permissive=tolerant)
    return _together([_accepted(raw, TRIPS, tolerant, evolve) for raw in frames], spark, TRIPS)


def read_zones(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    return read_csv(spark, path, ZONES, tolerant)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
