"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts have it: tab to carriage return, and the space.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(columns: Sequence[str], name: str) -> str:
    """``name``, or with underscores appended, such that no column has it (names compare without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """The column of exactly this name, even if it holds dots or back ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def crc32_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id written in decimal, modulo ``buckets``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(buckets))
