"""A training-corpus pipeline over ``documents``: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm.stages import STAGES
from tripmart.session import shared_dir

__all__ = ["ORACLE_SQL", "STAGES", "run"]

#: Stages 1, 2 and 5 (a fitted scorer, connected components, byte-pair merges) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, "pipeline")
    for place, (name, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
