"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns the columns of ``docs``, but the last."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import bpe, jaccard, mixing, pii, toxicity
from tripmart.llm.common import fresh


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the documents that score below the threshold. The lexicon is learned from those that are in ``docs``."""
    lexicon = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = fresh(docs.columns, "_score")
    return toxicity.score(docs, lexicon, score).filter(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the document of smallest id of each group that links connect; of rows with one id, one stays.

    Documents without an id or without words link with nothing and stay.
    """
    groups = jaccard.linked_components(docs)
    others = groups.filter("component_id != doc_id").select("doc_id").distinct()
    left = docs.join(others, "doc_id", "left_anti").select(*docs.columns)
    again = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if not again.limit(1).count():
        return left
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).union(
        left.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    )


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces what is found by its kind; ``n_chars`` follows the text."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that each source comes near its target."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document that is left, once for each copy."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode(docs, path, bpe.fit(docs, path), decoded=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("pii", mask_personal_data),
    ("mix", mix_sources),
    ("bpe", encode),
]
