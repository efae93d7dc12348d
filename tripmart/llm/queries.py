"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import ann, bpe, collocations, impacts, jaccard, language, lexical, mixing, pii, quality_rules, suffixes, tokenfile, toxicity
from tripmart.llm.common import crc32_bucket, documents
from tripmart.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    _QUERIES[make.__name__] = make
    return make


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    tokenfile.write(documents(spark, sf_dir), path, tokenizer_path())
    return tokenfile.index(spark, path)


@query
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    encoded = bpe.encode(docs, tokenizer_path(), bpe.fit(docs, tokenizer_path()))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.removed(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    lexicon = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, lexicon, "score").select(
        "doc_id",
        (crc32_bucket(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir)).drop("rejected_by")


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned, names = mixing.planned_copies(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col(names["copies"])).alias("taken")
    )


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs)
    return language.identify(docs.select("doc_id", "text"), model, "found").select(
        "doc_id",
        (crc32_bucket(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(documents(spark, sf_dir).select("doc_id", "text"), "found")
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}") for kind in pii.BASE
    ]
    base = pii.joined(F.filter("found", lambda s: s["base"]))
    return found.select(
        "doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), pii.joined(F.col("found")).alias("spans")
    )


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(documents(spark, sf_dir))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op12_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impacts.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))
