"""The numbered queries: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, grace, langmix, merkle, mixing, nbsvm, packing, sanitise, simhash, topk, toxcnn, wavelet, xent
from .common import read_table


def wavelet_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.digest(read_table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.report(read_table(spark, sf_dir, "documents"))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(read_table(spark, sf_dir, "documents"))


def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return topk.search(vectors).select("query_id", "rank", "vec_id", "score")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langmix.identify(read_table(spark, sf_dir, "documents"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxcnn.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def lm_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = read_table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return xent.score(read_table(spark, sf_dir, "documents"), good)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), with_ids=False)


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace.duplicate_report(read_table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


def cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_wavelet_token_output": wavelet_token_output,
    "op2_simhash_near_dedup": simhash_near_dedup,
    "op3_pii_sanitisation": pii_sanitisation,
    "op4_source_mixing": source_mixing,
    "op5_exact_topk": exact_topk,
    "op6_language_id": language_id,
    "op7_toxicity": toxicity,
    "op8_lm_cross_entropy": lm_cross_entropy,
    "op9_best_fit_packing": best_fit_packing,
    "op10_exact_dedup": exact_dedup,
    "op11_quality_classifier": quality_classifier,
    "op12_merkle_manifest": merkle_manifest,
    "op13_cross_tokenizer_alignment": cross_tokenizer_alignment,
}
