"""The operators of this package on the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.llm import bpe, exact, extraction, merkle, minhash, mixing, packing, quality, spelling, substring, topk, toxicity, urls
from statforge.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_naive_bayes_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_pages(table(spark, sf_dir, "pages"))


def op3_cuckoo_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op4_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op9_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op10_min_max_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_part_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_recursive_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.check_manifest(docs, merkle.tampered(docs))


def op13_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_naive_bayes_svm": op1_naive_bayes_svm,
    "op2_tag_path_ratios": op2_tag_path_ratios,
    "op3_cuckoo_exact_dedup": op3_cuckoo_exact_dedup,
    "op4_weak_supervision": op4_weak_supervision,
    "op5_poisson_mixing": op5_poisson_mixing,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_pivot_top_k": op7_pivot_top_k,
    "op8_super_kmers": op8_super_kmers,
    "op9_url_vocabulary": op9_url_vocabulary,
    "op10_min_max_hashing": op10_min_max_hashing,
    "op11_part_enum": op11_part_enum,
    "op12_recursive_climb": op12_recursive_climb,
    "op13_rank_array_bpe": op13_rank_array_bpe,
}

ORACLE: dict[str, str] = {
    "op3_cuckoo_exact_dedup": exact.SQL,
    "op5_poisson_mixing": mixing.mixing_sql(),
    "op7_pivot_top_k": topk.top_k_sql(20),
    "op9_url_vocabulary": urls.url_sql(),
    "op11_part_enum": spelling.variants_sql(),
    "op12_recursive_climb": merkle.manifest_sql(),
}
