"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from layerloom.llm import lattice, licenses, minhash, packing, ranking, recompression, secrets, suffixes, topk, toxicity, transducer, urls, whitening
from layerloom.llm.common import prepared, read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# The rules of the url query.
URL_RULES = [
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(prepared(spark), sf_dir, "documents"), TOKENIZER)


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(prepared(spark), sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(prepared(spark), sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(read(prepared(spark), sf_dir, "documents"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(prepared(spark), sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicate_vectors(read(prepared(spark), sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(prepared(spark), sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read(prepared(spark), sf_dir, "pages"), URL_RULES)


def op9_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeated_words(read(prepared(spark), sf_dir, "documents")).drop("kept")


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.round_trip(read(prepared(spark), sf_dir, "documents"), TOKENIZER)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked_search(read(prepared(spark), sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(prepared(spark), sf_dir, "embeddings"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read(prepared(spark), sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_minhash_near_dedup,
        op3_license_scan,
        op4_suffix_array_dedup,
        op5_exact_top_k,
        op6_lattice_near_dedup,
        op7_toxicity,
        op8_url_filters,
        op9_recompression_dedup,
        op10_bpe_round_trip,
        op11_ranked_search,
        op12_whitening,
        op13_secret_scan,
    )
}
