"""The registered queries of the corpus operators and their oracle SQL.

Each query applies its operator with production parameters to its whole table and
derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embeddings, hard_negatives, html_text, minhash, oracles, packing, prefix_trie, secret_crf, substring, suffix, topk, toxicity, url_filter
from .common import table


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_links(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_crf.scan(docs, secret_crf.train(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_crf")


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans are [start, end) in code points of the input text."""
    out = substring.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("removed_spans", lambda s: F.concat_ws(":", s[0], s[1]))
    return out.select(
        "doc_id",
        F.size("removed_spans").cast("long").alias("n_spans"),
        F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0]).alias("n_removed"),
        F.array_join(spans, ",").alias("spans"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = toxicity.judge(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", F.round("tox_score", 6).alias("score"), F.col("tox_categories").alias("categories"), F.col("tox_reject").alias("toxic"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.suffix_dedup(table(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(table(spark, sf_dir, "documents"), size=3, percent=85)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.word_counts(table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


#: (verdict, host, path) of op12.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.default_labels(spark))
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), model, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", moved, "embedding")
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_dedup, op2_secret_scan, op3_bpe_round_trip, op4_html_text, op5_substring_dedup,
        op6_toxicity, op7_top_k, op8_suffix_dedup, op9_minhash_dedup, op10_best_fit_packing, op11_prefix_trie, op12_url_filter, op13_hard_negatives,
    )
}

ORACLE: dict[str, str] = dict(oracles.ORACLE)
