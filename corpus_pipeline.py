"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns
a DataFrame that is written as Parquet and read again as the next stage's documents. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import minhash, packing, secret_crf, substring, toxicity
from orderlens.llm.common import Staged, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies (five-word shingles, 0.8 or more).

    Rows without an id stay: nothing tells which of them is meant."""
    classes = minhash.near_classes(docs, size=5, percent=80)
    gone = classes.where("not kept").select("doc_id").distinct()
    kept = docs.join(gone.hint("merge"), "doc_id", "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds."""
    return substring.substring_dedup(docs, spans_column=None)


def secrets_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each secret replaced by a mark."""
    return secret_crf.redact(docs, secret_crf.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their bin, its capacity and their place in it."""
    return packing.pack(packing.word_counts(docs))


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secrets", secrets_redacted),
    ("packing", packed),
]

#: The stages hold trained models and fuzzy matching, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = Staged(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        docs = staged.write(out)
    return docs
