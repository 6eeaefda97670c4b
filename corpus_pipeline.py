"""The training-data pipeline: documents through five stages, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricetide.llm import langid, ngram_join, packing, pii, queries, suffix_dedup
from pricetide.llm.common import table
from pricetide.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or text go: no language can be told."""
    return langid.identified(docs, langid.fit(docs))


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return ngram_join.first_of_each(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that stand elsewhere too are taken out; the document stays."""
    return _measured(suffix_dedup.without_repeats(docs))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms of their format, under the session's key (``spark.pricetide.key``).

    Without one the key of the test queries is taken, which is public: anyone can undo those pseudonyms.
    """
    own = spark.conf.get("spark.pricetide.key", None)
    key = own.encode() if own else queries.KEY
    return _measured(pii.pseudonyms(docs, key).select(*[f"`{c}`" for c in docs.columns]))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, in sequences that are as full as can be."""
    return packing.pack_documents(docs, queries.WORDS)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify),
    ("near-copies", join_near_copies),
    ("repeats", remove_repeats),
    ("private", replace_private),
    ("packing", pack),
]

# The language model, the ciphers and the packing of the stages have no SQL form; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
