"""The registered queries of the operators, and their SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pricetide.llm import bpe, extraction, fingerprint, itq, langid, licenses, ngram_join, packing, pii, prefix_trie, repair, suffix_dedup, toxicity
from pricetide.llm.common import held_out, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return bpe.decode(ids, RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


WORDS = public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORDS)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted, "terms")


# Pseudonyms are as secret as this key; a real run passes its own.
KEY = b"public demonstration key"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), wrapped=True)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited(table(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "languages")


def op10_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(table(spark, sf_dir, "conversations"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_ngram_join, op3_bpe, op4_toxicity, op5_pii, op6_licenses, op7_fingerprints, op8_langid, op9_packing,
        op10_itq, op11_extraction, op12_repair, op13_trie,
    )
}

SQL: dict[str, str] = {"op6_licenses": licenses.scan_sql()}
