"""Spec pairs spread over rows, and filters on specs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.functions import specs

# Words in the names of graphics specs.
GPU_KEYS = ["card", "đồ họa", "vga", "gpu"]


def spec_rows(pairs: DataFrame, record: list[str], keep: str = "last", order: str = "pos") -> DataFrame:
    """One row per (record, key): place of the key's first occurrence, first or last value.

    Stays in rows, so a record with very many pairs is never gathered in one task.
    """
    pick = F.min_by if keep == "first" else F.max_by
    return pairs.groupBy(*record, "key").agg(
        F.min(order).alias("key_pos"), pick("value", order).alias("value"), F.count(F.lit(1)).alias("n_values")
    )


def with_spec(df: DataFrame, key_words: list[str], value_part: str, column: str = "specs") -> DataFrame:
    """Records with a pair whose key contains one of the words and whose value contains the part."""
    return df.filter(specs.any_spec(F.col(column), key_words, value_part))


def clean(pairs: Column) -> Column:
    """Complete pairs only, last value per key."""
    return specs.dedup_pairs(specs.clean_pairs(pairs))
