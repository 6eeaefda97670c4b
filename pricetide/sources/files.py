"""Positions of rows in files, and plain text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.functions import text


def with_file_position(df: DataFrame) -> DataFrame:
    """Adds ``file``, ``block`` and ``pos``, whose order is the order of rows in the files.

    A file may be read in several blocks; the row counter grows within a block.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


def read_links(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Link files, one ``url[TAB lastmod]`` per line: ``url, lastmod`` and the position. Blank lines are dropped."""
    line = text.pystrip(F.col("value"))
    parts = F.split(line, "\t")
    lines = with_file_position(spark.read.text(paths)).filter(line != "")
    return lines.select(
        F.get(parts, F.lit(0)).alias("url"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("lastmod"),
        "file",
        "block",
        "pos",
    )


def link_lastmods(links: DataFrame) -> DataFrame:
    """``url, lastmod`` with the last entry of a repeated url."""
    order = F.struct("file", "block", "pos")
    return links.groupBy("url").agg(F.max_by("lastmod", order).alias("lastmod"))


def read_page_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Saved page files, whole: ``url`` (the file) and ``html``."""
    pages = spark.read.text(paths, wholetext=True)
    return pages.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages table: ``page_id, url, html``."""
    return spark.read.schema("page_id bigint, url string, html string").parquet(path)
