"""Sitemap files."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide import schema as S
from pricetide.functions import markup, text
from pricetide.operators import links
from pricetide.sources.files import with_file_position

POSITION = ["file_rank", "file", "block", "pos"]


def read_sitemap(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every ``<url>`` entry of the files: ``loc, lastmod`` ('' if absent) and its position.

    The files count in the order of ``paths``; a path may be a folder or glob. The list is short: one path per
    published sitemap.
    """

    def entries(path: str, rank: int) -> DataFrame:
        rows = spark.read.format("xml").option("rowTag", "url").schema(S.SITEMAP_URL).load(path)
        return with_file_position(rows).select(
            F.coalesce("loc", F.lit("")).alias("loc"),
            F.coalesce("lastmod", F.lit("")).alias("lastmod"),
            F.lit(rank).alias("file_rank"),
            "file",
            "block",
            "pos",
        )

    return reduce(DataFrame.unionAll, [entries(path, rank) for rank, path in enumerate(paths)])


def sitemap_links(sitemap: DataFrame, rule: str) -> DataFrame:
    """Product links of a sitemap, ``url, lastmod``: the first entry of a link wins."""
    kept = links.filter_urls(sitemap, rule, "loc")
    return links.keep_first(kept, ["loc"], POSITION).select(F.col("loc").alias("url"), "lastmod")


def read_sitemap_index(spark: SparkSession, paths: list[str], position: bool = False) -> DataFrame:
    """Sub-sitemap addresses of an index: ``loc``, with ``position`` also where they stand."""
    rows = spark.read.format("xml").option("rowTag", "sitemap").schema(S.SITEMAP_INDEX).load(paths)
    return (with_file_position(rows) if position else rows).filter(F.col("loc") != "")


def recent_sitemaps(index: DataFrame, as_of: dt.date | Column, months: int = 3) -> DataFrame:
    return links.prune_periods(index, as_of, months)


def locs(value: Column) -> Column:
    """``<loc>`` texts of a raw sitemap."""
    return F.regexp_extract_all(value, F.lit(r"(?d)<loc>(.*?)</loc>"), F.lit(1))


def loose_locs(value: Column) -> Column:
    """The same for a re-rendered document: attributes, line breaks and inner tags allowed."""
    bodies = F.regexp_extract_all(value, F.lit(r"(?is)<loc\b[^>]*>(.*?)</loc\s*>"), F.lit(1))
    return F.transform(bodies, lambda b: text.pystrip(markup.unescape(markup.strip_tags(b))))


def raw_sitemap_links(raw: DataFrame, column: str = "value") -> DataFrame:
    """Product links of raw sitemap texts, one row per occurrence.

    The loose reading is used for a document in which the strict one finds no product link.
    """
    wanted = links.URL_RULES["fptshop"]
    strict = F.filter(locs(F.col(column)), wanted)
    loose = F.filter(loose_locs(F.col(column)), wanted)
    found = F.when(F.size(strict) > 0, strict).otherwise(loose)
    carried = [c for c in raw.columns if c != column]
    return raw.select(*carried, F.explode(found).alias("url"))


def read_raw_sitemap(spark: SparkSession, paths: list[str]) -> DataFrame:
    return raw_sitemap_links(spark.read.text(paths, wholetext=True))
