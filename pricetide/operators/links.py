"""Product links: filters, first-seen de-duplication, last-modified lookup."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.functions import dates, text


def contains_path(url: Column, part: str) -> Column:
    return text.mentions(url, part)


def product_slug(url: Column) -> Column:
    """Laptop detail page: section path, long dashed slug, no spare parts. Case matters."""
    slug = text.last_segment(url)
    return (
        F.contains(url, F.lit("/may-tinh-xach-tay/"))
        & F.contains(slug, F.lit("-"))
        & (F.length(slug) > 20)
        & ~F.contains(url, F.lit("linh-kien"))
    )


def starts_with_any(href: Column, prefixes: list[str]) -> Column:
    ok = F.lit(False)
    for prefix in prefixes:
        ok = ok | F.startswith(href, F.lit(prefix))
    return ok


# Which links of a shop are product pages.
URL_RULES = {
    "gearvn": lambda c: contains_path(c, "/products/laptop"),
    "tgdd": lambda c: contains_path(c, "/laptop/"),
    "fptshop": product_slug,
    "fptshop_anchor": lambda c: starts_with_any(c, ["/may-tinh-xach-tay/", "/laptop"]),
}


def filter_urls(df: DataFrame, rule: str, column: str = "url") -> DataFrame:
    return df.filter((F.col(column) != "") & URL_RULES[rule](F.col(column)))


def named(name: Column) -> Column:
    """Card with a real name; placeholders have none."""
    return text.pystrip(F.coalesce(name, F.lit(""))) != ""


def laptop_name(name: Column) -> Column:
    return F.coalesce(F.startswith(F.lower(text.pystrip(name)), F.lit("laptop")), F.lit(False))


def name_or_sku(name: Column, sku: Column, keyword: str) -> Column:
    key = F.lit(keyword.upper())
    hit = F.contains(F.upper(F.coalesce(name, F.lit(""))), key)
    return hit | F.contains(F.upper(F.coalesce(sku, F.lit(""))), key)


def prune_periods(df: DataFrame, as_of: Column | dt.date, months: int = 3, column: str = "loc") -> DataFrame:
    """Monthly sitemaps not older than ``months`` before ``as_of``; names without a month are dropped."""
    return df.filter(dates.period_month(F.col(column)) >= dates.cutoff_month(as_of, months))


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row per key in the given total order; null keys equal each other.

    A rank limit of 1 is applied on the map side before the shuffle, so a key
    that holds much of the data sends one row per task. Rows are sorted by a hash
    of the keys before the keys themselves: links differ late, a number at once.
    """
    first = Window.partitionBy("_key_hash", *keys).orderBy(*order)
    hashed = df.withColumn("_key_hash", F.xxhash64(*keys))
    return hashed.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") == 1).drop("_rank", "_key_hash")


def last_value_by_url(links: DataFrame, order: str = "pos") -> DataFrame:
    """One row per url with the ``lastmod`` of its last occurrence."""
    return links.groupBy("url").agg(F.max_by("lastmod", order).alias("lastmod"))


def attach_lastmod(records: DataFrame, links: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``source_lastmod`` from a link list with one row per url; '' without a match.

    No broadcast is forced: the link list grows with the crawl, and the
    optimizer broadcasts it by its measured size.
    """
    known = links.select(F.col("url").alias("_url"), F.col("lastmod").alias("_lastmod"))
    joined = records.join(known, F.col(url) == F.col("_url"), "left")
    return joined.withColumn("source_lastmod", F.coalesce("_lastmod", F.lit(""))).drop("_url", "_lastmod")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Stage guard: discovery without any link is an error."""
    if df.isEmpty():
        raise ValueError(f"no {what} found")
    return df
