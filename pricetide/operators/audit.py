"""Counts and audits: overlap of collections, distinct links, store report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pairs(members: DataFrame) -> DataFrame:
    """Occurrences per (link, page), pre-aggregated: a link's rows are never gathered."""
    return members.groupBy("link", "page_name").agg(
        F.count(F.lit(1)).alias("n_in_page"),
        F.min_by("name", "seq").alias("name_in_page"),
        F.min("seq").alias("seq_in_page"),
    )


def _totals(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("link").agg(
        F.sum("n_in_page").alias("n"),
        F.min_by("name_in_page", "seq_in_page").alias("first_name"),
        F.min("seq_in_page").alias("first_seq"),
    )


def overlap_links(members: DataFrame) -> DataFrame:
    """Links that occur more than once, one row per page they occur on.

    ``members``: ``page_name, name, link, seq``. Occurrences count, so a link
    listed twice on one page is shared too. With all columns in use, both sides
    of the join read the same shuffle of the members.
    """
    pairs = _pairs(members)
    shared = _totals(pairs).filter(F.col("n") > 1)
    return pairs.join(shared, "link").select(
        "link", "first_name", "first_seq", "n", "page_name", "name_in_page", "seq_in_page", "n_in_page"
    )


def overlap_by_page(members: DataFrame) -> DataFrame:
    """Per page: rows, rows whose link occurs once, rows whose link is shared."""
    pairs = members.groupBy("link", "page_name").agg(F.count(F.lit(1)).alias("n_in_page"))
    totals = pairs.groupBy("link").agg(F.sum("n_in_page").alias("n"))
    once = F.col("n") == 1
    return (
        pairs.join(totals, "link")
        .groupBy("page_name")
        .agg(
            F.sum("n_in_page").alias("n_rows"),
            F.sum(F.when(once, F.col("n_in_page")).otherwise(0)).alias("n_unique"),
            F.sum(F.when(~once, F.col("n_in_page")).otherwise(0)).alias("n_shared"),
        )
    )


def link_counts(links: DataFrame, column: str = "link") -> DataFrame:
    """All and distinct links, one row."""
    return links.agg(F.count(column).alias("n_links"), F.count_distinct(column).alias("n_unique"))


def store_report(catalog: DataFrame, registry: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """Status and row count per registered store, and a total over the stores that are ok.

    ``catalog`` has a ``store`` column. ``present`` lists the stores whose table
    could be read (column ``store``); a table without rows is ``empty``, a
    store not listed is ``missing``. Without it, a store without rows is ``missing``.
    """
    counts = catalog.groupBy("store").agg(F.count(F.lit(1)).alias("_n"))
    joined = registry.select("store", "sheet_name").join(counts, "store", "left")
    if present is not None:
        joined = joined.join(present.select("store").distinct().withColumn("_here", F.lit(True)), "store", "left")
        here = F.col("_here").isNotNull()
    else:
        here = F.col("_n").isNotNull()
    status = F.when(F.col("_n") > 0, "ok").when(here, "empty").otherwise("missing")
    return with_total(joined.select("sheet_name", status.alias("status"), F.coalesce("_n", F.lit(0)).alias("n_rows")))


def with_total(lines: DataFrame) -> DataFrame:
    """Report lines (``sheet_name, status, n_rows``) and their total."""
    return (
        lines.rollup("sheet_name")
        .agg(
            F.when(F.grouping("sheet_name") == 1, F.lit("total")).otherwise(F.max("status")).alias("status"),
            F.sum("n_rows").alias("n_rows"),
            F.grouping("sheet_name").cast("int").alias("is_total"),
        )
        .select(F.coalesce("sheet_name", F.lit("TOTAL")).alias("sheet_name"), "status", "n_rows", "is_total")
    )


def report_lines(report: DataFrame) -> DataFrame:
    """Report rows as text, the total last."""
    line = (
        F.when(F.col("is_total") == 1, F.format_string("Tổng cộng: %d sản phẩm", "n_rows"))
        .when(F.col("status") == "ok", F.format_string("%s: %d sản phẩm", "sheet_name", "n_rows"))
        .when(F.col("status") == "empty", F.format_string("%s: bảng trống (0 sản phẩm)", "sheet_name"))
        .when(F.col("status") == "error", F.format_string("%s: lỗi", "sheet_name"))
        .otherwise(F.format_string("%s: không có dữ liệu", "sheet_name"))
    )
    return report.withColumn("value", line).orderBy("is_total", "sheet_name")
