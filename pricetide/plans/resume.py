"""Jobs that go on where an earlier application stopped."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.operators import links as link_ops
from pricetide.plans import jobs
from pricetide.session import folders
from pricetide.sinks.pending import read_pending, update_pending
from pricetide.sources import files, sitemaps


def file_key(spark: SparkSession, path: str, glob: str = "*") -> str:
    """Names, sizes and times of the files below a path, as one number; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    listed = reader.load(path).select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h"))
    row = listed.agg(F.count("h").alias("n"), F.sum("h").alias("h")).first()
    return f"{row['n']}:{row['h']}"


def step(spark: SparkSession, root: str, name: str, inputs: object, make: Callable[[], DataFrame]) -> DataFrame:
    """Result of a step: found again below ``root`` if it was finished for the same inputs, otherwise made and kept.

    ``inputs`` is whatever decides the result, as plain values (parameters, ``file_key`` of what is read). A result
    counts as finished by the mark that Spark's writer leaves last; half a result is written anew.
    """
    key = hashlib.sha256(json.dumps([name, inputs], sort_keys=True, default=str).encode()).hexdigest()[:32]
    path = f"{root}/{name}-{key}"
    if "_SUCCESS" not in folders(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def discover(spark: SparkSession, index: list[str], rule: str, as_of: dt.date, months: int = 3, locate: Callable[[str], str] = str) -> DataFrame:
    """Product links, ``url, lastmod``, of the recent sub-sitemaps of an index; the first entry of a link wins.

    The names of the recent ones (one per month and page) are known before the scan is planned, so no other file is
    listed or opened. ``locate`` gives the captured file of an address.
    """
    recent = sitemaps.recent_sitemaps(sitemaps.read_sitemap_index(spark, index, position=True), as_of, months)
    names = [r["loc"] for r in recent.orderBy("file", "block", "pos").toLocalIterator()]
    paths = list(dict.fromkeys(locate(name) for name in names))
    if not paths:
        raise ValueError("no recent sitemaps found")
    return link_ops.require_rows(sitemaps.sitemap_links(sitemaps.read_sitemap(spark, paths), rule), "links")


def work_list(
    spark: SparkSession, store: str, total: int, pending: str, stored_links: str | None, find: Callable[[], DataFrame]
) -> DataFrame:
    """Work of a store's run by precedence: what any store left pending, a stored link list, discovery (``find``).

    Only what comes first is read. On a retry run a store without pending links has no work.
    """
    left = read_pending(spark, pending)
    if left is not None and not left.isEmpty():
        return jobs.plan_shards(left.select("url", "lastmod"), store, total, left)
    if stored_links is not None and folders(spark, stored_links):
        return jobs.plan_shards(files.link_lastmods(files.read_links(spark, stored_links)), store, total)
    return jobs.plan_shards(find(), store, total)


def crawl_run(work: DataFrame, pages: DataFrame, store: str, pending: str) -> DataFrame:
    """Judge a run's captured pages, bring the pending table up to date, and return the links left of this run."""
    log = jobs.crawl_log(work, pages, store)
    update_pending(jobs.after_run(log), log, pending)
    left = read_pending(work.sparkSession, pending)
    return jobs.after_run(log).limit(0) if left is None else left.where(F.col("store") == store)
