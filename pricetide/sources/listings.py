"""Captured responses of a paged listing API."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide import schema as S
from pricetide.session import folders, stage


def read_listing(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """JSON lines ``{"page": n, "body": "<response text>"}`` as captured."""
    return spark.read.schema("listing string, page int, body string").json(paths)


def listing_links(responses: DataFrame, host: str, listing: list[str]) -> DataFrame:
    """Product links of all pages before the first empty or unreadable one, per listing.

    ``responses``: the listing key columns, ``page`` and ``body``.
    """
    # Bodies are parsed once; only the link names go on.
    return _before_end(stage(_names(responses, listing), "listing"), host, listing)


_EMPTY = "coalesce(size(names), 0) <= 0"


def _names(responses: DataFrame, listing: list[str]) -> DataFrame:
    products = F.from_json("body", S.LISTING_BODY)["data"]["products"]
    return responses.select(*listing, "page", F.transform(products, lambda p: p["canonical"]).alias("names"))


def _before_end(slim: DataFrame, host: str, listing: list[str]) -> DataFrame:
    ends = slim.groupBy(*listing).agg(F.min(F.when(F.expr(_EMPTY), F.col("page"))).alias("_end"))
    before_end = F.col("_end").isNull() | (F.col("page") < F.col("_end"))
    items = (
        slim.join(ends, listing)
        .filter(before_end)
        .select(*listing, "page", F.posexplode("names").alias("pos", "canonical"))
    )
    return items.filter(F.col("canonical") != "").select(
        *listing, "page", "pos", F.concat(F.lit(host + "/"), F.col("canonical")).alias("url")
    )


def scan_listing(spark: SparkSession, root: str, host: str, listing: list[str], columns: str, ahead: int = 4) -> DataFrame:
    """Product links of captured responses laid out as ``page=N`` folders, without reading behind the end.

    Pages are read in order, ``ahead`` at a time, until every listing of the first turn has had an empty or unreadable
    one; the folders behind that turn are not opened (with ``ahead=1`` none behind the last end). A listing begins in the
    first turn. ``columns`` is the schema of the listing columns and ``body``. The links are those of
    :func:`listing_links` over all pages.
    """
    pages = sorted(int(name.split("=")[1]) for name in folders(spark, root) if name.startswith("page="))
    found, ended, seen, at = [], None, None, 0
    while at < len(pages):
        turn = pages[at : at + ahead]
        at += len(turn)
        paths = [f"{root}/page={n}" for n in turn]
        bodies = spark.read.schema(columns).option("basePath", root).json(paths).withColumn("page", F.col("page").cast("int"))
        if ended is not None:
            bodies = bodies.join(ended, listing, "left_anti")
        parsed = stage(_names(bodies, listing), "listing")
        found.append(_before_end(parsed, host, listing))
        stops = parsed.where(_EMPTY).select(*listing).distinct()
        seen = stage(parsed.select(*listing).distinct(), "listings") if seen is None else seen
        ended = stage(stops if ended is None else ended.unionByName(stops), "ended")
        if seen.join(ended, listing, "left_anti").isEmpty():
            break
    if not found:
        raise ValueError("no pages found")
    return reduce(DataFrame.unionByName, found)
