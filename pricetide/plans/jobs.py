"""The entry points of the pipeline as DataFrame jobs."""

from __future__ import annotations

from urllib.parse import unquote

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricetide import schema as S
from pricetide.functions import markup
from pricetide.operators import audit, breaker, extract, links, position, records, specs
from pricetide.session import folders, remove, stage
from pricetide.sinks import tables as sink
from pricetide.sources import tables as source

CARRY = ("store", "chunk", "run")


def plan_shards(product_links: DataFrame, store: str, total: int, pending: DataFrame | None = None) -> DataFrame:
    """Work list of a store: ``store, chunk, idx`` (place in the chunk), ``url, lastmod``.

    On a retry run (anything pending in any store) it is the store's pending
    list as it stands, without new shards.
    """
    columns = ["store", "chunk", "idx", "url", "lastmod"]
    # Discovery and the breaker run once; their rows are looked at more than once.
    pending = stage(pending, "pending") if pending is not None else None
    if pending is not None and not pending.isEmpty():
        return pending.filter(F.col("store") == store).select(columns)
    known = links.require_rows(stage(product_links, "links"), "links")
    chunks = position.assign_chunks(known, "url", total).withColumnRenamed("idx", "_all")
    return (
        chunks.join(known, "url")
        .withColumns({"store": F.lit(store), "idx": F.col("chunk_idx")})
        .select(columns)
    )


def crawl_log(work: DataFrame, pages: DataFrame, store: str) -> DataFrame:
    """Outcome of every link of a work list, judged from its captured page.

    ``fail``: no page, or an interstitial instead of it; ``neutral``: a page
    without the structured product its layout needs; ``ok`` otherwise.
    ``pages``: one row per ``url``.
    """
    shop = S.SHOPS[store]
    html = F.col("html")
    title, heading = markup.tag_body(html, "title"), markup.strip_tags(markup.tag_body(html, "h1"))
    blocked = markup.is_challenge(title, heading, shop.host.split("//")[1])
    outcome = F.when(html.isNull() | blocked, "fail")
    if store == "gearvn":
        outcome = outcome.when(markup.json_ld_product(html).isNull(), "neutral")
    judged = pages.select("url", outcome.otherwise("ok").alias("outcome"))
    log = work.join(judged, "url", "left").withColumn("outcome", F.coalesce("outcome", F.lit("fail")))
    # The log is small next to the pages and read more than once.
    return stage(log, "crawl-log")


def restart_overlap() -> Column:
    """Links that a store's next run takes again before the last three failures."""
    cases = [F.when(F.col("store") == store, F.lit(n)) for store, n in S.RESTART_OVERLAP.items()]
    return F.coalesce(*cases, F.lit(0))


def after_run(log: DataFrame, overlap: int | Column | None = None) -> DataFrame:
    """Pending links of a crawl log (``store, chunk, idx, url, lastmod, outcome``); finished shards leave none.

    The overlap is that of the store unless one is given.
    """
    left = breaker.pending_links(log, ["store", "chunk"], overlap=restart_overlap() if overlap is None else overlap)
    return left.select("store", "chunk", "idx", "url", "lastmod")


def shard_tables(pages: DataFrame, store: str, lastmods: DataFrame | None = None) -> DataFrame:
    """Captured pages of one store to its shop table.

    ``pages``: ``store, chunk, run, url, html, captured_at``; ``lastmods``: one row per url.
    """
    shop = S.SHOPS[store]
    usable = extract.drop_challenges(pages, shop.host.split("//")[1]) if store in S.CHALLENGED else pages
    found = extract.with_discount(extract.extract_fields(usable, store))
    if lastmods is not None and S.LASTMOD in shop.headers:
        found = links.attach_lastmod(found, lastmods)
    return records.shop_rows(found, shop.headers, shop.spec_sep, CARRY)


def topic_table(pages: DataFrame, value_part: str) -> DataFrame:
    """Single-topic table: products whose graphics spec mentions ``value_part``; the shown discount is kept."""
    found = specs.with_spec(extract.extract_fields(pages, "gearvn_topic"), specs.GPU_KEYS, value_part)
    clean = found.withColumn("specs", specs.clean(F.col("specs")))
    return records.shop_rows(extract.with_discount(clean, keep_scraped=True), S.TOPIC_HEADERS)


def merge_and_publish(spark: SparkSession, bronze: str, silver: str, catalog: str, tidy: bool = False, unreadable: str | None = None) -> DataFrame:
    """Merge all shards into the per-store table, append them to the catalog, report the counts.

    All stores go through one job; the tables differ in headers only. Damaged shard files are left out and, with
    ``unreadable``, listed there (``file, rows, modified, error``). With ``tidy`` the files that were merged are removed.
    """
    shards, found = source.checked_shards(spark, bronze)
    if unreadable is not None:
        found.where("error IS NOT NULL").write.mode("append").parquet(unreadable)
    sink.write_stores(records.merge_shards(shards, source.SHARD_ORDER), silver)
    table = source.read_workbook(spark, silver, S.SILVER)
    sink.write_catalog(table, catalog)
    if tidy:
        sink.remove_merged(found)
    return audit.store_report(table, S.registry(spark))


def build_workbook(spark: SparkSession, root: str, path: str) -> list[str]:
    """The topic workbook anew from the shops' topic tables: a sheet per shop, prices as numbers, no discount column.

    Returns the sheets whose shop has no table below ``root``; they are not in the workbook.
    """
    found, missing = source.read_registered(spark, root, {s.key: s.topic_file for s in S.SHOPS.values()})
    if found:
        sheets = {S.SHOPS[store].topic_sheet: records.topic_numbers(df) for store, df in found.items()}
        sink.rewrite(records.union_stores(sheets), path)
    return [S.SHOPS[store].topic_sheet for store in missing]


def repair_workbook(spark: SparkSession, root: str, path: str, store: str = "tgdd") -> list[str]:
    """A shop's discounts computed anew, in its topic table and in its sheet; other sheets are not touched.

    What is not there is passed over; returns the paths that were repaired.
    """
    shop, done = S.SHOPS[store], []
    found, _ = source.read_registered(spark, root, {store: shop.topic_file})
    if found:
        done.append(f"{root}/{shop.topic_file}")
        sink.rewrite(records.topic_repair_discount(found[store]), done[-1], None)
    if shop.topic_sheet in {unquote(name.removeprefix("store=")) for name in folders(spark, path)}:
        sheet = source.read_workbook(spark, path, S.WORKBOOK).where(F.col("store") == shop.topic_sheet)
        sink.write_stores(stage(records.topic_repair_discount(sheet), "sheet"), path)
        done.append(path)
    return done


def clean_workbook(spark: SparkSession, path: str) -> None:
    """The workbook without its discount column, prices as text without a currency sign."""
    sink.rewrite(records.topic_clean_text(source.read_workbook(spark, path, S.WORKBOOK)), path)


def publish_stores(
    spark: SparkSession, tables: dict[str, str], catalog: str, run: str, schema: StructType | str, sheets: dict[str, str] | None = None
) -> DataFrame:
    """Publish each store's table to the catalog on its own and report ``ok``, ``empty``, ``missing`` or ``error``.

    A store that fails leaves nothing in the catalog and does not stop the others. Rows are counted by the write itself.
    A run has its own folder in each store, so a run that is repeated replaces its rows and none are doubled.
    ``tables``: path by store (one entry per registered shop); ``sheets``: names in the report, the stores' by default.
    """
    lines = []
    for store, path in tables.items():
        status, rows = _publish(spark, store, path, catalog, run, schema)
        lines.append(((sheets or {}).get(store, store), status, rows))
    return audit.with_total(spark.createDataFrame(lines, "sheet_name string, status string, n_rows long"))


def _publish(spark: SparkSession, store: str, path: str, catalog: str, run: str, schema: StructType | str) -> tuple[str, int]:
    counted = Observation()
    own = f"{catalog}/store={store}/run={run}"
    try:
        table = spark.read.schema(schema).option("ignoreCorruptFiles", "false").parquet(path)
        table.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(own)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        status, rows = "missing", 0
    except (PySparkException, Py4JError):
        status, rows = "error", 0
    else:
        rows = counted.get["n"]
        status = "ok" if rows else "empty"
    if status != "ok":
        remove(spark, [own])
    return status, rows
