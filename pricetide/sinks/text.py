"""Text outputs: link files, reports, dumps of pairs and sample rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide import schema as S
from pricetide.operators.position import top_rows


def write_links(df: DataFrame, path: str, with_lastmod: bool = True) -> None:
    """Link file, sorted by url: ``url`` or ``url TAB lastmod`` per line."""
    line = F.concat_ws("\t", "url", F.coalesce("lastmod", F.lit(""))) if with_lastmod else F.col("url")
    # A range sort over all partitions; part files in name order give the whole order.
    df.orderBy("url").select(line.alias("value")).write.mode("overwrite").text(path)


def write_pending(pending: DataFrame, path: str) -> None:
    """Pending links by shard, ``url TAB lastmod``; shards without pending rows leave no folder."""
    line = F.concat_ws("\t", "url", F.coalesce("lastmod", F.lit("")))
    (
        pending.hint("rebalance", F.col("store"), F.col("chunk"))
        .sortWithinPartitions("store", "chunk", "idx")
        .select("store", "chunk", line.alias("value"))
        .write.mode("overwrite")
        .partitionBy("store", "chunk")
        .text(path)
    )


def write_lines(df: DataFrame, path: str, line: Column | str = "value") -> None:
    (df.select(F.col(line) if isinstance(line, str) else line.alias("value"))).write.mode("overwrite").text(path)


def pair_lines(specs: DataFrame) -> DataFrame:
    """``key: value`` lines of extracted spec pairs."""
    return specs.select(F.explode("specs").alias("p")).select(F.concat("p.key", F.lit(": "), "p.value").alias("value"))


def sample_lines(df: DataFrame, order: list, n: int = 3) -> DataFrame:
    """The first rows of a shop table as readable text, one block per row."""

    def cell(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) if name in df.columns else F.lit("")

    block = F.concat_ws(
        "\n",
        F.concat(F.lit("["), F.col("idx").cast("string"), F.lit("] "), cell(S.NAME)),
        F.concat(F.lit("Khuyến mãi: "), cell(S.PROMOS)),
        F.concat(F.lit("Giá: "), cell(S.PRICE)),
        F.concat(F.lit("Cấu hình: "), cell(S.SPECS)),
    )
    return top_rows(df, order, n).select("idx", block.alias("value")).orderBy("idx").select("value")
