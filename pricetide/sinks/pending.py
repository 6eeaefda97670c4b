"""Pending links as a table that every run updates shard by shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.session import folders, remove, stage

SCHEMA = "idx bigint, url string, lastmod string, store string, chunk int"
SHARD = ["store", "chunk"]


def read_pending(spark: SparkSession, root: str) -> DataFrame | None:
    """``store, chunk, idx, url, lastmod`` of all unfinished shards; None if there are none."""
    if not any(name.startswith("store=") for name in folders(spark, root)):
        return None
    return spark.read.schema(SCHEMA).parquet(root).select("store", "chunk", "idx", "url", "lastmod")


def update_pending(pending: DataFrame, ran: DataFrame, root: str) -> None:
    """After a run over the shards ``ran``: those with rows in ``pending`` are replaced, the others of them go.

    Shards that did not run stay as they are. The rows come first and the folders go last, so a run that is stopped
    between leaves a shard that is done once more. Names of finished shards, not links, pass through the driver.
    """
    spark = pending.sparkSession
    left = stage(pending.select("idx", "url", "lastmod", *SHARD), "pending")
    dealt = left.hint("rebalance", *[F.col(c) for c in SHARD]).write.mode("overwrite")
    dealt.option("partitionOverwriteMode", "dynamic").partitionBy(*SHARD).parquet(root)
    finished = ran.select(*SHARD).distinct().join(left, SHARD, "left_anti")
    remove(spark, [f"{root}/store={r['store']}/chunk={r['chunk']}" for r in finished.toLocalIterator()])
    remove(spark, [path for name in folders(spark, root) if name.startswith("store=") and not folders(spark, path := f"{root}/{name}")])
