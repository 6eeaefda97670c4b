"""Table writers and shard compaction."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.session import stage
from pricetide.sources.tables import checked_shards

PARTITIONS = ("store", "chunk", "run")


def write_shard(df: DataFrame, root: str) -> None:
    """Write a run's rows to its own (store, chunk, run) folders.

    Only the folders present in ``df`` are replaced, so repeating a run is
    harmless; without rows nothing is written.
    """
    dealt = df.hint("rebalance", *[F.col(c) for c in PARTITIONS])
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(root)


def write_stores(df: DataFrame, path: str) -> None:
    """Per-store table; the stores in ``df`` replace their former content, others stay.

    Rebalanced by store for files of even size: a store that holds much of the
    rows is split over several tasks.
    """
    df.hint("rebalance", F.col("store")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("store").parquet(path)


def write_catalog(df: DataFrame, path: str, clear: bool = False) -> None:
    """Publish rows to a catalog laid out by store: append, or with ``clear`` replace the stores that ``df`` has, and
    no others. An empty input is refused."""
    if not path or df.isEmpty():
        raise ValueError("target or rows missing")
    dealt = df.hint("rebalance", F.col("store")).write
    if clear:
        dealt = dealt.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        dealt = dealt.mode("append")
    dealt.partitionBy("store").parquet(path)


def rewrite(df: DataFrame, path: str, partition: str | None = "store") -> None:
    """Replace a table by a table computed from itself (read fully before the old one goes)."""
    staged = stage(df, "rewrite")
    writer = staged.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def compact(spark: SparkSession, root: str, transform, path: str, store: str) -> DataFrame:
    """Merge a store's shards into its table, then remove the shard files whose rows were merged.

    Only whole files are merged and removed; damaged ones stay. Returns all files that were found (see
    ``checked_shards``). Rows are merged from files that were counted as whole; should one break meanwhile, the merge fails.
    """
    shards, found = checked_shards(spark, root, store)
    if not found.where("error IS NULL").isEmpty():
        write_stores(transform(shards), path)
    remove_merged(found)
    return found


def remove_merged(found: DataFrame) -> None:
    """Delete the whole files among ``found``, but none that was changed since it was read.

    Tasks in Python have no access to the cluster's file systems, so the calls are made here: one partition of names
    is held at a time, many calls at once.
    """
    spark = found.sparkSession
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()

    def remove(row) -> None:
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["file"]))
        system = target.getFileSystem(hadoop)
        if system.exists(target) and system.getFileStatus(target).getModificationTime() == row["modified"]:
            system.delete(target, False)

    names = found.where("error IS NULL").select("file", "modified").toLocalIterator()
    with ThreadPoolExecutor(16) as pool:
        while part := list(islice(names, 1000)):
            list(pool.map(remove, part))
