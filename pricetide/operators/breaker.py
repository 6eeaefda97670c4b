"""Failure-streak circuit breaker and the work left after it.

A crawl log has one row per link of a shard, with its 1-based position and
outcome: ``ok``, ``fail`` or ``neutral`` (neither extends nor ends a streak).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pending_links(
    log: DataFrame,
    shard: list[str],
    limit: int = 3,
    overlap: int | Column = 0,
    block_rows: int = 1_000_000,
    block: str | None = None,
) -> DataFrame:
    """Rows still to do for every shard that stopped.

    A shard stops at the first position where ``limit`` failures follow each
    other without an ``ok``; the last ``limit + overlap`` positions up to the
    stop and everything after it are pending. Adds ``stop_idx``. ``overlap`` may
    be a column of the shard.

    Positions are cut into blocks (of ``block_rows``, or by the column
    ``block``, which grows with the position), so one shard may hold any share
    of the log: streaks inside a block are found by a window on (shard, block);
    a streak that crosses a border is closed on a table with one row per block.
    """
    cut = F.col(block) if block else F.floor((F.col("idx") - 1) / F.lit(block_rows))
    work = log.withColumn("_block", cut)
    block = [*shard, "_block"]
    fail = (F.col("outcome") == "fail").cast("int")
    ok = F.coalesce(F.col("outcome") == "ok", F.lit(False))

    so_far = Window.partitionBy(*block).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    counted = work.withColumn("_fails", F.sum(F.coalesce(fail, F.lit(0))).over(so_far)).withColumn(
        "_base", F.max(F.when(ok, F.col("_fails"))).over(so_far)
    )
    is_fail = F.coalesce(fail, F.lit(0)) == 1
    leading = F.col("_base").isNull()
    run = F.col("_fails") - F.coalesce("_base", F.lit(0))

    summary = counted.groupBy(*block).agg(
        F.max(ok.cast("int")).alias("_has_ok"),
        (F.max("_fails") - F.coalesce(F.max("_base"), F.lit(0))).alias("_trailing"),
        F.min(F.when(is_fail & ~leading & (run >= limit), F.col("idx"))).alias("_inner"),
        F.array(
            *[F.min(F.when(is_fail & leading & (F.col("_fails") == k), F.col("idx"))) for k in range(1, limit + 1)]
        ).alias("_lead"),
    )

    by_block = Window.partitionBy(*shard).orderBy("_block")
    by_run = Window.partitionBy(*shard, "_run").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        summary.withColumn("_run", F.sum("_has_ok").over(by_block))
        .withColumn("_out", F.sum("_trailing").over(by_run))
        .withColumn("_in", F.coalesce(F.lag("_out").over(by_block), F.lit(0)))
    )
    # A carried streak of `limit` or more means that an earlier block already stopped.
    at_border = F.when(F.col("_in") < limit, F.element_at("_lead", (F.lit(limit) - F.col("_in")).cast("int")))
    stops = carried.select(
        *block, F.min(F.least(at_border, F.col("_inner"))).over(Window.partitionBy(*shard)).alias("stop_idx")
    ).filter(F.col("stop_idx").isNotNull())

    # Joined on (shard, block), the key the log is already distributed by.
    return work.join(stops, block).filter(F.col("idx") > F.col("stop_idx") - F.lit(limit) - overlap).drop("_block")


def runnable_shards(shards: DataFrame, pending: DataFrame, shard: list[str]) -> DataFrame:
    """Shards to process: those with pending rows, or all when nothing is pending anywhere."""
    if pending.isEmpty():
        return shards
    return shards.join(pending.select(*shard).distinct(), shard, "left_semi")
