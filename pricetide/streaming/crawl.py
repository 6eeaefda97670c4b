"""The failure-streak breaker over a crawl log that arrives bit by bit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricetide.operators.breaker import pending_links
from pricetide.session import folders, remove, stage


def _frontier(rows: DataFrame, shard: list[str], block_rows: int) -> DataFrame:
    """First position of each shard that has not arrived, of rows from position ``_next`` on.

    Gaps are looked for inside blocks of positions and then among the blocks, one row each, so a shard may hold any share
    of a batch.
    """
    block = F.floor((F.col("idx") - 1) / block_rows)
    start = F.greatest(F.col("_next"), F.col("_block") * block_rows + 1)
    in_block = Window.partitionBy(*shard, "_block").orderBy("idx")
    places = rows.withColumn("_block", block).withColumn("_want", start + F.row_number().over(in_block) - 1)
    blocks = places.groupBy(*shard, "_block", "_next").agg(
        F.count(F.when(F.col("idx") == F.col("_want"), 1)).alias("_dense"), start.alias("_start")
    )
    end = F.col("_start") + F.col("_dense")
    by_shard = Window.partitionBy(*shard).orderBy("_block")
    # A block counts if the one before it is full, the first if it holds the next position.
    after = F.coalesce(F.lag(end).over(by_shard), F.col("_next"))
    chained = blocks.withColumn("_gap", (F.col("_start") != after).cast("int")).withColumn("_end", end)
    before_gap = F.sum("_gap").over(by_shard.rowsBetween(Window.unboundedPreceding, 0)) == 0
    reached = chained.withColumn("_end", F.when(before_gap, F.col("_end")))
    return reached.groupBy(*shard, "_next").agg(F.max("_end").alias("_end")).select(
        *shard, F.coalesce("_end", "_next").alias("_to")
    )


def _advance(
    arrived: DataFrame, state: DataFrame | None, held: DataFrame | None, shard: list[str], limit: int, overlap: Column, keep: int, block_rows: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """State, held rows and pending rows after a batch. A held row keeps its columns."""
    if state is None:
        state = arrived.select(*shard).distinct().select("*", *[F.lit(0).cast("bigint").alias(c) for c in ("_next", "_streak", "stop_idx")]).limit(0)
        held = arrived.limit(0)
    columns = arrived.columns
    known = state.unionByName(
        arrived.select(*shard).distinct().join(state, shard, "left_anti")
        .select(*shard, F.lit(1).cast("bigint").alias("_next"), F.lit(0).cast("bigint").alias("_streak"), F.lit(None).cast("bigint").alias("stop_idx"))
    )
    rows = stage(held.unionByName(arrived).join(known, shard), "crawl-rows")
    # Behind a stop every row is pending as it arrives.
    late = rows.where("stop_idx IS NOT NULL").select(*columns, "stop_idx")
    running = rows.where("stop_idx IS NULL").drop("stop_idx")
    to = _frontier(running.where("idx >= _next"), shard, block_rows)
    placed = running.join(to, shard, "left").withColumn("_to", F.coalesce("_to", "_next"))
    # Rows before `_next` were judged by an earlier batch: only the streak that reaches the border counts of them.
    carried = F.when(F.col("idx") >= F.col("_next") - F.col("_streak"), "fail").otherwise("neutral")
    judged = stage(
        placed.withColumn("_own", F.struct(*columns)).withColumn(
            "outcome", F.when(F.col("idx") < F.col("_next"), carried).when(F.col("idx") < F.col("_to"), F.col("outcome")).otherwise("neutral")
        ),
        "crawl-judged",
    )
    # Rows behind a gap are no part of the log yet, but are pending if a stop comes before the gap.
    ready = pending_links(judged.where("idx < _to"), shard, limit, overlap, block_rows)
    stops = stage(ready.select(*shard, "stop_idx").distinct(), "crawl-stops")
    first = judged.join(stops, shard).where(F.col("idx") > F.col("stop_idx") - limit - overlap).select("_own.*", "stop_idx")

    done = judged.where("idx < _to")
    ends = done.groupBy(*shard).agg(F.max(F.when(F.col("outcome") == "ok", F.col("idx"))).alias("_ok"))
    open_fails = (F.col("outcome") == "fail") & (F.col("idx") > F.coalesce("_ok", F.lit(0)))
    streaks = done.join(ends, shard).groupBy(*shard).agg(F.count(F.when(open_fails, 1)).alias("_now"), F.max("_to").alias("_reached"))
    new_state = (
        known.join(streaks, shard, "left")
        .join(stops.withColumnRenamed("stop_idx", "_new"), shard, "left")
        .select(
            *shard, F.coalesce("_reached", "_next").alias("_next"), F.coalesce("_now", "_streak").alias("_streak"),
            F.coalesce("stop_idx", "_new").alias("stop_idx"),
        )
    )
    still = judged.join(stops, shard, "left_anti").where(F.col("idx") >= F.col("_to") - keep)
    return new_state, still.select("_own.*"), late.unionByName(first)


def stream_pending(
    log: DataFrame, shard: list[str], target: str, checkpoint: str, limit: int = 3, overlap: Column | int = 0, most_overlap: int | None = None, block_rows: int = 1_000_000
) -> StreamingQuery:
    """Append the pending links of a crawl log to ``target`` as they become known, for all that is available now.

    ``log``: the shard columns (none null), ``idx`` (from 1, each once), ``outcome`` and any others. All runs together give
    the rows of ``pending_links`` over the whole log, in whatever order and batches it arrives: rows behind a gap wait until
    it closes. ``overlap`` may be a column of the shard; ``most_overlap`` is then its largest value.

    State is a table with a row per shard (next position, open streak, stop) and one of the held rows (the last
    ``limit + overlap - 1`` judged ones and those behind a gap), both by batch next to the checkpoint: a batch that is
    repeated reads the state before it and replaces what it wrote. Older states go.
    """
    keep = limit - 1 + (most_overlap if most_overlap is not None else overlap if isinstance(overlap, int) else 0)
    if most_overlap is None and not isinstance(overlap, int):
        raise ValueError("most_overlap is needed with a column")
    over = F.lit(overlap) if isinstance(overlap, int) else overlap
    names = {"state": f"{checkpoint}/breaker-state", "held": f"{checkpoint}/breaker-held"}

    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = spark._jsc.sc().getLocalProperty("sql.streaming.queryId")
        before = _last(spark, names["state"], batch_id)
        state, held = (spark.read.parquet(f"{names[n]}/{before}") if before else None for n in ("state", "held"))
        arrived = stage(batch, "crawl-batch")
        state, held, pending = _advance(arrived, state, held, shard, limit, over, keep, block_rows)
        placed = pending.withColumns({"query": F.lit(own), "batch": F.lit(batch_id)}).write.mode("overwrite")
        placed.option("partitionOverwriteMode", "dynamic").partitionBy("query", "batch").parquet(target)
        # The state last: a batch counts as done when both of its tables are whole.
        held.write.mode("overwrite").parquet(f"{names['held']}/{batch_id}")
        state.write.mode("overwrite").parquet(f"{names['state']}/{batch_id}")
        for path in names.values():
            remove(spark, [f"{path}/{n}" for n in folders(spark, path) if n.isdigit() and int(n) < batch_id - 1])

    query = log.writeStream.foreachBatch(advance).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _last(spark: SparkSession, path: str, batch_id: int) -> str | None:
    """Name of the last state before a batch."""
    return reduce(lambda a, b: b if a is None or int(b) > int(a) else a, [n for n in folders(spark, path) if n.isdigit() and int(n) < batch_id], None)
