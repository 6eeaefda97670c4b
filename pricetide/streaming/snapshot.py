"""A run's table that is brought up to date after every few captured files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pricetide.sinks.tables import write_shard


def captured(spark: SparkSession, path: str, schema: StructType | str, every: int) -> DataFrame:
    """Captured files as a stream, ``every`` at a time. A damaged file stops the stream, with all before it saved."""
    reader = spark.readStream.schema(schema).option("ignoreCorruptFiles", "false").option("maxFilesPerTrigger", every)
    return reader.parquet(path)


def snapshot_run(pages: DataFrame, transform: Callable[[DataFrame], DataFrame], root: str, checkpoint: str) -> StreamingQuery:
    """Write the shop rows of all files that are available now, then stop.

    ``transform`` makes shop rows with ``store, chunk, run`` of pages. After each batch the shard tables below ``root`` hold
    all rows so far. A batch has its own part of the run (``run`` and the batch's number), so none before it is read or
    written again, and a batch that was stopped midway replaces itself: a run that is started again goes on at the first
    batch that was not finished, and no row comes twice. A batch of few files is dealt over all tasks before ``transform``,
    since parsing a page costs far more than moving it.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        tasks = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = transform(batch.repartition(tasks))
        write_shard(rows.withColumn("run", F.concat("run", F.lit(f"-{batch_id:06d}"))), root)

    query = pages.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
