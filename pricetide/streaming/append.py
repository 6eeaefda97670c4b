"""Append job: newly arrived shards go to the catalog, old ones are not read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_new(spark: SparkSession, path: str, schema: StructType | str, glob: str | None = None) -> DataFrame:
    """New files as a stream. A damaged file stops the stream, so it is never marked as read when it was read in part."""
    reader = spark.readStream.schema(schema).option("ignoreCorruptFiles", "false")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def stream_append(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    transform=None,
    event_time: str | None = None,
    dedup: list[str] | None = None,
    within: str = "1 day",
) -> StreamingQuery:
    """Append everything that is available now, then stop.

    Each micro-batch is written to its own folder, named by the stream's id, which
    its checkpoint keeps, and the batch: a batch that is repeated after a failure
    replaces itself, and streams into one catalog do not meet. Rows are not de-duplicated across
    runs unless ``dedup`` names key columns (needs ``event_time``).
    """
    if transform is not None:
        rows = transform(rows)
    if dedup:
        rows = rows.withWatermark(event_time, within).dropDuplicatesWithinWatermark(dedup)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession._jsc.sc().getLocalProperty("sql.streaming.queryId")
        (
            batch.withColumns({"query": F.lit(own), "batch": F.lit(batch_id)})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("query", "batch")
            .parquet(target)
        )

    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
