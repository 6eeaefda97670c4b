"""Append job that no damaged file can stop: new files are read whole or listed as damaged."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# Files of a micro-batch; their names, and no more, pass through the driver.
FILES = 1000
# Fixed value: the condition under which Spark reports a file that cannot be decoded.
DAMAGED = "FAILED_READ_FILE"
# Inside a micro-batch failures arrive as the bridge's errors.
FAILURES = (PySparkException, Py4JError)


def new_files(spark: SparkSession, path: str, glob: str = "*.parquet", most: int = FILES) -> DataFrame:
    """Names of newly arrived files as a stream, ``most`` at a time. Their content is not read here. Spark's readers pass
    over files without a byte, so these are neither listed nor read."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", most).load(path).select(F.col("path").alias("file"))


def _error(rows: DataFrame) -> str | None:
    """Why the files of ``rows`` cannot be read to their end; None if they can."""
    try:
        rows.write.format("noop").mode("overwrite").save()
    except FAILURES as e:
        found = [line.strip() for line in str(e).splitlines() if DAMAGED in line]
        if not found:
            raise
        return found[0]
    return None


def damaged(files: list[str], read: Callable[[list[str]], DataFrame]) -> dict[str, str]:
    """Damaged files and their errors: each half of the files that fails is halved again. Spark's own scan decodes them,
    block by block, so no file is held whole."""
    found, left = {}, [files]
    while left:
        part = left.pop()
        error = _error(read(part)) if part else None
        if error is not None:
            if len(part) == 1:
                found[part[0]] = error
            else:
                left += [part[: len(part) // 2], part[len(part) // 2 :]]
    return found


def append_files(
    files: DataFrame, schema: StructType | str, target: str, quarantine: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Append the rows of all files that are available now, then stop.

    A batch is written in one read. Only if that fails its damaged files are looked for, and listed in ``quarantine``
    (``file, error``); the others are appended, so a damaged file delays nothing behind it. Both tables have a folder for
    each stream and batch: a batch that is repeated after a failure replaces itself, and every row arrives once.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = {"query": F.lit(spark._jsc.sc().getLocalProperty("sql.streaming.queryId")), "batch": F.lit(batch_id)}
        names, bad = sorted(r["file"] for r in batch.collect()), {}

        def read(part: list[str]) -> DataFrame:
            rows = spark.read.schema(schema).option("ignoreCorruptFiles", "false").parquet(*part)
            return transform(rows) if transform is not None else rows

        def write(rows: DataFrame, path: str) -> None:
            placed = rows.withColumns(own).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            placed.partitionBy("query", "batch").parquet(path)

        def all_columns(part: list[str]) -> DataFrame:
            return spark.read.schema(schema).option("ignoreCorruptFiles", "false").parquet(*part)

        def append_whole() -> None:
            good = [n for n in names if n not in bad]
            if good:
                write(read(good), target)

        try:
            append_whole()
        except FAILURES:
            # All columns, so a file is judged as a whole, whatever the transformation uses of it.
            found = damaged(names, all_columns)
            if not found:
                raise
            bad.update(found)
            append_whole()
        if bad:
            write(spark.createDataFrame(sorted(bad.items()), "file string, error string"), quarantine)

    query = files.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
