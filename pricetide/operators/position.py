"""Exact positions in a sort order without a single-task sort.

The rows are range-partitioned on (group, order), so a large group spreads over
many partitions, and sorted within them. Partition number and place are stored
with the rows (staged once); each partition then only needs the count of the
rows before it, taken from a small table of counts. The rows are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.session import stage


def with_position(
    df: DataFrame, order: list[str], group: list[str] | None = None, part: str | None = None
) -> DataFrame:
    """Adds ``idx`` (1-based place within the group) and ``n_total`` (size of the group).

    ``order`` must be unique within the group. ``part`` names a column for the
    range partition of a row: within a group it grows with ``idx``.
    """
    group = group or []
    # The id counts rows within a partition; its upper 31 bits are the partition number.
    ranged = stage(
        df.repartitionByRange(*group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33).cast("int")),
        "ranged",
    )
    keys = [*group, "_part"]
    # Without a group this window spans the table of counts: one row per range partition.
    by_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
        .select(
            *keys,
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
            F.sum("_n").over(by_group).alias("n_total"),
        )
    )
    # Null group values form one group, as in the windows above.
    condition = F.col("l._part") == F.col("o._part")
    for k in group:
        condition = condition & F.col(f"l.{k}").eqNullSafe(F.col(f"o.{k}"))
    return (
        ranged.alias("l")
        .join(offsets.alias("o"), condition)
        .select(
            *[F.col(f"l.{c}").alias(c) for c in df.columns],
            (F.col("l._at") + F.col("o._shift")).alias("idx"),
            F.col("o.n_total"),
            *([F.col("l._part").alias(part)] if part else []),
        )
    )


def assign_chunks(df: DataFrame, key: str, total: int) -> DataFrame:
    """Distinct keys in ascending order with ``idx``, ``chunk`` and ``chunk_idx`` (place in the chunk).

    Chunks are equal slices of ``ceil(n / total)`` keys; the last ones may be short or empty.
    """
    placed = with_position(df.select(key).filter(F.col(key).isNotNull()).distinct(), [key])
    size = F.ceil(F.col("n_total") / F.lit(total))
    before = F.col("idx") - 1
    return placed.select(
        key, "idx", (F.floor(before / size) + 1).cast("int").alias("chunk"), (before % size + 1).alias("chunk_idx")
    )


def shuffled(df: DataFrame, key: str, seed: str) -> DataFrame:
    """Random-looking order that depends only on the key and the seed, not on the partitioning."""
    return shuffle_key(df, key, seed).orderBy("_hash", key).drop("_hash")


def shuffle_key(df: DataFrame, key: str, seed: str) -> DataFrame:
    """Adds ``_hash``, the place of a row in the shuffled order."""
    return df.withColumn("_hash", F.md5(F.concat(F.lit(seed + "/"), F.col(key))))


def top_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows in order, numbered; each task keeps at most ``n`` rows."""
    head = df.orderBy(*order).limit(n)
    # At most n rows are left, so one window over them is small.
    return head.withColumn("idx", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
