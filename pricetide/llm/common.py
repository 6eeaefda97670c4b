"""Helpers shared by the operators: batches, splits by document id, table access."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str) -> Column:
    """True for the rows that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(_as_text(doc_id)), F.lit(3)) == 1, F.lit(False))


def _as_text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string").cast("binary")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds about ``max_bytes`` at most.

    A single longer row is a run of its own.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def released() -> None:
    """Give memory that is no longer used back to the machine.

    Python workers are used again by later stages, and Arrow's pool and the C library keep what was freed; over the
    stages of a long session that adds up in an executor.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Batches = Iterator[pa.RecordBatch]


def tidy(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``function`` for ``mapInArrow``, with its memory released when a task's rows are done."""

    def run(batches: Batches) -> Batches:
        try:
            yield from function(batches)
        finally:
            released()

    return run


def map_arrow(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    text: str = "text",
    max_bytes: int = 8 << 20,
    done: Callable[[], None] = lambda: None,
) -> DataFrame:
    """Apply ``function`` to bounded Arrow batches of ``df``; ``done`` is called at the end of a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, max_bytes):
                out = function(part)
                if out is not None and out.num_rows:
                    yield out
        done()

    return df.mapInArrow(tidy(run), schema)


def packed_parts(part: np.ndarray, parts: int, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """A row per part with its share of every column, packed."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    packed = [[c[order[cuts[p] : cuts[p + 1]]].tobytes() for p in full] for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(b, pa.binary()) for b in packed)], ["part", *names])


def unpacked(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> list[np.ndarray]:
    """The packed columns of all rows, joined."""
    held: dict[str, list[bytes]] = {name: [] for name in kinds}
    for batch in batches:
        for name, blobs in held.items():
            blobs += [b for b in batch[name].to_pylist() if b]
    return [np.frombuffer(b"".join(held[name]), kind) for name, kind in kinds.items()]
