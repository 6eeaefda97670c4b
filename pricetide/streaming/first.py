"""First row per key over all runs of a stream, with one small state per key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Rows that are gathered before they are reduced to the first of each key.
ROWS = 100_000


def first_rows(table: pa.Table, keys: list[str], order: list[str]) -> pa.Table:
    """The first row of each key in ``order`` (nulls first), of equal ones the first that came."""
    ranked = table.sort_by([(c, "ascending") for c in order], null_placement="at_start") if order else table
    place = pa.array(np.arange(ranked.num_rows))
    names = [f"k{i}" for i in range(len(keys))]
    numbered = pa.table([ranked[k] for k in keys] + [place], names=[*names, "place"])
    return ranked.take(numbered.group_by(names, use_threads=False).aggregate([("place", "min")])["place_min"])


def first_per_key(rows: DataFrame, keys: list[str], order: list[str], expiry_ms: int | None = None) -> DataFrame:
    """Rows whose keys no earlier batch had; of several in one batch the first in ``order``.

    A batch is dealt by key and reduced to a row per key, column by column in Arrow; a task holds a row for each of its keys.
    Only these rows meet the state. Keys and order are columns of plain types.

    The state is a flag per key, kept by Spark's own removal of duplicates. With ``expiry_ms`` it goes when the key was not
    seen for so long, and the key counts as new again; that takes a call of Python per key and batch. Rows arrive in
    batches: cut by the order of arrival, the result is that of ``keep_first`` over all of them.
    """

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new, n_new = None, [], 0
        for batch in batches:
            new.append(batch)
            n_new += batch.num_rows
            # As many new rows as are held, so that each row is sorted a few times at most.
            if n_new >= max(ROWS, held.num_rows if held is not None else 0):
                held, new, n_new = _merged(held, new), [], 0
        if new:
            held = _merged(held, new)
        if held is not None:
            yield from held.to_batches(max_chunksize=10_000)

    def _merged(held: pa.Table | None, new: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(new)
        return first_rows(table if held is None else pa.concat_tables([held, table]), keys, order)

    def unseen(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        found = list(chunks)
        if found and not state.exists:
            state.update((True,))
            yield found[0].head(1)
        state.setTimeoutDuration(expiry_ms)

    firsts = rows.repartition(*keys).mapInArrow(reduced, rows.schema)
    if expiry_ms is None:
        return firsts.dropDuplicates(keys)
    return firsts.groupBy(*keys).applyInPandasWithState(unseen, rows.schema, "seen boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)
