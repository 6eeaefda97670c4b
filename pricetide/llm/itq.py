"""Near-duplicates of embeddings by iterative quantisation.

Rotations are learned on a bounded sample so that the signs of a rotated vector lose little; the signs are the
code. Substrings of the codes are the keys of multi-index Hamming tables: two vectors meet where a substring is equal.
Vectors that meet are compared by cosine with the original vectors in double precision, so no link is wrong; a link
is found if the codes agree on one substring in any table, which is measured in the tests (recall 0.9 at least).

A pair is counted in the first table where it meets and nowhere else. A table's entry with more than ``BLOCK`` vectors
is split into blocks and the pairs of blocks become tasks of their own, so no task holds an unbounded entry, and only a
count and one spanning edge per vector leave a task.

Defined results: vectors that are null, empty, zero, or hold a null or a non-finite component, link with nothing; vectors
of different lengths have no cosine, and those of each length are compared with each other. Empty tables give no rows. Rows that repeat an id are one vector, the smallest.
A row without an id is returned without links and is kept. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricetide.llm.components import components
from pricetide.session import stage

SAMPLE = 20_000
ROTATIONS, SUBSTRING, ITERATIONS = 3, 12, 40
BLOCK = 2_048
COSINE = 0.9


def learn(sample: np.ndarray, rotations: int = ROTATIONS, iterations: int = ITERATIONS) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sample's mean and projections (principal axes times a learned rotation), one per random start."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=True) if len(sample) < centred.shape[1] else (0, 0, np.linalg.eigh(centred.T @ centred)[1].T)
    projected = centred @ axes.T
    out = []
    for seed in range(rotations):
        turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((axes.shape[0],) * 2))[0]
        for _ in range(iterations):
            u, _, v = np.linalg.svd(np.where(projected @ turn >= 0, 1.0, -1.0).T @ projected)
            turn = (u @ v).T
        out.append(axes.T @ turn)
    return mean, out


def keys(unit: np.ndarray, mean: np.ndarray, projections: list[np.ndarray], width: int) -> np.ndarray:
    """Table keys of unit vectors: a column for each substring of each code."""
    columns = []
    for projection in projections:
        bits = (unit - mean) @ projection >= 0
        for start in range(0, bits.shape[1] - width + 1, width):
            columns.append(bits[:, start : start + width] @ (1 << np.arange(width)))
    return np.stack(columns, axis=1).astype("<i4")


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _linked(rows: dict[str, np.ndarray], table: int, crossing: bool, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row of one entry, and the smallest id that it reaches inside it."""
    ids, unit, own, side = rows["vec_id"], rows["unit"], rows["keys"], rows["side"]
    n = len(ids)
    counts, root = np.zeros(n, np.int64), np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    left = np.flatnonzero(side == 0) if crossing else np.arange(n)
    for start in range(0, len(left), 256):
        part = left[start : start + 256]
        a, b = np.nonzero(unit[part] @ unit.T >= cosine)
        a = part[a]
        keep = (side[b] == 1) if crossing else (a < b)
        a, b = a[keep], b[keep]
        if table and len(a):
            new = np.ones(len(a), bool)
            for before in range(table):
                new &= own[a, before] != own[b, before]
            a, b = a[new], b[new]
        counts += np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        # One edge per row and group of equal roots is enough.
        pairs = np.unique(np.stack([np.array([find(x) for x in np.unique(a)])[np.searchsorted(np.unique(a), a)], b]), axis=1) if len(a) else np.zeros((2, 0), int)
        for x, y in pairs.T.tolist():
            x, y = find(x), find(y)
            if x != y:
                x, y = (x, y) if ids[x] < ids[y] else (y, x)
                root[y] = x
    return counts, np.array([ids[find(x)] for x in range(n)], np.int64)


def links(vectors: DataFrame, width: int = SUBSTRING, rotations: int = ROTATIONS, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """``vec_id``, ``n`` (links found in one entry) and ``other`` (the smallest id reached there), over all entries."""
    size = vectors.first()["size"]
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    mean, projections = learn(_unit(np.array([r["vector"] for r in chosen], np.float64)), rotations)
    width = min(width, size)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2_000):
                batch = whole.slice(start, 2_000)
                flat = batch["vector"].flatten().to_numpy(zero_copy_only=False)
                matrix = flat.reshape(batch.num_rows, size)
                own = keys(_unit(matrix.astype(np.float64)), mean, projections, width)
                tables = own.shape[1]
                blob = pa.array([m.tobytes() for m in matrix], pa.binary())
                codes = pa.array([k.tobytes() for k in own], pa.binary())
                for t in range(tables):
                    columns = [pa.array(np.full(len(own), t), pa.int32()), pa.array(own[:, t], pa.int32()), batch["vec_id"], codes, blob]
                    yield pa.RecordBatch.from_arrays(columns, ["t", "k", "vec_id", "codes", "vector"])

    held = stage(vectors.select("vec_id", "vector").mapInArrow(entries, "t int, k int, vec_id long, codes binary, vector binary"), "itq-entries")
    totals = held.groupBy("t", "k").count().where("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        held.join(totals, ["t", "k"])
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", other)
        .select("t", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "vec_id", "codes", "vector")
    )
    kind = "<f4" if vectors.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def solve(rows: pa.Table) -> pa.RecordBatch:
            first = rows.slice(0, 1).to_pylist()[0]
            data = {"vec_id": rows["vec_id"].to_numpy(), "side": rows["side"].to_numpy()}
            data["unit"] = _unit(np.frombuffer(b"".join(rows["vector"].to_pylist()), kind).reshape(rows.num_rows, size).astype(np.float64))
            data["keys"] = np.frombuffer(b"".join(rows["codes"].to_pylist()), "<i4").reshape(rows.num_rows, -1)
            n, least = _linked(data, first["t"], first["i"] != first["j"], cosine)
            found = np.flatnonzero(n)
            columns = [pa.array(data["vec_id"][found]), pa.array(n[found]), pa.array(least[found])]
            return pa.RecordBatch.from_arrays(columns, ["vec_id", "n", "other"])

        # Rows come sorted by entry; an entry may go on in the next batch.
        for batch in batches:
            entry = np.stack([batch[c].to_numpy() for c in ("t", "k", "i", "j")])
            cuts = [0, *(np.flatnonzero((entry[:, 1:] != entry[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                if kept and any(kept[0][c][0] != part[c][0] for c in ("t", "k", "i", "j")):
                    out = solve(pa.Table.from_batches(kept))
                    kept = []
                    if out.num_rows:
                        yield out
                kept.append(part)
        if kept:
            out = solve(pa.Table.from_batches(kept))
            if out.num_rows:
                yield out

    entry = ["t", "k", "i", "j"]
    return dealt.repartition(*entry).sortWithinPartitions(*entry).mapInArrow(compare, "vec_id long, n long, other long")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every vector."""
    inner = embeddings.schema["embedding"].dataType.elementType.simpleString()
    kind = "float" if inner == "float" else "double"
    cast = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("vector"))
    rows = cast.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & (squares > 0)).withColumn("size", F.size("vector"))
    # Vectors of one length are compared; a row for each length that several vectors have.
    sizes = sorted(r["size"] for r in usable.groupBy("size").count().where("count > 1").collect())
    ids = rows.select("vec_id")
    if not sizes:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    every = [links(usable.where(F.col("size") == size), cosine=cosine) for size in sizes]
    found = stage(functools.reduce(DataFrame.union, every), "itq-links")
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("vec_id").alias("a"), F.col("other").alias("b")), "itq-components")
    joined = ids.join(counts, "vec_id", "left").join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
