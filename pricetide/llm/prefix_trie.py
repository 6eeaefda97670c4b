"""Prefix trie of conversations, from sorted sequences and a sparse table over their common prefixes.

Every turn is a 16-byte name (digest of role and text), a conversation a string of such names. The distinct strings are
sorted over all partitions. In a partition, the common prefix of each row with the row before it (LCP) and a sparse table
of range minima over these lengths give, for each candidate prefix on its own, the rows that share it: a binary search to
the left and one to the right, over the powers of two of the table, with no stack and no order among candidates. All
candidates of a partition search at once. Sums over a subtree are sums over such an interval of rows, by running totals.

How it stays whole on many tasks:

- Equal strings are one row with a count, so a group of copies, however large, is one row.
- A prefix whose rows lie in several partitions gives one part in each; a node's parts are added by its name, the XOR of the
  hashes of its turns with their places (128 bits). Each partition also sees the last row before it and the first one
  after it, so that a prefix is counted as new in one partition only.
- Strings are cut into segments of ``SEGMENT`` turns, so that one conversation may hold any share of all rows. A segment
  is sorted under the name of all turns before it. What hangs below the end of a full segment is added up along the chain of
  segments by doubling the distance in each round, and enters the sums of the row it hangs on.
- The digest of a node's ends is one string of ids; they are sorted over all partitions and joined there in runs, so the
  task that ends a node's digest reads one row for some thousand ids.

Defined results. Null role or text: empty. Turns of one number: by role, then by digest of the text; null turns first;
repeated rows are turns like others. A null ``conv_id`` is no conversation. ``c % 100`` keeps the sign of ``c``, as SQL's.
Without a conversation there is no root. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pricetide.operators.position import with_position
from pricetide.session import stage

# Turns of a segment, and bytes of a turn's name.
SEGMENT = 1024
NAME = 16
# Rows and bytes of sorted strings in a partition, about; ids that are joined to one row; turns of a block; children from
# which a parent is copied.
SHARD_ROWS = 200_000
SHARD_BYTES = 32 << 20
RUN_IDS = 4096
BLOCK = 65_536
HOT = 1000


# --- turns -------------------------------------------------------------------------------------


def rebuilt(conversations: DataFrame, bases: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """All ``conv_id``, and their rebuilt turns as ``conv_id, pos, name, chars``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", role.alias("role"), F.unhex(F.substring(digest, 1, 2 * NAME)).alias("name"), F.length(text).cast("long").alias("chars")
    )
    placed = with_position(rows, ["turn", "role", "name"], ["conv_id"]).select("conv_id", F.col("idx").alias("pos"), "name", "chars", "n_total")
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    # At most `heads` - 1 turns of a base go to the at most `bases` conversations of its block.
    convs = stage(
        placed.where("pos = 1").select("conv_id", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % bases).alias("base"), "n_total"), "trie-convs"
    )
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n_total").alias("n_base"))
    known = convs.join(lengths, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("given"), "n_total"
    )
    known = stage(known, "trie-known")
    first = placed.where(F.col("pos") < heads).select(F.col("conv_id").alias("base"), "pos", "name", "chars")
    borrowed = known.join(first, "base").where("pos <= h").select("conv_id", "pos", "name", "chars")
    # A long conversation meets its own row once per block of turns, each block in a place of its own.
    block = F.floor((F.col("pos") - 1) / F.lit(BLOCK))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_total") - 1) / F.lit(BLOCK))))
    spread = known.select("conv_id", "h", "given", blocks.alias("block"))
    own = placed.withColumn("block", block).join(spread, ["conv_id", "block"]).where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "name", "chars")
    return convs.select("conv_id"), borrowed.unionByName(own)


def _hashes() -> list[Column]:
    """Two hashes of a turn at its place."""
    return [F.xxhash64("name", "pos").alias("a"), F.xxhash64("pos", F.lit(1), "name").alias("b")]


def _segments(turns: DataFrame, segment: int) -> DataFrame:
    """A row per conversation and segment: ``ga, gb`` (name of the turns before), ``a, b`` (with the segment), ``key``,
    ``chars``, ``goes_on``."""
    at = F.floor((F.col("pos") - 1) / F.lit(segment)).alias("seg")
    listed = F.sort_array(F.collect_list(F.struct("pos", "name", "chars")))
    cut = (
        turns.withColumns(dict(zip("ab", _hashes(), strict=True)))
        .groupBy("conv_id", at)
        .agg(listed.alias("_all"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
        .withColumns({"names": F.transform("_all", lambda x: x["name"]), "chars": F.transform("_all", lambda x: x["chars"])})
    )
    # One short row per segment passes here.
    by_conv = Window.partitionBy("conv_id").orderBy("seg")
    so_far = by_conv.rowsBetween(Window.unboundedPreceding, 0)
    whole = cut.select(
        "conv_id", "seg", "names", "chars", F.col("a").alias("oa"), F.col("b").alias("ob"),
        F.bit_xor("a").over(so_far).alias("a"), F.bit_xor("b").over(so_far).alias("b"),
        F.lead("seg").over(by_conv).isNotNull().cast("long").alias("goes_on"),
    )
    return whole.withColumns({"ga": F.col("a").bitwiseXOR(F.col("oa")), "gb": F.col("b").bitwiseXOR(F.col("ob"))}).drop("oa", "ob")


# --- one partition of sorted strings -----------------------------------------------------------


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs of 1, 2, 4, ... values."""
    table = [values]
    while len(table[-1]) > 1 << (len(table) - 1):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def extents(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row that shares the first ``depth`` names of ``row``, for all candidates at once.

    ``table`` is over the LCP of each row with the row before it. A search halves its step; at each step one look-up
    tells if a whole run of rows still shares the prefix.
    """
    left, right, n = row.copy(), row.copy(), len(table[0])
    for power in range(len(table) - 1, -1, -1):
        least, step = table[power], 1 << power
        # Rows left - step + 1 .. left all share the prefix with the row before them.
        start = left - step + 1
        fits = start >= 1
        fits[fits] = least[start[fits]] >= depth[fits]
        left[fits] -= step
        start = right + 1
        fits = start + step <= n
        fits[fits] = least[start[fits]] >= depth[fits]
        right[fits] += step
    return left, right


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return (int(differ[0]) if len(differ) else n) // NAME


_PARTS = pa.schema(
    [(c, pa.int64()) for c in ("a", "b", "pa", "pb", "depth", "n_convs", "least", "n_leaves", "saved", "new")]
)
_PART_COLUMNS = "a long, b long, pa long, pb long, depth long, n_convs long, least long, n_leaves long, saved long, new long"
# A row of `_shard`'s input; n_convs is 0 for the neighbours of a partition's rows.
_ROW = ["part", "ga", "gb", "seg", "key", "chars", "ha", "hb", "n_convs", "least", "goes_on", "more_leaves", "more_saved"]


def _shard(rows: dict[str, list], segment: int, roots: bool) -> pa.RecordBatch | None:
    """Parts of the nodes of one partition of sorted rows; the first and the last one may be neighbours."""
    n = len(rows["key"])
    groups = list(zip(rows["ga"], rows["gb"], strict=True))
    lcp = np.full(n, -1, np.int64)
    for i in range(1, n):
        if groups[i] == groups[i - 1]:
            lcp[i] = _common(rows["key"][i - 1], rows["key"][i])
    weight = np.array(rows["n_convs"], np.int64)
    real = weight > 0
    lengths = np.array([len(k) // NAME for k in rows["key"]], np.int64)
    # A node is new at its first row; a row's own prefixes are those longer than what it shares with the row before.
    # A prefix that also the neighbour before has, begins there: its part here starts at the first own row.
    from_ = np.where(np.r_[False, ~real[:-1]] & real, -1, lcp) + 1
    low = np.where(roots, 0, 1)
    from_ = np.maximum(from_, low)
    counts = np.where(real, np.maximum(lengths + 1 - from_, 0), 0)
    if not counts.sum():
        return None
    row = np.repeat(np.arange(n), counts)
    depth = np.repeat(from_, counts) + np.arange(len(row)) - np.repeat(np.r_[0, np.cumsum(counts)[:-1]], counts)
    left, right = extents(sparse_table(lcp), row, depth)
    # Neighbours carry no weight.
    left = np.maximum(left, np.flatnonzero(real)[0])
    right = np.minimum(right, np.flatnonzero(real)[-1])

    # Per row: characters up to each depth, and hashes up to each depth, one after the other.
    begin = np.r_[0, np.cumsum(lengths + 1)]
    chars, ha, hb = (np.zeros(begin[-1], np.int64) for _ in range(3))
    for i in range(n):
        if real[i]:
            chars[begin[i] + 1 : begin[i + 1]] = np.cumsum(np.array(rows["chars"][i], np.int64))
            for out, base, own in ((ha, rows["ga"][i], rows["ha"][i]), (hb, rows["gb"][i], rows["hb"][i])):
                out[begin[i]] = base
                out[begin[i] + 1 : begin[i + 1]] = np.bitwise_xor.accumulate(np.array(own, np.int64)) ^ np.int64(base)
    total = chars[begin[1:] - 1]
    shared = np.maximum(lcp, 0)
    fresh = np.where(real, total - chars[begin[:-1] + np.minimum(shared, lengths)], 0)
    ends = np.r_[lcp[1:] < lengths[:-1], True] & real & (np.array(rows["goes_on"], np.int64) == 0)
    leaves = ends + np.array(rows["more_leaves"], np.int64)
    below = weight * total + np.array(rows["more_saved"], np.int64)
    add = lambda x: np.r_[0, np.cumsum(x)]
    over = lambda run: run[right + 1] - run[left]
    members = over(add(weight))
    before = np.maximum(depth - 1, 0)
    # New characters of the first row count from the candidate's depth on, or from where the neighbour ends.
    own = total[row] - chars[begin[row] + np.maximum(before, np.minimum(shared[row], lengths[row]))]
    saved = over(add(below)) - members * chars[begin[row] + before] - (over(add(fresh)) - fresh[row] + own)
    least = np.minimum.reduceat(np.r_[np.array(rows["least"], np.int64), np.iinfo(np.int64).max], np.c_[left, right + 1].ravel())[::2]
    new = (depth > lcp[row]) & (depth > 0)
    columns = [
        ha[begin[row] + depth], hb[begin[row] + depth], ha[begin[row] + before], hb[begin[row] + before],
        np.array(rows["seg"], np.int64)[row] * segment + depth, members, least, over(add(leaves)), saved, new.astype(np.int64),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_PARTS)


def _parts(segment: int, roots: bool):
    """Rows of whole partitions, in order, to parts of nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in _ROW}

        def flushed() -> Iterator[pa.RecordBatch]:
            out = _shard(held, segment, roots) if held["key"] else None
            for c in held.values():
                c.clear()
            if out is not None:
                yield out

        for batch in batches:
            columns = {c: batch[c].to_pylist() for c in _ROW}
            parts = columns["part"]
            cut = [0, *(i for i in range(1, len(parts)) if parts[i] != parts[i - 1]), len(parts)]
            for begin, end in zip(cut, cut[1:], strict=False):
                if begin == end:
                    continue
                if held["key"] and held["part"][-1] != parts[begin]:
                    yield from flushed()
                for c in _ROW:
                    held[c] += columns[c][begin:end]
        yield from flushed()

    return run


# --- all partitions ----------------------------------------------------------------------------


def _sorted_strings(segments: DataFrame, segment: int) -> DataFrame:
    """Distinct strings with their counts, in sorted parts, with the neighbours of each part."""
    # Names are spread evenly, so any order that keeps equal prefixes together will do: bytes.
    key = F.expr("unhex(concat_ws('', transform(names, x -> hex(x))))")
    hashes = [F.transform("names", lambda x, i: F.xxhash64(x, F.col("seg") * segment + i + 1)), F.transform("names", lambda x, i: F.xxhash64(F.col("seg") * segment + i + 1, F.lit(1), x))]
    distinct = (
        segments.withColumn("key", key)
        .groupBy("ga", "gb", "key")
        .agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("least"), F.sum("goes_on").alias("goes_on"),
            *[F.any_value(c).alias(c) for c in ("seg", "chars", "names", "a", "b")],
        )
        .withColumns({"ha": hashes[0], "hb": hashes[1]})
        .drop("names")
    )
    distinct = stage(distinct, "trie-strings")
    size = distinct.agg(F.count("*").alias("n"), F.sum(F.length("key")).alias("bytes")).first()
    parts = 1 + max((size["n"] or 0) // SHARD_ROWS, (size["bytes"] or 0) // SHARD_BYTES)
    order = ["ga", "gb", "key"]
    dealt = distinct.repartitionByRange(int(parts), *order).sortWithinPartitions(*order)
    dealt = stage(dealt.withColumn("part", F.spark_partition_id()), "trie-dealt")
    # The last row of each part belongs before the next one that has rows, its first row behind the one before.
    border = [F.min_by(F.struct("ga", "gb", "key"), F.struct("ga", "gb", "key")), F.max_by(F.struct("ga", "gb", "key"), F.struct("ga", "gb", "key"))]
    edges = dealt.groupBy("part").agg(border[0].alias("lo"), border[1].alias("hi"))
    by_part = Window.partitionBy(F.lit(0)).orderBy("part")  # one row per part
    near = edges.select("part", F.lag("hi").over(by_part).alias("before"), F.lead("lo").over(by_part).alias("after"))
    both = near.select("part", F.explode(F.array("before", "after")).alias("k")).where("k IS NOT NULL").select("part", "k.*")
    zero = {c: F.lit(0).cast("long") for c in ("n_convs", "goes_on", "seg")}
    both = both.withColumns({**zero, "least": F.lit((1 << 63) - 1)})
    return dealt.unionByName(both, allowMissingColumns=True)


def _nodes(strings: DataFrame, segment: int, roots: bool, more: DataFrame | None = None) -> DataFrame:
    """Parts of nodes; ``more`` (``a, b, more_leaves, more_saved``): what hangs below the end of a row."""
    none = [F.lit(0).cast("long").alias(c) for c in ("more_leaves", "more_saved")]
    if more is None:
        rows = strings.select("*", *none)
    else:
        own = strings.join(more, ["a", "b"], "left")
        rows = own.select(*[c for c in strings.columns], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("more_leaves", "more_saved")])
    wide = rows.select(*_ROW).repartition("part").sortWithinPartitions("part", "ga", "gb", "key")
    return wide.mapInArrow(_parts(segment, roots), _PART_COLUMNS)


def _below(strings: DataFrame, segment: int) -> DataFrame:
    """``a, b, more_leaves, more_saved``: sums over all nodes below the end of a full segment."""
    own = _nodes(strings, segment, True).where(F.col("depth") % segment == 0).where("a = pa AND b = pb")
    own = own.groupBy("a", "b").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
    # The segment that a group of segments hangs on: its string's row is under the name of the group above.
    up = strings.where("n_convs > 0 AND goes_on > 0").select("a", "b", F.col("ga").alias("ua"), F.col("gb").alias("ub"))
    chain = stage(own.join(up, ["a", "b"]), "trie-chain")
    while not chain.where("ua IS NOT NULL").isEmpty():
        given = chain.where("ua IS NOT NULL").groupBy(F.col("ua").alias("a"), F.col("ub").alias("b")).agg(
            F.sum("leaves").alias("l"), F.sum("saved").alias("s")
        )
        jump = chain.select(F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("ua").alias("va"), F.col("ub").alias("vb"))
        now = chain.join(given, ["a", "b"], "left").join(jump, ["ua", "ub"], "left")
        chain = stage(
            now.select(
                "a", "b", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), F.col("va").alias("ua"), F.col("vb").alias("ub"),
            ),
            "trie-chain",
        )
    return chain.select("a", "b", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``a, b, conv_id`` rows to rows of joined ids."""
    for batch in batches:
        a, b, ids = (batch[c].to_pylist() for c in ("a", "b", "conv_id"))
        out, begin = [], 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or (a[i], b[i]) != (a[begin], b[begin]) or i - begin == RUN_IDS:
                out.append({"a": a[begin], "b": b[begin], "first": ids[begin], "ids": ",".join(map(str, ids[begin:i]))})
                begin = i
        if out:
            yield pa.RecordBatch.from_pylist(out, pa.schema([("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the joined ids of each node, from its runs in order."""
    held: list = []
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
    closed = lambda: {"a": held[0][0], "b": held[0][1], "ends_sha256": held[1].hexdigest()}
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            node = (row["a"], row["b"])
            if held and held[0] == node:
                held[1].update(b"," + row["ids"].encode())
            else:
                if held:
                    done.append(closed())
                held[:] = [node, hashlib.sha256(row["ids"].encode())]
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if held:
        yield pa.RecordBatch.from_pylist([closed()], schema)


def _ends(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """``a, b, ends_sha256``: digest of the ids of the conversations that end at a node."""
    zero = F.lit(0).cast("long")
    last = turns.select("conv_id", *_hashes()).unionByName(convs.select("conv_id", zero.alias("a"), zero.alias("b")))
    ends = last.groupBy("conv_id").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    ranged = ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    runs = ranged.select("a", "b", "conv_id").mapInArrow(_runs, "a long, b long, first long, ids string")
    return runs.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_digests, "a long, b long, ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """All nodes: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``convs``: every ``conv_id`` once; ``turns``: ``conv_id, pos`` (from 1, without gaps), ``name`` (16 bytes), ``chars``.
    """
    turns = stage(turns, "trie-turns")
    segments = stage(_segments(turns, segment), "trie-segments")
    strings = stage(_sorted_strings(segments, segment), "trie-sorted")
    more = None
    if not strings.where("goes_on > 0").isEmpty():
        more = _below(strings, segment)
    parts = stage(_nodes(strings, segment, False, more), "trie-parts")

    # A node's parts, its children and its ends are put together by its name, partly added up before the shuffle.
    zero = F.lit(0).cast("long")
    owned = parts.select("a", "b", "pa", "pb", "depth", "n_convs", "least", "n_leaves", "saved")
    children = parts.where("new > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.sum("new").alias("n_children"))
    top = parts.where("pa = 0 AND pb = 0")
    at_root = [zero.alias(c) for c in ("a", "b", "depth")]
    # The root has all conversations and what its children have; the others hang on nothing.
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("least")).where("n_convs > 0").select(*at_root, "n_convs", "least")
    sums = parts.where("depth = 1").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    every = owned
    for more in (root, sums, children, _ends(convs, turns)):
        every = every.unionByName(more, allowMissingColumns=True)
    nodes = every.groupBy("a", "b").agg(
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.min("least").alias("conv_id"), F.coalesce(F.sum("n_children"), zero).alias("n_children"),
        F.greatest(F.sum("n_leaves"), F.lit(1).cast("long")).alias("n_leaves"), F.coalesce(F.sum("saved"), zero).alias("saved_tokens"), F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
    return _with_parents(stage(nodes, "trie-nodes")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Adds ``parent_conv_id``. A parent of very many children is copied, and its children are dealt over the copies."""
    limit = max(HOT, nodes.count() // 100_000)
    # At most 100,000 rows, each with more than `limit` children.
    hot = nodes.where(F.col("n_children") > limit).select(
        F.col("a").alias("pa"), F.col("b").alias("pb"), F.ceil(F.col("n_children") / limit).alias("copies")
    )
    salted = nodes.join(F.broadcast(hot), ["pa", "pb"], "left").withColumn("salt", F.pmod(F.xxhash64("a", "b"), F.coalesce("copies", F.lit(1))))
    parents = nodes.where("n_children > 0").select(
        F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("n_children") > limit, F.ceil(F.col("n_children") / limit) - 1).otherwise(0))).alias("salt"),
    )
    return salted.join(parents, ["pa", "pb", "salt"], "left")


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuilt(conversations), segment)
