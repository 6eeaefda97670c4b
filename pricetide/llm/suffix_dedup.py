"""Removal of repeated byte strings: every byte that a string of ``LENGTH`` bytes covers which starts elsewhere too.

Every window of ``LENGTH`` bytes belongs to its anchor, the ``ANCHOR`` bytes in it with the smallest hash (the first of
equal ones). The windows that share one anchor place form a segment. Equal windows have equal anchors at equal places,
so all places of a string meet under one anchor, and anchors that occur once are done with.

Equal segments under an anchor are named once, with their number of places. An anchor with one distinct segment in
several places settles it: all its windows repeat. The distinct segments of the other anchors go, by anchor, to shards,
whose suffixes are sorted with common-prefix values by external induced sorting (``suffix_array``); a window repeats if
its suffix shares ``LENGTH`` bytes with a neighbour or its segment has several places. A segment under an anchor that
is very common is first cut under longer anchors, up to whole windows, so its shard stays bounded.

Defined results: a null or empty text has no bytes and nothing is removed; matches never cross documents; rows that
are equal in id and text count as places of their own and get equal results, so all windows of such a row repeat.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pricetide.llm import suffix_array
from pricetide.llm.common import packed_parts, slices, tidy, unpacked
from pricetide.session import stage

LENGTH, ANCHOR = 200, 64
SHARD_INPUT = 12 << 20  # bytes of all places that a shard's segments stand for; the segments themselves are fewer
DOCS_PER_PART = 4_000
# Places of an anchor from which its segments are cut under longer anchors, and how long these are.
COMMON = ((2_000_000, 200), (20_000, 160))


def _window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` bytes, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    power, step, done, out = np.uint64(0x100000001B3), 1, 0, None
    left = width
    while left:
        if left & 1:
            out = h if out is None else out[: len(data) - done - step + 1] * power + h[done : done + len(data) - done - step + 1]
            done += step
        left >>= 1
        if left:
            n = len(h) - step
            h = h[:n] * power + h[step:]
            step, power = step * 2, power * power
    out = out ^ (out >> np.uint64(31))
    out = out * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values if step == width else np.minimum(values[: len(values) - (width - step)], values[width - step :])


def segments(data: bytes, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of each segment, in order."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        hashes = _window_hashes(np.frombuffer(data, np.uint8), anchor)
    width = length - anchor + 1
    best = _least(hashes, width)
    change = best[1:] != best[:-1]
    # Places that are smallest in some window: those where no window around has a larger smallest hash.
    around = np.concatenate([np.zeros(width - 1, np.uint64), best, np.zeros(width - 1, np.uint64)])
    anchors = np.flatnonzero(hashes == ~_least(~around, width))
    if ((hashes[anchors[1:]] == hashes[anchors[:-1]]) & (np.diff(anchors) <= width)).any():
        # Text that repeats in itself: a segment also ends where the first place of the smallest hash moves.
        change = _first_places(hashes, best, width)
    starts = np.concatenate([[0], np.flatnonzero(change) + 1])
    sizes = np.diff(np.concatenate([starts, [len(best)]]))
    return best[starts].view(np.int64), starts, sizes


def _first_places(hashes: np.ndarray, best: np.ndarray, width: int) -> np.ndarray:
    """True where the place of the smallest hash differs between a window and the next one."""
    order = np.argsort(hashes, kind="stable")
    rank = np.empty(len(hashes), np.int64)
    rank[order] = np.arange(len(hashes))
    # Ranks break ties by place, so their minimum names the first place of the smallest hash.
    least = _least(rank, width)
    return least[1:] != least[:-1]


PLACE = {"anchor": np.int64, "segment": np.int64, "doc_id": np.int64, "text_key": np.int64, "start": np.int32, "n": np.int32, "kind": np.uint8}
NORMAL, SPREAD, MARK = 0, 1, 2
# An anchor in so many places of one task's input is common: its later places are spread, and a mark goes where it belongs.
# So a task sends fewer than this many places of an anchor, and one mark, to the part that the anchor belongs to.
SPREAD_FROM = 64
# Counters of a task; anchors that share one are common a little sooner, which costs time and changes nothing else.
COUNTERS = 1 << 21
# Joins by a common anchor are dealt by so many remainders of the segment's hash as well.
SALTS = 64


class _Common:
    """Anchors that are common in what a task has read so far."""

    def __init__(self) -> None:
        self.seen, self.marked = np.zeros(COUNTERS, np.uint32), np.zeros(0, np.int64)

    def add(self, anchors: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the distinct ``anchors`` are common, and those of them that were not marked before."""
        slot = anchors.view(np.uint64) % np.uint64(COUNTERS)
        self.seen[slot] = np.minimum(self.seen[slot] + counts, SPREAD_FROM)
        common = (self.seen[slot] >= SPREAD_FROM) | (counts >= SPREAD_FROM)
        fresh = np.setdiff1d(anchors[common], self.marked, assume_unique=True)
        self.marked = np.union1d(self.marked, fresh)
        return common, fresh


def _places(rows: pa.RecordBatch, length: int, anchor: int) -> dict[str, np.ndarray] | None:
    """Every segment of the batch: anchor, hash of the whole segment, document, first window, number of windows."""
    parts: list[tuple] = []
    for doc_id, key, text in zip(rows["doc_id"].to_pylist(), rows["text_key"].to_pylist(), rows["text"], strict=True):
        data = (text.as_py() or "").encode()
        anchors, starts, sizes = segments(data, length, anchor)
        if len(anchors):
            own = [hashlib.blake2b(data[a : a + n + length - 1], digest_size=8).digest() for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
            n = len(anchors)
            document = NO_ID if doc_id is None else doc_id
            parts.append((anchors, np.frombuffer(b"".join(own), "<i8"), np.full(n, document), np.full(n, key), starts, sizes, np.zeros(n)))
    if not parts:
        return None
    return {name: np.concatenate(c).astype(kind) for (name, kind), c in zip(PLACE.items(), zip(*parts, strict=True), strict=True)}


# Stands for a null id inside this module.
NO_ID = -(1 << 63)


def _spread(places: dict[str, np.ndarray]) -> np.ndarray:
    """A number by document, text and place, so that copies of one text are dealt to different parts."""
    h = (places["doc_id"].view(np.uint64) + places["start"].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return places["text_key"] ^ (h ^ (h >> np.uint64(32))).view(np.int64)


def _hot_places(docs: DataFrame, parts: int, length: int, anchor: int) -> DataFrame:
    """Places of anchors that are in several places; ``mixed`` if their segments may differ."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Common()
        for whole in batches:
            for rows in slices(whole, "text", 2 << 20):
                found = _places(rows, length, anchor)
                if found is None:
                    continue
                by_anchor, inverse, count = np.unique(found["anchor"], return_inverse=True, return_counts=True)
                common, fresh = known.add(by_anchor, count)
                found["kind"][common[inverse]] = SPREAD
                marks = {name: np.zeros(len(fresh), kind) for name, kind in PLACE.items()}
                marks["anchor"], marks["kind"][:] = fresh, MARK
                both = {name: np.concatenate([found[name], marks[name]]) for name in PLACE}
                spread = np.where(both["kind"] == SPREAD, _spread(both), 0)
                part = (both["anchor"] ^ spread).view(np.uint64) % np.uint64(parts)
                yield packed_parts(part.astype(np.int64), parts, list(both.values()), list(PLACE))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = dict(zip(PLACE, unpacked(batches, PLACE), strict=True))
        if not len(rows["anchor"]):
            return
        order = np.lexsort((rows["kind"], rows["anchor"]))
        rows = {name: c[order] for name, c in rows.items()}
        first = np.flatnonzero(np.concatenate([[True], rows["anchor"][1:] != rows["anchor"][:-1]]))
        size = np.diff(np.concatenate([first, [len(order)]]))
        marked = np.maximum.reduceat(rows["kind"], first) > NORMAL
        differ = np.maximum.reduceat(rows["segment"], first) != np.minimum.reduceat(rows["segment"], first)
        hot, mixed = np.repeat((size > 1) | marked, size), np.repeat(differ | marked, size)
        keep = hot & (rows["kind"] != MARK)
        columns = [rows[name][keep] for name in list(PLACE)[:-1]] + [mixed[keep]]
        for start in range(0, len(columns[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[start : start + 100_000]) for c in columns], [*list(PLACE)[:-1], "mixed"])

    sent = docs.mapInArrow(tidy(find), "part int, " + ", ".join(f"{name} binary" for name in PLACE))
    kinds = "anchor long, segment long, doc_id long, text_key long, start int, n int, mixed boolean"
    return sent.repartition(parts, "part").mapInArrow(tidy(meet), kinds)


def _sort_shard(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The repeated windows of the shards in one partition, as runs of each row's windows."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    shard = rows["shard"].to_numpy()
    for number in np.unique(shard):  # the shards that were dealt to this task, one after the other
        part = rows.filter(pa.array(shard == number))
        texts = part["bytes"].to_pylist()
        symbols, starts = suffix_array.join(texts)
        same = suffix_array.repeated(symbols, length)
        places, begin, end = [], [], []
        for k, (start, text) in enumerate(zip(starts.tolist(), texts, strict=True)):
            own = np.concatenate([[False], same[start : start + len(text) - length + 1], [False]])
            edges = np.flatnonzero(own[1:] != own[:-1])
            places += [k] * (len(edges) // 2)
            begin.append(edges[::2])
            end.append(edges[1::2])
        if not places:
            continue
        found = part.select(["anchor", "segment"]).take(pa.array(places))
        shift = part["shift"].to_numpy()[places]
        columns = [found["anchor"].combine_chunks(), found["segment"].combine_chunks(), pa.array(np.concatenate(begin) + shift, pa.int32()), pa.array(np.concatenate(end) + shift, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["anchor", "segment", "begin", "end"])


def text_key(text: Column | str) -> Column:
    return F.xxhash64(text)


def repeated_windows(docs: DataFrame, hot: DataFrame, length: int, shards: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``begin``, ``end``: runs of windows that start elsewhere too."""
    plain = hot.where("NOT mixed").select("doc_id", "text_key", F.col("start").alias("begin"), (F.col("start") + F.col("n")).alias("end"))
    mixed = hot.where("mixed")
    one = F.struct("doc_id", "text_key", "start", "n")
    named = mixed.groupBy("anchor", "segment").agg(F.count("*").alias("held"), F.min(one).alias("one"))
    named = stage(named.select("anchor", "segment", "held", "one.*"), "suffix-named")
    # Only common anchors need their number of places; each stands here once for every salt.
    common = named.groupBy("anchor").agg(F.sum("held").alias("places")).where(F.col("places") >= COMMON[-1][0])
    common = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = named.withColumn("salt", F.pmod(F.xxhash64("segment"), F.lit(SALTS)).cast("int")).join(common, ["anchor", "salt"], "left")
    piece = F.struct("anchor", "segment", F.coalesce("places", F.lit(0)).alias("places"), "start", "n")
    wanted = salted.groupBy("doc_id", "text_key").agg(F.collect_list(piece).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in slices(whole, "text"):
                out: list[tuple] = []
                for text, wanted_here in zip(rows["text"], rows["wanted"].to_pylist(), strict=True):
                    data = text.as_py().encode()
                    for w in wanted_here:
                        piece = data[w["start"] : w["start"] + w["n"] + length - 1]
                        longer = next((k for most, k in COMMON if w["places"] >= most), 0)
                        if not longer:
                            out.append((w["anchor"], w["anchor"], w["segment"], 0, piece))
                            continue
                        for by, start, n in zip(*(x.tolist() for x in segments(piece, length, longer)), strict=True):
                            out.append((by, w["anchor"], w["segment"], start, piece[start : start + n + length - 1]))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 5, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["route", "anchor", "segment", "shift", "bytes"])

    # The same join at every size: the list of segments grows with the input, so it is never broadcast.
    texts = docs.select("doc_id", "text_key", "text").join(wanted.hint("merge"), ["doc_id", "text_key"]).select("text", "wanted")
    # A row of one text stands twice in ``docs`` if the row is repeated; one is enough.
    pieces = texts.mapInArrow(tidy(cut), "route long, anchor long, segment long, shift int, bytes binary")
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)).cast("int")).dropDuplicates(["shard", "anchor", "segment", "shift"])
    sorted_ = pieces.select("shard", "anchor", "segment", "shift", "bytes").repartition(shards, "shard").mapInArrow(tidy(lambda b: _sort_shard(b, length)), "anchor long, segment long, begin int, end int")
    several = named.where("held > 1").select("anchor", "segment", F.lit(0).alias("begin"), F.col("n").alias("end"))
    single = sorted_.join(named.where("held = 1").select("anchor", "segment"), ["anchor", "segment"], "left_semi")
    runs = mixed.join(several.union(single), ["anchor", "segment"])
    return plain.union(runs.select("doc_id", "text_key", F.col("start") + F.col("begin"), F.col("start") + F.col("end")))


def _with_runs(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """``doc_id``, ``text``, the other columns as ``rest``, and ``runs`` of repeated windows."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *([F.struct(*others).alias("rest")] if others else []),
    ).withColumn("text_key", text_key("text"))
    narrow = keyed.select("doc_id", "text_key", "text")
    parts = max(16, -(-docs.count() // DOCS_PER_PART))
    hot = stage(_hot_places(narrow, parts, length, anchor), "suffix-places")
    windows = hot.where("mixed").agg(F.sum(F.col("n") + F.lit(length).cast("long"))).first()[0] or 0
    shards = max(8, -(-windows // SHARD_INPUT))
    runs = repeated_windows(narrow, hot, length, shards)
    # As many runs as the document has windows at most.
    own = runs.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))
    joined = keyed.join(own.hint("merge"), ["doc_id", "text_key"], "left")
    back = F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id")
    return joined.select(back, "text", "runs", *(["rest"] if others else []))


def _spans(runs: list[dict] | None, length: int) -> list[tuple[int, int]]:
    return merge([(r["begin"], r["end"] + length - 1) for r in runs or []])


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id``, ``kept`` (the remaining bytes), ``n_bytes`` and ``spans`` (start and end of each removed run)."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in slices(whole, "text"):
                texts = [t.as_py().encode() for t in rows["text"]]
                spans = [_spans(r, length) for r in rows["runs"].to_pylist()]
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                columns = [
                    rows["doc_id"],
                    pa.array([without(t, s) for t, s in zip(texts, spans, strict=True)], pa.binary()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kept", "n_bytes", "spans"])

    found = _with_runs(docs.select("doc_id", "text"), length, anchor)
    return found.mapInArrow(tidy(apply), "doc_id long, kept binary, n_bytes long, spans array<struct<start:int,end:int>>")


def without_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """The input with the repeats taken out of ``text``. A character stays whole: it goes if all its bytes go. A null
    text becomes an empty one; the other columns pass."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in slices(whole, "text"):
                texts = []
                for text, runs in zip(rows["text"], rows["runs"].to_pylist(), strict=True):
                    data = text.as_py().encode()
                    texts.append(without(data, [whole_characters(data, a, b) for a, b in _spans(runs, length)]).decode())
                at, off = rows.schema.get_field_index("text"), rows.schema.get_field_index("runs")
                columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(rows.columns) if i != off]
                yield pa.RecordBatch.from_arrays(columns, [n for n in rows.schema.names if n != "runs"])

    found = _with_runs(docs, length, anchor)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields if f.name != "runs")
    done = found.mapInArrow(tidy(apply), kinds)
    return done.select(*[F.col(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c) for c in docs.columns])


def whole_characters(data: bytes, start: int, end: int) -> tuple[int, int]:
    """The part of a run that begins and ends between characters of UTF-8."""
    inside = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    while start < end and inside(start):
        start += 1
    while end > start and inside(end):
        end -= 1
    return start, end


def merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    place, out = 0, []
    for a, b in spans:
        out.append(data[place:a])
        place = b
    return b"".join([*out, data[place:]])
