"""Suffixes of a shard in order, by external induced sorting with common-prefix values.

Suffixes are S (smaller than the next) or L; an S behind an L is a star. Star substrings are named by their rank, and
if names repeat, the suffixes of the string of names are ranked first, recursively. The sorted stars, each with the
length of its common prefix with the one before (up to ``cap``), then induce the order of all L suffixes, and those
the order of all S suffixes: a suffix that is scanned puts the suffix one byte to its left into a queue, in the bucket
of its first byte, with a common-prefix value that is one more than the least value scanned since the bucket's last
entry. Buckets are read by byte, entries in the order of insertion, so the queue is a priority queue on (byte, rank).
Queue entries beyond ``memory`` go to a file.
"""

from __future__ import annotations

import os
import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

END, MARK, SHIFT = 0, 1, 2  # the last symbol of a shard, the one behind each segment, and what is added to a byte
BLOCK = 1 << 17


def join(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all segments and the start of each. UTF-8 has no byte above 0xF4, so symbols fit in a byte."""
    sizes = np.array([len(s) + 1 for s in segments])
    starts = np.cumsum(sizes) - sizes
    symbols = np.frombuffer(b"".join(s + b"\xff" for s in segments) + b"\xfe", np.uint8) + np.uint8(SHIFT)
    return symbols, starts  # 0xff + 2 wraps to MARK, 0xfe + 2 to END


def _types(symbols: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last one is S."""
    n = len(symbols)
    if n == 1:
        return np.ones(1, bool)
    rising, differ = symbols[:-1] < symbols[1:], symbols[:-1] != symbols[1:]
    # Equal neighbours have the type of the next place where they differ.
    at = np.where(differ, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = rising[np.minimum(at, n - 2)]
    return out


def _ranked(words, length: np.ndarray, per: int) -> tuple[np.ndarray, bool]:
    """Dense ranks of strings; ``words(which, round)`` packs the next ``per`` symbols. Equal strings share a rank."""
    n = len(length)
    keys = words(np.arange(n), 0)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    head = np.concatenate([[True], keys[1:] != keys[:-1]])
    # Places in the order that are tied with a neighbour, and the first place of their group; only these go on.
    at = np.flatnonzero(~head | np.concatenate([~head[1:], [False]]))
    own = np.maximum.accumulate(np.where(head[at], at, 0))
    turn = 1
    while len(at):
        which = order[at]
        edges = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        alive = np.maximum.reduceat(length[which] > per * turn, edges)
        alive = np.repeat(alive, np.diff(np.concatenate([edges, [len(at)]])))
        at, own, which = at[alive], own[alive], which[alive]
        if not len(at):
            break
        keys = words(which, turn)
        placed = np.lexsort((keys, own))
        order[at], keys = which[placed], keys[placed]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (keys[1:] != keys[:-1])])
        head[at] |= new
        tied = ~new | np.concatenate([~new[1:], [False]])
        own = np.maximum.accumulate(np.where(new, at, 0))[tied]
        at = at[tied]
        turn += 1
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(head) - 1
    return rank, bool(head.all())


def _next_star(stars: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Number of the first star behind each place; the last star is behind itself."""
    return np.minimum(np.searchsorted(stars, places, side="right"), len(stars) - 1)


def _star_ranks(symbols: np.ndarray, kinds: np.ndarray, stars: np.ndarray, bits: int) -> np.ndarray:
    """Ranks of the star suffixes: names of their substrings, and where names repeat, ranks of the names' string."""
    per, n = 63 // bits, len(symbols)
    last = stars[_next_star(stars, stars)]

    def words(which: np.ndarray, turn: int) -> np.ndarray:
        start, end, out = stars[which] + turn * per, last[which], np.zeros(len(which), np.uint64)
        for k in range(per):
            at = np.minimum(start + k, n - 1)
            code = symbols[at].astype(np.uint64) * np.uint64(2) + kinds[at].astype(np.uint64) + np.uint64(1)
            out = out << np.uint64(bits) | np.where(start + k <= end, code, np.uint64(0))
        return out

    names, single = _ranked(words, last - stars + 1, per)
    return names if single else _all_ranks(names)


def _all_ranks(symbols: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes of a string of names: each is its symbols up to the next star, then that star's rank."""
    n = len(symbols)
    kinds = _types(symbols)
    stars = np.flatnonzero(kinds & np.concatenate([[False], ~kinds[:-1]]))
    if not len(stars):
        stars = np.array([n - 1])
    bits = max(2, int(2 * symbols.max() + 3).bit_length())
    ranks = _star_ranks(symbols, kinds, stars, bits)
    # Symbols in order: for each name its L places, its S places, and its stars by rank.
    below = np.searchsorted(np.sort(symbols[stars]), np.arange(int(symbols.max()) + 1))
    code = 2 * symbols + kinds + below[symbols] + 1
    ends = np.zeros(n, np.int64)
    ends[stars] = 2 * symbols[stars] + 3 + ranks
    nearest = _next_star(stars, np.arange(n))
    last = np.where(np.arange(n) >= stars[-1], np.arange(n), stars[nearest])

    def words(which: np.ndarray, turn: int) -> np.ndarray:
        out, end = np.zeros(len(which), np.uint64), last[which]
        for k in range(2):
            at = np.minimum(which + 2 * turn + k, n - 1)
            own = np.where(at == end, np.where(which == end, code[at], ends[at]), code[at])
            out = out << np.uint64(32) | np.where(which + 2 * turn + k <= end, own, 0).astype(np.uint64)
        return out

    return _ranked(words, last - np.arange(n) + 1, 2)[0]


def common_prefixes(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Lengths of the common prefixes of pairs of suffixes, up to ``cap``, eight symbols at a time."""
    padded = np.concatenate([symbols, np.zeros(cap + 16, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    out = np.full(len(a), cap, np.int64)
    alive = np.arange(len(a))
    for at in range(0, cap, 8):
        differ = eight[a[alive] + at] ^ eight[b[alive] + at]
        ended = differ != 0
        low = differ[ended] & (~differ[ended] + np.uint64(1))
        out[alive[ended]] = np.minimum(cap, at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3))
        alive = alive[~ended]
        if not len(alive):
            break
    return out


class Queue:
    """Entries (place, common prefix) by bucket, first in first out; beyond ``memory`` entries they go to a file."""

    def __init__(self, memory: int, folder: str | None = None):
        self.memory, self.folder, self.file = memory, folder, None
        self.held = 0
        self.buckets: list[deque] = [deque() for _ in range(256)]

    def push(self, bucket: int, places: np.ndarray, prefixes: np.ndarray) -> None:
        if self.held + len(places) > self.memory:
            if self.file is None:
                self.file = tempfile.TemporaryFile(dir=self.folder)
            self.file.seek(0, os.SEEK_END)
            at = self.file.tell()
            self.file.write(places.tobytes() + prefixes.tobytes())
            self.buckets[bucket].append((at, len(places), places.dtype))
        else:
            self.held += len(places)
            self.buckets[bucket].append((places, prefixes))

    def pop(self, bucket: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All entries of the bucket, also those that are pushed meanwhile, in runs of about BLOCK."""
        own = self.buckets[bucket]
        while own:
            parts, size = [], 0
            while own and size < BLOCK:
                part = own.popleft()
                if len(part) == 3:
                    at, n, kind = part
                    self.file.seek(at)
                    data = self.file.read(n * (kind.itemsize + 1))
                    part = np.frombuffer(data[: n * kind.itemsize], kind), np.frombuffer(data[n * kind.itemsize :], np.uint8)
                else:
                    self.held -= len(part[0])
                parts.append(part)
                size += len(part[0])
            yield np.concatenate([p for p, _ in parts]), np.concatenate([v for _, v in parts])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class _Scan:
    """One induction pass: what is scanned feeds the queue of the suffixes to the left that are wanted."""

    def __init__(self, symbols: np.ndarray, wanted: np.ndarray, cap: int, queue: Queue):
        self.symbols, self.wanted, self.cap, self.queue = symbols, wanted, cap, queue
        self.least = np.full(256, cap, np.int64)  # of the values scanned since a bucket's last entry
        self.used = np.zeros(256, bool)

    def feed(self, places: np.ndarray, prefixes: np.ndarray) -> None:
        for start in range(0, len(places), BLOCK):
            self._feed(places[start : start + BLOCK], prefixes[start : start + BLOCK])

    def _feed(self, places: np.ndarray, prefixes: np.ndarray) -> None:
        left = places - 1
        ok = (places > 0) & self.wanted[left]
        index = np.flatnonzero(ok)
        left = left[index]
        first = self.symbols[left]
        lowest = int(prefixes.min()) if len(prefixes) else self.cap
        order = np.argsort(first, kind="stable")
        cuts = np.flatnonzero(np.diff(first[order])) + 1
        after = np.minimum(self.least, lowest)
        for group in np.split(order, cuts) if len(order) else []:
            bucket = int(first[group[0]])
            at = index[group]
            bounds = np.concatenate([[0], at + 1])
            whole = at[-1] + 1 < len(prefixes)
            low = np.minimum.reduceat(prefixes, bounds if whole else bounds[:-1])
            values = low[: len(at)].astype(np.int64)
            values[0] = min(values[0], self.least[bucket])
            values = np.minimum(values + 1, self.cap)
            if not self.used[bucket]:
                values[0] = 0
            self.used[bucket] = True
            after[bucket] = low[-1] if whole else self.cap
            self.queue.push(bucket, left[group], values.astype(np.uint8))
        self.least = after


def scan(symbols: np.ndarray, cap: int, memory: int = 32 << 20, folder: str | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes but the last from the largest to the smallest, in blocks: their places, and the length (up to
    ``cap``, at most 255) of each one's common prefix with the suffix before it in this order."""
    kinds = _types(symbols)
    stars = np.flatnonzero(kinds & np.concatenate([[False], ~kinds[:-1]])).astype(np.int64)
    ranks = _star_ranks(symbols, kinds, stars, 10)
    order = np.empty(len(stars), np.int64)
    order[ranks] = stars
    place = np.int32 if len(symbols) < 1 << 31 else np.int64
    order = order.astype(place)
    values = np.concatenate([[0], common_prefixes(symbols, order[:-1], order[1:], cap)]).astype(np.uint8)
    starts = np.searchsorted(symbols[order], np.arange(257))
    queue = Queue(memory, folder)
    larger = Queue(memory, folder)  # the sorted L suffixes by bucket
    one = lambda a, b: int(common_prefixes(symbols, np.array([a]), np.array([b]), cap)[0])
    try:
        run = _Scan(symbols, ~kinds, cap, queue)
        for c in range(256):
            before = None
            for places, prefixes in queue.pop(c):
                larger.push(c, places, prefixes)
                before = places[-1]
                run.feed(places, prefixes)
            own = slice(starts[c], starts[c + 1])
            if starts[c] < starts[c + 1]:
                prefixes = values[own].copy()
                prefixes[0] = one(before, order[starts[c]]) if before is not None else 0
                run.feed(order[own], prefixes)
        run = _Scan(symbols, kinds, cap, queue)
        for c in range(255, -1, -1):
            before = None
            for places, prefixes in queue.pop(c):
                before = places[-1]
                run.feed(places, prefixes)
                yield places, prefixes
            ascending = list(larger.pop(c))
            follow = 0  # of the suffix just above with the next one down
            for places, prefixes in reversed(ascending):
                down = places[::-1]
                shared = np.concatenate([[follow], prefixes[:0:-1]]).astype(np.uint8)
                if before is not None and places is ascending[-1][0]:
                    shared[0] = one(before, down[0])
                follow = int(prefixes[0])
                run.feed(down, shared)
                yield down, shared
    finally:
        queue.close()
        larger.close()


def repeated(symbols: np.ndarray, length: int) -> np.ndarray:
    """True where a suffix shares its first ``length`` symbols with another one."""
    out = np.zeros(len(symbols), bool)
    before = None
    for places, prefixes in scan(symbols, length):
        same = prefixes >= length
        out[places[same]] = True
        out[places[:-1][same[1:]]] = True
        if same[0] and before is not None:
            out[before] = True
        before = places[-1]
    return out
