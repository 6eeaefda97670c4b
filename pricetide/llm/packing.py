"""Best-fit packing by minimum bin slack.

``pieces`` turns documents into pieces of at most ``capacity`` tokens; ``pack`` places pieces into sequences. A
sequence starts with the longest piece left; a bitset of reachable sums over the other lengths left then finds the
combination that fills it best, and that combination is removed. Pieces are dealt to shards of bounded size by hash,
and each shard is packed alone, so a run wastes at most the few last sequences of each shard.

Defined results: a null or empty text is the end token alone; repeated rows are packed like any other; only the id
column and the text are read. An empty table gives no pieces.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from pricetide.llm.common import map_arrow

CAPACITY = 2048
SHARD_PIECES = 32_768

# Words whose ids depend on nothing around them: letters that are composed and have one lower-case form, and after
# them a run of signs that is one more word for the tokenizer.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|\"$%&()*+/<=>@\[\]^_`{}~#-]*)")


def _byte_names() -> list[str]:
    """Byte-level vocabularies write a byte as its own character if printable, else as one after U+00FF."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


class WordTokens:
    """Ids of white-space separated chunks of text, as packed 32-bit integers; both memories are bounded."""

    MOST_CHUNKS, MOST_WORDS = 100_000, 300_000

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.names = _byte_names()
        self.forget()

    def forget(self) -> None:
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {"": b""}

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= self.MOST_WORDS:
                self.words = {"": b""}
            parts = self.tokenizer.model.tokenize("".join([self.names[b] for b in word.encode()]))
            got = self.words[word] = np.array([p.id for p in parts], "<u4").tobytes()
        return got

    def _chunk(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk)
        if plain and len(chunk) < 100:
            return self._word(plain[1].lower()) + self._word(plain[2])
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        chunks = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        try:
            return b"".join([self.chunks[c] for c in chunks])
        except KeyError:
            pass
        out, known = [], self.chunks
        for chunk in chunks:
            got = known.get(chunk)
            if got is None:
                got = self._chunk(chunk)
                if len(known) >= self.MOST_CHUNKS:
                    known.clear()
                    known[""] = b""
                if len(chunk) < 100:
                    known[chunk] = got
            out.append(got)
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def tokens(path: str) -> WordTokens:
    return WordTokens(path)


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece; ``keep_ids`` adds the packed ids themselves as ``ids``."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        coder, end, width = tokens(tokenizer_path), np.uint32(end_id).tobytes(), 4 * capacity
        out: list[list] = [[], [], [], [], [], []]
        for doc_id, text in zip(rows["doc_id"].to_pylist(), rows["text"], strict=True):
            ids = coder.ids(text.as_py() or "") + end
            for n, at in enumerate(range(0, len(ids), width)):
                part = ids[at : at + width]
                row = doc_id, n, at // 4, len(part) // 4, zlib.crc32(part), part
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + keep_ids]
        columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=False)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(narrow, batch, PIECE + ", ids binary" * keep_ids, done=lambda: tokens(tokenizer_path).forget())


def fill(room: int, left: np.ndarray, distinct: list[int]) -> list[int]:
    """Lengths, largest first, whose sum is the largest that fits ``room``; ``left`` counts the pieces of a length.

    Bit s of ``reach`` says that some combination of the lengths seen so far sums to s.
    """
    whole, reach, steps = (1 << (room + 1)) - 1, 1, []
    for size in distinct:
        if size > room:
            continue
        for _ in range(min(int(left[size]), room // size)):
            more = (reach | (reach << size)) & whole
            if more == reach:
                break
            steps.append((size, reach))
            reach = more
            if reach >> room:
                break
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, []
    for size, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(size)
            total -= size
    return chosen


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece."""
    order = np.argsort(lengths, kind="stable")
    left = np.bincount(lengths, minlength=capacity + 1)
    ends = np.cumsum(left)
    distinct = [int(s) for s in np.flatnonzero(left)[::-1]]
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    number = 0
    while distinct:
        longest = distinct[0]
        left[longest] -= 1
        place = 0
        sizes = [longest, *(fill(capacity - longest, left, distinct) if longest < capacity else [])]
        for k, size in enumerate(sizes):
            if k:
                left[size] -= 1
            ends[size] -= 1
            at = order[ends[size]]
            sequence[at], offset[at] = number, place
            place += size
        number += 1
        if any(not left[s] for s in sizes):
            distinct = [s for s in distinct if left[s]]
    return sequence, offset


def pack(rows: DataFrame, shards: int, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``; the sum of ``length`` over a sequence is at most ``capacity``."""

    def shard(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece"], kind="stable", na_position="first")
        sequence, offset = pack_lengths(group["length"].to_numpy(np.int64), capacity)
        return group.drop(columns="shard").assign(sequence_id=sequence + (int(group["shard"].iloc[0]) << 40), offset=offset)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    # The hash takes every column, so copies of one document spread over the shards.
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(*rows.columns), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(shard, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    shards = max(1, -(-docs.count() // SHARD_PIECES))
    return pack(pieces(docs, tokenizer_path, end_id, capacity), shards, capacity)
