"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Defined results: a null text is an empty text and has no ids; repeated rows give repeated results; only the id
column and the text are read, so further columns of any name do not matter. Texts are encoded whole: long ones
are handed to the library in runs cut where the pattern always ends a match, so the ids are those of one call.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from pricetide.llm.common import map_arrow

RUN_CHARS = 50_000

# The pattern never matches across these places: white space after something else, and a change between letters
# and digits. What follows the place does not see what stands before it.
_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


@functools.lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def runs(text: str, limit: int = RUN_CHARS) -> Iterator[str]:
    """Cut a long text at safe places, each run about ``limit`` characters or up to the next safe place."""
    start = 0
    while len(text) - start > limit:
        place = _SAFE.search(text, start + limit)
        if place is None or place.start() >= len(text):
            break
        yield text[start : place.start()]
        start = place.start()
    yield text[start:]


def encode_text(text: str, coder: tiktoken.Encoding, pattern: str) -> list[int]:
    ids: list[int] = []
    for run in runs(text):
        if len(run) <= 4 * RUN_CHARS:
            ids += coder.encode_ordinary(run)
        else:
            # One match or one white space run is very long: match here, merge each match alone.
            for match in regex.finditer(pattern, run):
                ids += coder._encode_single_piece(match[0])
    return ids


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids``: the ids of the whole text, packed as little-endian unsigned 32-bit integers."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoding(ranks_path, pattern)
        packed = [np.asarray(encode_text(t.as_py() or "", coder, pattern), "<u4").tobytes() for t in rows["text"]]
        return pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(packed, pa.binary())], ["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), batch, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``bytes``: the raw bytes that packed ids stand for, which need not be valid UTF-8."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoding(ranks_path, pattern)
        out = [coder.decode_bytes(np.frombuffer(i.as_py() or b"", "<u4").tolist()) for i in rows["ids"]]
        return pa.RecordBatch.from_arrays([rows["doc_id"], rows["ids"], pa.array(out, pa.binary())], ["doc_id", "ids", "bytes"])

    return map_arrow(encoded.select("doc_id", "ids"), batch, "doc_id long, ids binary, bytes binary", "ids")
