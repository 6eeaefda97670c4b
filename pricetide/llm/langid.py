"""Language identification as a mixture of languages per document.

``fit`` learns letter n-gram likelihoods per language. ``identify`` estimates each document's language proportions by
expectation-maximisation and selects the set of languages by penalised likelihood: languages enter in the order of
their proportions in the full mixture, as long as the likelihood gains more than half the logarithm of the number of
n-grams per language.

Defined results: a text that is null or has no letter is ``und`` with score 0 and no languages; so is every text if
there was nothing to learn from. Ties go to the language that sorts first. Repeated rows give repeated results. Only
``doc_id``, ``text`` and, to learn, ``lang`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from pricetide.llm.common import held_out, map_arrow

BUCKETS = 1 << 16
# Learned from this many documents of each language at most, taken by hash of the id.
DOCS_PER_LANGUAGE = 1536
SALTS = 64
# Text that is worked on at once: a text's n-grams take some 20 bytes for each language and byte.
SLICE_BYTES = 1 << 20
STEPS = 12
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")


def _letters() -> np.ndarray:
    """Byte classes: a-z in either case, bytes of other letters as they are, 0 for the rest."""
    table = np.zeros(256, np.uint32)
    for b in range(ord("a"), ord("z") + 1):
        table[b] = table[b - 32] = b
    table[128:] = np.arange(128, 256)
    return table


_CLASS = _letters()


def grams(text: str) -> np.ndarray:
    """Buckets of the text's three-byte windows that hold a letter; runs of other bytes count as one blank."""
    b = _CLASS[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    b = b[np.concatenate([[True], (b[1:] != 0) | (b[:-1] != 0)])]
    if len(b) < 3:
        return np.zeros(0, np.int64)
    g = b[:-2] * np.uint32(65599) ^ b[1:-1] * np.uint32(2654435) ^ b[2:] * np.uint32(40503)
    return ((g ^ (g >> np.uint32(15))) & np.uint32(BUCKETS - 1)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    likelihood: np.ndarray  # n-gram bucket x language


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Learn from the rows that are not held out and have a language, at most ``per_language`` of each."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    # A language is dealt over SALTS windows, so that a common one is not ranked by a single task.
    salted = known.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
    order = Window.partitionBy("lang", "salt").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    chosen = salted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= -(-per_language // SALTS))
    # At most per_language ids of each language: a bounded table.
    sample = known.select("doc_id", "text", "lang").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")

    def count(rows: pa.RecordBatch) -> pa.RecordBatch:
        langs, ids, totals = [], [], []
        for lang in sorted(set(rows["lang"].to_pylist())):
            total = np.zeros(BUCKETS, np.int64)
            for text, own in zip(rows["text"], rows["lang"].to_pylist(), strict=True):
                if own == lang:
                    np.add.at(total, grams(text.as_py()), 1)
            seen = np.flatnonzero(total)
            langs += [lang] * len(seen)
            ids.append(seen)
            totals.append(total[seen])
        columns = [pa.array(langs, pa.string()), pa.array(np.concatenate(ids), pa.int32()), pa.array(np.concatenate(totals), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    counts = map_arrow(sample, count, "lang string, gram int, n long", max_bytes=SLICE_BYTES).groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in counts})
    table = np.full((BUCKETS, len(languages)), 0.1)
    place = {lang: k for k, lang in enumerate(languages)}
    for r in counts:
        table[r["gram"], place[r["lang"]]] += r["n"]
    return Model(languages, (table / table.sum(axis=0)).astype(np.float32))


def _mixture(p: np.ndarray, n: np.ndarray, starts: np.ndarray, owner: np.ndarray, share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation from ``share``; the proportions and each document's log-likelihood."""
    total = np.add.reduceat(n, starts)[:, None]
    for _ in range(steps):
        part = share[owner] * p
        part *= (n / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, starts, axis=0) / total
    mixed = np.einsum("ij,ij->i", share[owner], p)
    return share, np.add.reduceat(n * np.log(np.maximum(mixed, 1e-30)), starts)


def proportions(texts: list[str], model: Model) -> np.ndarray:
    """Language proportions of each text after selection; rows of zeros where there is no n-gram."""
    width = len(model.languages)
    out = np.zeros((len(texts), width))
    seen, counts, rows = [], [], []
    for k, text in enumerate(texts):
        dense = np.bincount(grams(text), minlength=BUCKETS)
        own = np.flatnonzero(dense)
        if len(own):
            rows.append(k)
            seen.append(own)
            counts.append(dense[own])
    if not rows or not width:
        return out
    sizes = np.array([len(s) for s in seen])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    p, n = model.likelihood[np.concatenate(seen)], np.concatenate(counts).astype(np.float32)
    owner = np.repeat(np.arange(len(rows)), sizes)
    full, _ = _mixture(p, n, starts, owner, np.full((len(rows), width), 1 / width, np.float32), STEPS)
    order = np.argsort(-full, axis=1, kind="stable")
    penalty = np.log(np.maximum(np.add.reduceat(n, starts), 2)) / 2
    # The best single language needs no iteration.
    alone = np.add.reduceat(n[:, None] * np.log(p), starts, axis=0)
    first = alone.argmax(axis=1)
    best = alone.max(axis=1) - penalty
    share = np.zeros((len(rows), width))
    share[np.arange(len(rows)), first] = 1
    active = np.arange(len(rows))
    for k in range(2, width + 1):
        # Only documents that gained from the last language try one more.
        keep = np.isin(owner, active)
        local = np.searchsorted(active, owner[keep])
        at = np.concatenate([[0], np.flatnonzero(np.diff(local)) + 1])
        start = np.zeros((len(active), width), np.float32)
        np.put_along_axis(start, order[active, :k], 1.0 / k, axis=1)
        got, fitness = _mixture(p[keep], n[keep], at, local, start, STEPS)
        fitness = fitness - k * penalty[active]
        better = fitness > best[active]
        share[active[better]], best[active[better]] = got[better], fitness[better]
        active = active[better]
        if not len(active):
            break
    out[rows] = share
    return out


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (its proportion) and ``languages``: every selected language and its share."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in rows["text"].to_pylist()]
        shares = proportions(texts, model)
        best, scores, every = [], [], []
        for text, share in zip(texts, shares, strict=True):
            if share.sum() <= 0 or not _LETTER.search(text):
                best.append(UNDETERMINED)
                scores.append(0.0)
                every.append([])
                continue
            k = int(share.argmax())
            best.append(model.languages[k])
            scores.append(float(min(1.0, share[k])))
            every.append([{"lang": model.languages[i], "share": float(share[i])} for i in np.argsort(-share, kind="stable") if share[i] > 0])
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        columns = [rows["doc_id"], pa.array(best, pa.string()), pa.array(scores, pa.float64()), pa.array(every, kind)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "languages"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(narrow, batch, "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>", max_bytes=SLICE_BYTES)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The input rows that have a language, all columns as they are; a null ``lang`` is filled in. Without anything to
    learn from, the rows that have a letter, as they are."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in rows["text"].to_pylist()]
        shares = proportions(texts, model)
        known = bool(model.languages)
        has = [(not known or bool(s.sum() > 0)) and bool(_LETTER.search(t)) for t, s in zip(texts, shares, strict=True)]
        best = [model.languages[int(s.argmax())] if h and known else None for h, s in zip(has, shares, strict=True)]
        at = rows.schema.get_field_index("lang")
        columns = list(rows.columns)
        columns[at] = pa.array([given if given is not None else b for given, b in zip(columns[at].to_pylist(), best, strict=True)], pa.string())
        return pa.RecordBatch.from_arrays(columns, rows.schema.names).filter(pa.array(has, pa.bool_()))

    return map_arrow(docs, batch, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), max_bytes=SLICE_BYTES)
