"""Toxicity scores on text restored from leetspeak, spacing and repetition.

The noisy channel writes a letter as itself, as a look-alike sign, several times in a row, or with separators around
it. ``restore`` finds the most likely source of a disguised word, or of a run of spaced-out words, by a Viterbi search
over the lattice of possible letters and word borders under a letter-trigram model counted from the whole corpus. The scorer is a list of weighted words and word
beginnings learned from labelled rows; words are compared with runs of one letter collapsed, on both sides.

Defined results: a null text scores like an empty one (the prior alone); a row without an id or label teaches
nothing; an id with several labels counts with its largest; repeated rows give repeated results. Only ``doc_id`` and
``text`` are read from documents, ``doc_id`` and ``toxic`` from labels.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricetide.llm.common import held_out, map_arrow

# Learned from this many labelled documents at most, taken by hash of the id.
TRAINING_DOCS = 16_000
# The model keeps this many words and beginnings at most, the surest.
TERMS = 40_000
# Of all terms compared, so many at most are expected to pass the test of significance by chance.
CHANCE = 0.05
PREFIXES = (4, 5, 6)
# Borders of spaced-out words: paths of the lattice so much less likely (as a logarithm) than the best one count too.
MARGIN = 20.0
# Parts between separators in one restored word at most.
LONGEST = 30
THRESHOLD = 0.7

# Signs that stand for letters.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "+": "t", "|": "il", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "#": "h",
}

_SIGNS = re.escape("".join(LOOKALIKES))
# Single characters between separators, at least three.
_SPACED = re.compile(rf"(?<![^\W_])[^\W_](?:[ .*_\-]{{1,2}}(?:[^\W_]|[@$!+|(])){{2,}}(?![^\W_])")
# A word that holds a look-alike next to a letter, an inner separator or a run of three.
_DISGUISED = re.compile(rf"(?=.*[^\W\d_])(?:.*[{_SIGNS}].*|.*[^\W\d_][ .*_\-]+[^\W\d_].*|.*(.)\1\1.*)")
_EDGES = re.compile(r"^[^\w@$!+|(<€£¡#]+|[^\w@$+|]+$")
_STRIPPED = " .*_-'’"
_PLACE = re.compile(r"([ .*_\-'’]+)|(.)\2*")
_RUN = re.compile(r"(.)\1+")

WIDTH = 64  # letter classes: 0 the edge, 1-26 a-z, 27-58 Latin letters with marks, 59 any other letter


def letter_class(code: int) -> int:
    if 97 <= code <= 122:
        return code - 96
    if 223 <= code <= 255 and code != 247:
        return code - 223 + 27
    return 59 if chr(code).isalpha() else 0


_CLASSES = np.array([letter_class(c) for c in range(0x250)], np.int64)


def trigram_counts(text: str) -> np.ndarray:
    """Ids of the text's letter trigrams, word edges included."""
    codes = np.frombuffer(f"  {text.lower()}  ".encode("utf-32-le"), np.uint32)
    c = np.where(codes < len(_CLASSES), _CLASSES[np.minimum(codes, len(_CLASSES) - 1)], 59)
    ids = (c[:-2] * WIDTH + c[1:-1]) * WIDTH + c[2:]
    return ids[(c[1:-1] > 0) | (c[2:] > 0)]


def letter_model(docs: DataFrame) -> np.ndarray:
    """Log-probability of a letter after the two before it, counted over every text. Its size is fixed (64 cubed)."""

    def count(rows: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros(WIDTH**3, np.int64)
        for text in rows["text"]:
            if text.is_valid:
                total += np.bincount(trigram_counts(text.as_py()), minlength=WIDTH**3)
        seen = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["gram", "n"])

    counted = map_arrow(docs.select(F.col("text").cast("string").alias("text")), count, "gram int, n long")
    table = np.full(WIDTH**3, 0.05)
    # At most WIDTH**3 rows, whatever the size of the corpus.
    for gram, n in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        table[gram] += n
    cube = table.reshape(WIDTH, WIDTH, WIDTH)
    return np.log(cube / cube.sum(axis=2, keepdims=True)).astype(np.float32)


def squeeze(word: str) -> str:
    return _RUN.sub(r"\1", word)


def restore(word: str, model: np.ndarray) -> str:
    """The likeliest letters behind a disguised lower-case word, or words with a blank between them."""
    return decoded(word, model).replace("\0", "")


def decoded(word: str, model: np.ndarray) -> str:
    """As ``restore``, with a zero character for each separator that is no border.

    Runs of one sign become one place of the lattice, which may stand for one letter or a double one. Separators become
    one place each: nothing, or the border of two words.
    """
    # state: last two classes -> (log-probability, letters as a linked list)
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for place in _PLACE.finditer(word.strip(_STRIPPED)):
        run = place[0]
        sign = run[0]
        grown: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        if place[1] is not None:
            grown |= {k: (fit, ("\0", letters)) for k, (fit, letters) in states.items()}
            for (a, b), (fit, letters) in states.items():
                total = fit + float(model[a, b, 0])
                if b and ((b, 0) not in grown or grown[b, 0][0] < total):
                    grown[b, 0] = total, (" ", letters)
            states = grown
            continue
        choices = [(c, -1.0) for c in LOOKALIKES.get(sign, "")]
        if sign.isalpha():
            choices.append((sign, 0.0))
        elif not choices:
            choices.append(("", -1.0))
        for (a, b), (fit, letters) in states.items():
            for letter, cost in choices:
                for copies in (1, 2) if len(run) > 1 and letter else (1,):
                    x, y, total, made = a, b, fit + cost, letters
                    for _ in range(copies if letter else 0):
                        k = letter_class(ord(letter))
                        total += float(model[x, y, k])
                        x, y, made = y, k, (letter, made)
                    if (x, y) not in grown or grown[x, y][0] < total:
                        grown[x, y] = total, made
        states = grown
    ends = ((fit + (float(model[a, b, 0]) if b else 0.0), made) for (a, b), (fit, made) in states.items())
    made, out = max(ends, key=lambda x: x[0])[1], []
    while made:
        out.append(made[0])
        made = made[1]
    return "".join(reversed(out)).strip(" \0")


def likely_words(path: str, model: np.ndarray) -> list[str]:
    """Words between separators of a decoded path, on the best path or on one that is less likely by ``MARGIN`` at most."""
    parts = [x for x in re.split("[ \0]", path) if x]
    size = len(parts)
    fits: dict[tuple[int, int], float] = {}
    for i in range(size):
        a = b = 0
        total = 0.0
        for j in range(i + 1, min(size, i + LONGEST) + 1):
            for c in parts[j - 1]:
                # A word after another one begins behind that one's last letter, the first one behind two edges.
                k = letter_class(ord(c))
                x = letter_class(ord(parts[i - 1][-1])) if i and not a and not b else a
                total += float(model[x, b, k])
                a, b = b, k
            fits[i, j] = total + float(model[a, b, 0])
    before, behind = [-math.inf] * (size + 1), [-math.inf] * (size + 1)
    before[0] = behind[size] = 0.0
    for (i, j), fit in sorted(fits.items()):
        before[j] = max(before[j], before[i] + fit)
    for (i, j), fit in sorted(fits.items(), reverse=True):
        behind[i] = max(behind[i], behind[j] + fit)
    return ["".join(parts[i:j]) for (i, j), fit in fits.items() if before[i] + fit + behind[j] >= before[size] - MARGIN]


def words(text: str) -> set[str]:
    """Distinct chunks of a text, and the runs of spaced-out characters as one chunk each."""
    found = set(text.split())
    found.update(m[0] for m in _SPACED.finditer(text))
    return found


def plain(chunk: str, model: np.ndarray) -> list[str]:
    """The words of a chunk in lower case without signs at its edges, restored if it looks disguised, runs collapsed.

    Where it holds separators, every word counts that they may likely border, and the chunk without separators."""
    word = _EDGES.sub("", chunk.lower())
    spaced = _SPACED.fullmatch(word) is not None
    if (spaced or len(word) <= 60) and (re.search(r"(.)\1\1", word) or (not word.isalpha() and _DISGUISED.fullmatch(word))):
        path = decoded(word, model)
        made = [re.sub("[ \0]", "", path), *(likely_words(path, model) if re.search("[ \0]", path) else [])]
        return list(dict.fromkeys(map(squeeze, made)))
    return [squeeze(word)]


def features(word: str) -> list[str]:
    return [f"{word}$", *(word[:n] for n in PREFIXES if len(word) > n)] if 3 <= len(word) <= 60 else []


def copy_key(text: str) -> int:
    """Smallest hash of the text's long words: mostly equal for near copies, which then teach once."""
    return min((zlib.crc32(w.encode()) for w in set(text.split()) if len(w) >= 8), default=zlib.crc32(text.encode()))


@dataclass
class Model:
    letters: np.ndarray
    prior: float
    weights: dict[str, float]
    known: set[str] = field(default_factory=set)
    evidence: dict[str, list[tuple[str, float]]] = field(default_factory=dict)

    MOST_KNOWN = 600_000

    def __getstate__(self):
        return {"letters": self.letters, "prior": self.prior, "weights": self.weights, "known": set(), "evidence": {}}

    def terms(self, text: str) -> dict[str, float]:
        """Restored words of the text that speak for the label, and their weights."""
        chunks = words(text)
        if len(self.known) > self.MOST_KNOWN:
            self.known, self.evidence = set(), {}
        for chunk in chunks - self.known:
            weighed = [(word, max((self.weights.get(f, 0.0) for f in features(word)), default=0.0)) for word in plain(chunk, self.letters)]
            if speaking := [x for x in weighed if x[1] > 0]:
                self.evidence[chunk] = speaking
            if len(chunk) <= 100:
                self.known.add(chunk)
        return dict(x for c in chunks & self.evidence.keys() for x in self.evidence[c])

    def score(self, text: str) -> tuple[float, dict[str, float]]:
        terms = self.terms(text)
        odds = self.prior + sum(sorted(terms.values(), reverse=True))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, odds)))), terms


def stems(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Weights without the beginnings that one longer term explains: a stem stays only if several endings follow it."""
    explained = {
        term[:n]
        for term, (rows, weight) in found.items()
        for n in PREFIXES
        if n < len(term.rstrip("$")) and term[:n] in found and rows >= 0.8 * found[term[:n]][0] and weight >= found[term[:n]][1] - 0.1
    }
    return {term: weight for term, (_, weight) in found.items() if term not in explained}


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCS, terms: int = TERMS) -> Model:
    """Learn from labelled rows that are not held out, at most ``most`` of them; the letter model from every text."""
    letters = letter_model(docs)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Ids and labels of a bounded sample; the texts stay distributed.
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")

    def keys(rows: pa.RecordBatch) -> pa.RecordBatch:
        key = pa.array([copy_key(t or "") for t in rows["text"].to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays([*rows.columns, key], [*rows.schema.names, "copies"])

    keyed = map_arrow(chosen, keys, ", ".join(f"{n} {k}" for n, k in chosen.dtypes) + ", copies long")
    chosen = keyed.groupBy("copies", "toxic").agg(F.min_by("text", "doc_id").alias("text"))

    def count(rows: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        memory: dict[str, list[str]] = {}
        for text, toxic in zip(rows["text"].to_pylist(), rows["toxic"].to_pylist(), strict=True):
            own = {""}  # stands for the row itself
            for chunk in words(text or ""):
                if chunk not in memory:
                    memory[chunk] = [f for word in plain(chunk, letters) for f in features(word)]
                own.update(memory[chunk])
            seen[int(toxic > 0)].update(own)
        names = list(seen[0].keys() | seen[1].keys())
        columns = [pa.array(names, pa.string()), *(pa.array([seen[k][n] for n in names], pa.int64()) for k in (1, 0))]
        return pa.RecordBatch.from_arrays(columns, ["feature", "toxic", "clean"])

    counts = map_arrow(chosen, count, "feature string, toxic long, clean long").groupBy("feature")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    row, rows = F.col("feature") == "", F.col("toxic") + F.col("clean")
    whole = counts.agg(
        F.max(F.when(row, F.col("toxic"))).alias("toxic"),
        F.max(F.when(row, F.col("clean"))).alias("clean"),
        F.count_if(rows >= 3).alias("compared"),
    ).first()
    if not whole["toxic"]:
        return Model(letters, -4.0, {})
    toxic, clean = float(whole["toxic"]), float(whole["clean"])
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    # Chernoff's bound on the chance that so many of a term's rows are toxic if it says nothing, as -log: what a row
    # adds to it does not depend on how many there are, so a rarer word passes with more rows.
    share = toxic / (toxic + max(clean, 0.5))
    part = lambda n, expected: F.when(n > 0, n * F.log(n / (rows * expected))).otherwise(0.0)
    sure = part(F.col("toxic"), share) + part(F.col("clean"), 1 - share)
    best = (
        counts.where(~row & (rows >= 3) & (F.col("toxic") > rows * share))
        .where(sure >= math.log(max(1, whole["compared"]) / CHANCE))
        .where((F.col("toxic") + 0.5) * F.lit((clean + 1) / (toxic + 1)) >= 30 * (F.col("clean") + 0.5))
        .select("feature", "toxic", weight.alias("weight"))
        .orderBy(sure.desc(), "feature")
        .limit(terms)
        .collect()
    )
    kept = stems({r["feature"]: (r["toxic"], r["weight"]) for r in best})
    return Model(letters, math.log((toxic + 0.5) / (clean + 0.5)), kept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` and ``terms``: the restored words that count, sorted."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        results = [model.score(t or "") for t in rows["text"].to_pylist()]
        columns = [rows["doc_id"], pa.array([s for s, _ in results], pa.float64()), pa.array([sorted(t) for _, t in results], pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "terms"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(narrow, batch, "doc_id long, score double, terms array<string>")
