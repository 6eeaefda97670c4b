"""N-gram Jaccard join with prefix trees.

A document's set is its distinct word shingles, as 64-bit hashes. All sets share one order: rare shingles last in the
trees, first in the prefixes; how common a shingle is comes from a count over all documents in a fixed number of
buckets, and the hash breaks ties, so the order is total and the join exact whatever the counts are.

1. Two sets that link share shingles of their prefixes (the rarest by the bucket counts). The posted shingles are
   counted exactly, and each set keeps the rarest by that count, as few as leave no link out. Sets that share one of
   these form candidate groups. Equal sets post once per batch; a shingle that many sets keep leaves a task once, with
   the smallest key that holds it, and the others of the task tied to that key.
2. Equal sets are one set. Each set of a group with several goes to its task once; a large group
   is cut into blocks, and every pair of blocks is a task, so no task holds more than two blocks.
3. A task stores its sets in a prefix tree. Each set walks the tree with the overlap of the path so far, shared by all
   sets below, and leaves a branch whose remaining length cannot reach the threshold, or whose sets all are in its own
   component already. So links inside a component that are not needed are not listed, and none between components is lost.

Defined results: a document without words or with a null text has an empty set and links with nothing; with fewer
words than a shingle the whole sequence is its one shingle. Rows that repeat an id are one document with several
texts. A row without an id links with nothing and has no component. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pricetide.llm.common import packed_parts, slices, tidy, unpacked
from pricetide.llm.components import components
from pricetide.session import stage

WORDS = 5
PERCENT = 80
BUCKETS = 1 << 17
BLOCK_SHINGLES = 1_500_000
DOCS_PER_PART = 4_000
GROUPS_PER_SHARD = 2_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes. Letters A-Z are lower-cased; ASCII white space ends a word."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    hashes = np.array([xxhash.xxh64_intdigest(t) for t in tokens], np.uint64)
    width = min(words, len(hashes))
    # A short sequence never equals a shingle: its length goes into the hash.
    total = np.full(len(hashes) - width + 1, words - width, np.uint64)
    for k in range(width):
        total += hashes[k : len(hashes) - width + 1 + k] * _ODD[k % len(_ODD)] * np.uint64(2 * (k // len(_ODD)) + 1)
    return np.unique(_mix(total))


def _signature(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _key(hashes: np.ndarray) -> int:
    """The first half of a set's signature, as a number."""
    return int.from_bytes(_signature(hashes)[:8], "little", signed=True)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _needed(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _rare_first(hashes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return hashes[np.lexsort((hashes, weight[_bucket(hashes)]))]


def _summaries(docs: DataFrame, words: int) -> DataFrame:
    """A row per document (size and signature of its set) and the bucket counts of each task, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        names = ["doc_id", "n", "signature", "key", "bucket", "held"]
        none = lambda n, kind: pa.nulls(n, kind)
        for whole in batches:
            for rows in slices(whole, "text"):
                sizes, signatures, keys = [], [], []
                for text in rows["text"]:
                    own = shingles(text.as_py(), words)
                    total += np.bincount(_bucket(own), minlength=BUCKETS)
                    sizes.append(len(own))
                    signatures.append(_signature(own) if len(own) else None)
                    keys.append(_key(own) if len(own) else None)
                n = rows.num_rows
                columns = [rows["doc_id"], pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), pa.array(keys, pa.int64()), none(n, pa.int32()), none(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)
        seen = np.flatnonzero(total)
        n = len(seen)
        columns = [none(n, pa.int64()), none(n, pa.int64()), none(n, pa.binary()), none(n, pa.int64()), pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(tidy(run), "doc_id long, n long, signature binary, key long, bucket int, held long")


def _group_runs(tokens: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, the smallest id of each, and the distinct pairs (smallest id, other id) of one token."""
    order = np.lexsort((ids, tokens))
    tokens, ids = tokens[order], ids[order]
    first = np.concatenate([[True], tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, bool)
    least = ids[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(tokens) else ids
    other = least != ids
    return tokens[first], ids[first], np.unique(np.stack([least[other], ids[other]], axis=1), axis=0)


def _sizes(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For sets of n shingles: how many of the rarest are looked at, and how many of those a partner shares at least.

    A partner shares ``needed`` shingles, so of the n - needed + common rarest ones it shares ``common``, if it looks
    as far itself. The smallest partner has ``needed`` shingles, and its own ``common`` is the guaranteed number.
    """
    needed = -(-percent * n // 100)
    return np.minimum(n, n - needed + 1 + n // 5), 1 + needed // 5


def _dealt(df: DataFrame, parts: int) -> DataFrame:
    return df.repartition(parts, "part")


def _candidates(docs: DataFrame, weight: np.ndarray, parts: int, words: int, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` of set keys that hold sets together which may link.

    The rarest shingles by bucket count are posted and counted exactly, by sets. Among its posted shingles a set then
    takes the rarest by that count, all but as many as a partner shares for sure, and one more: two sets that link
    still share one of these. Shingles that no other set posts come first and meet nobody, so a set that is mostly new
    text has no candidates, and passages that many documents share come last.
    """

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in slices(whole, "text"):
                tokens, own_keys, totals, seen = [], [], [], set()
                for text in rows["text"]:
                    own = shingles(text.as_py(), words)
                    key = _key(own)
                    if not len(own) or key in seen:
                        continue
                    seen.add(key)
                    looked = int(_sizes(np.array([len(own)]), percent)[0][0])
                    tokens.append(_rare_first(own, weight)[:looked])
                    own_keys.append(np.full(looked, key, np.int64))
                    totals.append(np.full(looked, len(own), np.int32))
                if tokens:
                    token = np.concatenate(tokens)
                    yield packed_parts((token % np.uint64(parts)).astype(np.int64), parts, [token, np.concatenate(own_keys), np.concatenate(totals)], ["tokens", "keys", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, key, n = unpacked(batches, {"tokens": np.uint64, "keys": np.int64, "n": np.int32})
        order = np.lexsort((key, token))
        token, key, n = token[order], key[order], n[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (key[1:] != key[:-1])])[: len(token)]
        token, key, n = token[new], key[new], n[new]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])[: len(token)])
        held = np.diff(np.concatenate([first, [len(token)]]))
        sets = np.repeat(np.minimum(held, 65_535), held).astype(np.uint16)
        shared = sets > 1
        token, key, n, sets = token[shared], key[shared], n[shared], sets[shared]
        by_key = np.argsort(key, kind="stable")
        token, key, n, sets = token[by_key], key[by_key], n[by_key], sets[by_key]
        if len(token):
            yield packed_parts((key.view(np.uint64) % np.uint64(parts)).astype(np.int64), parts, [token, key, n, sets], ["tokens", "keys", "n", "sets"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, key, n, sets = unpacked(batches, {"tokens": np.uint64, "keys": np.int64, "n": np.int32, "sets": np.uint16})
        if not len(token):
            return
        order = np.lexsort((token, sets, key))
        token, key, n = token[order], key[order], n[order].astype(np.int64)
        first = np.concatenate([[True], key[1:] != key[:-1]])
        start = np.flatnonzero(first)
        shared = np.diff(np.concatenate([start, [len(key)]]))
        looked, common = _sizes(n[start], percent)
        wanted = looked - common + 1 - (looked - shared)
        place = np.arange(len(key)) - np.repeat(start, shared)
        chosen = place < np.repeat(wanted, shared)
        token, least, pairs = _group_runs(token[chosen], key[chosen])
        if len(token):
            tied = packed_parts((pairs[:, 0].view(np.uint64) % np.uint64(parts)).astype(np.int64), parts, [pairs[:, 0], pairs[:, 1]], ["a", "b"])
            sent = packed_parts((token % np.uint64(parts)).astype(np.int64), parts, [token, least], ["tokens", "keys"])
            for batch in (sent, tied):
                names = ["part", "tokens", "keys", "a", "b"]
                columns = [batch[x] if x in batch.schema.names else pa.nulls(batch.num_rows, pa.binary()) for x in names]
                yield pa.RecordBatch.from_arrays(columns, names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, key, a, b = unpacked(batches, {"tokens": np.uint64, "keys": np.int64, "a": np.int64, "b": np.int64})
        _, _, pairs = _group_runs(token, key)
        pairs = np.unique(np.concatenate([pairs.reshape(-1, 2), np.stack([a, b], axis=1)]), axis=0)
        for start in range(0, len(pairs), 100_000):
            part = pairs[start : start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], ["a", "b"])

    posted = docs.select("text").mapInArrow(tidy(postings), "part int, tokens binary, keys binary, n binary")
    counted = _dealt(posted, parts).mapInArrow(tidy(count), "part int, tokens binary, keys binary, n binary, sets binary")
    chosen = _dealt(counted, parts).mapInArrow(tidy(choose), "part int, tokens binary, keys binary, a binary, b binary")
    return _dealt(chosen, parts).mapInArrow(tidy(meet), "a long, b long")


class PrefixTree:
    """Sets of ranks in ascending order, stored by common beginnings; a node holds the ranks after its parent's."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.nodes: list[tuple[np.ndarray, int, list[int], int]] = []  # ranks, depth, children, set or -1
        self.short, self.long, self.uniform = [], [], []
        path = [self._add(np.zeros(0, np.uint32), 0, -1)]
        before = np.zeros(0, np.uint32)
        for i in order:
            own = sets[i]
            n = min(len(own), len(before))
            differ = np.flatnonzero(own[:n] != before[:n])
            common = int(differ[0]) if len(differ) else n
            last = None
            while self.nodes[path[-1]][1] > common:
                last = path.pop()
            if self.nodes[path[-1]][1] < common:
                # Split the branch that was left: its upper part becomes a node of its own.
                ranks, depth, children, leaf = self.nodes[last]
                start = self.nodes[path[-1]][1]
                middle = self._add(ranks[: common - start], common, -1)
                self.nodes[middle][2].append(last)
                self.nodes[last] = (ranks[common - start :], depth, children, leaf)
                self.nodes[path[-1]][2][-1] = middle
                path.append(middle)
            node = self._add(own[common:], len(own), i)
            self.nodes[path[-1]][2].append(node)
            path.append(node)
            before = own
        self._measure(sets)

    def _add(self, ranks: np.ndarray, depth: int, leaf: int) -> int:
        self.nodes.append((ranks, depth, [], leaf))
        return len(self.nodes) - 1

    def _measure(self, sets: list[np.ndarray]) -> None:
        self.short, self.long = [1 << 60] * len(self.nodes), [0] * len(self.nodes)
        self.uniform = [-1] * len(self.nodes)
        stack = [(0, False)]
        while stack:
            node, done = stack.pop()
            _, _, children, leaf = self.nodes[node]
            if not done:
                stack.append((node, True))
                stack += [(c, False) for c in children]
                continue
            lengths = [len(sets[leaf])] if leaf >= 0 else []
            self.short[node] = min([*lengths, *(self.short[c] for c in children)], default=0)
            self.long[node] = max([*lengths, *(self.long[c] for c in children)], default=0)
            if leaf >= 0 and not children:
                self.uniform[node] = leaf


def tree_links(sets: list[np.ndarray], sides: list[int] | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (places in ``sets``) that span the components of the Jaccard graph; with ``sides``, of the links between
    side 0 and side 1. ``sets`` hold ranks in ascending order."""
    if not sets:
        return []
    inside = list(range(len(sets))) if sides is None else [i for i, s in enumerate(sides) if s == 1]
    asking = list(range(len(sets))) if sides is None else [i for i, s in enumerate(sides) if s == 0]
    tree = PrefixTree([sets[i] for i in inside])
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    mark = np.zeros(int(max((s[-1] for s in sets if len(s)), default=0)) + 1, bool)
    for x in asking:
        own, size = sets[x], len(sets[x])
        mark[own] = True
        stack = [(0, 0, False)]
        while stack:
            node, overlap, done = stack.pop()
            ranks, depth, children, leaf = tree.nodes[node]
            if done:
                # All sets below in one component: later walks from it can skip them.
                below = [tree.uniform[c] for c in children] + ([leaf] if leaf >= 0 else [])
                if min(below) >= 0 and len({find(inside[b]) for b in below}) == 1:
                    tree.uniform[node] = below[0]
                continue
            if tree.uniform[node] >= 0 and find(inside[tree.uniform[node]]) == find(x):
                continue
            overlap += int(np.count_nonzero(mark[ranks]))
            # The length below that leaves most room for the threshold.
            best = min(max(depth + size - overlap, tree.short[node]), tree.long[node])
            most = overlap + min(best - depth, size - overlap)
            if 100 * most < percent * (size + best - most):
                continue
            if leaf >= 0 and 100 * overlap >= percent * (size + depth - overlap):
                a, b = find(x), find(inside[leaf])
                if a != b:
                    out.append((x, inside[leaf]))
                    root[b] = a
            if children:
                stack.append((node, overlap, True))
                stack += [(c, overlap, False) for c in children]
        mark[own] = False
    return out


def _solve(rows: pd.DataFrame, weight: np.ndarray, percent: int) -> list[tuple[int, int]]:
    hashes = [np.frombuffer(b, np.uint64) for b in rows["hashes"]]
    vocabulary, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    # Common shingles first, so that alike sets share long paths.
    order = np.lexsort((vocabulary, weight[_bucket(vocabulary)]))[::-1]
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    cuts = np.cumsum([len(h) for h in hashes])[:-1]
    sets = [np.sort(part) for part in np.split(rank[inverse], cuts)]
    ids = rows["doc_id"].tolist()
    sides = rows["side"].tolist() if (rows["side"] >= 0).all() else None
    return [(ids[a], ids[b]) for a, b in tree_links(sets, sides, percent)]


def link(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    summary = stage(_summaries(narrow, words), "ngram-summary")
    weight = np.zeros(BUCKETS, np.int64)
    # A fixed number of buckets, whatever the input.
    for bucket, held in summary.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("held")).collect():
        weight[bucket] = held
    summary = summary.where("bucket IS NULL").select("doc_id", "n", "signature", "key")
    parts = max(16, -(-summary.count() // DOCS_PER_PART))

    groups = components(_candidates(narrow, weight, parts, words, percent), "ngram-groups").withColumnsRenamed({"node": "key", "component": "grp"})
    known = summary.where("doc_id IS NOT NULL AND signature IS NOT NULL")
    least = known.groupBy("signature").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.max("key").alias("key"))
    copies = known.join(least.select("signature", "least"), "signature").where("doc_id != least").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
    # One document of each distinct set, in groups with at least two sets. An id may have several texts, so a set is
    # named by its signature as well.
    sets = least.select(F.col("least").alias("doc_id"), "signature", "n", "key").join(groups, "key")
    total = sets.groupBy("grp").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles")).where("sets > 1")
    wanted = sets.join(total, "grp").withColumn("blocks", F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int"))
    wanted = stage(wanted.select("doc_id", "signature", "grp", "blocks"), "ngram-sets")
    shards = max(1, -(-wanted.count() // GROUPS_PER_SHARD))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in slices(whole, "text"):
                own = [shingles(t.as_py(), words) for t in rows["text"]]
                right = [_signature(h) == s.as_py() for h, s in zip(own, rows["signature"], strict=True)]
                columns = [rows["doc_id"], rows["signature"], rows["grp"], rows["blocks"], pa.array([h.tobytes() for h in own], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "signature", "grp", "blocks", "hashes"]).filter(pa.array(right))

    # The same join at every size: the list of sets grows with the input, so it is never broadcast.
    texts = narrow.join(wanted.hint("merge"), "doc_id").mapInArrow(tidy(gather), "doc_id long, signature binary, grp long, blocks int, hashes binary")
    own = F.pmod(F.xxhash64("signature"), F.col("blocks")).cast("int")
    dealt = (
        texts.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .withColumn("side", F.when(F.col("i") == F.col("j"), -1).otherwise((F.col("own") > F.col("other")).cast("int")))
        # Small groups share a task; a pair of blocks of a large one has its own.
        .withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("grp"), F.lit(shards))).otherwise(F.xxhash64("grp", "i", "j")))
    )

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, one in rows.drop_duplicates(["grp", "i", "j", "signature"]).groupby(["grp", "i", "j"], sort=False):
            found += _solve(one, weight, percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    links = dealt.select("task", "grp", "i", "j", "side", "doc_id", "signature", "hashes").groupBy("task").applyInPandas(solve, "a long, b long")
    joined = components(links.union(copies), "ngram-links").withColumnRenamed("node", "doc_id")
    return summary.join(joined, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The input without the documents that are linked, directly or not, to one with a smaller id."""
    linked = link(docs, words, percent)
    later = linked.where(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias("later")).distinct()
    # The list grows with the input: the same join at every size, never a broadcast.
    return docs.join(later.hint("merge"), docs["doc_id"] == later["later"], "left_anti")
