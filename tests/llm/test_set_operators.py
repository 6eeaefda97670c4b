"""Suffix sorting and dedup, n-gram join, fingerprints, packing, embeddings and the pipeline against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pricetide.llm import fingerprint, itq, ngram_join, packing, queries, suffix_array, suffix_dedup
from pricetide.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=()):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    for name in extra:
        df = df.withColumn(name, F.col("doc_id"))
    return df


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# ---- connected components


def test_components(spark):
    rng = random.Random(0)
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    noise = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)] + [(5, 5), (1, 2)]
    edges = [*chain, *star, *noise]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- suffix sorting and dedup


@pytest.mark.parametrize("memory", [4, 1 << 20])
def test_suffix_order_and_prefixes(memory):
    rng = random.Random(memory)
    for _ in range(150):
        letters = b"abcd"[: rng.choice([1, 2, 4])]
        pieces = [bytes(rng.choice(letters) for _ in range(rng.randint(1, rng.choice([5, 40, 250])))) for _ in range(rng.choice([1, 2, 4]))]
        symbols, _ = suffix_array.join(pieces)
        cap = rng.choice([3, 20, 200])
        order, shared = [], []
        for places, prefixes in suffix_array.scan(symbols, cap, memory):
            order += places.tolist()
            shared += prefixes.tolist()
        data = symbols.tobytes()
        assert order == sorted(range(len(data)), key=lambda i: data[i:])[1:][::-1]
        for a, b, n in zip(order, order[1:], shared[1:], strict=False):
            x, y = data[a : a + cap], data[b : b + cap]
            assert n == next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


def removed(rows, length):
    """Row by row: bytes, removed bytes, runs and the hash of the rest, from a count of all windows."""
    data = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(d[k : k + length] for _, d in data for k in range(len(d) - length + 1))
    out = []
    for i, d in data:
        gone = np.zeros(len(d) + 1, bool)
        for k in range(len(d) - length + 1):
            if count[d[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int(np.count_nonzero(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if len(d) else 0
        kept = bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])
        out.append((i if i is not None else -1, len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    got = suffix_dedup.remove_repeats(df).select(
        "doc_id", "n_bytes", F.col("n_bytes") - F.length("kept"), F.size("spans"), F.sha2("kept", 256)
    )
    return sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in got.collect())


def hard_rows():
    rng = random.Random(8)
    base = prose(rng, 120, 10**6)
    rows = [(1, None), (2, ""), (3, "short"), (None, base), (4, base), (5, prose(rng, 100, 10**6)), (6, "ä" * 300), (7, "ab" * 400)]
    rows += [(8, "x" * 199), (9, "x" * 199 + "y"), (10, "z" * 200), (11, prose(rng, 30, 10**6) + base[50:260] + prose(rng, 30, 10**6))]
    rows += [(12, base[50:249] + "!"), (13, "same row " * 40), (13, "same row " * 40), (14, "é" + base[:230]), (15, "twice " + (p := prose(rng, 50, 10**6)) + " and " + p)]
    near = prose(rng, 300, 10**6).split()
    for i in range(20, 40):
        w = list(near)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"q{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows.append((41, prose(rng, 40_000, 10**6)))
    return rows


def test_suffix_dedup_matches_window_counts(spark):
    rows = hard_rows()
    assert found(documents(spark, rows, ("runs", "rest", "text_key", "shard", "begin"))) == removed(rows, 200)


def test_suffix_dedup_cuts_common_anchors_alike(spark, monkeypatch):
    rows = hard_rows()
    monkeypatch.setattr(suffix_dedup, "COMMON", ((12, 200), (3, 160)))
    assert found(documents(spark, rows)) == removed(rows, 200)


def test_suffix_dedup_counts_common_anchors_over_slices():
    known, first = suffix_dedup._Common(), np.array([3, 9])
    for i in range(suffix_dedup.SPREAD_FROM):
        common, fresh = known.add(first, np.array([1, 0 if i else 1]))
        last = i == suffix_dedup.SPREAD_FROM - 1
        assert common.tolist() == [last, False] and fresh.tolist() == ([3] if last else [])
    same_slot = np.array([3 + suffix_dedup.COUNTERS])  # shares the counter, so it is common at once, with a mark of its own
    assert [x.tolist() for x in known.add(same_slot, np.array([1]))] == [[True], [3 + suffix_dedup.COUNTERS]]
    common, fresh = known.add(first, np.array([1, 500]))
    assert common.tolist() == [True, True] and fresh.tolist() == [9]


def test_suffix_dedup_spreads_copies_of_one_text(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(600))
    docs = spark.range(0, 3000, 1, 4).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"), F.lit(5).cast("long").alias("text_key"))
    hot = suffix_dedup._hot_places(docs, 16, 200, 64)
    held = hot.groupBy(F.spark_partition_id().alias("part")).count().collect()
    total = sum(r["count"] for r in held)
    assert total == 3000 * hot.select("anchor").distinct().count()
    assert max(r["count"] for r in held) < total / 4
    rows = [(i, text) for i in range(200)] + [(200, "x" + text[:210]), (201, prose(rng, 60, 10**6))]
    assert found(documents(spark, rows)) == removed(rows, 200)


def test_suffix_dedup_stage_keeps_characters_and_columns(spark):
    rows = [(1, "é" * 150), (2, "x" + "é" * 150), (3, "clean text"), (4, None)]
    df = documents(spark, rows, ("runs", "spans"))
    out = suffix_dedup.without_repeats(df)
    assert out.columns == df.columns
    assert {r.doc_id: (r.text, r.runs, r.source) for r in out.collect()} == {1: ("", 1, "s"), 2: ("x", 2, "s"), 3: ("clean text", 3, "s"), 4: ("", 4, "s")}
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0
    assert suffix_dedup.whole_characters("aéb".encode(), 2, 3) == (3, 3)


# ---- n-gram join


def jaccard_groups(rows, words=5):
    sets = []
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x]
        sets.append((i, {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()))
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for p, (a, x) in enumerate(sets):
        for b, y in sets[p + 1 :]:
            if None not in (a, b) and x and 100 * len(x & y) >= 80 * len(x | y):
                r, s = find(a), find(b)
                parent[max(r, s)] = min(r, s)
    return sorted(((i if i is not None else -1), len(s), (find(i) if i is not None else -1)) for i, s in sets)


def near_rows():
    rng = random.Random(9)
    rows = [(1, None), (2, ""), (3, "a"), (4, "A "), (5, "a b c d"), (6, "a  B\tc\nd"), (7, "é É"), (8, "É é"), (None, "a b c d e f g"), (9, "a b c d e f g")]
    rows += [(10, "one two three"), (10, "four five six seven eight nine"), (11, "one two three"), (12, "   ")]
    n = 20
    for _ in range(12):
        base = prose(rng, rng.choice([6, 30, 80, 200]), 10**6).split()
        for _ in range(rng.choice([2, 5, 12])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append((n, " ".join(w[: len(w) - rng.randint(0, 3)])))
            n += 1
    line = prose(rng, 12, 10**6)
    rows += [(n + k, line + " " + prose(rng, rng.randint(1, 30), 10**6)) for k in range(40)]
    rows.append((n + 40, prose(rng, 30_000, 10**6)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [ngram_join.BLOCK_SHINGLES, 60])
def test_ngram_join_matches_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    rows = near_rows()
    got = ngram_join.link(documents(spark, rows, ("n", "signature", "grp", "hashes", "side")))
    plain = lambda v: -1 if v is None else v
    assert sorted((plain(r.doc_id), r.n_shingles, plain(r.component_id)) for r in got.collect()) == jaccard_groups(rows)


def test_ngram_join_empty_and_stage(spark):
    df = documents(spark, near_rows(), ("later", "grp"))
    assert ngram_join.link(df.limit(0)).count() == 0
    kept = ngram_join.first_of_each(df)
    want = sorted(i for i, _, c in jaccard_groups(near_rows()) if i == c)
    assert kept.columns == df.columns and sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == want


def test_prefix_tree_links_span_the_same_components():
    rng = random.Random(3)
    for _ in range(200):
        sets = []
        for _ in range(rng.randint(1, 25)):
            own = set(rng.sample(range(30), rng.randint(1, 20))) if not sets or rng.random() < 0.4 else set(rng.choice(sets).tolist()) ^ {rng.randrange(30)}
            if own and not any(set(s.tolist()) == own for s in sets):
                sets.append(np.array(sorted(own), np.uint32))
        for sides in (None, [rng.randrange(2) for _ in sets]):
            def groups(links):
                parent = list(range(len(sets)))
                def find(x):
                    while parent[x] != x:
                        x = parent[x]
                    return x
                for a, b in links:
                    a, b = find(a), find(b)
                    parent[max(a, b)] = min(a, b)
                return [find(x) for x in range(len(sets))]
            every = [
                (a, b) for a in range(len(sets)) for b in range(a)
                if (sides is None or sides[a] != sides[b])
                and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
            ]
            assert groups(ngram_join.tree_links(sets, sides)) == groups(every)


# ---- fingerprints


def test_fingerprint_is_a_multiset_sum(spark):
    a, b = "One line. Two parts!\nsecond line\n\nthird", "third\nsecond line\nOne line. Two parts!"
    df = spark.createDataFrame([(a, b, "second line", "third\nOne line. Two parts!")], "a string, b string, c string, d string")
    l = {c: fingerprint.lanes(F.col(c)) for c in "abcd"}
    row = df.select(
        fingerprint.hexadecimal(l["a"]).alias("a"),
        fingerprint.hexadecimal(l["b"]).alias("b"),
        fingerprint.hexadecimal(l["d"]).alias("d"),
        fingerprint.hexadecimal(fingerprint.combine(l["d"], l["c"])).alias("inserted"),
        fingerprint.hexadecimal(fingerprint.combine(l["a"], l["c"], -1)).alias("deleted"),
    ).first()
    assert row.a == row.b == row.inserted and row.d == row.deleted != row.a


def test_edited_fingerprints(spark):
    rng = random.Random(5)
    rows = [(i * i, "\n".join(prose(rng, 12, 10**6) + "." for _ in range(rng.randint(0, 12)))) for i in range(1, 120)]
    rows += [(-5, None), (0, "same"), (1_000_000, "é漢👍x"), (1_000_001, "same")]
    df = documents(spark, rows, ("bucket", "guest", "next", "lanes", "first", "own"))
    got = {r.doc_id: r for r in fingerprint.edited(df).collect()}
    order = sorted(rows)
    for (i, t), (_, follow) in zip(order, [*order[1:], order[0]], strict=True):
        t, follow = t or "", follow or ""
        half = len(t) // 2
        edit = t[: len(t) - half] + follow[:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        if edit == t:
            assert got[i].fingerprint == got[i].edited_fingerprint and got[i].near_edited == 1
    assert got[0].fingerprint == got[1_000_001].fingerprint
    long = [got[i] for i, t in rows if t and t.count("\n") > 6]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.9


def test_edited_fingerprints_small_tables(spark):
    assert fingerprint.edited(documents(spark, []).limit(0)).count() == 0
    one = fingerprint.edited(documents(spark, [(3, "ab")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"aa").hexdigest()
    odd = fingerprint.edited(documents(spark, [(None, "x"), (1, "a" * 150_000), (1, "b"), (1, "b")])).collect()
    assert len(odd) == 4


# ---- packing


def test_packing_pieces_and_sequences(spark):
    rng = random.Random(6)
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (4, prose(rng, 9_000, 10**6)), (None, "It's DON'T Ⅷ straße ﬁ é́  x\x1cy 12a <|endoftext|> a<|endoftext|>b word<|startoftext|>")]
    rows += [(i, prose(rng, rng.randint(1, 500), 10**6) + rng.choice(["!", "...", " 漢字"])) for i in range(10, 120)]
    got = packing.pack_documents(documents(spark, rows, ("piece", "shard", "ids", "length")), queries.WORDS).toPandas()
    coder = Tokenizer.from_file(queries.WORDS)
    want = []
    for i, t in rows:
        ids = np.array([*coder.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for n, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            want.append((-1 if i is None else i, n, a, len(part), zlib.crc32(part.tobytes())))
    plain = got.assign(doc_id=got.doc_id.fillna(-1).astype(int))
    assert sorted(plain[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, sequence in got.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert sequence.offset.tolist() == [0, *np.cumsum(sequence.length)[:-1]] and sequence.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1
    assert packing.pack_documents(documents(spark, []).limit(0), queries.WORDS).count() == 0


def test_fill_is_the_fullest_combination():
    rng = random.Random(7)
    for _ in range(200):
        lengths = [rng.randint(1, 12) for _ in range(rng.randint(1, 9))]
        room = rng.randint(0, 40)
        left = np.bincount(lengths, minlength=50)
        chosen = packing.fill(room, left, sorted(set(lengths), reverse=True))
        best = max(sum(x for k, x in enumerate(lengths) if m >> k & 1) for m in range(1 << len(lengths)) if sum(x for k, x in enumerate(lengths) if m >> k & 1) <= room)
        assert sum(chosen) == best and not collections.Counter(chosen) - collections.Counter(lengths)


# ---- embeddings


def embeddings(n=600, size=32):
    rng = np.random.default_rng(3)
    rows = []
    while len(rows) < n:
        base = rng.standard_normal(size)
        for _ in range(rng.choice([1, 1, 2, 6, 40])):
            rows.append((base + rng.uniform(0.02, 0.35) * rng.standard_normal(size)).astype(np.float32).tolist())
    return [(i, v, 0) for i, v in enumerate(rows)]


def brute(rows):
    ids = [i for i, _, _ in rows]
    v = np.array([v for _, v, _ in rows], np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    close = v @ v.T >= 0.9
    np.fill_diagonal(close, False)
    return ids, close


def reach(close):
    least = np.arange(len(close))
    while True:
        new = np.minimum(least, np.where(close, least[None, :], len(close)).min(axis=1))
        if (new == least).all():
            return least
        least = new


@pytest.mark.parametrize("block", [itq.BLOCK, 16])
def test_embedding_links_and_recall(spark, monkeypatch, block):
    monkeypatch.setattr(itq, "BLOCK", block)
    rows = embeddings()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("t", F.lit(1)).withColumn("vector", F.lit(2))
    got = {r.vec_id: r for r in itq.near_duplicates(df).collect()}
    ids, close = brute(rows)
    counts = close.sum(axis=1)
    assert counts.sum() > 1000 and all(got[i].n_links <= counts[k] for k, i in enumerate(ids))
    assert sum(r.n_links for r in got.values()) >= 0.9 * counts.sum()
    least = reach(close)
    assert all(got[i].component_id >= least[k] for k, i in enumerate(ids))
    assert np.mean([got[i].component_id == least[k] for k, i in enumerate(ids)]) > 0.95
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_embedding_odd_rows(spark):
    good = [1.0] * 8
    rows = [(1, good), (2, good), (3, None), (4, [0.0] * 8), (5, [1.0, None] * 4), (6, [float("nan")] * 8), (7, [float("inf")] * 8), (8, [1.0] * 3), (9, []), (None, good), (2, good)]
    got = itq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()}
    assert found[1] == (1, 1, True) and found[2] == (1, 1, False) and found[None] == (0, None, True)
    assert all(found[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)) and got.count() == 10
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert itq.near_duplicates(empty).count() == 0


# ---- pipeline


def test_pipeline_stages_keep_the_columns_and_run(spark):
    rng = random.Random(11)
    passage = prose(rng, 60, 10**6)
    rows = [(1, None), (2, "12 34"), (3, "clean words only here"), (4, f"{prose(rng, 40, 10**6)} {passage} mail ana@example.com"), (5, f"{passage} {prose(rng, 50, 10**6)}")]
    near = prose(rng, 100, 10**6)
    rows += [(6, near), (7, near), (8, near + " end")]
    docs = documents(spark, rows, ("spans", "runs"))
    columns = docs.columns
    kept = []
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, "").cache()
        assert docs.columns == columns
        kept.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    assert kept == [[3, 4, 5, 6, 7, 8], [3, 4, 5, 6], [3, 4, 5, 6], [3, 4, 5, 6]]
    texts = {r.doc_id: r for r in docs.collect()}
    assert passage[50:200] not in texts[4].text + texts[5].text and "ana@" not in texts[4].text
    assert texts[3].text == "clean words only here" and all(r.n_chars == len(r.text) for r in texts.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert sorted(r.doc_id for r in packed.where("piece = 0").collect()) == [3, 4, 5, 6]


def test_pipeline_run(spark):
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf).toPandas()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    firsts = {i for i, _, c in jaccard_groups([(i, t) for i, t in texts.items() if re.search(r"[^\W\d_]", t or "")]) if i == c}
    assert set(got.doc_id) == firsts


def test_embeddings_of_several_lengths(spark):
    pick = np.random.default_rng(3)
    rows = [(i, pick.standard_normal(16).tolist()) for i in range(40)]
    rows += [(100, [1.0, 2.0, 3.0]), (101, [2.0, 4.0, 6.0]), (102, [3.0, -1.0, 0.0]), (103, [5.0]), (104, [7.0]), (105, [1.0, 1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert len(got) == 46
    assert (got[100], got[101], got[102]) == ((1, 100), (1, 100), (0, 102))
    assert (got[103], got[104], got[105]) == ((1, 103), (1, 103), (0, 105))
