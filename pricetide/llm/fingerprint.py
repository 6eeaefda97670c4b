"""Homomorphic multiset fingerprints of documents, with DataFrame functions only.

A paragraph (a line with text) is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs'
vectors, lane by lane modulo a power of two. So the order of paragraphs does not matter, equal multisets have equal
fingerprints, and a paragraph is inserted or deleted by adding or subtracting its vector (``combine``). The vector has
two parts: 8 lanes of 32 bits hashed from the whole paragraph, for equality, and 40 words of 60 bits in which every
sentence of the paragraph adds a hash bit to each of 120 counters, for likeness: two documents' counters, centred on
their sentence counts, have about the cosine of their sentence multisets.

Defined results: a null text is an empty text, whose lanes are all 0. ``edited`` orders a null id first and rows of
one id by their text; a table of one row is its own next document. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SEEDS, WIDE_SEEDS = 4, 2
STEPS = 20  # bits of a hash that go to one word each, three counters of 20 bits per word
COUNTER = (1 << 20) - 1
THIRD = 1 | 1 << 20 | 1 << 40
WORD60, WORD32 = (1 << 60) - 1, (1 << 32) - 1
# Ids are dealt by knots of their distribution; a bucket then holds about so many rows.
KNOTS, BUCKET_ROWS, MOST_BUCKETS = 64, 2_000, 65_536


def _sum(hashes: Column, term, mask: int) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda total, h: (total + term(h)).bitwiseAND(F.lit(mask)))


def _hashes(parts: Column, seed: int) -> Column:
    return F.transform(parts, lambda p: F.xxhash64(p, F.lit(seed)))


def _lanes(equal: Column, wide: Column, n: Column) -> Column:
    return F.named_struct(F.lit("equal"), equal, F.lit("wide"), wide, F.lit("n"), n)


def lanes(text: Column) -> Column:
    """Struct of ``equal`` (8 lanes), ``wide`` (40 words) and ``n`` (sentences)."""
    filled = lambda parts: F.filter(parts, lambda p: F.trim(p) != "")
    paragraphs = filled(F.split(text, "\n", -1))
    sentences = filled(F.split(text, r"\n|(?<=[.!?])\s", -1))
    equal = F.array(
        *[
            F.transform(
                F.array(_hashes(paragraphs, seed)),
                lambda hs: F.array(
                    _sum(hs, lambda h: h.bitwiseAND(F.lit(WORD32)), WORD32),
                    _sum(hs, lambda h: F.shiftrightunsigned(h, 32), WORD32),
                ),
            )[0]
            for seed in range(SEEDS)
        ]
    )
    wide = F.array(
        *[
            F.transform(
                F.array(_hashes(sentences, SEEDS + seed)),
                lambda hs: F.transform(
                    F.sequence(F.lit(0), F.lit(STEPS - 1)),
                    lambda j: _sum(hs, lambda h: F.call_function("shiftrightunsigned", h, j).bitwiseAND(F.lit(THIRD)), WORD60),
                ),
            )[0]
            for seed in range(WIDE_SEEDS)
        ]
    )
    return _lanes(F.flatten(equal), F.flatten(wide), F.size(sentences).cast("long"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of the union of two documents' paragraphs, or with ``sign`` -1 of the first without the second."""
    add = lambda mask: lambda x, y: F.pmod(x + sign * y, F.lit(mask + 1))
    return _lanes(
        F.zip_with(a["equal"], b["equal"], add(WORD32)), F.zip_with(a["wide"], b["wide"], add(WORD60)), a["n"] + sign * b["n"]
    )


def hexadecimal(l: Column) -> Column:
    equal = F.transform(l["equal"], lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    wide = F.transform(l["wide"], lambda x: F.lpad(F.lower(F.hex(x)), 15, "0"))
    return F.concat(F.array_join(equal, ""), F.array_join(wide, ""))


def centred(l: Column) -> Column:
    """The 120 counters as signed sums: twice the counter less the number of sentences."""
    return F.flatten(
        F.transform(
            l["wide"],
            lambda w: F.array(*[(F.shiftright(w, 20 * k).bitwiseAND(F.lit(COUNTER)) * 2 - l["n"]).cast("double") for k in range(3)]),
        )
    )


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two arrays of centred counters; 1 for equal ones."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a) * dot(b, b))
    cosine = F.when(size > 0, dot(a, b) / size).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def _bucket(docs: DataFrame) -> Column:
    """Number of an id's bucket, growing with the id; buckets hold about equally many rows if ids are spread evenly
    between knots."""
    stats = docs.agg(F.count("*").alias("rows"), F.percentile_approx("doc_id", [k / KNOTS for k in range(KNOTS + 1)], 1000).alias("knots")).first()
    knots = sorted(set(stats["knots"] or []))
    per = max(1, min(MOST_BUCKETS, stats["rows"] // BUCKET_ROWS) // KNOTS)
    out = F.lit(0)
    if len(knots) > 1:
        table = F.array(*[F.lit(k).cast("long") for k in knots])
        at = F.greatest(F.lit(1), F.least(F.lit(len(knots) - 1), F.size(F.filter(table, lambda k: k <= F.col("doc_id")))))
        low, high = F.element_at(table, at).cast("double"), F.element_at(table, at + 1).cast("double")
        inside = F.floor((F.col("doc_id").cast("double") - low) / (high - low) * per)
        out = at * per + F.greatest(F.lit(0), F.least(F.lit(per - 1), inside))
    return F.coalesce(out.cast("long"), F.lit(-1).cast("long"))


def with_next(docs: DataFrame) -> DataFrame:
    """Each row with the text and lanes of the next document by id; one shuffle of the rows.

    The first rows of a bucket are sent to the bucket before as guests, so every row finds its next in its bucket.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bucket = _bucket(rows)
    firsts = rows.select(bucket.alias("bucket"), "doc_id").groupBy("bucket").agg(F.min("doc_id").alias("first"))
    # One row per bucket, MOST_BUCKETS and KNOTS at most.
    turn = Window.partitionBy(F.lit(0)).orderBy("bucket")
    whole = Window.partitionBy(F.lit(0))
    before = F.coalesce(F.lag("bucket").over(turn), F.max("bucket").over(whole))
    firsts = firsts.select("first", F.col("bucket").alias("own"), before.alias("before"))
    dealt = rows.withColumn("bucket", bucket).join(
        F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("bucket") == F.col("own")), "left"
    )
    places = F.when(
        F.col("own").isNotNull(),
        F.array(F.struct(F.col("bucket"), F.lit(0).alias("guest")), F.struct(F.col("before").alias("bucket"), F.lit(1).alias("guest"))),
    ).otherwise(F.array(F.struct(F.col("bucket"), F.lit(0).alias("guest"))))
    sent = dealt.select("doc_id", "text", lanes(F.col("text")).alias("lanes"), F.explode(places).alias("at"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return (
        sent.select("doc_id", "text", "lanes", "at.bucket", "at.guest")
        .withColumn("next", F.lead(F.struct("text", "lanes")).over(order))
        .where(F.col("guest") == 0)
    )


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text: its last half replaced by the next one's beginning."""
    half = F.floor(F.length("text") / 2).cast("int")
    edit = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(F.col("next.text"), F.lit(1), half))
    whole = with_next(docs).select("doc_id", "text", "lanes", F.col("next.lanes").alias("next_lanes"), edit.alias("edited_text"))
    marked = whole.withColumn("edited_lanes", lanes(F.col("edited_text")))
    own = centred(F.col("lanes"))
    return marked.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        hexadecimal(F.col("lanes")).alias("fingerprint"),
        hexadecimal(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(own, centred(F.col("edited_lanes"))).alias("near_edited"),
        likeness(own, centred(F.col("next_lanes"))).alias("near_next"),
    )
