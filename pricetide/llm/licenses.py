"""License scans with DataFrame functions only.

``base_scan`` finds license phrases as consecutive words. ``template_blocks`` is an exact set-similarity join of text
blocks with license templates: every block whose words contain a template's words to the threshold is found. Blocks are
lines and, if asked for, windows over the words of the whole text, which line breaks and comment signs do not cut. A
template of n words is compared with windows of 2 n words that begin every n / 2 words: it is found if the words that
reach the threshold lie within 1.5 n words.
Words are ordered by their frequency over all blocks, rarest first. A template is indexed under its prefix alone (a
block without any prefix word cannot reach the threshold); candidates then pass a length and a positional filter
before the overlap is counted: a shared word at places p and q of the two ordered sets leaves at most min(p, q) words
before and the shorter rest behind. Each text is looked at once; a row per text, with its template words, is staged.

Defined results: a null text is an empty text, without words, places or labels; repeated rows are scanned each for
itself; ties need no rule, as all results are counts, extremes and sorted sets. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricetide.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_IN, _OUT = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Short public notices and opening sentences of public licenses, and their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
THRESHOLD_PERCENT = 80


def lowered(text: Column | str) -> Column:
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), UPPER, LOWER)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def _count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def read(docs: DataFrame, templates: list[tuple[str, str]], percent: int, wrapped: bool) -> DataFrame:
    """What the scans need of every row, from one look at its text: ``doc_id, text_key, n_words``, the phrases (``hits``,
    ``first_word``, ``last_word``), ``lines`` (number and template words of each line that has some), and with ``wrapped``
    the text again (``low``, else null) where it has several lines that hold a template's words together.

    No phrase ends as another begins, so a scan for the next phrase behind the last one finds every place.
    """
    sets = [sorted(set(text.split(" "))) for _, text in templates]
    own = F.array(*map(F.lit, sorted({w for words in sets for w in words})))
    phrases = "|".join(p.replace(" ", f"{_OUT}+") for p in PHRASES)
    pattern = F.lit(f"(?<!{_IN})({phrases})(?!{_IN})")
    # A line's words do not cross its end, so a text's words are those of its lines; each is cut into words once.
    parts = F.transform(F.split("low", "\n", -1), lambda line: _words(line))
    held = F.transform(
        "parts", lambda words, i: F.struct(i.alias("block"), F.size(words).alias("n"), F.array_intersect(words, own).alias("own"))
    )
    some = F.array_distinct(F.flatten(F.transform("lines", lambda line: line["own"])))
    enough = F.lit(False)
    for words in sets:
        enough = enough | (F.size(F.array_intersect("some", F.array(*map(F.lit, words)))) >= _need(words, percent))
    # Few texts hold a first word of a phrase at all; only those are searched for the phrases.
    maybe = F.lit(False)
    for phrase in PHRASES:
        maybe = maybe | F.contains("low", F.lit(phrase.split(" ")[-1])) & F.contains("low", F.lit(phrase.split(" ")[0]))
    none = F.array().cast("array<string>")
    seen = (
        docs.select("doc_id", lowered("text").alias("low"))
        .select("doc_id", "low", parts.alias("parts"))
        .select("doc_id", "low", held.alias("all_lines"))
        .select(
            "doc_id", "low", F.aggregate("all_lines", F.lit(0).cast("long"), lambda n, line: n + line["n"]).alias("n_words"),
            F.size("all_lines").alias("n_lines"), F.filter("all_lines", lambda line: F.size(line["own"]) > 0).alias("lines"),
            F.when(maybe, F.regexp_extract_all("low", pattern, F.lit(1))).otherwise(none).alias("hits"),
        )
        .select("*", some.alias("some"))
    )
    found = F.size("hits") > 0
    between = F.split("low", pattern, -1)
    last = F.col("n_words") - _count_words(F.element_at(between, -1)) - _count_words(F.element_at("hits", -1))
    again = (F.col("n_lines") > 1) & enough if wrapped else F.lit(False)
    return seen.select(
        "doc_id",
        F.xxhash64("low").alias("text_key"),
        "n_words",
        "hits",
        F.when(found, _count_words(F.element_at(between, 1))).alias("first_word"),
        F.when(found, last).alias("last_word"),
        F.transform("lines", lambda line: F.struct(line["block"].alias("block"), line["own"].alias("own"))).alias("lines"),
        F.when(again, F.col("low")).alias("low"),
    )


def base_scan(seen: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and the phrase columns of every row of ``read``."""
    label = F.transform("hits", lambda h: _label(h))
    return seen.select(
        "doc_id",
        "text_key",
        "n_words",
        F.size("hits").cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.array_sort(F.array_distinct(label)).alias("base"),
    )


def _label(hit: Column) -> Column:
    out = F.lit(None).cast("string")
    for phrase, label in PHRASES.items():
        out = F.when(F.startswith(hit, F.lit(phrase.split(" ")[0])), F.lit(label)).otherwise(out)
    return out


def _need(words: list[str], percent: int) -> int:
    return -(-percent * len(words) // 100)


def windows(seen: DataFrame, templates: list[tuple[str, str]], percent: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``block``, ``span`` (words of the template) and ``own`` of the windows of the texts that
    ``read`` kept, for the templates whose words they hold."""
    sets = [sorted(set(text.split(" "))) for _, text in templates]
    own = F.array(*map(F.lit, sorted({w for words in sets for w in words})))
    held = seen.where("low IS NOT NULL").select("doc_id", "text_key", _words(F.col("low")).alias("words")).withColumn("held", F.array_intersect("words", own))
    enough = [
        F.when(F.size(F.array_intersect("held", F.array(*map(F.lit, words)))) >= _need(words, percent), F.lit(len(text.split(" "))))
        for words, (_, text) in zip(sets, templates, strict=True)
    ]
    cut = held.select("doc_id", "text_key", "words", F.explode(F.array_distinct(F.array_compact(F.array(*enough)))).alias("span"))
    step = F.greatest(F.lit(1), F.floor(F.col("span") / 2).cast("int"))
    # The last window begins where the one before it leaves words over.
    last = F.greatest(F.lit(0), F.size("words") - 2 * F.col("span") + step - 1)
    parts = F.transform(F.sequence(F.lit(0), last, step), lambda at: F.array_intersect(F.slice("words", at + 1, 2 * F.col("span")), own))
    return cut.select("doc_id", "text_key", F.lit(-1).alias("block"), "span", F.explode(parts).alias("own"))


def overlap_bound(place: Column, total: Column, at: Column, size: Column) -> Column:
    """Most words that two ordered sets can share, given that the word at ``place`` of one (of ``total``) is the one ``at`` a
    place of the other (of ``size``): what lies before both, the word, and what lies behind both."""
    return F.least(place, at) + 1 + F.least(total - place - 1, size - at - 1)


def candidates(every: DataFrame, order: dict[str, int], templates: list[tuple[str, str]], percent: int) -> DataFrame:
    """Pairs of a block and a template that share a word of the template's prefix and pass the length and the positional
    filter."""
    index = []
    for number, (label, text) in enumerate(templates):
        ranked = sorted(set(text.split(" ")), key=order.__getitem__)
        need = _need(ranked, percent)
        for place, word in enumerate(ranked[: len(ranked) - need + 1]):
            index.append((word, order[word], number, label, ranked, need, place, len(text.split(" "))))
    schema = "word string, rank int, template int, label string, template_words array<string>, need int, place int, length int"
    prefixes = every.sparkSession.createDataFrame(index, schema)
    ranks = F.create_map(*[x for w, k in order.items() for x in (F.lit(w), F.lit(k))])
    starts = F.array(*map(F.lit, sorted({row[0] for row in index})))
    at = F.array_position(F.array_sort(F.transform("own", lambda w: F.element_at(ranks, w))), F.col("rank")).cast("int") - 1
    return (
        every.select("doc_id", "text_key", "block", "span", "own", F.explode(F.array_intersect("own", starts)).alias("word"))
        # The index has a row per prefix word of a template: a fixed size.
        .join(F.broadcast(prefixes), "word")
        .where((F.col("span") == 0) | (F.col("span") == F.col("length")))
        .where(F.size("own") >= F.col("need"))
        .where(overlap_bound(F.col("place"), F.size("template_words"), at, F.size("own")) >= F.col("need"))
    )


def template_blocks(
    seen: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, percent: int = THRESHOLD_PERCENT
) -> DataFrame:
    """``doc_id``, ``text_key``, ``block``, ``label`` and ``containment`` of every block that contains a template to
    ``percent`` of its distinct words. Blocks are lines and the windows (block -1) of the texts that ``read`` kept."""
    vocabulary = sorted({w for _, text in templates for w in text.split(" ")})
    lines = seen.select("doc_id", "text_key", F.inline("lines"))
    # How many blocks hold each word of the templates; as many rows as the templates have words.
    held = lines.select(F.explode("own").alias("word")).groupBy("word").count().collect()
    frequency = {r["word"]: r["count"] for r in held}
    order = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}
    every = lines.withColumn("span", F.lit(0)).unionByName(windows(seen, templates, percent))
    overlap = F.size(F.array_intersect("own", "template_words"))
    scored = candidates(every, order, templates, percent).select(
        "doc_id", "text_key", "block", "template", "label", overlap.alias("overlap"), F.size("template_words").alias("total")
    )
    return (
        scored.where(F.col("overlap") * 100 >= F.col("total") * percent)
        # A line and a template once; of the windows of a text the one that holds most.
        .groupBy("doc_id", "text_key", "block", "template", "label", "total")
        .agg(F.max("overlap").alias("overlap"))
        .select("doc_id", "text_key", "block", "label", (F.col("overlap") / F.col("total")).alias("containment"))
    )


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, wrapped: bool = False) -> DataFrame:
    """Phrase columns, base labels, all labels and the score of every row: 1 with a phrase, else the best containment.
    ``wrapped``: templates are also found where lines break inside them."""
    seen = stage(read(docs, templates, THRESHOLD_PERCENT, wrapped), "license-words")
    found = (
        template_blocks(seen, templates)
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set("label")).alias("own"), F.max("containment").alias("best"))
        .withColumnsRenamed({"doc_id": "d", "text_key": "k"})
    )
    base = base_scan(seen)
    joined = base.join(found, base["doc_id"].eqNullSafe(found["d"]) & (base["text_key"] == found["k"]), "left")
    every = F.array_sort(F.array_union("base", F.coalesce("own", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def scan_sql(templates: list[tuple[str, str]] = TEMPLATES, percent: int = THRESHOLD_PERCENT) -> str:
    """The same result by counting every word of every line against every template; it has no windows."""
    sets = ", ".join("('{}', [{}])".format(label, ", ".join(f"'{w}'" for w in sorted(set(text.split(" "))))) for label, text in templates)
    places = " UNION ALL ".join(
        "SELECT doc_id, low, i - 1 AS pos, '{}' AS label FROM w, unnest(range(1, len(words) + 1)) u(i) WHERE {}".format(
            label, " AND ".join(f"words[i + {k}] = '{word}'" for k, word in enumerate(phrase.split(" ")))
        )
        for phrase, label in PHRASES.items()
    )
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents),
w AS (SELECT doc_id, low, regexp_extract_all(low, '{WORD}') AS words FROM d),
p AS ({places}),
b AS (SELECT doc_id, low, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
             list_sort(list_distinct(list(label))) AS base FROM p GROUP BY doc_id, low),
t(label, t) AS (VALUES {sets}),
l AS (SELECT DISTINCT doc_id, low, list_distinct(regexp_extract_all(line, '{WORD}')) AS words
      FROM d, unnest(string_split(low, chr(10))) u(line)),
m AS (SELECT doc_id, low, list_distinct(list(label)) AS own, max(len(list_intersect(words, t)) / len(t)) AS best
      FROM l, t WHERE len(list_intersect(words, t)) * 100 >= len(t) * {percent} GROUP BY doc_id, low)
SELECT w.doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(base, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (doc_id, low) LEFT JOIN m USING (doc_id, low)"""
