"""Spec lists: ordered ``array<struct<key,value>>`` and their text and map forms.

Everything here works within one record; pairs spread over rows are in
``operators.specs``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricetide.functions.text import let, pystrip

PAIRS = "array<struct<key:string,value:string>>"


def clean_pairs(pairs: Column, drop_keys: list[str] | None = None) -> Column:
    """Strip both sides, keep pairs with a key and a value, optionally drop some keys."""
    stripped = F.transform(
        pairs, lambda p: F.struct(pystrip(p["key"]).alias("key"), pystrip(p["value"]).alias("value"))
    )

    def wanted(p: Column) -> Column:
        ok = (p["key"] != "") & (p["value"] != "")
        return ok & ~F.lower(p["key"]).isin(drop_keys) if drop_keys else ok

    return F.filter(stripped, wanted)


def dedup_pairs(pairs: Column, keep: str = "last") -> Column:
    """One pair per key, at the place of its first occurrence, with the first or last value."""

    def picked(pairs: Column) -> Column:
        keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))

        def pick(k: Column) -> Column:
            same = F.filter(pairs, lambda p: p["key"] == k)
            chosen = F.get(same, F.lit(0)) if keep == "first" else F.element_at(same, -1)
            return F.struct(k.alias("key"), chosen["value"].alias("value"))

        return F.transform(keys, pick)

    # The pairs are made once per record, not once more for each key that looks at them.
    return let(pairs, picked)


def spec_map(pairs: Column, keep: str = "last") -> Column:
    """Ordered pairs as a map; does not depend on the session's duplicate-key policy."""
    return F.map_from_entries(dedup_pairs(pairs, keep))


def spec_text(pairs: Column, sep: str = " | ") -> Column:
    """``k: v`` pieces joined by ``sep``."""
    return F.concat_ws(sep, F.transform(pairs, lambda p: F.concat(p["key"], F.lit(": "), p["value"])))


# A separator counts only when another key follows, so it may also occur inside a value.
PIECE_BORDER = r" \| (?=[^|:\n]*:)|\n(?=[^\n:]*:)"


def parse_spec_text(text: Column, sep: str = PIECE_BORDER) -> Column:
    """Text form back to pairs, split on the first colon."""
    pieces = F.filter(F.split(text, sep), lambda t: F.contains(t, F.lit(":")))
    pairs = F.transform(
        pieces,
        lambda t: F.struct(
            F.substring_index(t, ":", 1).alias("key"), F.substring(t, F.locate(":", t) + 1, F.length(t)).alias("value")
        ),
    )
    return clean_pairs(pairs)


def any_spec(pairs: Column, key_words: list[str], value_part: str) -> Column:
    """True when a pair's key contains one of the words and its value contains ``value_part``."""

    def hit(p: Column) -> Column:
        key = F.lower(p["key"])
        named = F.lit(False)
        for word in key_words:
            named = named | F.contains(key, F.lit(word))
        return named & F.contains(p["value"], F.lit(value_part))

    return F.coalesce(F.exists(pairs, hit), F.lit(False))


MULTIMAP = "array<struct<key:string,values:array<string>>>"


def spec_multimap(text: Column, sep: str = " | ") -> Column:
    """Text form as an ordered multimap: ``key`` and the ``values`` that follow each other under it.

    Nothing is lost: repeated keys keep all their values, a piece without ``: `` behind a key stands under the empty key,
    and :func:`multimap_text` gives the same text back. A null text is null.
    """

    def entry(piece: Column) -> Column:
        at = F.locate(": ", piece)
        return F.struct(
            F.when(at > 1, F.substring(piece, F.lit(1), at - 1)).otherwise(F.lit("")).alias("key"),
            F.when(at > 1, F.substring(piece, at + 2, F.length(piece))).otherwise(piece).alias("value"),
        )

    def runs(entries: Column, starts: Column) -> Column:
        # Each run of one key is cut out by its borders, so a text of n pieces costs n steps and no growing state.
        def run(start: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(entries))
            values = F.transform(F.slice(entries, start + 1, end - start), lambda e: e["value"])
            return F.struct(F.get(entries, start)["key"].alias("key"), values.alias("values"))

        return F.transform(starts, run)

    def cut(entries: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(entries) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(entries, i)["key"] != F.get(entries, i - 1)["key"]))
        return let(starts, lambda s: runs(entries, s))

    # The entries and the borders are made once per text, not once for each piece that looks at them.
    pieces = F.split(text, sep, -1) if len(sep) == 1 else F.split(text, "\\Q" + sep + "\\E", -1)
    return F.when(text.isNotNull(), let(F.transform(pieces, entry), cut))


def multimap_text(multimap: Column, sep: str = " | ") -> Column:
    """Inverse of :func:`spec_multimap`."""

    def pieces(e: Column) -> Column:
        return F.transform(e["values"], lambda v: F.when(e["key"] == "", v).otherwise(F.concat(e["key"], F.lit(": "), v)))

    return F.when(multimap.isNotNull(), F.array_join(F.flatten(F.transform(multimap, pieces)), sep))


def values_of(multimap: Column, key: str) -> Column:
    """All values of a key, in order."""
    return F.flatten(F.transform(F.filter(multimap, lambda e: e["key"] == key), lambda e: e["values"]))
