"""Text helpers. The source data was cleaned with Python and JavaScript string
rules, so white space is matched by those rules and not by Java's ASCII default."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as `str.split` sees it, and as JavaScript's `\s` does.
PY_SPACE = r"[\s\x1c-\x1f]"  # with (?U)
JS_SPACE = r"[\t\n\x0b\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"

# The same sets as characters; by rule, all of them lie below U+3001 but for the byte order mark.
_PY_SPACES = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_JS_SPACES = "".join(ch for ch in _PY_SPACES if ch not in "\x1c\x1d\x1e\x1f\x85") + "\ufeff"

CONTACT = "liên hệ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: the element of a list of one."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pystrip(c: Column) -> Column:
    """Remove all Unicode white space at both ends."""
    return F.btrim(c, F.lit(_PY_SPACES))


def jstrim(c: Column) -> Column:
    """Remove JavaScript white space at both ends."""
    return F.btrim(c, F.lit(_JS_SPACES))


def collapse(c: Column) -> Column:
    """Runs of white space become one blank; none is left at the ends."""
    return F.regexp_replace(pystrip(c), rf"(?U){PY_SPACE}+", " ")


def collapsed_sql(x: str) -> str:
    """``collapse`` of an SQL expression."""
    return f"regexp_replace(btrim({x}, '{_PY_SPACES}'), '(?U)[\\\\s\\\\x1c-\\\\x1f]+', ' ')"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def blank_to_null(c: Column) -> Column:
    """Empty cells and the ``N/A`` token are read back as null."""
    return F.nullif(F.nullif(c, F.lit("")), F.lit("N/A"))


def first_non_empty(*candidates: Column) -> Column:
    """First candidate with text left after stripping, else ''."""
    # Each is stripped once; as ``nullif`` it would be computed again to be compared.
    full = F.filter(F.transform(F.array(*candidates), pystrip), lambda t: t != "")
    return F.coalesce(F.get(full, F.lit(0)), F.lit(""))


def mentions(c: Column, word: str) -> Column:
    """Case-insensitive contains; null counts as no match."""
    return F.coalesce(F.contains(F.lower(c), F.lit(word.lower())), F.lit(False))


def mentions_any(c: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | mentions(c, word)
    return found


# --- urls -----------------------------------------------------------------------------------


def absolute_url(href: Column, base: str) -> Column:
    return F.when(F.startswith(href, F.lit("/")), F.concat(F.lit(base), href)).otherwise(href)


def drop_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


# --- promotions -----------------------------------------------------------------------------


def promo_line(c: Column) -> Column:
    """One promotion block as one line: line breaks become dashes, blanks are
    collapsed, doubled dashes merged, dashes at the ends removed."""
    t = F.regexp_replace(jstrim(c), r"\n+", " - ")
    t = F.regexp_replace(t, rf"{JS_SPACE}+", " ")
    t = F.regexp_replace(t, rf" -{JS_SPACE}+-", " -")
    t = F.regexp_replace(t, rf"\A-{JS_SPACE}*", "")
    return jstrim(F.regexp_replace(t, rf"{JS_SPACE}*-\z", ""))


def newline_to_dash(c: Column) -> Column:
    return F.regexp_replace(jstrim(c), r"\n+", " - ")


def keep_lines(items: Column, keep=None, distinct: bool = True) -> Column:
    """Drop empty, null and lone-dash items, then apply ``keep``; order is kept."""

    def wanted(t: Column) -> Column:
        ok = t.isNotNull() & (t != "") & (t != "-")
        return ok & keep(t) if keep is not None else ok

    kept = F.filter(items, wanted)
    return F.array_distinct(kept) if distinct else kept


def longer_than(n: int):
    return lambda t: F.length(t) > n


def contains_any(*words: str):
    def test(t: Column) -> Column:
        found = F.lit(False)
        for word in words:
            found = found | F.contains(t, F.lit(word))
        return found

    return test


def drop_scope_label(c: Column) -> Column:
    """Remove the leading scope label of a promotion, in any case."""
    return jstrim(F.regexp_replace(c, rf"(?iu)\AƯu đãi theo phạm vi{JS_SPACE}*", ""))


def title_with_note(title: Column, note: Column) -> Column:
    """``title (note)``; the note is left out when blank."""
    title, note = jstrim(text_or_empty(title)), jstrim(text_or_empty(note))
    return F.concat(title, F.when(note != "", F.concat(F.lit(" ("), note, F.lit(")"))).otherwise(""))


def title_dash_note(title: Column, note: Column) -> Column:
    """``title - note``; line breaks become blanks."""
    joined = F.concat(jstrim(text_or_empty(title)), F.lit(" - "), jstrim(text_or_empty(note)))
    return F.regexp_replace(jstrim(joined), r"\n+", " ")


def join_list(items: Column, sep: str = " | ", as_set: bool = False) -> Column:
    """Array to one string. A set has no order of its own, so it is sorted."""
    return F.concat_ws(sep, F.array_sort(F.array_distinct(items)) if as_set else items)
