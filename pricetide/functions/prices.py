"""Vietnamese đồng price text: parsing, validity, discounts, rendering.

All built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricetide.functions.text import CONTACT, contains_any, jstrim, mentions, pystrip, text_or_empty

# Decimal digits of other scripts, in every plane, by rule from the Unicode tables.
_OTHER_DIGITS = "".join(ch for ch in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(ch) == "Nd")
_AS_ASCII = "".join(str(unicodedata.digit(ch)) for ch in _OTHER_DIGITS)


def is_number(c: Column) -> Column:
    """True for a column of a numeric type; known when the query is planned, so the other branch falls away."""
    return F.typeof(c).rlike("^(tinyint|smallint|int|bigint|float|double|decimal)")


def _number(c: Column) -> Column:
    """The finite value of a numeric cell."""
    return F.when(F.abs(c.try_cast("double")) < float("inf"), c.try_cast("double"))


def _whole(c: Column) -> Column:
    return F.round(_number(c)).try_cast("bigint")


def digit_text(c: Column) -> Column:
    """Digits only, in ASCII; null counts as no digits. A number counts by its whole part."""
    cell = text_or_empty(c)
    # Few cells hold other digits; only those are translated.
    ascii_ = F.when(cell.rlike(r"[\p{Nd}&&[^0-9]]"), F.translate(cell, _OTHER_DIGITS, _AS_ASCII)).otherwise(cell)
    bare = _bare(cell)
    read = F.when(_plain(bare), bare).otherwise(F.regexp_replace(ascii_, "[^0-9]+", ""))
    return F.when(is_number(c), F.coalesce(F.abs(_whole(c)).cast("string"), F.lit(""))).otherwise(read)


def _bare(cell: Column) -> Column:
    return _without(cell, ".,đ₫")


def _plain(bare: Column) -> Column:
    """True when nothing but ASCII digits is left, as in most price cells: byte searches tell, without regular expressions."""
    return F.ltrim(bare, F.lit("0123456789")) == ""


def digits(c: Column) -> Column:
    """Digits of a text as a whole number, null when there are none; a number as it is, rounded."""
    # A cast that fails costs an exception per row, so text without digits becomes null before it.
    parsed = F.concat(F.lit("0"), F.nullif(digit_text(c), F.lit(""))).try_cast("bigint")
    # The plain cell has a branch of its own: only cheap searches are repeated in it.
    bare = _bare(text_or_empty(c))
    plain = F.when(_plain(bare), F.when(bare != "", bare.try_cast("bigint"))).otherwise(parsed)
    return F.when(is_number(c), _whole(c)).otherwise(plain)


def price(c: Column) -> Column:
    """Whole đồng of a price cell."""
    return digits(c)


def price_note(c: Column) -> Column:
    """Text of a price cell that holds no number, such as a contact note."""
    return F.when(digits(c).isNull() & ~is_number(c), c.cast("string"))


def percent_text(p: Column) -> Column:
    return F.concat(F.lit("-"), p.cast("int").cast("string"), F.lit("%"))


def is_contact(c: Column) -> Column:
    return mentions(c, CONTACT)


def drop_percent(current: Column, original: Column) -> Column:
    """Drop between two whole numbers in per cent, half to even; null unless 0 < current < original."""
    pct = F.rint((original - current).cast("double") / original.cast("double") * F.lit(100.0))
    return F.when((current > 0) & (original > current), pct)


def shown_discount(scraped: Column | None) -> Column:
    return pystrip(text_or_empty(scraped)) if scraped is not None else F.lit("")


def chosen_discount(contact: Column, pct: Column, shown: Column) -> Column:
    """Discount text from its parts: none for a contact price, the computed one, else the shop's own text,
    which gets a sign when it ends in per cent."""
    signed = F.when(
        F.endswith(shown, F.lit("%")) & ~F.startswith(shown, F.lit("-")), F.concat(F.lit("-"), shown)
    ).otherwise(shown)
    return F.when(contact, F.lit("")).when(pct.isNotNull(), percent_text(pct)).otherwise(signed)


def capped(pct: Column, cap: int | None) -> Column:
    """A drop above ``cap`` is not believed."""
    return pct if cap is None else F.when(pct <= cap, pct)


def _bound(body, **values: Column) -> Column:
    """``body`` of a struct of values, each evaluated once per row."""
    one = F.array(F.struct(*[v.alias(name) for name, v in values.items()]))
    return F.get(F.transform(one, body), F.lit(0))


def _parsed_discount(current: Column, original: Column, body) -> Column:
    contact = is_contact(current) | is_contact(original)
    rate = lambda v: body(v, F.when(~v["contact"], drop_percent(v["cur"], v["orig"])))
    return _bound(rate, cur=digits(current), orig=digits(original), contact=contact)


def discount_percent(current: Column, original: Column, cap: int | None = 70) -> Column:
    """Drop in whole per cent; null when it cannot be computed or exceeds ``cap``."""
    return _parsed_discount(current, original, lambda v, pct: capped(pct, cap).cast("int"))


def discount_text(current: Column, original: Column, scraped: Column | None = None, cap: int | None = 70) -> Column:
    """Discount such as ``-20%``: computed if plausible, else the shop's own text, else ''.

    For whole tables ``operators.records.add_discount`` stays in generated code.
    """
    shown = shown_discount(scraped)
    return _parsed_discount(
        current, original, lambda v, pct: chosen_discount(v["contact"], capped(pct, cap), shown)
    )


def _without(c: Column, signs: str) -> Column:
    """The text without some characters: a byte search for each, where ``translate`` looks up every character."""
    for sign in signs:
        c = F.replace(c, F.lit(sign), F.lit(""))
    return c


def _plain_number(c: Column) -> Column:
    # Only decimal notation: a Java cast would also take forms such as '1d'.
    return F.nullif(F.regexp_extract(c, r"\A[+-]?[0-9]+([eE][+-]?[0-9]+)?\z", 0), F.lit("")).cast("double")


def repair_number(c: Column) -> Column:
    return F.when(is_number(c), _number(c)).otherwise(_plain_number(pystrip(_without(c.cast("string"), "₫.,"))))


def repaired_discount(current: Column, original: Column) -> Column:
    """Discount recomputed from price text without a cap; '' when there is no drop."""
    return _bound(
        lambda v: repaired_from(v["cur"], v["orig"]), cur=repair_number(current), orig=repair_number(original)
    )


def repaired_from(cur: Column, orig: Column) -> Column:
    pct = F.rint((orig - cur) / F.nullif(orig, F.lit(0.0)) * F.lit(100.0))
    return F.when((orig > 0) & (cur < orig), F.concat(F.lit("-"), pct.cast("bigint").cast("string"), F.lit("%"))).otherwise(
        F.lit("")
    )


def final_number(c: Column) -> Column:
    """Price cell as a number: currency signs, marks and thousands separators removed; a number stays."""
    bare = pystrip(_without(c.cast("string"), "₫đĐ*"))
    return F.when(is_number(c), _number(c)).otherwise(_plain_number(_without(bare, ".,")))


def plain_number_text(c: Column) -> Column:
    """Price cell as a number where only separators are removed; text with a currency sign gives null, a number stays."""
    return F.when(is_number(c), _number(c)).otherwise(_plain_number(pystrip(_without(c.cast("string"), ".,"))))


def strip_currency(c: Column) -> Column:
    """Price text without the currency sign; null and 'nan' become ''. A number is written without an exponent."""
    bare = pystrip(_without(text_or_empty(c), "₫đĐ"))
    number = _number(c)
    written = F.when(number == F.rint(number), number.try_cast("bigint").cast("string")).otherwise(number.cast("string"))
    return F.when(is_number(c), F.coalesce(written, F.lit(""))).when(bare == "nan", F.lit("")).otherwise(bare)


def drop_marks(c: Column) -> Column:
    """Remove footnote stars from price text."""
    return pystrip(F.translate(c, "*", ""))


def vnd_text(amount: Column) -> Column:
    """Whole number as ``19.990.000đ``."""
    return F.concat(F.replace(F.format_number(amount, 0), F.lit(","), F.lit(".")), F.lit("đ"))


def json_price(c: Column) -> Column:
    """Price of structured data as a whole number; zero and unreadable text give null."""
    whole = F.coalesce(c.try_cast("bigint"), F.floor(c.try_cast("double")))
    return F.nullif(whole, F.lit(0).cast("bigint"))


# --- validity -------------------------------------------------------------------------------


def valid_price_a(c: Column) -> Column:
    """At least six digits and no contact note."""
    return (F.length(digit_text(c)) >= 6) & ~mentions(c, CONTACT)


def valid_price_b(c: Column) -> Column:
    """At least six digits, or four next to a currency sign (loyalty points have none)."""
    n = F.length(digit_text(c))
    signed = mentions(c, "đ") | F.coalesce(F.contains(c, F.lit("₫")), F.lit(False))
    return (signed & (n >= 4)) | (n >= 6)


def checked_current_a(c: Column) -> Column:
    """A contact note is normalised; other invalid text is kept as it is."""
    return F.when(mentions(c, CONTACT), F.lit("Liên hệ")).otherwise(c)


def checked_original_a(c: Column) -> Column:
    return F.when(valid_price_a(c), c).otherwise(F.lit(""))


def checked_b(c: Column) -> Column:
    return F.when(valid_price_b(c), c).otherwise(F.lit(""))


def with_structured_fallback(dom_current: Column, dom_original: Column, offer: Column, list_offer: Column):
    """Current and list price; structured data fills in only when the page shows no current price."""
    current, original = text_or_empty(dom_current), text_or_empty(dom_original)
    missing = current == ""
    offer_text = F.coalesce(vnd_text(json_price(offer)), F.lit(""))
    list_text = F.coalesce(vnd_text(json_price(list_offer)), F.lit(""))
    return (
        F.when(missing, offer_text).otherwise(current),
        F.when(missing & (original == ""), list_text).otherwise(original),
    )


# --- stock ----------------------------------------------------------------------------------


def stock_flag(c: Column) -> Column:
    """Upper-cased stock note, kept only for the two known states."""
    note = F.upper(jstrim(text_or_empty(c)))
    return F.when(contains_any("TẠM HẾT HÀNG", "SẮP VỀ HÀNG")(note), note).otherwise(F.lit(""))
