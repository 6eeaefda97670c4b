"""Format-preserving pseudonyms for validated numbers and dates.

A value is found by its format and validated (check digits, ranges, calendar), read as a number below the size of its
format's domain, permuted there by a keyed Feistel network and written in the same format. The permutation depends on
the key and the kind of value alone, so equal values get equal pseudonyms in every document and different values of a
format get different ones; no value stays as it is where its format has another one. A date is the same value in every
format. Mail addresses, assigned secrets, access keys and bearer tokens go the same way, letter by letter class.

Defined results: a null text stays null, without findings; an empty text stays empty; repeated rows give repeated
results. Where two findings overlap the one that starts first counts, then the order of ``KINDS``. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import calendar
import datetime
import functools
import hashlib
import hmac
import math
import re
import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricetide.llm.common import map_arrow

ROUNDS = 8
_HINT = re.compile(r"[0-9@]|AKIA|ASIA|(?i:passw|secret|token|key|bearer)")


def permute(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """Keyed permutation of 0 .. size - 1, or its inverse: a balanced Feistel network over bits, walked until it falls inside."""
    half = max(1, (size - 1).bit_length() + 1 >> 1)
    mask = (1 << half) - 1

    def mixed(turn: int, part: int) -> int:
        message = f"{kind}|{size}|{turn}|{part}".encode()
        return int.from_bytes(hmac.digest(key, message, "sha256"), "big") & mask

    while True:
        left, right = value >> half, value & mask
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            left, right = (right ^ mixed(turn, left), left) if back else (right, left ^ mixed(turn, right))
        value = left << half | right
        if value < size:
            return value


@functools.lru_cache(maxsize=50_000)
def move(value: int, size: int, key: bytes, kind: str) -> int:
    """A permutation that is one cycle through all values: permuted, moved on by a keyed step, permuted back."""
    step = int.from_bytes(hmac.digest(key, f"{kind}|{size}|step".encode(), "sha256"), "big") % size
    while math.gcd(step, size) != 1:
        step += 1
    return permute((permute(value, size, key, kind) + step) % size, size, key, kind, back=True)


def _walk(value: int, size: int, key: bytes, kind: str, allowed: Callable[[int], object]) -> int:
    """Permutation of the allowed values: moved until it is on one again. As all values are one cycle, it is another one
    unless there is no other."""
    value = move(value, size, key, kind)
    while not allowed(value):
        value = move(value, size, key, kind)
    return value


def luhn(digits: str) -> int:
    """Check digit of the digits before it."""
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (2 if place % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _refill(text: str, digits: str) -> str:
    """The text's signs with its digits replaced in turn."""
    turn = iter(digits)
    return "".join(next(turn) if c in string.digits else c for c in text)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in string.digits)


def card(text: str, key: bytes) -> str | None:
    """Issuer digit (with 2, the range 2221-2720) and check digit stay valid; numbers that fail the check are no cards."""
    d = _digits(text)
    if not 13 <= len(d) <= 19 or len(set(d)) == 1 or luhn(d[:-1]) != int(d[-1]) or not _issuer(d):
        return None
    issued = lambda v: _issuer(f"{d[0]}{v:0{len(d) - 2}d}")
    body = f"{_walk(int(d[1:-1]), 10 ** (len(d) - 2), key, f'card{d[0]}', issued):0{len(d) - 2}d}"
    return _refill(text, d[0] + body + str(luhn(d[0] + body)))


def _issuer(digits: str) -> bool:
    return digits[0] in "3456" or 2221 <= int(digits[:4]) <= 2720


def phone(text: str, key: bytes) -> str | None:
    """The country code, if there is one, and the separators stay; a number starts with no 0 where it had none.

    Without a separator the first two digits count as country code.
    """
    head = re.match(r"\+[0-9]{1,3}(?=[ .\-(])|\+[0-9]{2}", text)
    prefix, rest = (head[0], text[head.end() :]) if head else ("", text)
    d = _digits(rest)
    if not 7 <= len(d) <= 14 or len(set(d)) == 1:
        return None
    low = 0 if d[0] == "0" else 10 ** (len(d) - 1)
    new = _walk(int(d), 10 ** len(d), key, "phone", lambda v: (v >= low) if low else v < 10 ** (len(d) - 1))
    return prefix + _refill(rest, f"{new:0{len(d)}d}")


def ipv4(text: str, key: bytes) -> str | None:
    octets = [int(o) for o in text.split(".")]
    if max(octets) > 255 or octets[0] == 0 or any(len(o) > 1 and o[0] == "0" for o in text.split(".")):
        return None
    value = int.from_bytes(bytes(octets), "big")
    return ".".join(map(str, _walk(value, 1 << 32, key, "ipv4", lambda v: v >> 24 > 0).to_bytes(4, "big")))


def social(text: str, key: bytes) -> str | None:
    def valid(v: int) -> bool:
        area, group, serial = v // 10**6, v // 10**4 % 100, v % 10**4
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    value = int(_digits(text))
    return _refill(text, f"{_walk(value, 10**9, key, 'social', valid):09d}") if valid(value) else None


def iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _by_class(plain[4:], key, "iban" + plain[:2])
    check = 98 - number(body + plain[:2] + "00") % 97
    turn = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(turn) for c in text)


FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)


def date(text: str, key: bytes) -> str | None:
    """Year first, or last with the day before the month, or the month first where only that is a date.

    Days after the 12th are permuted among themselves, and so are the others, so that a date can be written in any of the
    formats and is read back the same way: one day has one pseudonym, whatever its format. Without leading zeros if the
    input has none.
    """
    parts, marks = re.split(r"[-/.]", text), re.findall(r"[-/.]", text)
    if marks[0] != marks[1]:
        return None
    orders = ("ymd",) if len(parts[0]) == 4 else ("dmy", "mdy")
    for order in orders:
        f = dict(zip(order, map(int, parts), strict=True))
        if FIRST_DAY.year <= f["y"] <= LAST_DAY.year and 1 <= f["m"] <= 12 and 1 <= f["d"] <= calendar.monthrange(f["y"], f["m"])[1]:
            break
    else:
        return None
    size = (LAST_DAY - FIRST_DAY).days + 1
    late = f["d"] > 12
    value = (datetime.date(f["y"], f["m"], f["d"]) - FIRST_DAY).days
    day = FIRST_DAY + datetime.timedelta(_walk(value, size, key, "date", lambda v: ((FIRST_DAY + datetime.timedelta(v)).day > 12) == late))
    width = 1 if any(len(p) == 1 for p in parts) else 2
    new = {"y": f"{day.year:04d}", "m": f"{day.month:0{width}d}", "d": f"{day.day:0{width}d}"}
    return marks[0].join(new[c] for c in order)


BLOCK = 64


def _by_class(text: str, key: bytes, kind: str) -> str:
    """Permute a text among the texts with the same class (digit, lower, upper, hexadecimal) in every place.

    Long texts go block by block, each under all that stands before it.
    """
    hexadecimal = len(text) >= 12 and re.fullmatch(r"[0-9a-f]*[a-f][0-9a-f]*", text) is not None
    out, before = [], hashlib.sha256()
    for at in range(0, len(text), BLOCK):
        part = text[at : at + BLOCK]
        tweak = f"{kind}|{before.hexdigest()[:32]}" if at else kind
        out.append(_block(part, key, tweak, hexadecimal and re.search("[a-f]", part) is not None))
        before.update(part.encode())
    return "".join(out)


def _block(text: str, key: bytes, kind: str, hexadecimal: bool) -> str:
    classes = ["0123456789abcdef" if hexadecimal else next((s for s in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if c in s), c) for c in text]
    value, size = 0, 1
    for c, letters in zip(text, classes, strict=True):
        value, size = value * len(letters) + letters.index(c), size * len(letters)
    shape = "".join(s[0] if len(s) > 1 else s for s in classes)
    tweak = f"{kind}|{hashlib.sha256(shape.encode()).hexdigest()[:16]}"
    # A hexadecimal value keeps a letter, so that it never becomes one of the decimal values.
    lettered = lambda v: not hexadecimal or re.search("[a-f]", f"{v:x}")
    value = _walk(value, size, key, tweak, lettered) if size > 1 else 0
    out = []
    for letters in reversed(classes):
        value, at = divmod(value, len(letters))
        out.append(letters[at])
    return "".join(reversed(out))


def email(text: str, key: bytes) -> str | None:
    local, host = text.rsplit("@", 1)
    return f"{_by_class(local, key, 'email')}@{host}"


def secret(text: str, key: bytes) -> str | None:
    """The name stays, its value changes."""
    place = re.search(r"[0-9A-Za-z_\-]+$", text).start()
    return text[:place] + _by_class(text[place:], key, "secret")


def access_key(text: str, key: bytes) -> str | None:
    """The four letters that say what it is stay."""
    return text[:4] + _by_class(text[4:], key, "access_key")


def bearer(text: str, key: bytes) -> str | None:
    """The word stays, the token changes; a token holds a digit and a letter."""
    place = re.search(r"\S+$", text).start()
    token = text[place:]
    if not (re.search("[0-9]", token) and re.search("[A-Za-z]", token)):
        return None
    return text[:place] + _by_class(token, key, "bearer")


KINDS: dict[str, tuple[str, Callable[[str, bytes], str | None]]] = {
    "email": (r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![\w-])", email),
    "secret": (r"(?i:password|passwd|secret|token|api[_-]?key|access[_-]?key)\s?[=:]\s?[\"']?[0-9A-Za-z_\-]{8,}", secret),
    "access_key": (r"(?<!\w)A[KS]IA[A-Z2-7]{16}(?!\w)", access_key),
    "bearer": (r"(?<!\w)(?i:bearer) {1,3}[0-9A-Za-z_\-.~+/]{20,}=*(?![\w])", bearer),
    "iban": (r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)", iban),
    "ipv4": (r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])", ipv4),
    "date": (r"(?<![\w./-])(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4})(?![\w]|[./-][0-9])", date),
    "social": (r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", social),
    "card": (r"(?<![\w])[0-9](?:[ -]?[0-9]){12,18}(?![\w])", card),
    "phone": (r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?!\w)|(?<!\w)\+[0-9]{1,3}(?:[ .-][0-9]{2,8}){1,5}(?!\w)|(?<![\w+])\+[1-9][0-9]{8,14}(?!\w)", phone),
}
_ANY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, (pattern, _) in KINDS.items()))


def replace(text: str, key: bytes) -> tuple[str, list[dict]]:
    """The text with pseudonyms, and ``kind``, ``start``, ``end`` (code points of the input) and ``pseudonym`` of each."""
    if not _HINT.search(text):
        return text, []
    out, spans, done = [], [], 0
    place = 0
    while found := _ANY.search(text, place):
        # The first kind in order whose format starts here and whose rules the value meets.
        for kind, (_, renew) in KINDS.items():
            value = _compiled(kind).match(text, found.start())
            if not value:
                continue
            end, new = _shortened(value, key) if kind == "card" else (value.end(), renew(value[0], key))
            if new is not None:
                out += [text[done : value.start()], new]
                spans.append({"kind": kind, "start": value.start(), "end": end, "pseudonym": new})
                done = place = end
                break
        else:
            place = found.start() + 1
    return "".join([*out, text[done:]]), spans


def _shortened(value: re.Match, key: bytes) -> tuple[int, str | None]:
    """Where the longest part that is a card ends, and its pseudonym. Parts begin where the value does and end
    where a group of digits does, so an expiry date, a code or an amount behind a number is not taken into it."""
    text = value[0]
    for size in [len(text), *(m.start() for m in reversed(list(re.finditer(r"[ -]", text))))]:
        new = card(text[:size], key)
        if new is not None:
            return value.start() + size, new
    return value.end(), None


@functools.lru_cache(maxsize=32)
def _compiled(kind: str) -> re.Pattern:
    return re.compile(KINDS[kind][0])


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())])


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """The input with ``text`` replaced, and ``spans``; other columns, whatever their names, pass as they are."""
    taken = {c.lower() for c in docs.columns}
    spans_name = next(n for n in ("spans", *(f"spans_{i}" for i in range(len(taken) + 1))) if n not in taken)

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        done = [replace(t, key) if t is not None else (None, []) for t in rows["text"].to_pylist()]
        at = rows.schema.get_field_index("text")
        columns = list(rows.columns)
        columns[at] = pa.array([t for t, _ in done], pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array([s for _, s in done], pa.list_(SPAN))], [*rows.schema.names, spans_name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, batch, f"{kinds}, `{spans_name}` array<struct<kind:string,start:int,end:int,pseudonym:string>>")
