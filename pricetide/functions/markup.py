"""Captured page markup as columns.

Simple fields come from regular expressions. Where nesting matters, ``nodes`` cuts a page once into tags and texts
(one ``regexp_extract_all``); the tag names alone are matched, in Arrow batches, which gives nested intervals: for each
tag the place of its end, its parent and its number among its siblings. A rule names elements by tag, class, attribute and
the elements around them; "inside" is a test of intervals, and the texts of an element are those in its interval.
``pick`` gives the elements of each rule, as short arrays that stay built-in expressions.
"""

from __future__ import annotations

import json
from array import array
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from html.entities import name2codepoint

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.functions.text import collapsed_sql as _collapsed
from pricetide.functions.text import let, pystrip

# Elements without an end tag, and elements that start a new line.
VOID = "area base br col embed hr img input link meta source track wbr".split()
BLOCK = (
    "address article aside blockquote body br dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p "
    "section table td th tr ul"
).split()


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _attribute(n: str, name: str) -> str:
    """Value of an attribute of node ``n``, '' if it has none, null if it is not there."""
    return f"get(filter({n}.attrs, a -> a.name = {_quoted(name)}), 0).value"


# --- rules -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class El:
    """Test of one element. ``has``: parts of attribute values; ``child``: directly below the step before."""

    tag: str = ""  # names separated by blanks
    cls: str = ""  # classes, all needed
    attrs: tuple[tuple[str, str | None], ...] = ()  # exact values; None: only set
    has: tuple[tuple[str, str], ...] = ()
    nth: int = 0
    child: bool = False

    def fits(self, n: str) -> str:
        """The test of node ``n``, as SQL."""
        # Not ``IN``: outside generated code Spark ends its search by throwing, which costs microseconds a match.
        tests = [_any([f"{n}.tag = {_quoted(t)}" for t in self.tag.split()]) if self.tag else f"{n}.tag != ''"]
        tests += [f"contains({n}.cls, {_quoted(f' {c} ')})" for c in self.cls.split()]
        if self.nth:
            tests.append(f"{n}.nth = {self.nth}")
        for name, value in self.attrs:
            tests.append(f"{_attribute(n, name)} IS NOT NULL" if value is None else f"{_attribute(n, name)} = {_quoted(value)}")
        tests += [f"contains({_attribute(n, name)}, {_quoted(part)})" for name, part in self.has]
        return f"coalesce({' AND '.join(tests)}, false)"


@dataclass(frozen=True)
class Part:
    """Texts taken from elements below a picked element (from itself without ``paths``).

    ``take``: ``own`` direct texts, ``deep`` all texts, ``inner`` texts of inner elements, ``raw`` text content,
    ``lines`` text as shown (one line per block), ``outer`` markup, ``@name`` an attribute.
    """

    take: str
    paths: tuple[tuple[El, ...], ...] = ()
    at: int | None = None  # only this match
    child: bool = False  # direct children only
    without: tuple[El, ...] = ()  # elements cut out of ``raw``


@dataclass(frozen=True)
class Rule:
    """Elements matching any of the paths (outermost step first), and what to take from each."""

    paths: tuple[tuple[El, ...], ...]
    parts: tuple[Part, ...] = ()


def any_of(*paths) -> tuple[tuple[El, ...], ...]:
    return tuple(p if isinstance(p, tuple) else (p,) for p in paths)


def rule(*paths, take: str | None = None, parts: tuple[Part, ...] = ()) -> Rule:
    return Rule(any_of(*paths), parts or ((Part(take),) if take else ()))


# --- a page as nested intervals ----------------------------------------------------------------

# Outside quotes a tag holds no further '<', and the groups are possessive, so broken markup costs no repeated scans.
_ATTRIBUTES = r"""((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>"""
_NAME = r"[a-zA-Z][^\s/<>]*+"
# Elements whose content is text up to their end tag come as one token, tag and content.
_TEXT_ONLY = rf"<(script|style|textarea|title)(?=[\s/>]){_ATTRIBUTES}.*?(?=</\1\b|\z)"
_TOKENS = rf"(?si)<!--.*?(?:-->|\z)|{_TEXT_ONLY}|</?{_NAME}{_ATTRIBUTES}|<[!?][^<>]*+>|(?:[^<]++|<(?![a-z/!?]))++|<"
_ATTRIBUTE = r"""(?is)[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+"""
OPEN, CLOSE, ALONE, TEXT, OTHER = range(5)
_BLOCKS = frozenset(BLOCK)


def _attributes(source: Column) -> Column:
    """Names (lower case) and values of a tag's attributes."""

    # The pattern has seen to the form of each; plain searches take it apart.
    space = F.lit(" \t\n\x0b\f\r")

    def pair(a: Column) -> Column:
        named = F.substring_index(a, "=", 1)
        return F.struct(F.lower(F.rtrim(named, space)).alias("name"), F.ltrim(F.substr(a, F.length(named) + 2), space).alias("value"))

    def resolved(p: Column) -> Column:
        given = p["value"]
        quoted = F.startswith(given, F.lit('"')) | F.startswith(given, F.lit("'"))
        inner = F.when(quoted, F.substr(given, F.lit(2), F.length(given) - 2)).otherwise(given)
        value = F.when(F.contains(given, F.lit("&")), unescape(inner)).otherwise(inner)
        return F.struct(p["name"].alias("name"), value.alias("value"))

    return F.transform(F.transform(F.regexp_extract_all(source, F.lit(_ATTRIBUTE), F.lit(0)), pair), resolved)


def tokens(html: Column) -> Column:
    """Tags, texts and the rest of a page: ``kind, tag, attrs, source``, in page order."""
    name = rf"(?si)\A</?({_NAME})"
    # Tags whose content is text: the tag, then the content.
    cut = rf"(?si)\A<(?:script|style|textarea|title)(?=[\s/>]){_ATTRIBUTES}"
    none = F.array().cast("array<struct<name:string,value:string>>")

    def piece(source: Column, content: bool) -> Column:
        return F.struct(source.alias("source"), F.lit(content).alias("content"))

    def pieces(t: Column) -> Column:
        tag = F.regexp_extract(t, cut, 0)
        whole = F.array(piece(t, False))
        # Few tokens are searched at all: tags that begin like one of the four names.
        letter = F.lower(F.substring(t, 2, 1))
        return F.when(~((letter == "s") | (letter == "t")), whole).when(tag == "", whole).otherwise(
            F.array(piece(tag, False), piece(F.substr(t, F.length(tag) + 1), True))
        )

    def token(cut_: Column) -> Column:
        t = cut_["source"]
        is_text = cut_["content"] | ~F.startswith(t, F.lit("<"))

        def known(tag: Column) -> Column:
            is_end = F.startswith(t, F.lit("</"))
            kind = (
                F.when(is_text, TEXT)
                .when(tag == "", F.when(t.rlike(r"\A<[!?]"), OTHER).otherwise(TEXT))
                .when(is_end, CLOSE)
                .when(tag.isin(*VOID), ALONE)
                .otherwise(OPEN)
            )
            source = F.regexp_extract(t, rf"(?si)\A<{_NAME}{_ATTRIBUTES}\z", 1)
            # A tag longer than its name and two brackets has attributes.
            attrs = F.when((tag != "") & ~is_end & (F.length(t) > F.length(tag) + 2), _attributes(source)).otherwise(none)
            return F.struct(kind.alias("kind"), tag.alias("tag"), attrs.alias("attrs"), t.alias("source"))

        return let(F.when(is_text, "").otherwise(F.lower(F.regexp_extract(t, name, 1))), known)

    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TOKENS), F.lit(0))
    # An empty content is no text.
    return F.transform(F.filter(F.flatten(F.transform(found, pieces)), lambda t: t["source"] != ""), token)


_PLACE = T.StructType([T.StructField(c, T.IntegerType()) for c in ("last", "parent", "nth", "line")])
_ARROW_PLACE = pa.struct([(c, pa.int32()) for c in ("last", "parent", "nth", "line")])


def nested(marks: list[str]) -> list[tuple[int, int, int, int]]:
    """``nested_columns``, token by token."""
    return list(zip(*nested_columns(marks), strict=True))


def nested_columns(marks: list[str]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Last place inside, parent, number among its siblings and line of every token, a list of each.

    ``marks``: ``p`` begins an element, ``/p`` ends the nearest open one of its name and all that is open in it, ``p/`` has
    no end, '' is a text and ``!`` anything else. What is open at the end of the page ends there.
    """
    last, parent, nth, lines = list(range(len(marks))), [-2] * len(marks), [0] * len(marks), [0] * len(marks)
    opened, kids, line, still = [-1], [0], 0, Counter()
    for i, mark in enumerate(marks):
        if mark.startswith("/"):
            if not still[mark[1:]]:
                continue
            while True:
                ended = opened.pop()
                kids.pop()
                still[marks[ended]] -= 1
                line += marks[ended] in _BLOCKS
                last[ended] = i if marks[ended] == mark[1:] else i - 1
                if last[ended] == i:
                    break
        elif mark != "!":
            parent[i] = opened[-1]
            if mark:
                kids[-1] += 1
                nth[i] = kids[-1]
                line += mark.removesuffix("/") in _BLOCKS
                if not mark.endswith("/"):
                    opened.append(i)
                    kids.append(0)
                    still[mark] += 1
        lines[i] = line
    for i in opened[1:]:
        last[i] = len(marks) - 1
    return last, parent, nth, lines


@F.arrow_udf(T.ArrayType(_PLACE))
def _places(marks: pa.Array) -> pa.Array:
    """``nested_columns`` of each page. It is all that is left to Python: Spark's folds copy their whole state at every step.

    One page at a time is made of Python's objects; what is gathered for a batch is 16 bytes a token.
    """
    ends, rows = [0], [array("i") for _ in _ARROW_PLACE]
    for m in marks:
        page = m.as_py()
        for column, found in zip(rows, nested_columns(page) if page is not None else ((),) * len(rows), strict=True):
            column.extend(found)
        ends.append(len(rows[0]))
    columns = [pa.array(np.frombuffer(c, np.int32)) for c in rows]
    places = pa.StructArray.from_arrays(columns, fields=list(_ARROW_PLACE))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), places, mask=marks.is_null() if marks.null_count else None)


def nodes(tokens: str) -> Column:
    """A column of tokens as nested intervals: ``id, last, parent, nth, line, tag, cls, attrs, text, source``.

    ``tag`` is '' for texts and null for end tags, comments and declarations; ``text`` has its references resolved, but
    in scripts and styles.
    """
    all_ = F.col(tokens)
    ends = {OPEN: lambda t: t["tag"], CLOSE: lambda t: F.concat(F.lit("/"), t["tag"]), ALONE: lambda t: F.concat(t["tag"], F.lit("/"))}

    def mark(t: Column) -> Column:
        said = F.when(t["kind"] == TEXT, "")
        for kind, text in ends.items():
            said = said.when(t["kind"] == kind, text(t))
        return said.otherwise("!")

    def node(r: Column, i: Column) -> Column:
        t = F.get(all_, i)
        is_text = t["kind"] == TEXT
        around = F.get(all_, r["parent"])["tag"]
        raw = F.coalesce((around == "script") | (around == "style"), F.lit(False))
        cls = F.get(F.filter(t["attrs"], lambda a: a["name"] == "class"), F.lit(0))["value"]
        return F.struct(
            i.alias("id"),
            *[r[c].alias(c) for c in ("last", "parent", "nth", "line")],
            F.when((t["kind"] != CLOSE) & (t["kind"] != OTHER), t["tag"]).alias("tag"),
            F.concat(F.lit(" "), F.regexp_replace(cls, r"\s+", " "), F.lit(" ")).alias("cls"),
            t["attrs"].alias("attrs"),
            F.when(is_text & raw, t["source"]).when(is_text, unescape(t["source"])).alias("text"),
            t["source"].alias("source"),
        )

    return F.transform(_places(F.transform(all_, mark)), node)


def elements(page: str) -> Column:
    """The elements among the nodes of a column."""
    return F.expr(f"filter({page}, n -> n.tag != '')")


# --- picking elements --------------------------------------------------------------------------


# The column of the markup.
HTML = "html"


class _Names:
    """Names of lambda variables that do not meet."""

    def __init__(self) -> None:
        self.last = 0

    def __call__(self) -> str:
        self.last += 1
        return f"v{self.last}"


def _let(names: _Names, value: str, body: Callable[[str], str]) -> str:
    """``body`` of a value that is computed once: the element of a list of one."""
    v = names()
    return f"get(transform(array({value}), {v} -> {body(v)}), 0)"


def _any(tests: list[str]) -> str:
    return f"({' OR '.join(tests)})"


def _inside(n: str, scope: str) -> str:
    return f"({n}.id > {scope}.id AND {n}.id <= {scope}.last)"


def _span(page: str, low: str, high: str) -> str:
    """Nodes from one place to another, each fetched by its place: ``slice`` unpacks the whole page every time."""
    return f"transform(sequence({low}, {high}), at -> get({page}, at))"


def _within(page: str, n: str) -> str:
    return _span(page, f"{n}.id", f"{n}.last")


def _none_of(items: str) -> str:
    return f"transform(cast(array() AS array<int>), at -> get({items}, at))"


def _filter(names: _Names, items: str, test: Callable[[str], str]) -> str:
    n = names()
    return f"filter({items}, {n} -> {test(n)})"


def _transform(names: _Names, items: str, body: Callable[[str], str]) -> str:
    n = names()
    return f"transform({items}, {n} -> {body(n)})"


Test = Callable[[str], str]


def _mentioned(path: tuple[El, ...]) -> str:
    """Whether the markup has all names that a path asks for: most fallback paths of a shop are in no page, and end here."""
    words = {w for el in path for w in (*el.cls.split(), *(n for n, _ in el.attrs), *(v for _, v in (*el.attrs, *el.has) if v))}
    # Attribute names may be written in any case.
    cased = {n for el in path for n, _ in el.attrs}
    # Lower-casing a page costs most and comes last.
    ordered = sorted(words, key=lambda w: (w in cased, w))
    return " AND ".join(f"contains({f'lower({HTML})' if w in cased else HTML}, {_quoted(w)})" for w in ordered) or "true"


def _if_mentioned(paths: tuple[tuple[El, ...], ...], items: str, found: str) -> str:
    tests = {_mentioned(p) for p in paths}
    return found if "true" in tests else f"if({' OR '.join(f'({t})' for t in sorted(tests))}, {found}, {_none_of(items)})"


def _matching(names: _Names, page: str, paths: tuple[tuple[El, ...], ...], body: Callable[[Test], str]) -> str:
    """``body`` of the test whether an element is the last step of one of the paths; the steps before are found once."""

    def bound(rest: tuple, tests: list[Test]) -> str:
        if not rest:
            return body(lambda n: _any([t(n) for t in tests]))
        path, *others = rest

        def steps(k: int, scope: str | None) -> str:
            el = path[k]

            def test(n: str) -> str:
                if scope is None:
                    return el.fits(n)
                around = names()
                near = f"{n}.parent = {around}.id" if el.child else _inside(n, around)
                return f"({el.fits(n)} AND exists({scope}, {around} -> {near}))"

            if k == len(path) - 1:
                return bound(tuple(others), [*tests, test])
            return _let(names, _if_mentioned((path,), page, _filter(names, page, test)), lambda found: steps(k + 1, found))

        return steps(0, None)

    return bound(paths, [])


def _taken(names: _Names, page: str, part: Part, found: str) -> str:
    """Texts of one part from the elements it found."""
    how = part.take
    joined = lambda items, field: f"array_join({_transform(names, items, lambda n: f'{n}.{field}')}, '')"
    if how.startswith("@"):
        return _transform(names, found, lambda j: f"coalesce({_attribute(j, how[1:])}, '')")
    if how == "outer":
        return _transform(names, found, lambda j: joined(_within(page, j), "source"))

    def texts(items: str, keep: Test | None = None) -> str:
        return _filter(names, items, lambda n: f"({n}.tag = ''{' AND ' + keep(n) if keep else ''})")

    def raw(j: str) -> str:
        def content(own: str) -> str:
            if not part.without:
                return joined(texts(own), "text")
            cut = _filter(names, own, lambda n: f"({n}.id > {j}.id AND {_any([el.fits(n) for el in part.without])})")

            def outside(c: str) -> str:
                around = names()
                return joined(texts(own, lambda n: f"NOT exists({c}, {around} -> {_inside(n, around)})"), "text")

            return _let(names, cut, outside)

        return _let(names, _within(page, j), content)

    def shown(j: str) -> str:
        def lines(own: str) -> str:
            at = f"array_distinct({_transform(names, own, lambda n: f'{n}.line')})"
            line = lambda k: _collapsed(joined(_filter(names, own, lambda n: f"{n}.line = {k}"), "text"))
            return f"array_join({_filter(names, _transform(names, at, line), lambda t: f'{t} != {_quoted("")}')}, {_quoted(chr(10))})"

        return _let(names, texts(_within(page, j)), lines)

    if how in ("raw", "lines"):
        return _transform(names, found, raw if how == "raw" else shown)
    near = {
        "own": lambda n, j: f"{n}.parent = {j}.id",
        "inner": lambda n, j: f"({n}.parent > {j}.id AND {n}.parent <= {j}.last)",
        "deep": _inside,
    }[how]
    # The elements found may lie in each other: a text counts once.
    low = f"array_min({_transform(names, found, lambda j: f'{j}.id')})"
    high = f"array_max({_transform(names, found, lambda j: f'{j}.last')})"

    def kept(n: str) -> str:
        j = names()
        return f"exists({found}, {j} -> {near(n, j)})"

    return _transform(names, texts(_span(page, low, high), kept), lambda n: f"{n}.text")


def _part(names: _Names, page: str, part: Part, test: Test | None, item: str) -> str:
    """Texts of one part of a picked element; null if its paths find nothing."""
    if test is None:
        return _let(names, f"array({item})", lambda found: _taken(names, page, part, found))
    near = (lambda n: f"({n}.parent = {item}.id AND {test(n)})") if part.child else test
    found = _filter(names, _within(page, item), near)
    chosen = found if part.at is None else f"slice({found}, {part.at + 1}, 1)"
    return _let(names, chosen, lambda c: f"if(size({c}) > 0, {_taken(names, page, part, c)}, NULL)")


def _picked(page: str, elements: str, r: Rule) -> str:
    names = _Names()

    def bound(k: int, tests: list[Test | None], found: str) -> str:
        if k < len(r.parts):
            paths = r.parts[k].paths
            if not paths:
                return bound(k + 1, [*tests, None], found)
            return _matching(names, elements, paths, lambda test: bound(k + 1, [*tests, test], found))

        def one(item: str) -> str:
            parts = [_part(names, page, p, t, item) for p, t in zip(r.parts, tests, strict=True)]
            return f"named_struct('id', {item}.id, 'last', {item}.last, 'parts', cast(array({', '.join(parts)}) AS array<array<string>>))"

        return _transform(names, found, one)

    found = _matching(names, elements, r.paths, lambda test: _if_mentioned(r.paths, elements, _filter(names, elements, test)))
    return _let(names, found, lambda f: bound(0, [], f))


def pick(page: str, elements: str, rules: dict[str, Rule]) -> dict[str, Column]:
    """For each rule the elements it names, in page order: ``id, last, parts``.

    ``page`` and ``elements`` are columns (see ``nodes``), next to the column ``html``. Names of classes and values of
    attributes in rules stand in the markup as they are, not as character references.
    """
    return {name: F.expr(_picked(page, elements, r)) for name, r in rules.items()}


# --- choosing among picks ----------------------------------------------------------------------


def first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def part(item: Column, k: int = 0) -> Column:
    """Texts of one part of a picked element; empty when it is missing."""
    return F.coalesce(F.get(item["parts"], F.lit(k)), F.array().cast("array<string>"))


def has_part(item: Column, k: int) -> Column:
    return F.get(item["parts"], F.lit(k)).isNotNull()


def texts(items: Column, k: int = 0) -> Column:
    """Texts of one part over all picked elements, in page order."""
    return F.flatten(F.transform(items, lambda x: part(x, k)))


def first_text(items: Column, k: int = 0) -> Column:
    """First text over all picked elements, stripped; '' if none."""
    return pystrip(F.coalesce(first(texts(items, k)), F.lit("")))


def below(items: Column, scope: Column) -> Column:
    """Picked elements strictly inside another one."""
    return F.filter(items, lambda x: (x["id"] > scope["id"]) & (x["id"] <= scope["last"]))


def joined_text(items: Column, sep: str = " ") -> Column:
    """Non-blank texts, stripped and joined."""
    return F.concat_ws(sep, F.filter(F.transform(items, pystrip), lambda t: t != ""))


def block_or_body(html: Column, found: list[Column]) -> Column:
    """Markup of the first element of the first successful pick (part ``outer``), else the whole body."""
    body = F.regexp_replace(F.regexp_extract(html, r"(?is)<body\b[^>]*>(.*)", 1), r"(?is)</body\s*>.*", "")
    body = F.when(body == "", html).otherwise(body)
    return F.coalesce(*[first(texts(f)) for f in found], body)


# --- regular expressions on the raw page -------------------------------------------------------


def tag_body(html: Column, name: str) -> Column:
    """Inner markup of the first ``name`` element, '' if none."""
    return F.regexp_extract(html, rf"(?is)<{name}\b[^>]*>(.*?)</{name}\s*>", 1)


def tag_count(html: Column, name: str) -> Column:
    return F.regexp_count(html, F.lit(rf"(?i)<{name}\b"))


def strip_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, r"<[^>]*>", "")


# A reference after its '&': decimal, hexadecimal, or a name that may go without its semicolon in the few old cases.
_REFERENCE = r"\A(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[a-zA-Z][a-zA-Z0-9]*;|(?:amp|lt|gt|quot|nbsp|copy|reg)(?![a-zA-Z0-9=]))"

_NAMES = json.dumps(name2codepoint)


def unescape(c: Column) -> Column:
    """Character references resolved, named ones by the table of the standard library; unknown ones stay."""

    def one(piece: Column) -> Column:
        def resolved(found: Column) -> Column:
            bare = F.rtrim(found, F.lit(";"))
            number = F.when(F.lower(F.substring(bare, 2, 1)) == "x", F.conv(F.substring(bare, 3, 6), 16, 10)).otherwise(F.substring(bare, 2, 7))
            named = F.try_element_at(F.from_json(F.lit(_NAMES), "map<string,int>"), bare)
            code = F.when(F.startswith(bare, F.lit("#")), number.try_cast("int")).otherwise(named)
            # A number that is no character stands for the replacement character.
            valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
            char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
            return F.when((found == "") | code.isNull(), F.concat(F.lit("&"), piece)).otherwise(
                F.concat(char, F.substr(piece, F.length(found) + 1))
            )

        return let(F.regexp_extract(piece, _REFERENCE, 0), resolved)

    pieces = F.split(c, "&")
    rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), one)
    return F.when(F.contains(c, F.lit("&")), F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))).otherwise(c)


_ANCHOR = r"""(?is)<a(?=[\s/"'])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""


def hrefs(html: Column) -> Column:
    """Values of the ``href`` attribute of all anchors outside comments, in any quoting, references resolved."""

    def target(attributes: Column) -> Column:
        own = F.filter(F.regexp_extract_all(attributes, F.lit(_ATTRIBUTE), F.lit(0)), lambda a: a.rlike(r"(?i)\Ahref\s*="))
        value = F.regexp_replace(F.get(own, F.lit(0)), r"\A[^=]*=\s*", "")
        return unescape(F.regexp_replace(value, r"""\A["']|["']\z""", ""))

    shown = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")
    anchors = F.regexp_extract_all(shown, F.lit(_ANCHOR), F.lit(1))
    return F.filter(F.transform(anchors, target), lambda v: v.isNotNull())


LD_SCHEMA = (
    "struct<name:string,offers:struct<price:string,priceSpecification:struct<price:string>>,"
    "additionalProperty:array<struct<name:string,value:string>>>"
)


def json_ld_product(html: Column) -> Column:
    """First structured-data script whose type is Product, parsed; null if there is none."""
    bodies = F.regexp_extract_all(
        html, F.lit(r"""(?is)<script\b[^>]*\btype=["']application/ld\+json["'][^>]*>(.*?)</script\s*>"""), F.lit(1)
    )
    products = F.filter(bodies, lambda b: F.get_json_object(b, "$['@type']") == "Product")
    return F.from_json(F.get(products, F.lit(0)), LD_SCHEMA)


# The three shapes in which page scripts carry name/value pairs. In the second, the first name on a
# line goes with the next value on it, whatever lies between.
EMBEDDED_PATTERNS = {
    "description": r'"displayName":"([^"]+)","description":"([^"]+)"',
    "lazy_value": r'"displayName":"([^"]+)(?=")|"value":"([^"]+)"|\n',
    "same_object": r'\{[^{]*?"displayName":"([^"]+)"[^{]*?"value":"([^"]+)"[^{]*?\}',
}


def embedded_pairs(html: Column, variant: str) -> Column:
    """Name/value pairs from escaped JSON inside page scripts, in page order."""
    plain = F.replace(F.replace(html, F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
    pattern = "(?d)" + EMBEDDED_PATTERNS[variant]
    # The page is searched once; the groups are read from the short matches, which end before a looked-ahead quote.
    own = pattern.replace('(?=")', "")
    found = F.transform(
        F.regexp_extract_all(plain, F.lit(pattern), F.lit(0)),
        lambda m: F.struct(
            F.regexp_extract(m, own, 1).alias("key"), F.regexp_extract(m, own, 2).alias("value")
        ),
    )
    return _next_to_each_other(found) if variant == "lazy_value" else found


def _next_to_each_other(marks: Column) -> Column:
    """Pairs from marks that hold a name, a value, or neither (a line's end): the first name after a value or a line's
    end goes with the next mark, once the names between are left out, if that is a value. A name over a line's end starts
    anew."""

    def unnamed(m: Column) -> Column:
        return m["key"] == ""

    def firsts(all_: Column) -> Column:
        return F.filter(
            all_, lambda m, i: unnamed(m) | (i == 0) | unnamed(F.get(all_, i - 1)) | F.contains(m["key"], F.lit("\n"))
        )

    def paired(kept: Column) -> Column:
        value = lambda i: F.coalesce(F.get(kept, i + 1)["value"], F.lit(""))
        pairs = F.transform(kept, lambda m, i: F.struct(m["key"].alias("key"), value(i).alias("value")))
        return F.filter(pairs, lambda m: ~unnamed(m) & (m["value"] != ""))

    # Each list is the element of a list of one, so that it is made once and not for each of its marks.
    return first(F.transform(F.array(first(F.transform(F.array(marks), firsts))), paired))


# Titles of interstitial pages.
CHALLENGE_TITLES = ("Just a moment", "Cloudflare")


def is_challenge(title: Column, heading: Column, host: str, titles: tuple[str, ...] = CHALLENGE_TITLES) -> Column:
    """Interstitial page instead of the product: known title, or the bare host as heading."""
    title, heading = F.coalesce(title, F.lit("")), F.coalesce(heading, F.lit(""))
    found = F.contains(F.lower(heading), F.lit(host.lower()))
    for known in titles:
        found = found | F.contains(title, F.lit(known))
    return found
