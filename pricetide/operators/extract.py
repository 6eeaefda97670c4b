"""Product fields from captured pages, by shop.

``pages`` has ``url`` and ``html``; other columns are carried along. One page is
one row all the way, so no shuffle takes place. Each shop has a set of pick
rules and a function from the picks to field columns. Each step is the row of an
``inline`` over a list of one: computed once, and no later filter moves below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.functions import markup as M
from pricetide.functions import prices, specs, text
from pricetide.functions.markup import El, Part, any_of, rule
from pricetide.operators.records import add_discount

FIELDS = ["name", "price_text", "list_price_text", "percent_text", "stock_status", "promos", "gift_note", "specs"]


def _pair(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def _pairs(rows: Column, pair) -> Column:
    """Pairs of the rows for which ``pair`` gives one."""
    return F.filter(F.transform(rows, pair), lambda p: p.isNotNull())


def _fields(**given: Column) -> dict[str, Column]:
    blank = {f: F.lit("") for f in ("stock_status", "gift_note", "percent_text")}
    return {f: {**blank, **given}[f] for f in FIELDS}


def _first_full(*lists: Column) -> Column:
    """The first non-empty list, else the last one."""
    chosen = lists[-1]
    for items in reversed(lists[:-1]):
        chosen = F.when(F.size(items) > 0, items).otherwise(chosen)
    return chosen


# Fixed values, here and in the rules below: ids, classes and attributes of the shops' pages.

# --- shop with technical tables and promotion boxes --------------------------------------------

_SPEC_ROW = (
    Part("deep", any_of(El("td")), at=0),
    Part("deep", any_of(El("td")), at=1),
    Part("own", any_of(El(cls="item-technical-name"), El("p", nth=1))),
    Part("inner", any_of(El(cls="item-technical-value"), El("p", nth=2), El("div"))),
)
CELLPHONES = {
    "boxed_name": rule((El(cls="box-product-name"), El("h1")), take="own"),
    "name": rule(El("h1"), take="own"),
    "row": rule(
        (El(cls="modal-content"), El(cls="item-technical-content")),
        El("tr", cls="technical-content-item"),
        parts=_SPEC_ROW,
    ),
    "item": rule((El("ul", cls="technical-content"), El("li")), parts=_SPEC_ROW),
    "box": rule(El(cls="box-product-price-wrapper"), El(cls="box-info__box-price"), El(cls="tpt-box-price")),
    "current": rule(El(cls="tpt-price"), El(cls="product__price--show"), El(cls="sale-price"), take="own"),
    "original": rule(El(cls="tpt-price-through"), El(cls="product__price--through"), El(cls="base-price"), take="own"),
    "percent": rule((El(cls="product__price--percent-detail"), El("span")), take="own"),
    "stock": rule((El(cls="order-button"), El("strong")), take="raw"),
    "promo": rule(
        (El(cls="box-promotions"), El(cls="promotion-item")),
        El(cls="item-promotions"),
        El(cls="block-smem-price"),
        (El(cls="exclusive-price-block"), El(cls="txt")),
        El(cls="trade-price-label"),
        (El(cls="box-product-promotion-content"), El(cls="button__promotion")),
        parts=(
            Part(
                "raw",
                without=(
                    El("a button"),
                    El(cls="icon-pc"),
                    El(cls="btn-estimate-price-trade"),
                    El(cls="dang_nhap_xem_gia"),
                ),
            ),
        ),
    ),
}


def _cellphones(html: Column, p: dict[str, Column]) -> dict[str, Column]:
    box = M.first(p["box"])

    def shown(field: str) -> Column:
        return M.first_text(M.below(p[field], box))

    def pair(row: Column) -> Column:
        name = M.first_text(F.array(row), 2)
        inner = F.filter(M.part(row, 3), lambda t: text.pystrip(t) != name)
        table = M.has_part(row, 1)
        first_cell = text.pystrip(F.coalesce(M.first(M.part(row, 0)), F.lit("")))
        return _pair(
            F.when(table, first_cell).otherwise(name),
            F.when(table, M.joined_text(M.part(row, 1))).otherwise(M.joined_text(inner)),
        )

    return _fields(
        name=text.first_non_empty(M.first_text(p["boxed_name"]), M.first_text(p["name"])),
        price_text=prices.checked_current_a(shown("current")),
        list_price_text=prices.checked_original_a(shown("original")),
        percent_text=shown("percent"),
        stock_status=prices.stock_flag(M.first(M.texts(p["stock"]))),
        promos=text.keep_lines(F.transform(M.texts(p["promo"]), text.promo_line)),
        specs=specs.dedup_pairs(specs.clean_pairs(F.transform(_first_full(p["row"], p["item"]), pair))),
    )


# --- shop with structured product data ---------------------------------------------------------

_OLD_PROMOS = {
    "card": rule(
        (El(attrs=(("id", "gvn-promotions"),)), El(cls="gvn-promo-item")),
        parts=(
            Part("lines", any_of(El(cls="gvn-promo-title")), at=0),
            Part("lines", any_of(El(cls="gvn-promo-desc")), at=0),
        ),
    ),
    "gift": rule((El(attrs=(("id", "gift-promo--app"),)), El(cls="gift-promo--lists"), El("li")), take="lines"),
}
GEARVN = {
    "region": rule(El(attrs=(("data-product-summary-region", "true"),))),
    "current": rule(El("span", has=(("class", "red-700"), ("class", "bold"))), take="lines"),
    "original": rule(El("span", has=(("class", "line-through"),)), take="lines"),
    "percent": rule(El("span", has=(("class", "red-600"), ("class", "red-50"))), take="lines"),
    "section": rule(El("section", has=(("class", "surface-red"),))),
    "offer": rule(El("div", has=(("class", "gap"), ("class", "py"))), take="lines"),
    **_OLD_PROMOS,
}


def _old_promos(p: dict[str, Column]) -> Column:
    """Titles with notes and the gift list of the older page layout."""
    cards = F.transform(p["card"], lambda c: text.title_with_note(M.first(M.part(c, 0)), M.first(M.part(c, 1))))
    return text.keep_lines(F.concat(cards, M.texts(p["gift"])), distinct=False)


def _gearvn(html: Column, p: dict[str, Column]) -> dict[str, Column]:
    ld = M.json_ld_product(html)
    region = M.first(p["region"])

    def shown(field: str) -> Column:
        scoped = F.when(region.isNull(), p[field]).otherwise(M.below(p[field], region))
        return M.first_text(scoped)

    current, original = prices.with_structured_fallback(
        shown("current"), shown("original"), ld["offers"]["price"], ld["offers"]["priceSpecification"]["price"]
    )
    offers = F.filter(M.texts(M.below(p["offer"], M.first(p["section"]))), text.longer_than(5))
    offers = F.filter(F.transform(offers, text.drop_scope_label), lambda t: t != "")
    given = F.coalesce(ld["additionalProperty"], F.array().cast("array<struct<name:string,value:string>>"))
    props = F.transform(given, lambda x: _pair(F.coalesce(x["name"], F.lit("")), F.coalesce(x["value"], F.lit(""))))
    return _fields(
        # Null name: no structured product on the page.
        name=F.when(ld.isNotNull(), text.pystrip(F.coalesce(ld["name"], F.lit("")))),
        price_text=current,
        list_price_text=original,
        percent_text=shown("percent"),
        promos=_first_full(offers, _old_promos(p)),
        specs=specs.dedup_pairs(specs.clean_pairs(props)),
    )


# --- the same shop's older layout, used for the single-topic table -----------------------------

_INFO = El(cls="product-info")
_MONEY = El(cls="product-price")
GEARVN_TOPIC = {
    "info": rule(_INFO),
    "name": rule((_INFO, El(cls="product-name"), El("h1")), take="own"),
    "current": rule((_INFO, _MONEY, El(cls="pro-price")), take="own"),
    "original": rule((_INFO, _MONEY, El("del")), take="own"),
    "percent": rule((_INFO, _MONEY, El(cls="pro-percent")), take="own"),
    "note": rule((_INFO, El(cls="product-desc-short"), El()), take="own"),
    "row": rule(
        (El(attrs=(("id", "gvn-specs-container-table"),)), El("tr", cls="gvn-spec-row")),
        parts=(
            Part("own", any_of(El("th", attrs=(("colspan", None),)))),
            Part("own", any_of(El("th"))),
            Part("own", any_of(El("td"))),
        ),
    ),
    **_OLD_PROMOS,
}


def _gearvn_topic(html: Column, p: dict[str, Column]) -> dict[str, Column]:
    def pair(row: Column) -> Column:
        return F.when(~M.has_part(row, 0), _pair(M.first_text(F.array(row), 1), M.joined_text(M.part(row, 2))))

    return _fields(
        # Null name: the product block is missing.
        name=F.when(F.size(p["info"]) > 0, M.first_text(p["name"])),
        price_text=M.first_text(p["current"]),
        list_price_text=M.first_text(p["original"]),
        percent_text=M.first_text(p["percent"]),
        promos=_old_promos(p),
        gift_note=M.joined_text(M.texts(p["note"]), " | "),
        specs=_pairs(p["row"], pair),
    )


# --- shop with service packs and parameter lists -----------------------------------------------

_LEFT = any_of(El("aside", nth=1), El(cls="lileft"))
_RIGHT = any_of(El("aside", nth=2), El(cls="liright"), El("p div", has=(("class", "right"),)))
_PACKS = (El(cls="active", attrs=(("data-pack", None),)), El(cls="active", attrs=(("data-id", None),)))
TGDD = {
    "name": rule(El("h1"), take="own"),
    "row": rule(
        *[(El(cls=c), El("li")) for c in ("parameter__list", "parameter", "text-specifi")],
        parts=(
            Part("own", (*_LEFT, (El("p div", has=(("class", "left"),)),))),
            Part("inner", _LEFT),
            Part("inner", _RIGHT),
            Part("own", _RIGHT),
            Part("deep"),
        ),
    ),
    "pack_current": rule(*[(pack, El("span"), El("b")) for pack in _PACKS], take="own"),
    "present": rule(El(cls="box-price-present"), take="own"),
    "price": rule(El(cls="price"), take="own"),
    "pack_original": rule(*[(pack, El("span"), El("em")) for pack in _PACKS], take="own"),
    "old": rule(El(cls="box-price-old"), take="own"),
    "price_old": rule(El(cls="price-old"), take="own"),
    "percent": rule(El(cls="percent"), El(cls="box-price-percent"), take="own"),
    "promo": rule(El(cls="divb-right"), take="lines"),
    "season": rule(
        (El(cls="backtoschool"), El("div", child=True)),
        parts=(Part("lines", any_of(El("b")), at=0), Part("lines", any_of(El("span")), at=0)),
    ),
}


def _tgdd(html: Column, p: dict[str, Column]) -> dict[str, Column]:
    def pair(row: Column) -> Column:
        one = F.array(row)
        key = text.first_non_empty(M.first_text(one, 0), M.joined_text(M.part(row, 1)))
        value = text.first_non_empty(M.joined_text(M.part(row, 2)), M.first_text(one, 3))
        line = text.pystrip(F.concat_ws(" ", M.part(row, 4)))
        split = _pair(
            text.pystrip(F.substring_index(line, ":", 1)), text.pystrip(F.element_at(F.split(line, ":", 2), -1))
        )
        return F.when((key != "") & (value != ""), _pair(key, value)).when(F.contains(line, F.lit(":")), split)

    season = F.transform(p["season"], lambda s: text.title_dash_note(M.first(M.part(s, 0)), M.first(M.part(s, 1))))
    plain = F.transform(M.texts(p["promo"]), text.newline_to_dash)
    return _fields(
        name=M.first_text(p["name"]),
        price_text=prices.drop_marks(
            text.first_non_empty(*[M.first_text(p[f]) for f in ("pack_current", "present", "price")])
        ),
        list_price_text=text.first_non_empty(*[M.first_text(p[f]) for f in ("pack_original", "old", "price_old")]),
        percent_text=M.first_text(p["percent"]),
        promos=text.keep_lines(F.concat(plain, season)),
        specs=specs.dedup_pairs(_pairs(p["row"], pair)),
    )


# --- shop with utility classes and a spec popup ------------------------------------------------

_CELLS = any_of(El("td th"))
FPTSHOP = {
    "name": rule(El("h1"), take="deep"),
    "current": rule(
        El(cls="text-black-opacity-100 h4-bold"),
        (El(attrs=(("id", "price-product"),)), El("span", cls="text-black-opacity-100")),
        El(cls="st-price-main"),
        El(cls="text-black-opacity-100 h6-semibold"),
        take="own",
    ),
    "original": rule(
        El(cls="text-neutral-gray-5 line-through"),
        El(cls="text-textOnWhiteSecondary line-through"),
        El(cls="st-price-sub"),
        take="own",
    ),
    "offers": rule(
        (El("li", cls="flex items-start"), El("span", cls="text-textOnWhitePrimary")),
        El("span", cls="text-textOnWhitePrimary f1-regular"),
        take="own",
    ),
    "lines": rule(
        El("p", cls="relative pl-5 f1-regular"),
        El("p", cls="line-clamp-1 text-textOnWhitePrimary"),
        El("p", cls="text-textOnWhitePrimary f1-regular pc:b2-regular"),
        take="own",
    ),
    "items": rule((El(cls="promo-item"), El()), (El(cls="promotion-item"), El()), take="own"),
    "popup": rule(El(has=(("class", "modal"),)), El(has=(("class", "popup"),)), El(cls="relative z-50")),
    "dashed": rule(
        El(cls="border-dashed"), parts=tuple(Part("deep", any_of(El()), at=k, child=True) for k in range(3))
    ),
    "row": rule(
        (El("table"), El("tr")),
        El(cls="technical-content-item"),
        parts=(Part("deep", _CELLS, at=0), Part("deep", _CELLS, at=1)),
    ),
}


def _fptshop(html: Column, p: dict[str, Column]) -> dict[str, Column]:
    popup = M.first(p["popup"])
    rows = F.when(popup.isNull(), p["dashed"]).otherwise(M.below(p["dashed"], popup))

    def dashed(row: Column) -> Column:
        # Exactly two children.
        return F.when(
            M.has_part(row, 1) & ~M.has_part(row, 2),
            _pair(M.joined_text(M.part(row, 0), ""), M.joined_text(M.part(row, 1), "")),
        )

    def cells(row: Column) -> Column:
        return F.when(
            M.has_part(row, 1), _pair(F.concat_ws(" ", M.part(row, 0)), F.concat_ws(" ", M.part(row, 1)))
        )

    found, fallback = specs.clean_pairs(_pairs(rows, dashed)), specs.clean_pairs(_pairs(p["row"], cells))
    promos = _first_full(*[M.texts(p[f]) for f in ("offers", "lines", "items")])
    heading = F.coalesce(M.part(M.first(p["name"])), F.array().cast("array<string>"))
    return _fields(
        name=text.collapse(M.joined_text(heading)),
        price_text=prices.checked_b(M.first_text(p["current"])),
        list_price_text=prices.checked_b(M.first_text(p["original"])),
        promos=F.filter(F.transform(promos, text.pystrip), lambda t: t != ""),
        specs=specs.dedup_pairs(_first_full(found, fallback)),
    )


# --- shop with typed div elements --------------------------------------------------------------


def _div(child: bool = False, **attrs: str) -> El:
    return El("div", attrs=tuple(attrs.items()), child=child)


PHONGVU = {
    "name": rule(El("h1"), take="deep"),
    "price": rule(_div(type="title", color="primary500"), take="deep"),
    "gray": rule(
        (El(attrs=(("direction", "row"),)), _div(child=True, type="body", color="textSecondary")), take="deep"
    ),
    "title": rule(_div(color="textTitle"), take="deep"),
    "item": rule((El("ul"), El("li")), parts=(Part("deep", any_of(El("span")), at=0),)),
    "row": rule(
        _div(direction="row", width="100%"),
        parts=tuple(Part("deep", any_of(El("div")), at=k, child=True) for k in range(2)),
    ),
}


def _phongvu(html: Column, p: dict[str, Column]) -> dict[str, Column]:
    def glued(item: Column) -> Column:
        return M.joined_text(M.part(item), "")

    def side(row: Column, k: int) -> Column:
        return M.joined_text(M.part(row, k), "")

    price = F.when(F.size(p["price"]) > 0, glued(M.first(p["price"]))).otherwise(F.lit("N/A"))
    others = F.filter(
        F.transform(p["gray"], glued), lambda t: F.contains(t, F.lit("₫")) & (t != price)
    )
    titles = F.filter(F.transform(p["title"], glued), text.contains_any("Giảm", "áp dụng"))
    items = F.transform(F.filter(p["item"], lambda i: M.has_part(i, 0)), glued)
    pairs = _pairs(p["row"], lambda r: F.when(M.has_part(r, 1), _pair(side(r, 0), side(r, 1))))
    return _fields(
        # Null name: no heading on the page.
        name=F.when(F.size(p["name"]) > 0, glued(M.first(p["name"]))),
        price_text=price,
        list_price_text=F.coalesce(M.first(others), F.lit("N/A")),
        promos=F.array_sort(F.array_distinct(F.concat(titles, items))),
        specs=specs.clean_pairs(pairs, ["xem thêm", "thông số kỹ thuật"]),
    )


LAYOUTS = {
    "cellphones": (CELLPHONES, _cellphones),
    "gearvn": (GEARVN, _gearvn),
    "gearvn_topic": (GEARVN_TOPIC, _gearvn_topic),
    "tgdd": (TGDD, _tgdd),
    "fptshop": (FPTSHOP, _fptshop),
    "phongvu": (PHONGVU, _phongvu),
}


# --- operators ---------------------------------------------------------------------------------


def _carried(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c != "html"]


def _picked(pages: DataFrame, rules: dict) -> tuple[DataFrame, dict[str, Column]]:
    """The pages with the elements of each rule, as columns of their own, and these columns by rule."""

    def once(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select(*pages.columns, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))

    cut = once(once(pages, _tokens=M.tokens(F.col("html"))), _nodes=M.nodes("_tokens"))
    cut = cut.select("*", F.inline(F.array(F.struct(M.elements("_nodes").alias("_elements")))))
    found = once(cut, **{f"_pick_{name}": c for name, c in M.pick("_nodes", "_elements", rules).items()})
    return found, {name: F.col(f"_pick_{name}") for name in rules}


def extract_fields(pages: DataFrame, layout: str) -> DataFrame:
    """One row per page that holds a product, with the raw fields of one shop's layout.

    Pages without a product (null name) are dropped.
    """
    rules, assemble = LAYOUTS[layout]
    parsed, picks = _picked(pages, rules)
    fields = assemble(F.col("html"), picks)
    product = F.array(F.struct(*[c.alias(name) for name, c in fields.items()]))
    return parsed.select(*_carried(pages), F.inline(F.filter(product, lambda x: x["name"].isNotNull())))


def with_discount(extracted: DataFrame, keep_scraped: bool = False) -> DataFrame:
    """Adds ``discount_text``; ``keep_scraped`` shows the shop's text unchanged."""
    if keep_scraped:
        return extracted.withColumn("discount_text", F.col("percent_text"))
    return add_discount(extracted, "price_text", "list_price_text", "percent_text").drop("discount_pct")


def drop_challenges(pages: DataFrame, host: str, titles: tuple[str, ...] = M.CHALLENGE_TITLES) -> DataFrame:
    """Pages that are not an interstitial, judged by title and first heading (JVM side, before any parsing)."""
    title, heading = M.tag_body(F.col("html"), "title"), M.strip_tags(M.tag_body(F.col("html"), "h1"))
    return pages.filter(~M.is_challenge(title, heading, host, titles))


def page_fields(pages: DataFrame) -> DataFrame:
    """Title, first heading and first paragraph of any page, by regular expressions."""

    def shown(tag: str) -> Column:
        return text.collapse(M.unescape(M.strip_tags(M.tag_body(F.col("html"), tag))))

    fields = pages.select(
        *_carried(pages), shown("title").alias("title"), shown("h1").alias("h1"), shown("p").alias("paragraph")
    )
    return fields.withColumn("name", text.first_non_empty(F.col("h1"), F.col("title"))).filter(F.col("name") != "")


def page_links(pages: DataFrame, base: str) -> DataFrame:
    """All anchors of a page, absolute and without query string: ``link, pos``."""
    anchors = pages.select(*_carried(pages), F.posexplode(M.hrefs(F.col("html"))).alias("pos", "href"))
    return anchors.select(
        *_carried(pages), "pos", text.drop_query(text.absolute_url(F.col("href"), base)).alias("link")
    )


def product_blocks(pages: DataFrame, base: str) -> DataFrame:
    """Product cards of listing pages: ``pos, name, link, sku``."""
    anchor = any_of((El(cls="proloop-name"), El("a")))
    parts = (Part("own", anchor), Part("@href", anchor), Part("@data-product-sku"))
    cards, picks = _picked(pages, {"card": rule(El(cls="proloop-block"), parts=parts)})
    c = F.array("card")
    return cards.select(*_carried(pages), F.posexplode(picks["card"]).alias("pos", "card")).select(
        *_carried(pages),
        "pos",
        M.first_text(c, 0).alias("name"),
        text.absolute_url(F.coalesce(M.first(M.texts(c, 1)), F.lit("")), base).alias("link"),
        M.first_text(c, 2).alias("sku"),
    )


def card_links(pages: DataFrame, base: str) -> DataFrame:
    """Links of product cards in the main list of a listing page: ``link, pos``."""
    path = (El(cls="filter-sort__list-product"), El(cls="product-info-container"), El("a", cls="product__link"))
    anchors, picks = _picked(pages, {"a": rule(path, take="@href")})
    return (
        anchors.select(*_carried(pages), F.posexplode(M.texts(picks["a"])).alias("pos", "href"))
        .filter(F.col("href") != "")
        .select(*_carried(pages), "pos", text.absolute_url(F.col("href"), base).alias("link"))
    )


def element_texts(pages: DataFrame, tags: list[str], words: list[str]) -> DataFrame:
    """Elements of the given kinds whose text contains one of the words (any case): ``tag, id, text``."""
    found, picks = _picked(pages, {t: rule(El(t), take="raw") for t in tags})

    def labelled(t: str) -> Column:
        return F.transform(
            picks[t],
            lambda e: F.struct(
                F.lit(t).alias("tag"), e["id"].alias("id"), text.pystrip(M.first(M.part(e))).alias("text")
            ),
        )

    tagged = F.concat(*[labelled(t) for t in tags])
    rows = found.select(*_carried(pages), F.explode(tagged).alias("e")).select(*_carried(pages), "e.*")
    return rows.filter(text.mentions_any(F.col("text"), words))


def elements_by_class(pages: DataFrame, words: list[str]) -> DataFrame:
    """Elements whose class attribute contains one of the words (any case): ``id, class``."""
    found, picks = _picked(pages, {"e": rule(El(attrs=(("class", None),)), take="@class")})
    rows = found.select(*_carried(pages), F.explode(picks["e"]).alias("e"))
    named = rows.select(*_carried(pages), F.col("e.id").alias("id"), M.first(M.part(F.col("e"))).alias("class"))
    return named.filter(text.mentions_any(F.col("class"), words))


def selector_hits(pages: DataFrame, selectors: dict) -> DataFrame:
    """Per page, the number of elements each rule finds."""
    found, picks = _picked(pages, selectors)
    return found.select(*_carried(pages), *[F.size(c).alias(name) for name, c in picks.items()])


def page_block(pages: DataFrame, blocks: list) -> DataFrame:
    """Adds ``block``: markup of the first element found by the first successful path, else the body."""
    rules = {f"_b{i}": rule(path, take="outer") for i, path in enumerate(blocks)}
    parsed, picks = _picked(pages, rules)
    return parsed.select(*_carried(pages), M.block_or_body(F.col("html"), list(picks.values())).alias("block"))


def embedded_specs(pages: DataFrame, variant: str) -> DataFrame:
    """Adds ``specs``: name/value pairs in page scripts, first value per name."""
    pairs = specs.dedup_pairs(M.embedded_pairs(F.col("html"), variant), keep="first")
    return pages.select(*_carried(pages), pairs.alias("specs"))
