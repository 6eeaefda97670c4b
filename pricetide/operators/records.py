"""Shop tables (one text column per header) and the canonical catalog record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide import schema as S
from pricetide.functions import dates, prices, specs, text
from pricetide.operators.links import keep_first


# Words by which price columns are told from others.
PRICE_WORD = "giá"
NO_PRICE_WORDS = ("giảm", "khuyến")


def add_discount(
    df: DataFrame, current: str, original: str, scraped: str | None = None, cap: int | None = 70
) -> DataFrame:
    """Adds ``discount_pct`` and ``discount_text`` from price text columns.

    The parsed numbers are columns of their own, so each text is read once.
    """
    cur, orig = F.col(f"`{current}`"), F.col(f"`{original}`")
    parsed = df.withColumns(
        {
            "_cur": prices.digits(cur),
            "_orig": prices.digits(orig),
            "_contact": prices.is_contact(cur) | prices.is_contact(orig),
            "_shown": prices.shown_discount(F.col(f"`{scraped}`") if scraped else None),
        }
    )
    pct = prices.capped(prices.drop_percent(F.col("_cur"), F.col("_orig")), cap)
    rated = parsed.withColumn("_pct", F.when(~F.col("_contact"), pct))
    return rated.withColumns(
        {
            "discount_pct": F.col("_pct").cast("int"),
            "discount_text": prices.chosen_discount(F.col("_contact"), F.col("_pct"), F.col("_shown")),
        }
    ).drop("_cur", "_orig", "_contact", "_shown", "_pct")


def price_columns(columns: list[str]) -> list[str]:
    """Columns that hold a price: the name has the wanted word and none of those excluded."""
    return [c for c in columns if PRICE_WORD in c.lower() and not any(word in c.lower() for word in NO_PRICE_WORDS)]


def key_column(columns: list[str]) -> str | None:
    """Column that identifies a product, if the table has one."""
    return next((c for c in (S.URL, S.LINK) if c in columns), None)


def shop_rows(
    extracted: DataFrame, headers: tuple[str, ...], spec_sep: str = " | ", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Extracted fields as a shop table: nested fields flattened to text, columns by the shop's headers.

    Needs ``discount_text``; ``captured_at`` and ``source_lastmod`` are used when present.
    """

    def given(name: str) -> Column:
        return F.col(name) if name in extracted.columns else F.lit(None).cast("string")

    captured = (
        dates.local_time_text(F.col("captured_at")) if "captured_at" in extracted.columns else F.lit(None).cast("string")
    )
    by_header = {
        S.NAME: F.col("name"),
        S.PRICE: F.col("price_text"),
        S.LIST_PRICE: F.col("list_price_text"),
        S.DISCOUNT: F.col("discount_text"),
        S.STOCK: F.col("stock_status"),
        S.PROMOS: text.join_list(F.col("promos")),
        S.GIFT: F.col("gift_note"),
        S.SPECS: specs.spec_text(F.col("specs"), spec_sep),
        S.LINK: F.col("url"),
        S.URL: F.col("url"),
        S.LASTMOD: given("source_lastmod"),
        S.CRAWLED: captured,
        S.COLLECTED: captured,
    }
    return extracted.select(*[by_header[h].alias(h) for h in headers], *carry)


def union_tables(frames: list[DataFrame]) -> DataFrame:
    """Concatenate, columns aligned by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_stores(frames: dict[str, DataFrame]) -> DataFrame:
    """Concatenate stores, tagged with ``store``."""
    return union_tables([df.withColumn("store", F.lit(store)) for store, df in frames.items()])


def merge_shards(bronze: DataFrame, order: list[str]) -> DataFrame:
    """Shards of any number of stores to canonical records: first row per store and product.

    Duplicates go before any cell is parsed.
    """
    url = F.coalesce(*[text.blank_to_null(F.col(c)) for c in (S.URL, S.LINK) if c in bronze.columns])
    return silver(keep_first(bronze.withColumn("_url", url), ["store", "_url"], order))


def merge_shop(df: DataFrame, order: list[str]) -> DataFrame:
    """First row per product, price columns numeric with the text of unreadable cells kept next to them."""
    key = key_column(df.columns)
    unique = keep_first(df, [key], order) if key else df
    cols = {}
    for c in price_columns(df.columns):
        cell = text.blank_to_null(F.col(c))
        cols[c] = prices.price(cell)
        cols[f"{c} (ghi chú)"] = prices.price_note(cell)
    return unique.withColumns(cols)


def silver(bronze: DataFrame) -> DataFrame:
    """Canonical record from any mix of shop tables; needs ``store``, other columns are optional.

    Nothing is lost: the spec text stays next to the map, the crawl time as it was written next to the parsed one, and
    cells under headers that no shop is known to have are kept by header.
    """

    def cell(*names: str) -> Column:
        present = [text.blank_to_null(F.col(f"`{n}`")) for n in names if n in bronze.columns]
        return F.coalesce(*present) if present else F.lit(None).cast("string")

    price, original, shown = cell(S.PRICE), cell(S.LIST_PRICE), cell(S.DISCOUNT)
    # A cast that fails costs an exception per row, so a cell without a discount becomes null before it.
    pct = F.nullif(F.regexp_extract(F.coalesce(shown, F.lit("")), r"\A-(\d+)%\z", 1), F.lit("")).try_cast("int")
    return bronze.select(
        F.col("store"),
        cell(S.NAME).alias("name"),
        price.alias("price_text"),
        prices.price(price).alias("price"),
        original.alias("list_price_text"),
        prices.price(original).alias("list_price"),
        prices.price_note(price).alias("price_note"),
        pct.alias("discount_pct"),
        F.coalesce(shown, F.lit("")).alias("discount_text"),
        cell(S.STOCK).alias("stock_status"),
        F.filter(F.split(F.coalesce(cell(S.PROMOS), F.lit("")), r" \| "), lambda t: t != "")
        .cast(S.SILVER["promos"].dataType)
        .alias("promos"),
        cell(S.GIFT).alias("gift_note"),
        specs.spec_map(specs.parse_spec_text(F.coalesce(cell(S.SPECS), F.lit("")))).alias("specs"),
        cell(S.SPECS).alias("specs_text"),
        cell(S.URL, S.LINK).alias("url"),
        cell(S.LASTMOD).alias("source_lastmod"),
        dates.parse_local_time(cell(S.COLLECTED, S.CRAWLED)).alias("crawled_at"),
        cell(S.COLLECTED, S.CRAWLED).alias("crawled_text"),
        _other_cells(bronze).alias("other_cells"),
    )


def _other_cells(bronze: DataFrame) -> Column:
    """Filled cells of columns that are neither canonical nor helpers of a job, by header."""
    known = {h for shop in S.SHOPS.values() for h in shop.headers} | {"store", "chunk", "run"}
    names = [c for c in bronze.columns if c not in known and not c.startswith("_")]
    if not names:
        return F.lit(None).cast("map<string,string>")
    filled = [F.struct(F.lit(n).alias("key"), text.blank_to_null(F.col(f"`{n}`").cast("string")).alias("value")) for n in names]
    return F.map_from_entries(F.filter(F.array(*filled), lambda p: p["value"].isNotNull()))


def topic_numbers(df: DataFrame) -> DataFrame:
    """Topic workbook sheet: discount column dropped, price columns as numbers."""
    present = [c for c in (S.PRICE, S.LIST_PRICE) if c in df.columns]
    return df.drop(S.DISCOUNT).withColumns({c: prices.final_number(F.col(f"`{c}`")) for c in present})


def topic_clean_text(df: DataFrame) -> DataFrame:
    """Topic workbook sheet: discount column dropped, currency signs removed from price text."""
    present = [c for c in (S.PRICE, S.LIST_PRICE) if c in df.columns]
    return df.drop(S.DISCOUNT).withColumns({c: prices.strip_currency(F.col(f"`{c}`")) for c in present})


def topic_repair_discount(df: DataFrame, store: str | None = None) -> DataFrame:
    """Recompute the discount column, of one store's rows only when ``store`` is given."""
    parsed = df.withColumns(
        {
            "_cur": prices.repair_number(F.col(f"`{S.PRICE}`")),
            "_orig": prices.repair_number(F.col(f"`{S.LIST_PRICE}`")),
        }
    )
    fixed = prices.repaired_from(F.col("_cur"), F.col("_orig"))
    if store is not None:
        current = F.col(f"`{S.DISCOUNT}`") if S.DISCOUNT in df.columns else F.lit(None).cast("string")
        fixed = F.when(F.col("store") == store, fixed).otherwise(current)
    return parsed.withColumn(S.DISCOUNT, fixed).drop("_cur", "_orig")


def sheet_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every cell as text, null as ''; rows without any text are dropped."""
    columns = columns or df.columns
    cells = df.select(*[text.text_or_empty(F.col(f"`{c}`")).alias(c) for c in columns])
    return cells.filter(F.concat_ws("", *[F.col(f"`{c}`") for c in columns]) != "")
