"""Inputs of the registered queries, projected from the given tables.

The tables hold no listings, so price texts, shop tables and product pages are
rendered from their rows by Spark; every input grows with its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide import schema as S
from pricetide.functions import prices
from pricetide.operators.records import add_discount


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Narrow rows over all tasks, before each becomes a page: rendering and parsing cost far more than moving them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def whole(c: Column) -> Column:
    return F.round(c).cast("bigint")


# --- offers: line items as price texts ---------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line key with ``current``, ``original`` and ``scraped`` price texts, in the forms shops use."""
    li = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    current = prices.vnd_text(whole(F.col("l_extendedprice") * (1 - F.col("l_discount") * 8)))
    original = prices.vnd_text(whole(F.col("l_extendedprice")))
    scraped = F.concat(whole(F.col("l_tax") * 100).cast("string"), F.lit("%"))
    return li.select(
        *LINE_KEY,
        F.when(n == 1, F.lit("LIÊN HỆ ngay")).when(n == 2, F.lit("")).otherwise(current).alias("current"),
        F.when(n == 7, F.lit(None).cast("string")).otherwise(original).alias("original"),
        F.when(n <= 4, scraped).when(n == 5, F.concat(F.lit(" -"), scraped)).otherwise(F.lit("")).alias("scraped"),
    )


OFFERS_SQL = """
offers AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE l_linenumber WHEN 1 THEN 'LIÊN HỆ ngay' WHEN 2 THEN ''
      ELSE replace(format('{:,}', CAST(round(l_extendedprice * (1 - l_discount * 8)) AS BIGINT)), ',', '.') || 'đ' END AS current,
    CASE WHEN l_linenumber = 7 THEN NULL
      ELSE replace(format('{:,}', CAST(round(l_extendedprice) AS BIGINT)), ',', '.') || 'đ' END AS original,
    CASE WHEN l_linenumber <= 4 THEN CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) || '%'
      WHEN l_linenumber = 5 THEN ' -' || CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) || '%' ELSE '' END AS scraped
  FROM lineitem),
numbers AS (
  SELECT *, TRY_CAST(regexp_replace(coalesce(current, ''), '[^0-9]', '', 'g') AS BIGINT) AS c,
    TRY_CAST(regexp_replace(coalesce(original, ''), '[^0-9]', '', 'g') AS BIGINT) AS o,
    coalesce(lower(current) LIKE '%liên hệ%', false) OR coalesce(lower(original) LIKE '%liên hệ%', false) AS contact
  FROM offers)"""


# --- price texts of parts ----------------------------------------------------------------------


def part_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p_partkey, cell``: the retail price in six written forms, by part type."""
    amount = whole(F.col("p_retailprice") * F.col("p_size"))
    dotted = F.translate(F.format_number(amount, 0), ",", ".")
    cell = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(dotted, F.lit("₫")))
        .when(F.col("p_type") == "SMALL", F.concat(F.format_number(amount, 0), F.lit(" đ *")))
        .when(F.col("p_type") == "STANDARD", F.concat(F.lit("+"), dotted))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit("Liên hệ "), amount.cast("string")))
        .when(F.col("p_type") == "LARGE", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), amount.cast("string"), F.lit("Đ ")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", cell.alias("cell"))


PART_PRICES_SQL = """
amounts AS (SELECT *, CAST(round(p_retailprice * p_size) AS BIGINT) AS a FROM part),
cells AS (
  SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN replace(format('{:,}', a), ',', '.') || '₫'
    WHEN 'SMALL' THEN format('{:,}', a) || ' đ *'
    WHEN 'STANDARD' THEN '+' || replace(format('{:,}', a), ',', '.')
    WHEN 'PROMO' THEN 'Liên hệ ' || CAST(a AS VARCHAR)
    WHEN 'LARGE' THEN NULL ELSE ' ' || CAST(a AS VARCHAR) || 'Đ ' END AS cell
  FROM amounts)"""


# --- shop tables of line items -----------------------------------------------------------------

# Which shop an item belongs to, by its return flag.
SHOP_OF_FLAG = {"A": "tgdd", "N": "fptshop", "R": "cellphones"}


def shop_shards(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Per shop, a table under the shop's own headers plus the concat order ``_file, _row``."""
    shown = prices.vnd_text(whole(F.col("l_extendedprice") * (1 - F.col("l_discount"))))
    li = table(spark, sf_dir, "lineitem").withColumns(
        {
            "current": F.when(F.col("l_linenumber") == 1, F.lit("Liên hệ")).otherwise(shown),
            "original": prices.vnd_text(whole(F.col("l_extendedprice"))),
        }
    )
    rated = add_discount(li, "current", "original")
    cells = {
        S.NAME: F.concat(F.lit("Laptop "), F.col("l_partkey").cast("string")),
        S.PRICE: F.col("current"),
        S.LIST_PRICE: F.when(F.col("l_linenumber") == 2, F.lit("N/A")).otherwise(F.col("original")),
        S.DISCOUNT: F.col("discount_text"),
        S.STOCK: F.when(F.col("l_linestatus") == "O", F.lit("SẮP VỀ HÀNG")).otherwise(F.lit("")),
        S.PROMOS: F.concat_ws(" | ", F.lit("Giảm giá"), F.col("l_linestatus")),
        S.SPECS: F.concat(F.lit("CPU: "), F.col("l_suppkey").cast("string"), F.lit(" | RAM: 16 GB")),
        S.LASTMOD: F.date_format("l_shipdate", "yyyy-MM-dd"),
        S.CRAWLED: F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
    }
    cells[S.COLLECTED] = cells[S.CRAWLED]
    tables = {}
    for flag, store in SHOP_OF_FLAG.items():
        shop = S.SHOPS[store]
        link = F.concat(F.lit(shop.host + "/laptop/"), F.col("l_partkey").cast("string"))
        here = {**cells, S.LINK: link, S.URL: link}
        tables[store] = rated.filter(F.col("l_returnflag") == flag).select(
            *[here[h].alias(h) for h in shop.headers],
            F.col("l_suppkey").alias("_file"),
            F.struct("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_discount").alias("_row"),
        )
    return tables


SHOP_SHARDS_SQL = """
shards AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'tgdd' WHEN 'N' THEN 'fptshop' ELSE 'cellphones' END AS store,
    CASE l_returnflag WHEN 'A' THEN 'https://www.thegioididong.com' WHEN 'N' THEN 'https://fptshop.com.vn'
      ELSE 'https://cellphones.com.vn' END || '/laptop/' || CAST(l_partkey AS VARCHAR) AS url,
    'Laptop ' || CAST(l_partkey AS VARCHAR) AS name,
    CASE WHEN l_linenumber <> 1 THEN CAST(round(l_extendedprice * (1 - l_discount)) AS BIGINT) END AS price,
    CASE WHEN l_linenumber <> 2 THEN CAST(round(l_extendedprice) AS BIGINT) END AS list_price,
    CAST(round(l_extendedprice) AS BIGINT) AS o, l_linestatus, l_shipdate, l_suppkey, l_orderkey, l_linenumber, l_extendedprice, l_discount
  FROM lineitem),
firsts AS (
  SELECT * FROM shards
  QUALIFY row_number() OVER (PARTITION BY store, url ORDER BY l_suppkey, l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_discount) = 1)"""


# --- product pages of parts --------------------------------------------------------------------


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products: ``p_partkey, url, name, current, original`` (đồng) and spec values."""
    base = whole(F.col("p_retailprice") * 100)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("https://shop.example/laptop/"), F.col("p_partkey").cast("string")).alias("url"),
        F.concat(F.lit("Laptop "), F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string")).alias("name"),
        (base * (100 - F.col("p_size"))).alias("current"),
        (base * 100).alias("original"),
        "p_brand",
        "p_type",
        "p_size",
    )


PRODUCTS_SQL = """
products AS (
  SELECT p_partkey, 'Laptop ' || p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name,
    CAST(round(p_retailprice * 100) AS BIGINT) * (100 - p_size) AS current,
    CAST(round(p_retailprice * 100) AS BIGINT) * 100 AS original, p_brand, p_type, p_size
  FROM part)"""

# Page layouts; the marks are the columns of `products` (prices as text).
LAYOUTS = {
    "cellphones": """<html><head><title>x</title></head><body><h1>khác</h1><div class="box-product-name"><h1> {name} </h1></div>
<div class="box box-info__box-price"><p class="tpt-price">{current}</p><p class="tpt-price-through">{original}</p></div>
<div class="order-button"><strong>sắp về hàng</strong></div><p class="tpt-price">1đ</p>
<div class="box-promotions"><div class="promotion-item">Giảm {p_size}%
 <a href="#">Xem</a>cho <b>{p_type}</b></div></div><table><tr class="technical-content-item"><td>CPU</td><td><p>{p_brand}</p></td></tr>
<tr class="technical-content-item"><td>RAM</td><td>{p_size} GB</td></tr></table></body></html>""",
    "gearvn": """<html><head><script type="application/ld+json">{"@type":"Product","name":"{name}","offers":{"price":{raw_current},
"priceSpecification":{"price":"{raw_original}"}},"additionalProperty":[{"name":"CPU","value":"{p_brand}"},{"name":"RAM","value":"{p_size} GB"},
{"name":"","value":"x"}]}</script></head><body><section class="surface-red"><div class="gap-2 py-1">Ưu đãi theo phạm vi Giảm {p_size}%</div></section></body></html>""",
    "gearvn_topic": """<div class="product-info"><div class="product-name"><h1>{name}</h1></div><div class="product-price">
<span class="pro-price">{current}</span><del>{original}</del><span class="pro-percent">-{p_size}%</span></div></div>
<div id="gift-promo--app"><ul class="gift-promo--lists"><li>Giảm {p_size}%</li></ul></div>
<div id="gvn-specs-container-table"><table><tr class="gvn-spec-row"><th colspan="2">chung</th></tr>
<tr class="gvn-spec-row"><th>Card đồ họa</th><td>{p_brand}</td></tr><tr class="gvn-spec-row"><th>RAM</th><td>{p_size} GB</td></tr></table></div>""",
    "tgdd": """<h1> {name}</h1><div class="active" data-pack="1"><span><b>{current}*</b><em>{original}</em></span></div><p class="price">1đ</p>
<ul class="text-specifi"><li><aside>CPU</aside><aside><span>{p_brand}</span></aside></li><li>RAM: {p_size} GB</li></ul>
<div class="divb-right"><p>Giảm</p><p>{p_size}%</p></div>""",
    "fptshop": """<h1>{name}</h1><span class="st-price-main">{current}</span><p class="st-price-sub">{original}</p>
<p class="line-clamp-1 text-textOnWhitePrimary">Giảm {p_size}%</p><div class="popup"><div class="border-dashed"><b>CPU</b><b>{p_brand}</b></div>
<div class="border-dashed"><b>RAM</b><b>{p_size} GB</b></div></div>""",
    "phongvu": """<h1>{name}</h1><div type="title" color="primary500">{current}</div><div direction="row">
<div type="body" color="textSecondary">{original}₫</div></div><div color="textTitle">Giảm {p_size}%</div>
<div direction="row" width="100%"><div>CPU</div><div>{p_brand}</div></div><div direction="row" width="100%"><div>Xem thêm</div><div>x</div></div>
<div direction="row" width="100%"><div>RAM</div><div>{p_size} GB</div></div>""",
}


# The same products in the second layouts that the rules fall back on; every other part is shown so.
FALLBACKS = {
    "cellphones": """<h1> {name} </h1><div class="box-product-price-wrapper"><b class="sale-price">{current}</b><i class="base-price">{original}</i></div>
<div class="order-button"><strong>Sắp về hàng</strong></div><div class="item-promotions">Giảm {p_size}%
 <button>Xem</button>cho <b>{p_type}</b></div><ul class="technical-content"><li><p>CPU</p><p><span>{p_brand}</span></p></li>
<li><p>RAM</p><div><i>{p_size} GB</i></div></li></ul>""",
    "gearvn": """<script type="application/ld+json">{"@type":"Product","name":"{name}","offers":{"price":{raw_current},
"priceSpecification":{"price":"{raw_original}"}},"additionalProperty":
[{"name":"CPU","value":"{p_brand}"},{"name":"RAM","value":"{p_size} GB"}]}</script><span class="line-through">1đ</span>
<div data-product-summary-region="true"><span class="text-red-700 font-bold">{current}</span><span class="line-through">{original}</span></div>
<div id="gift-promo--app"><ul class="gift-promo--lists"><li>Giảm {p_size}%</li></ul></div>""",
    "gearvn_topic": """<div class="product-info"><div class="product-name"><h1>{name}</h1></div><div class="product-price">
<span class="pro-price">{current}</span><del>{original}</del><span class="pro-percent">-{p_size}%</span></div></div>
<div id="gvn-promotions"><div class="gvn-promo-item"><b class="gvn-promo-title">Giảm {p_size}%</b></div></div>
<div id="gvn-specs-container-table"><table><tr class="gvn-spec-row"><th>Card đồ họa</th><td>{p_brand}</td></tr><tr class="gvn-spec-row"><th>RAM</th><td>{p_size} GB</td></tr></table></div>""",
    "tgdd": """<h1>{name}</h1><p class="box-price-present">{current}*</p><p class="box-price-old">{original}</p><ul class="parameter">
<li><span class="lileft">CPU</span><span class="liright"><b>{p_brand}</b></span></li><li>RAM: {p_size} GB</li></ul>
<div class="backtoschool"><div><b>Giảm</b><span>{p_size}%</span></div></div>""",
    "fptshop": """<h1>{name}</h1><div id="price-product"><span class="text-black-opacity-100">{current}</span></div>
<p class="text-neutral-gray-5 line-through">{original}</p><div class="promo-item"><i>Giảm {p_size}%</i></div>
<table><tr><th>CPU</th><td>{p_brand}</td></tr><tr><th>RAM</th><td>{p_size} GB</td></tr></table>""",
    "phongvu": """<h1>{name}</h1><div type="title" color="primary500">{current}</div><div direction="row">
<div type="body" color="textSecondary">Giá cũ</div><div type="body" color="textSecondary">{original}₫</div></div>
<div color="textTitle">Tin mới</div><ul><li><span>Giảm {p_size}%</span><span>x</span></li></ul>
<div direction="row" width="100%"><div>CPU</div><div>{p_brand}</div></div><div direction="row" width="100%"><div>RAM</div><div>{p_size} GB</div></div>""",
}


def product_pages(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    """``p_partkey, url, html``: each part as a product page in one of a shop's two layouts."""
    html = F.when(F.col("p_partkey") % 2 == 0, F.lit(LAYOUTS[layout])).otherwise(F.lit(FALLBACKS[layout]))
    marks = {
        "name": F.col("name"),
        "current": prices.vnd_text(F.col("current")),
        "original": prices.vnd_text(F.col("original")),
        "raw_current": F.col("current").cast("string"),
        "raw_original": F.col("original").cast("string"),
        "p_brand": F.col("p_brand"),
        "p_type": F.col("p_type"),
        "p_size": F.col("p_size").cast("string"),
    }
    for mark, value in marks.items():
        html = F.replace(html, F.lit("{" + mark + "}"), value)
    return spread(products(spark, sf_dir), "p_partkey").select("p_partkey", "url", html.alias("html"))
