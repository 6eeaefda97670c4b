"""Column names, table schemas and the registry of shops."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Headers of the shop tables.
NAME = "Tên Sản Phẩm"
PRICE = "Giá Hiện Tại"
LIST_PRICE = "Giá Gốc"
DISCOUNT = "Giảm Giá"
STOCK = "Tình Trạng"
PROMOS = "Khuyến Mãi"
GIFT = "Quà Tặng / Ghi Chú"
SPECS = "Cấu Hình Chi Tiết"
LINK = "Link Sản Phẩm"
URL = "URL"
LASTMOD = "Ngày Cập Nhật (Sitemap)"
CRAWLED = "Ngày Giờ Crawl"
COLLECTED = "Ngày Thu Thập"


@dataclass(frozen=True)
class Shop:
    key: str  # name in table paths
    sheet: str  # name in the published report
    topic_sheet: str  # name in the topic workbook
    host: str
    headers: tuple[str, ...]
    spec_sep: str = " | "

    @property
    def topic_file(self) -> str:
        """Name of its topic table."""
        return f"laptop_rtx3050_{self.key}"


# The five shops and the columns of their tables, in order.
SHOPS = {
    s.key: s
    for s in (
        Shop(
            "fptshop", "FPTShop", "FPT Shop", "https://fptshop.com.vn",
            (NAME, PRICE, LIST_PRICE, DISCOUNT, PROMOS, SPECS, URL, COLLECTED),
        ),
        Shop(
            "phongvu", "PhongVu", "Phong Vu", "https://phongvu.vn",
            (NAME, PRICE, LIST_PRICE, DISCOUNT, PROMOS, SPECS, URL, COLLECTED), "\n",
        ),
        Shop(
            "tgdd", "TGDĐ", "The Gioi Di Dong", "https://www.thegioididong.com",
            (NAME, PRICE, LIST_PRICE, DISCOUNT, PROMOS, SPECS, LINK, LASTMOD, CRAWLED),
        ),
        Shop(
            "cellphones", "CellphoneS", "CellphoneS", "https://cellphones.com.vn",
            (NAME, PRICE, LIST_PRICE, DISCOUNT, STOCK, PROMOS, SPECS, LINK, CRAWLED),
        ),
        Shop(
            "gearvn", "GearVN", "GearVN", "https://gearvn.com",
            (NAME, PRICE, LIST_PRICE, DISCOUNT, PROMOS, GIFT, SPECS, LINK, LASTMOD, CRAWLED),
        ),
    )
}
TOPIC_HEADERS = (NAME, PRICE, LIST_PRICE, DISCOUNT, PROMOS, GIFT, SPECS, LINK, CRAWLED)

# All shop headers in one table; a shop leaves the others null.
BRONZE = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            NAME, PRICE, LIST_PRICE, DISCOUNT, STOCK, PROMOS, GIFT, SPECS, LINK, URL, LASTMOD, CRAWLED, COLLECTED,
        )
    ]
)

# Sheets of the topic workbook while their prices are numbers; a sheet leaves what it does not have null.
WORKBOOK = T.StructType(
    [T.StructField(f.name, T.DoubleType() if f.name in (PRICE, LIST_PRICE) else f.dataType) for f in BRONZE.fields]
    + [T.StructField("store", T.StringType())]
)

SILVER = T.StructType(
    [
        T.StructField("store", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("price_text", T.StringType()),
        T.StructField("price", T.LongType()),
        T.StructField("list_price_text", T.StringType()),
        T.StructField("list_price", T.LongType()),
        T.StructField("price_note", T.StringType()),
        T.StructField("discount_pct", T.IntegerType()),
        T.StructField("discount_text", T.StringType()),
        T.StructField("stock_status", T.StringType()),
        T.StructField("promos", T.ArrayType(T.StringType())),
        T.StructField("gift_note", T.StringType()),
        T.StructField("specs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("specs_text", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("source_lastmod", T.StringType()),
        T.StructField("crawled_at", T.TimestampType()),
        T.StructField("crawled_text", T.StringType()),
        T.StructField("other_cells", T.MapType(T.StringType(), T.StringType())),
    ]
)

SITEMAP_URL = "loc string, lastmod string"
SITEMAP_INDEX = "loc string"
LISTING_BODY = "struct<data:struct<products:array<struct<canonical:string>>>>"
CRAWL_LOG = "store string, chunk int, idx bigint, url string, outcome string"


def registry(spark: SparkSession) -> DataFrame:
    """One row per shop: ``ord, store, file, sheet_name``."""
    rows = [(i, s.key, f"laptop_{s.key}_all", s.sheet) for i, s in enumerate(SHOPS.values())]
    return spark.createDataFrame(rows, "ord int, store string, file string, sheet_name string")

# Shops that show an interstitial page instead of the product.
CHALLENGED = ("fptshop", "phongvu")

# Links before the last three failures that a shop's next run takes again.
RESTART_OVERLAP = {"fptshop": 1}
