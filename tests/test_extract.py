"""Field extraction on small handmade captures, one per layout."""

import json

import pyarrow as pa
from pyspark.sql import functions as F

from pricetide import schema as S
from pricetide.functions import markup as M
from pricetide.functions.markup import El
from pricetide.operators import extract, records


def pages(spark, *htmls):
    return spark.createDataFrame(
        [(i, f"https://shop/{i}", h) for i, h in enumerate(htmls)], "page_id bigint, url string, html string"
    )


def fields(spark, rules, html):
    rows = extract.extract_fields(pages(spark, html), rules).collect()
    return rows[0] if rows else None


def pairs(row):
    return [tuple(p) for p in row.specs]


CELLPHONES = """<html><body><h1>khác</h1><div class="box-product-name"><h1> Laptop A </h1></div>
<div class="x box-info__box-price"><p class="tpt-price">19.990.000đ</p><p class="tpt-price-through">24.990.000đ</p>
<div class="product__price--percent-detail"><span>-20%</span></div></div>
<p class="tpt-price">1đ</p>
<div class="order-button"><strong> Tạm hết hàng </strong></div>
<div class="box-promotions"><div class="promotion-item">Giảm 5%
<a href="#">Xem</a> cho <b>SV</b></div><div class="promotion-item">-</div><div class="promotion-item">Giảm 5%
 cho <b>SV</b></div></div><div class="block-smem-price"><button>x</button>Smember</div>
<table><tr class="technical-content-item"><td> CPU </td><td><p>i7</p> <p>13620H</p></td></tr>
<tr class="technical-content-item"><td>CPU</td><td>i9</td></tr><tr class="technical-content-item"><td>RAM</td><td></td></tr>
</table></body></html>"""


def test_cellphones(spark):
    r = fields(spark, "cellphones", CELLPHONES)
    assert (r.name, r.price_text, r.list_price_text, r.percent_text) == ("Laptop A", "19.990.000đ", "24.990.000đ", "-20%")
    assert r.stock_status == "TẠM HẾT HÀNG"
    assert r.promos == ["Giảm 5% - cho SV", "Smember"]
    assert pairs(r) == [("CPU", "i9")]


def test_cellphones_list_layout(spark):
    html = """<h1>L</h1><div class="tpt-box-price"><span class="sale-price">Liên Hệ ngay</span>
    <i class="base-price">99.999₫</i></div><ul class="technical-content"><li><p>GPU</p><div>RTX <b>3050</b></div></li>
    <li><p>Pin</p><p><span>Pin</span><span>60Wh</span></p></li></ul>"""
    r = fields(spark, "cellphones", html)
    assert (r.name, r.price_text, r.list_price_text, r.stock_status) == ("L", "Liên hệ", "", "")
    assert pairs(r) == [("GPU", "3050"), ("Pin", "60Wh")]


def gearvn_html(ld, body=""):
    return (
        '<html><script type="application/ld+json">{bad</script><script type="application/ld+json">'
        '{"@type": "Organization"}</script><script type="application/ld+json">' + json.dumps(ld) + "</script>"
        f"<body>{body}</body></html>"
    )


LD = {
    "@type": "Product", "name": " Laptop G ",
    "offers": {"price": 19990000, "priceSpecification": {"price": "24990000"}},
    "additionalProperty": [{"name": "CPU ", "value": "i5"}, {"name": "RAM", "value": ""}, {"name": "CPU", "value": "i7"}],
}


def test_gearvn(spark):
    body = """<span class="line-through">1đ</span><div data-product-summary-region="true">
    <span class="text-red-700 font-bold">18.000.000đ</span><span class="text-red-600 bg-red-50">-10%</span></div>
    <section class="bg-surface-red"><div class="gap-2 py-1">Ưu đãi theo phạm vi <p>Tặng balo</p></div>
    <div class="gap-2 py-1">ngắn</div></section>"""
    r = fields(spark, "gearvn", gearvn_html(LD, body))
    assert (r.name, r.price_text, r.list_price_text, r.percent_text) == ("Laptop G", "18.000.000đ", "", "-10%")
    assert r.promos == ["Tặng balo"]
    assert pairs(r) == [("CPU", "i7")]


def test_gearvn_fallbacks(spark):
    body = """<div id="gvn-promotions"><div class="gvn-promo-item"><b class="gvn-promo-title">Quà</b>
    <i class="gvn-promo-desc">chuột</i></div></div><div id="gift-promo--app"><ul class="gift-promo--lists"><li>Túi</li></ul></div>"""
    r = fields(spark, "gearvn", gearvn_html(LD, body))
    assert (r.price_text, r.list_price_text) == ("19.990.000đ", "24.990.000đ")
    assert r.promos == ["Quà (chuột)", "Túi"]
    assert fields(spark, "gearvn", "<h1>no data</h1>") is None


TOPIC = """<div class="product-info"><div class="product-name"><h1>Laptop T</h1></div><div class="product-price">
<span class="pro-price">19.000.000₫</span><del>20.000.000₫</del><span class="pro-percent">-5%</span></div>
<div class="product-desc-short"><p>Quà A</p><p> </p><p>Quà B</p></div></div>
<div id="gvn-specs-container-table"><table><tr class="gvn-spec-row"><th colspan="2">VGA 3050</th></tr>
<tr class="gvn-spec-row"><th>Card đồ họa</th><td>RTX<br> 3050</td></tr></table></div>"""


def test_topic(spark):
    r = fields(spark, "gearvn_topic", TOPIC)
    assert (r.name, r.price_text, r.list_price_text, r.percent_text) == ("Laptop T", "19.000.000₫", "20.000.000₫", "-5%")
    assert r.gift_note == "Quà A | Quà B"
    assert pairs(r) == [("Card đồ họa", "RTX 3050")]
    assert fields(spark, "gearvn_topic", "<div>x</div>") is None


TGDD = """<h1>Laptop D</h1><div class="active" data-pack="1"><span><b>18.990.000₫*</b><em>20.990.000₫</em></span></div>
<p class="box-price-present">1₫</p><span class="box-price-percent">-9%</span>
<ul class="text-specifi"><li><aside>CPU</aside><aside><span>i5</span><span>12500H</span></aside></li>
<li><aside><b>RAM</b></aside><aside>16 GB</aside></li><li>Màu: Bạc: nhạt</li><li>không</li></ul>
<div class="pr-item"><div class="divb-right"><p>Giảm 1</p><p>Giảm 2</p></div><div class="divb-right">Giảm 1<br>Giảm 2</div></div>
<div class="backtoschool"><div><b>Sinh viên</b><span>giảm 3%</span></div><div><i>x</i></div></div>"""


def test_tgdd(spark):
    r = fields(spark, "tgdd", TGDD)
    assert (r.name, r.price_text, r.list_price_text, r.percent_text) == ("Laptop D", "18.990.000₫", "20.990.000₫", "-9%")
    assert pairs(r) == [("CPU", "i5 12500H"), ("RAM", "16 GB"), ("Màu", "Bạc: nhạt")]
    assert r.promos == ["Giảm 1 - Giảm 2", "Sinh viên - giảm 3%"]


FPT = """<h1> Laptop <b>F</b>  15 </h1><div id="price-product"><span class="text-black-opacity-100">+1.722</span></div>
<span class="st-price-sub">24.990.000 đ</span><p class="line-clamp-1 text-textOnWhitePrimary"> Trả góp 0% </p>
<div class="border-dashed"><b>ngoài</b><b>1</b></div><div class="modal-x"><div class="border-dashed"><span>CPU</span><span>i5 <b>x</b></span></div>
<div class="border-dashed"><i>1</i><i>2</i><i>3</i></div></div>"""


def test_fptshop(spark):
    r = fields(spark, "fptshop", FPT)
    assert (r.name, r.price_text, r.list_price_text) == ("Laptop F 15", "", "24.990.000 đ")
    assert r.promos == ["Trả góp 0%"]
    assert pairs(r) == [("CPU", "i5x")]
    html = """<p class="st-price-main">9.999đ</p><table><tr><th>RAM</th><td>8 <i>GB</i></td></tr></table>
    <div class="promo-item"><i>A</i></div>"""
    r = fields(spark, "fptshop", html)
    assert (r.name, r.price_text, r.promos, pairs(r)) == ("", "9.999đ", ["A"], [("RAM", "8  GB")])


PHONGVU = """<h1>Laptop <b> P</b></h1><div type="title" color="primary500">19.990.000₫</div>
<div><div type="body" color="textSecondary">30.000.000₫</div></div>
<div direction="row"><div type="body" color="textSecondary">19.990.000₫</div><div type="body" color="textSecondary">21.000.000 ₫</div></div>
<div color="textTitle">Giảm 1tr</div><div color="textTitle">khác</div><ul><li><span>Quà</span><span>2</span></li><li>x</li></ul>
<div direction="row" width="100%"><div>CPU</div><div>i5</div></div><div direction="row" width="100%"><div>Xem thêm</div><div>i5</div></div>"""


def test_phongvu(spark):
    r = fields(spark, "phongvu", PHONGVU)
    assert (r.name, r.price_text, r.list_price_text) == ("LaptopP", "19.990.000₫", "21.000.000 ₫")
    assert r.promos == ["Giảm 1tr", "Quà"]
    assert pairs(r) == [("CPU", "i5")]
    assert fields(spark, "phongvu", "<p>chặn</p>") is None


def test_shop_rows_and_back(spark):
    found = extract.with_discount(extract.extract_fields(pages(spark, TGDD), "tgdd"))
    found = found.withColumns(
        {"captured_at": F.lit("2026-07-01 20:30:00").cast("timestamp"), "source_lastmod": F.lit("2026-06-30")}
    )
    table = records.shop_rows(found, S.SHOPS["tgdd"].headers)
    assert table.columns == list(S.SHOPS["tgdd"].headers)
    row = table.first()
    assert row[S.DISCOUNT] == "-10%" and row[S.CRAWLED] == "2026-07-02 03:30:00"
    silver = records.silver(table.withColumn("store", F.lit("tgdd")))
    assert silver.schema.names == S.SILVER.names
    assert [f.dataType for f in silver.schema] == [f.dataType for f in S.SILVER]
    back = silver.withColumn("at", F.col("crawled_at").cast("string")).first()
    assert (back.price, back.list_price, back.discount_pct) == (18990000, 20990000, 10)
    assert back.specs == {"CPU": "i5 12500H", "RAM": "16 GB", "Màu": "Bạc: nhạt"}
    assert back.promos == ["Giảm 1 - Giảm 2", "Sinh viên - giảm 3%"]
    assert back.at == "2026-07-01 20:30:00"


def picked(df, rules):
    found, columns = extract._picked(df, rules)
    return found.select(*[c.alias(name) for name, c in columns.items()])


def test_takes(spark):
    html = '<div id="a">x\n<br/>y<p>é</p><i> &amp; </i></div><div id="b">z'
    a, b = El(attrs=(("id", "a"),)), El(attrs=(("id", "b"),))
    takes = ("own", "deep", "inner", "raw", "lines", "outer", "@id")
    rules = {
        "a": M.rule(a, parts=tuple(M.Part(t) for t in takes)),
        "b": M.rule(b, take="outer"),
        "cut": M.rule(a, parts=(M.Part("raw", without=(El("p"),)), M.Part("own", M.any_of(El("em"))))),
        "child": M.rule((a, El("p i", child=True)), take="own"),
    }
    row = picked(pages(spark, html), rules).first()
    assert row.a[0].parts == [
        ["x\n", "y"], ["x\n", "y", "é", " & "], ["é", " & "], ["x\nyé & "], ["x\ny\né\n&"],
        ['<div id="a">x\n<br/>y<p>é</p><i> &amp; </i></div>'], ["a"],
    ]
    assert row.b[0].parts == [['<div id="b">z']]
    assert row.cut[0].parts == [["x\ny & "], None]
    assert [x.parts for x in row.child] == [[["é"]], [[" & "]]]
    nulls = picked(spark.createDataFrame([(None,), ("<b>x",)], "html string"), rules).collect()
    assert [r.a for r in nulls] == [[], []]


def test_page_block(spark):
    html = '<html><body class="x"><div class="my-spec"><i>1</i></div><table><tr></tr></table></body></html>'
    p = pages(spark, html, "<body>only</body>")
    spec = El(has=(("class", "spec"),))
    got = extract.page_block(p, [El("table"), spec]).orderBy("page_id").collect()
    assert [r.block for r in got] == ["<table><tr></tr></table>", "only"]
    short = extract.page_block(p, [El(has=(("class", "modal"),))]).orderBy("page_id").collect()
    assert [r.block for r in short] == ['<div class="my-spec"><i>1</i></div><table><tr></tr></table>', "only"]


def test_embedded_specs(spark):
    script = (
        r'<script>"{\"displayName\":\"CPU\",\"description\":\"i5\"} {\"displayName\":\"RAM\",\"unit\":null,'
        r'\"value\":\"16 GB\"},{\"displayName\":\"RAM\",\"value\":\"8\"}"</script>'
    )
    got = {
        v: {p.key: p.value for p in extract.embedded_specs(pages(spark, script), v).first().specs}
        for v in M.EMBEDDED_PATTERNS
    }
    assert got == {
        "description": {"CPU": "i5"},
        "lazy_value": {"CPU": "16 GB", "RAM": "8"},
        "same_object": {"RAM": "16 GB"},
    }


def test_product_blocks(spark):
    html = """<div class="proloop-block" data-product-sku=" SKU3050 "><h3 class="proloop-name"><a href="/products/a"> Laptop A </a></h3></div>
    <div class="proloop-block"><h3 class="proloop-name"><a href="https://x/b">Chuột</a></h3></div>
    <div class="proloop-block"><h3 class="proloop-name"></h3></div>"""
    rows = extract.product_blocks(pages(spark, html), "https://h").orderBy("pos").collect()
    assert [(r.name, r.link, r.sku) for r in rows] == [
        ("Laptop A", "https://h/products/a", "SKU3050"), ("Chuột", "https://x/b", ""), ("", "", ""),
    ]


def test_card_links_and_probes(spark):
    html = """<div class="filter-sort__list-product"><div class="product-info-container"><a class="product__link button" href="/l.html">L</a>
    <a href="/no.html">N</a></div></div><ul class="listproduct"><li class="item" data-id="1"><a class="main-contain">x</a></li></ul>
    <button>Xem CẤU HÌNH chi tiết</button><span>khác</span><div class="My-Spec-Table">t</div>"""
    p = pages(spark, html)
    assert [r.link for r in extract.card_links(p, "https://h").collect()] == ["https://h/l.html"]
    hits = extract.selector_hits(
        p,
        {
            "card": M.rule((El("li", cls="item"), El("a", cls="main-contain"))),
            "child": M.rule((El("li", attrs=(("data-id", None),)), El("a", child=True))),
            "none": M.rule(El("h1")),
        },
    ).first()
    assert (hits.card, hits.child, hits.none) == (1, 1, 0)
    found = extract.element_texts(p, ["button", "a", "span"], ["cấu hình", "thông số"]).collect()
    assert [(r.tag, r.text) for r in found] == [("button", "Xem CẤU HÌNH chi tiết")]
    assert [r["class"] for r in extract.elements_by_class(p, ["spec", "tech", "table"]).collect()] == ["My-Spec-Table"]


def test_challenge(spark):
    df = spark.createDataFrame(
        [("Just a moment...", ""), ("ok", "FPTShop.com.vn"), ("ok", "Laptop"), (None, None)], "t string, h string"
    )
    got = [r[0] for r in df.select(M.is_challenge(F.col("t"), F.col("h"), "fptshop.com.vn")).collect()]
    assert got == [True, True, False, False]


def page_nodes(spark, *htmls):
    cut = spark.createDataFrame([(h,) for h in htmls], "html string").select(M.tokens(F.col("html")).alias("t"))
    return cut.select(M.nodes("t").alias("n"))


def test_odd_markup(spark):
    html = (
        "<!-- <p>no</p> --><SCRIPT>var t = '</p><p>';</SCRIPT><DIV Class='a  b' data-x=1 hidden title=\"a > b\">1 < 2"
        "<br/>&lt;i&gt;<?pi?></b></i></DIV><title>a<b>&amp;</title><p>x<!-- open"
    )
    nodes = page_nodes(spark, html).first().n
    assert [n.tag for n in nodes if n.tag] == ["script", "div", "br", "title", "p"]
    assert [n.text for n in nodes if n.text is not None] == ["var t = '</p><p>';", "1 < 2", "<i>", "a<b>&", "x"]
    div = next(n for n in nodes if n.tag == "div")
    assert {a.name: a.value for a in div.attrs} == {"class": "a  b", "data-x": "1", "hidden": "", "title": "a > b"}
    assert div.cls == " a b "
    assert [n.source for n in nodes if div.id < n.id <= div.last][-1] == "</DIV>"


def test_nested_tags():
    marks = ["div", "", "p", "", "p", "br/", "/div", "/p", "!", "ul", "li", "li", "/li", "i", "/ul", ""]
    places = M.nested(marks)
    assert [p[0] for p in places] == [6, 1, 5, 3, 5, 5, 6, 7, 8, 14, 13, 12, 12, 13, 14, 15]
    assert [p[1] for p in places] == [-1, 0, 0, 2, 2, 4, -2, -2, -2, -1, 9, 10, -2, 10, -2, -1]
    assert [p[2] for p in places] == [1, 0, 1, 0, 1, 1, 0, 0, 0, 2, 1, 1, 0, 2, 0, 0]


def test_broken_markup_is_linear(spark):
    import time

    pieces = ("<a '", '<a "', "<!", "<", "</b>", "<b>", "<b></i>", "<!--", "&amp", "<script>", '<p class="x', "<b></b>")
    page_nodes(spark, "<p>a</p>").collect()
    start = time.perf_counter()
    page_nodes(spark, *[piece * 20000 for piece in pieces]).select(F.size("n")).collect()
    assert time.perf_counter() - start < 60


def test_character_references(spark):
    texts = ["a", "&", "&amp;lt;", "&#x2F;&#47;&eacute;", "&#128512;", "&nosuch;&amp", "&#0;&#xD800;", "&copy2&lt", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(M.unescape(F.col("t"))).collect()
    assert [r[0] for r in got] == ["a", "&", "&lt;", "//é", "😀", "&nosuch;&", "\ufffd\ufffd", "&copy2<", None]


def test_links_outside_comments_with_references_resolved(spark):
    html = "<a href='/a&#x2F;b&eacute;'>x</a><!-- <a href=/no>y</a> --><a href=/c&amp;d>z</a><!-- <a href=/open>"
    got = extract.page_links(pages(spark, html), "https://h").orderBy("pos").collect()
    assert [r.link for r in got] == ["https://h/a/bé", "https://h/c&d"]


def test_places_of_a_batch_are_plain_numbers():
    """Many tokens in one batch: what is held for it does not grow by an object for each."""
    import tracemalloc

    pages = pa.array([["ul", *["li", "", "/li"] * 30, "/ul"], None, []] * 1000, pa.list_(pa.string()))
    tracemalloc.start()
    got = M._places.func(pages)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8e6
    want = [dict(zip(("last", "parent", "nth", "line"), r)) for r in M.nested(pages[0].as_py())]
    assert [len(got), got[2997].as_py(), got[2998].as_py(), got[2999].as_py()] == [3000, want, None, []]


def test_rules_fetch_nodes_by_place():
    """No rule unpacks the whole page for each element it picks, nor ends a search by throwing."""
    for layout, (rules, _) in extract.LAYOUTS.items():
        for r in rules.values():
            sql = M._picked("_nodes", "_elements", r)
            assert "slice(_nodes" not in sql and "slice(_elements" not in sql and " IN (" not in sql, layout


def test_attribute_forms(spark):
    source = "<p A=\"'x'\" b = '\"y\"' c\n=\tz=1 d e=\"\" f='a&amp;b &lt;' g=&amp;>t</p>"
    row = spark.createDataFrame([(source,)], "html string").select(F.get(M.tokens(F.col("html")), F.lit(0))["attrs"].alias("a")).first()
    assert [tuple(a) for a in row.a] == [
        ("a", "'x'"), ("b", '"y"'), ("c", "z=1"), ("d", ""), ("e", ""), ("f", "a&b <"), ("g", "&"),
    ]
