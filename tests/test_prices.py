"""Golden rows of the price and discount rules, and a grid against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from pricetide.functions import prices

DISCOUNTS = [
    ("19.990.000₫", "24.990.000₫", "", "-20%"),
    ("24.990.000đ", "24.990.000đ", "15%", "-15%"),
    ("Liên hệ", "24.990.000đ", "-15%", ""),
    ("19.990.000đ", "LIÊN HỆ", "-15%", ""),
    ("5.000.000", "24.990.000", "-80%", "-80%"),
    ("5.000.000", "24.990.000", "", ""),
    ("300", "1.000", "1%", "-70%"),
    ("290", "1.000", "1%", "-1%"),
    ("875", "1000", "x", "-12%"),
    ("375", "1.000", "", "-62%"),
    ("999.999", "1.000.000", "5%", "-0%"),
    ("0", "100", "9%", "-9%"),
    ("", "24.990.000₫", "Giảm 5%", "-Giảm 5%"),
    ("N/A", "N/A", "", ""),
    (None, "1.000", " 7% ", "-7%"),
    (None, None, None, ""),
]


def column(spark, values, schema="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")


def run(df, expr):
    return [r.out for r in df.orderBy("i").select(expr.alias("out")).collect()]


def test_discount_golden(spark):
    rows = [(i, *d) for i, d in enumerate(DISCOUNTS)]
    df = spark.createDataFrame(rows, "i int, c string, o string, s string, want string")
    out = df.select("want", prices.discount_text(F.col("c"), F.col("o"), F.col("s")).alias("got"), "c", "o", "s").collect()
    assert [r for r in out if r.want != r.got] == []


def test_discount_grid(spark):
    def plain(c, o):
        p = round((o - c) / o * 100) if o > c > 0 else None
        return f"-{p}%" if p is not None and p <= 70 else ""

    pairs = [(c, o) for c in range(0, 400) for o in range(1, 400, 3)]
    df = spark.createDataFrame(pairs, "c int, o int").select(
        "c", "o", prices.discount_text(F.col("c").cast("string"), F.col("o").cast("string")).alias("got")
    )
    assert [r for r in df.collect() if r.got != plain(r.c, r.o)] == []


def test_clean_price(spark):
    cells = ["19.990.000₫", "19,990,000 đ *", "Liên hệ", None, "１９９"]
    df = column(spark, cells)
    assert run(df, prices.price(F.col("v"))) == [19990000, 19990000, None, None, 199]
    assert run(df, prices.price_note(F.col("v"))) == [None, None, "Liên hệ", None, None]


def test_final_number(spark):
    cells = ["19.990.000₫", "19,990,000 đ *", "Liên hệ", None, "nan", " 12 000", "1d", "1e3", ""]
    want = [19990000.0, 19990000.0, None, None, None, None, None, 1000.0, None]
    assert run(column(spark, cells), prices.final_number(F.col("v"))) == want


def test_strip_currency(spark):
    assert run(column(spark, ["19.990.000 ₫", "5Đ", None, "nan"]), prices.strip_currency(F.col("v"))) == [
        "19.990.000", "5", "", "",
    ]


def test_validity(spark):
    df = column(spark, ["99.999₫", "+1.722", "100.000", "999₫", "Liên hệ 0123456", None])
    assert run(df, prices.valid_price_a(F.col("v"))) == [False, False, True, False, False, False]
    assert run(df, prices.valid_price_b(F.col("v"))) == [True, False, True, False, True, False]
    assert run(df, prices.checked_current_a(F.col("v"))) == [
        "99.999₫", "+1.722", "100.000", "999₫", "Liên hệ", None,
    ]
    assert run(df, prices.checked_original_a(F.col("v"))) == ["", "", "100.000", "", "", ""]
    assert run(df, prices.checked_b(F.col("v"))) == ["99.999₫", "", "100.000", "", "Liên hệ 0123456", ""]


def test_repair(spark):
    rows = [("19.990.000₫", "24.990.000₫", "-20%"), ("0", "100", "-100%"), ("100", "100", ""), ("x", "1", ""),
            (None, "5", ""), ("1", "0", ""), ("875", "1000", "-12%"), ("1đ", "9", "")]
    df = spark.createDataFrame(rows, "c string, o string, want string")
    out = df.select("want", prices.repaired_discount(F.col("c"), F.col("o")).alias("got"), "c", "o").collect()
    assert [r for r in out if r.want != r.got] == []


def test_vnd_text(spark):
    df = column(spark, [0, 999, 1000, 19990000], "bigint")
    assert run(df, prices.vnd_text(F.col("v"))) == ["0đ", "999đ", "1.000đ", "19.990.000đ"]


def test_structured_fallback(spark):
    rows = [("", "", "19990000", "24990000"), ("", "9đ", "19990000", "24990000"), ("1đ", "", "2", "3"),
            ("", "", "abc", None), ("", "", "19990000.0", "0")]
    df = spark.createDataFrame(rows, "c string, o string, p string, l string")
    cur, orig = prices.with_structured_fallback(F.col("c"), F.col("o"), F.col("p"), F.col("l"))
    got = [tuple(r) for r in df.select(cur, orig).collect()]
    assert got == [("19.990.000đ", "24.990.000đ"), ("19.990.000đ", "9đ"), ("1đ", ""), ("", ""), ("19.990.000đ", "")]


def test_stock(spark):
    df = column(spark, [" tạm hết hàng ", "Sắp về hàng!", "Mua ngay", None])
    assert run(df, prices.stock_flag(F.col("v"))) == ["TẠM HẾT HÀNG", "SẮP VỀ HÀNG!", "", ""]


@pytest.mark.parametrize("seed", [1, 2])
def test_digits_random(spark, seed):
    import random

    rnd = random.Random(seed)
    cells = ["".join(rnd.choice("0123456789.,₫đ -xLiên") for _ in range(rnd.randint(0, 15))) for _ in range(300)]
    want = [int(d) if (d := re.sub(r"[^\d]", "", c)) else None for c in cells]
    assert run(column(spark, cells), prices.digits(F.col("v"))) == want


def test_numbers_pass_through(spark):
    df = spark.sql("SELECT 19990000.0D a, 19990000 b, CAST(19990000 AS DECIMAL(12,2)) c, CAST('NaN' AS DOUBLE) n, '19.990.000₫' t")
    for c in "abc":
        row = df.select(
            prices.final_number(F.col(c)), prices.repair_number(F.col(c)), prices.plain_number_text(F.col(c)),
            prices.price(F.col(c)), prices.price_note(F.col(c)), prices.strip_currency(F.col(c)), prices.valid_price_a(F.col(c)),
        ).first()
        assert tuple(row) == (19990000.0, 19990000.0, 19990000.0, 19990000, None, "19990000", True)
    assert tuple(df.select(prices.final_number(F.col("n")), prices.price(F.col("n")), prices.strip_currency(F.col("n"))).first()) == (None, None, "")
    assert df.select(prices.price(F.col("t"))).first()[0] == 19990000


def test_digits_of_every_plane(spark):
    wide = "".join(chr(0x1D7CE + int(d)) for d in "19") + "٩" + ".000₫"
    assert spark.createDataFrame([(wide,)], "p string").select(prices.price(F.col("p"))).first()[0] == 199000


def test_topic_steps_chain(spark):
    from pricetide import schema as S
    from pricetide.operators import records

    rows = spark.createDataFrame([("tgdd", "19.990.000₫", "24.990.000₫"), ("tgdd", "Liên hệ", None)], ["store", S.PRICE, S.LIST_PRICE])
    numbers = records.topic_numbers(rows)
    fixed = records.topic_repair_discount(numbers)
    assert [(r[S.PRICE], r[S.DISCOUNT]) for r in fixed.collect()] == [(19990000.0, "-20%"), (None, "")]
    assert [r[S.PRICE] for r in records.topic_clean_text(fixed).collect()] == ["19990000", ""]


def test_plain_cells_need_no_regular_expression(spark):
    cells = ["19.990.000đ", "1,5", "đ", ".,₫", "", None, "12 34", "-5", "+7", "٣.000đ", "1.0٣0", "Liên hệ 9", "9" * 18, "9" * 19, "9" * 30, "0", "007", "Đ5", "१२"]
    df = spark.createDataFrame([(c,) for c in cells], "v string")
    rows = df.select("v", prices.digits(F.col("v")).alias("n"), prices.digit_text(F.col("v")).alias("t")).collect()
    for r in rows:
        text = "".join(str(int(ch)) for ch in r.v or "" if ch.isdecimal())
        assert r.t == text
        assert r.n == (int(text) if text and int(text) < 2**63 else None)
    # The plain cell is told before any expression that matches a pattern.
    plan = df.select(prices.digits(F.col("v")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("ltrim(") < plan.index("regexp_replace(")
