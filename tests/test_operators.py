import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from pricetide import schema as S
from pricetide.operators import audit, breaker, links, position, records
from pricetide.operators import specs as spec_ops


def pending_plain(outcomes, limit=3, overlap=0):
    """Sequential rule: stop at the first streak of ``limit``; neutral keeps its place but changes nothing."""
    streak = 0
    for at, outcome in enumerate(outcomes, 1):
        if outcome == "fail":
            streak += 1
            if streak >= limit:
                return list(range(max(1, at - limit - overlap + 1), len(outcomes) + 1)), at
        elif outcome == "ok":
            streak = 0
    return [], None


def log_rows(spark, shards):
    rows = [(s, i, o) for s, outs in shards.items() for i, o in enumerate(outs, 1)]
    return spark.createDataFrame(rows, "shard string, idx bigint, outcome string")


@pytest.mark.parametrize("block_rows", [1, 2, 3, 5, 1000])
@pytest.mark.parametrize("overlap", [0, 1])
def test_breaker_against_plain(spark, block_rows, overlap):
    rnd = random.Random(block_rows * 10 + overlap)
    shards = {f"r{i}": rnd.choices(["ok", "fail", "neutral"], [3, 4, 2], k=rnd.randint(1, 25)) for i in range(60)}
    code = {"1": "ok", "0": "fail", "n": "neutral"}
    shards["golden"] = [code[c] for c in "100100010"]
    shards["neutral"] = [code[c] for c in "0n0n01"]
    shards["never"] = ["ok"] * 9
    shards["all"] = ["fail"] * 11
    got = breaker.pending_links(log_rows(spark, shards), ["shard"], overlap=overlap, block_rows=block_rows).collect()
    for name, outs in shards.items():
        want, stop = pending_plain(outs, 3, overlap)
        rows = [r for r in got if r.shard == name]
        assert sorted(r.idx for r in rows) == want, (name, outs)
        assert all(r.stop_idx == stop for r in rows)


def test_breaker_on_range_parts(spark):
    rnd = random.Random(5)
    shards = {"hot": rnd.choices(["ok", "fail", "neutral"], [6, 2, 2], k=4000), "cold": ["fail"] * 5}
    log = log_rows(spark, shards).withColumnRenamed("idx", "at").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = position.with_position(log, ["at"], ["shard"], part="part")
        assert placed.filter("shard = 'hot'").select("part").distinct().count() > 1
        got = breaker.pending_links(placed, ["shard"], block="part").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name, outs in shards.items():
        assert sorted(r.idx for r in got if r.shard == name) == pending_plain(outs)[0]


def test_breaker_golden(spark):
    code = {"1": "ok", "0": "fail", "n": "neutral"}
    shards = {"a": [code[c] for c in "100100010"], "b": [code[c] for c in "0n0n01"]}
    got = breaker.pending_links(log_rows(spark, shards), ["shard"]).orderBy("shard", "idx").collect()
    assert [(r.shard, r.idx) for r in got] == [("a", i) for i in range(5, 10)] + [("b", i) for i in range(3, 7)]


def test_runnable_shards(spark):
    shards = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1)], "store string, chunk int")
    pending = spark.createDataFrame([("x", 2), ("x", 2)], "store string, chunk int")
    keys = ["store", "chunk"]
    assert [tuple(r) for r in breaker.runnable_shards(shards, pending, keys).collect()] == [("x", 2)]
    assert breaker.runnable_shards(shards, pending.limit(0), keys).count() == 3


@pytest.mark.parametrize("total", [1, 3, 4, 7, 20])
def test_chunks_against_slices(spark, total):
    urls = [f"https://h/{i * 37 % 101:03d}-é" for i in range(10)]
    df = spark.createDataFrame([(u,) for u in urls * 2 + [None]], "url string").repartition(5)
    got = position.assign_chunks(df, "url", total).orderBy("idx").collect()
    ordered = sorted(set(urls))
    size = math.ceil(len(ordered) / total)
    want = [(u, i + 1, i // size + 1, i % size + 1) for i, u in enumerate(ordered)]
    assert [tuple(r) for r in got] == want


def test_position_spreads_a_hot_group(spark):
    """Two thirds of the rows are in one group; it is cut over several range partitions."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(7)).alias("g"), ((F.col("id") * 7919) % 30000).alias("k")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = position.with_position(rows, ["k"], ["g"]).toPandas().sort_values(["g", "k"])
        parts = rows.repartitionByRange("g", "k").filter("g = 7").select(F.spark_partition_id().alias("p")).distinct()
        assert parts.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert (got.idx == got.groupby("g").cumcount() + 1).all()
    assert (got.n_total == got.groupby("g").k.transform("size")).all()


def test_position_null_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "g string, k int")
    got = {(r.g, r.k): (r.idx, r.n_total) for r in position.with_position(df, ["k"], ["g"]).collect()}
    assert got == {(None, 1): (1, 2), (None, 2): (2, 2), ("a", 5): (1, 1)}


def test_shuffled_is_independent_of_partitions(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("url"))
    one = [r.url for r in position.shuffled(df.repartition(1), "url", "s").collect()]
    many = [r.url for r in position.shuffled(df.repartition(7), "url", "s").collect()]
    other = [r.url for r in position.shuffled(df, "url", "t").collect()]
    assert one == many != other and sorted(one) == sorted(other)


def test_keep_first(spark):
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)]
    df = spark.createDataFrame(rows, "pos int, url string").repartition(3)
    first = links.keep_first(df, ["url"], ["pos"])
    assert sorted(r.pos for r in first.collect()) == [1, 2, 4]
    assert sorted(map(tuple, links.keep_first(first, ["url"], ["pos"]).collect())) == sorted(map(tuple, first.collect()))


def test_keep_first_limits_before_the_shuffle(spark):
    """A key that holds most rows sends at most one row per task."""
    rows = spark.createDataFrame([(i, "hot" if i % 3 else str(i)) for i in range(100)], "id int, k string")
    plan = links.keep_first(rows, ["k"], ["id"])
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert len(limits) == 2 and limits[0] < exchange < limits[1]


def test_periods(spark):
    names = ["sitemap-product-2026-9", "sitemap-product-2026-8", "sitemap-product-2027-1?page=1", "sitemap-other", None]
    df = spark.createDataFrame([(n,) for n in names], "loc string")
    kept = {r.loc for r in links.prune_periods(df, dt.date(2026, 12, 1)).collect()}
    assert kept == {names[0], names[2]}
    # Months back are clipped to the month's end.
    assert links.prune_periods(
        spark.createDataFrame([("sitemap-product-2026-02",)], "loc string"), dt.date(2026, 5, 31)
    ).count() == 1


def test_url_rules(spark):
    good = "https://f/may-tinh-xach-tay/lenovo-loq-15arp10e-ryzen"
    urls = [good, good.replace("may-tinh-xach-tay", "x"), "https://f/may-tinh-xach-tay/short-one", good + "/linh-kien",
            "https://f/may-tinh-xach-tay/abcdefghijklmnopqrstuvwxyz", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.url for r in links.filter_urls(df, "fptshop").collect()] == [good]
    df = spark.createDataFrame([("/Products/LAPTOP-a",), ("/laptop/x",), ("/may-tinh-xach-tay/x",)], "url string")
    assert [r.url for r in links.filter_urls(df, "gearvn").collect()] == ["/Products/LAPTOP-a"]
    assert [r.url for r in links.filter_urls(df, "tgdd").collect()] == ["/laptop/x"]
    assert len(links.filter_urls(df, "fptshop_anchor").collect()) == 2


def test_lastmod_and_guard(spark):
    entries = spark.createDataFrame([("a", "1", 0), ("a", "2", 1), ("b", "3", 2)], "url string, lastmod string, pos int")
    records_ = spark.createDataFrame([("a",), ("c",), ("a",)], "url string")
    got = links.attach_lastmod(records_, links.last_value_by_url(entries)).collect()
    assert sorted(map(tuple, got)) == [("a", "2"), ("a", "2"), ("c", "")]
    with pytest.raises(ValueError):
        links.require_rows(records_.limit(0), "links")


MEMBERS = [("P1", "n1", "x", 1), ("P1", "n2", "x", 2), ("P1", "n3", "y", 3), ("P2", "n4", "y", 4), ("P2", "n5", "z", 5)]


def test_overlap(spark):
    members = spark.createDataFrame(MEMBERS, "page_name string, name string, link string, seq int")
    rows = audit.overlap_links(members).orderBy("link", "page_name").collect()
    assert [(r.link, r.first_name, r.n, r.page_name, r.n_in_page) for r in rows] == [
        ("x", "n1", 2, "P1", 2), ("y", "n3", 2, "P1", 1), ("y", "n3", 2, "P2", 1),
    ]
    pages = {r.page_name: (r.n_rows, r.n_unique, r.n_shared) for r in audit.overlap_by_page(members).collect()}
    assert pages == {"P1": (3, 0, 3), "P2": (2, 1, 1)}
    counts = audit.link_counts(members).first()
    assert (counts.n_links, counts.n_unique) == (5, 3)


def test_store_report(spark):
    catalog = spark.createDataFrame([("tgdd",)] * 3 + [("gearvn",)], "store string")
    present = spark.createDataFrame([("tgdd",), ("gearvn",), ("phongvu",)], "store string")
    report = audit.store_report(catalog, S.registry(spark), present)
    got = {r.sheet_name: (r.status, r.n_rows) for r in report.collect()}
    assert got == {"TGDĐ": ("ok", 3), "GearVN": ("ok", 1), "PhongVu": ("empty", 0), "FPTShop": ("missing", 0),
                   "CellphoneS": ("missing", 0), "TOTAL": ("total", 4)}
    lines = [r.value for r in audit.report_lines(report).collect()]
    assert lines[-1] == "Tổng cộng: 4 sản phẩm" and "TGDĐ: 3 sản phẩm" in lines


def test_price_columns():
    assert records.price_columns([S.NAME, S.PRICE, S.LIST_PRICE, S.DISCOUNT, "Giá Khuyến Mãi"]) == [S.PRICE, S.LIST_PRICE]
    assert records.key_column([S.LINK, S.URL]) == S.URL and records.key_column([S.LINK]) == S.LINK
    assert records.key_column(["x"]) is None


def test_merge_shop(spark):
    rows = [("a", "19.990.000₫", "N/A", 1), ("a", "1", "2", 2), ("b", "Liên hệ", "", 3)]
    df = spark.createDataFrame(rows, f"`{S.URL}` string, `{S.PRICE}` string, `{S.LIST_PRICE}` string, pos int")
    got = records.merge_shop(df, ["pos"]).orderBy("pos").collect()
    assert [(r[S.URL], r[S.PRICE], r[f"{S.PRICE} (ghi chú)"], r[S.LIST_PRICE]) for r in got] == [
        ("a", 19990000, None, None), ("b", None, "Liên hệ", None),
    ]


def test_topic_sheets(spark):
    rows = [("The Gioi Di Dong", "1.000₫", "2.000₫", "x"), ("GearVN", "1.000đ", "2.000đ", "-9%")]
    df = spark.createDataFrame(rows, f"store string, `{S.PRICE}` string, `{S.LIST_PRICE}` string, `{S.DISCOUNT}` string")
    fixed = {r.store: r[S.DISCOUNT] for r in records.topic_repair_discount(df, "The Gioi Di Dong").collect()}
    assert fixed == {"The Gioi Di Dong": "-50%", "GearVN": "-9%"}
    numbers = records.topic_numbers(df)
    assert S.DISCOUNT not in numbers.columns and {r[S.PRICE] for r in numbers.collect()} == {1000.0}
    assert {r[S.LIST_PRICE] for r in records.topic_clean_text(df).collect()} == {"2.000"}


def test_sheet_text(spark):
    df = spark.createDataFrame([(1, None), (None, None), (None, ""), (None, "x")], "a int, b string")
    assert sorted(map(tuple, records.sheet_text(df).collect())) == [("", "x"), ("1", "")]


@pytest.mark.parametrize("keep", ["first", "last"])
def test_spec_rows(spark, keep):
    rows = [("r", p, k, v) for p, (k, v) in enumerate([("a", "1"), ("b", "2"), ("a", "3")])]
    df = spark.createDataFrame(rows, "r string, pos int, key string, value string")
    got = {r.key: (r.key_pos, r.value, r.n_values) for r in spec_ops.spec_rows(df, ["r"], keep).collect()}
    assert got == {"a": (0, "1" if keep == "first" else "3", 2), "b": (1, "2", 1)}


def test_top_rows(spark):
    df = spark.createDataFrame([(i,) for i in itertools.chain(range(9), range(3))], "v int")
    got = position.top_rows(df.distinct(), [F.desc("v")], 3).orderBy("idx").collect()
    assert [(r.v, r.idx) for r in got] == [(8, 1), (7, 2), (6, 3)]


def test_keep_first_sorts_by_a_number(spark):
    rows = [("u2", None, 2), ("u1", "x", 5), ("u2", None, 1), ("u1", "x", 4), (None, None, 9), (None, None, 8), ("u1", None, 7), ("u1", None, 7)]
    df = spark.createDataFrame(rows, "url string, store string, at int")
    first = links.keep_first(df, ["store", "url"], ["at"])
    assert sorted(map(str, first.collect())) == sorted(
        map(str, [r for r in df.distinct().collect() if (r.url, r.at) in {("u2", 1), ("u1", 4), (None, 8), ("u1", 7)}])
    )
    assert first.columns == df.columns
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Sort [_key_hash" in plan and "Sort [store" not in plan
