"""Sources, sinks, compaction and the append stream on temporary folders."""

import datetime as dt
import glob
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pricetide import schema as S
from pricetide.operators import audit, links, records
from pricetide.plans import jobs
from pricetide.session import drop_staged, stage_path
from pricetide.sinks import tables as sink
from pricetide.sinks import text as text_sink
from pricetide.sources import files, listings, sitemaps
from pricetide.sources import tables as source
from pricetide.streaming import append, quarantine
from pricetide.streaming.first import first_per_key

NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'


def put(path, content):
    os.makedirs(os.path.dirname(str(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content)
    return str(path)


def entry(loc, lastmod=None):
    return f"<url><loc>{loc}</loc>" + (f"<lastmod>{lastmod}</lastmod>" if lastmod else "") + "</url>"


def test_sitemap_first_wins_in_list_order(spark, tmp_path):
    one = put(tmp_path / "s_2.xml", f"<urlset {NS}>{entry('h/Products/Laptop-a', '1')}{entry('h/chuot')}</urlset>")
    two = put(
        tmp_path / "s_1.xml",
        f"<urlset {NS}>{entry('h/Products/Laptop-a', '2')}{entry('h/products/laptop-b')}{entry('h/products/laptop-b', '9')}</urlset>",
    )
    got = sitemaps.sitemap_links(sitemaps.read_sitemap(spark, [one, two]), "gearvn").collect()
    assert sorted(map(tuple, got)) == [("h/Products/Laptop-a", "1"), ("h/products/laptop-b", "")]
    got = sitemaps.sitemap_links(sitemaps.read_sitemap(spark, [two, one]), "gearvn").collect()
    assert ("h/Products/Laptop-a", "2") in map(tuple, got)


def test_sitemap_index(spark, tmp_path):
    locs = [f"https://s/sitemap-product-{p}?page=1" for p in ("2026-9", "2026-8", "2027-1")] + ["https://s/other", ""]
    body = "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in locs)
    path = put(tmp_path / "index.xml", f"<sitemapindex {NS}>{body}</sitemapindex>")
    index = sitemaps.read_sitemap_index(spark, [path])
    assert index.count() == 4
    assert {r.loc for r in sitemaps.recent_sitemaps(index, dt.date(2026, 12, 1)).collect()} == {locs[0], locs[2]}


def test_raw_sitemap_and_fallback(spark, tmp_path):
    good = "https://f/may-tinh-xach-tay/lenovo-loq-15arp10e-ryzen"
    strict = put(tmp_path / "a.xml", f"<loc>{good}</loc><loc x>{good}-2</loc><loc>https://f/x</loc>")
    loose = put(tmp_path / "b.xml", f"<LOC x='1'>\n {good}-3 \n</LOC>")
    assert {r.url for r in sitemaps.read_raw_sitemap(spark, [strict, loose]).collect()} == {good, good + "-3"}


def test_link_files(spark, tmp_path):
    path = put(tmp_path / "l.txt", " u2\t2026 \n\n  \nu1\nu2\t2027\nu3\t\n")
    df = files.read_links(spark, path)
    assert [(r.url, r.lastmod) for r in df.orderBy("file", "block", "pos").collect()] == [
        ("u2", "2026"), ("u1", ""), ("u2", "2027"), ("u3", ""),
    ]
    assert {tuple(r) for r in files.link_lastmods(df).collect()} == {("u1", ""), ("u2", "2027"), ("u3", "")}
    out = str(tmp_path / "out")
    text_sink.write_links(files.link_lastmods(df), out)
    lines = [line for f in sorted(glob.glob(out + "/part-*")) for line in open(f, encoding="utf-8").read().splitlines()]
    assert lines == ["u1\t", "u2\t2027", "u3\t"]
    text_sink.write_links(df.select("url").distinct(), out, with_lastmod=False)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["u1", "u2", "u3"]


def test_listing_stops_at_first_empty_page(spark, tmp_path):
    def page(listing, n, *names):
        body = json.dumps({"data": {"products": [{"canonical": c} for c in names]}})
        return json.dumps({"listing": listing, "page": n, "body": body})

    lines = [
        page("a", 1, "x", None, ""), page("a", 2, "y"), page("a", 3), page("a", 4, "late"), page("b", 1, "z"),
        json.dumps({"listing": "b", "page": 2, "body": "<html>"}), page("b", 3, "late"), page("c", 1, "w"),
        json.dumps({"listing": "c", "page": 2, "body": '{"data": null}'}),
    ]
    responses = listings.read_listing(spark, put(tmp_path / "r.json", "\n".join(lines)))
    got = listings.listing_links(responses, "https://h", ["listing"]).collect()
    assert {r.url for r in got} == {"https://h/x", "https://h/y", "https://h/z", "https://h/w"}


def test_whole_page_files(spark, tmp_path):
    put(tmp_path / "p1.html", "<h1>a</h1>\n<p>b</p>\n")
    put(tmp_path / "p2.html", "<h1>c</h1>")
    got = {os.path.basename(r.url): r.html for r in files.read_page_files(spark, str(tmp_path)).collect()}
    assert got == {"p1.html": "<h1>a</h1>\n<p>b</p>\n", "p2.html": "<h1>c</h1>"}


def shard(spark, store, chunk, run, urls, price="1.000.000₫"):
    shop = S.SHOPS[store]
    cells = {h: F.lit("") for h in shop.headers}
    cells |= {S.NAME: F.concat(F.lit(f"{run} "), "u"), S.PRICE: F.lit(price), S.LIST_PRICE: F.lit("N/A")}
    key = S.URL if S.URL in shop.headers else S.LINK
    cells[key] = F.col("u")
    df = spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1)
    return df.select(
        *[cells[h].alias(h) for h in shop.headers],
        F.lit(store).alias("store"),
        F.lit(chunk).alias("chunk"),
        F.lit(run).alias("run"),
    )


def test_whole_shards_are_read_from_their_files(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    sink.write_shard(shard(spark, "tgdd", 1, "r1", ["a", "b"]), bronze)
    sink.write_shard(shard(spark, "tgdd", 2, "r1", ["c"]), bronze)
    rows, found = source.checked_shards(spark, bronze)
    assert [(r.rows, r.error) for r in found.orderBy("rows").collect()] == [(1, None), (2, None)]
    assert {os.path.basename(f) for f in rows.inputFiles()} >= {os.path.basename(f) for f in glob.glob(f"{bronze}/*/*/*/*.parquet")}
    assert sorted((r[S.LINK], r.chunk, r._row) for r in rows.collect()) == [("a", 1, 0), ("b", 1, 1), ("c", 2, 0)]
    # A file that comes later is not among those that were judged; one that breaks later is never read in part.
    late = glob.glob(f"{bronze}/store=tgdd/chunk=2/run=r1/*.parquet")[0]
    with open(late, "r+b") as f:
        f.truncate(os.path.getsize(late) // 2)
    for side in glob.glob(f"{bronze}/store=tgdd/chunk=2/run=r1/.*.crc"):
        os.remove(side)
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        rows.collect()
    rows, found = source.checked_shards(spark, bronze)
    assert found.where("error IS NOT NULL").count() == 1
    assert not any(f.startswith(f"file://{bronze}") for f in rows.inputFiles())  # staged as decoded
    assert sorted(r[S.LINK] for r in rows.collect()) == ["a", "b"]


def test_shards_merge_publish(spark, tmp_path):
    bronze, silver, catalog = (str(tmp_path / d) for d in ("bronze", "silver", "catalog"))
    sink.write_shard(shard(spark, "tgdd", 1, "r1", ["a", "b"]), bronze)
    sink.write_shard(shard(spark, "tgdd", 2, "r1", ["b", "c"]), bronze)
    sink.write_shard(shard(spark, "phongvu", 1, "r1", ["a"], price="Liên hệ"), bronze)
    sink.write_shard(shard(spark, "tgdd", 2, "r1", ["b", "c"]), bronze)  # a repeated run replaces itself
    assert source.read_shards(spark, bronze).count() == 5
    assert source.read_shards(spark, bronze, "tgdd").columns[: len(S.SHOPS["tgdd"].headers)] == list(S.SHOPS["tgdd"].headers)

    report = {r.sheet_name: (r.status, r.n_rows) for r in jobs.merge_and_publish(spark, bronze, silver, catalog).collect()}
    assert report["TGDĐ"] == ("ok", 3) and report["PhongVu"] == ("ok", 1) and report["TOTAL"] == ("total", 4)
    table = source.read_workbook(spark, silver, S.SILVER)
    assert {(r.store, r.url, r.price, r.price_note, r.list_price) for r in table.collect()} == {
        ("tgdd", "a", 1000000, None, None), ("tgdd", "b", 1000000, None, None), ("tgdd", "c", 1000000, None, None),
        ("phongvu", "a", None, "Liên hệ", None),
    }
    jobs.merge_and_publish(spark, bronze, silver, catalog)
    assert spark.read.parquet(catalog).count() == 8  # publishing appends
    table = source.read_workbook(spark, silver, S.SILVER)
    sink.write_catalog(table.filter("store = 'phongvu'"), catalog, clear=True)
    assert sorted(r.store for r in spark.read.parquet(catalog).collect()) == ["phongvu", *["tgdd"] * 6]  # the other shop stays
    sink.write_catalog(table, catalog, clear=True)
    assert spark.read.parquet(catalog).count() == 4
    with pytest.raises(ValueError):
        sink.write_catalog(table.limit(0), catalog)


def test_compact_keeps_unreadable(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    sink.write_shard(shard(spark, "gearvn", 1, "r1", ["a", "b"]), bronze)
    sink.write_shard(shard(spark, "gearvn", 2, "r1", ["b"]), bronze)
    sink.write_shard(shard(spark, "tgdd", 1, "r1", ["z"]), bronze)
    broken = put(f"{bronze}/store=gearvn/chunk=3/run=r1/part-0.parquet", "not parquet")
    found = sink.compact(spark, bronze, lambda df: records.merge_shards(df, source.SHARD_ORDER), silver, "gearvn").collect()
    assert sorted((r.rows, r.error is None) for r in found) == [(0, False), (1, True), (2, True)] and os.path.exists(broken)
    assert glob.glob(f"{bronze}/store=gearvn/chunk=*/run=r1/part-*.parquet") == [broken]
    assert glob.glob(f"{bronze}/store=tgdd/chunk=1/run=r1/part-*.parquet")
    assert sorted(r.url for r in spark.read.parquet(silver).collect()) == ["a", "b"]


def half_damaged(path, rows=4000):
    """A shard of four row groups whose last one is overwritten."""
    names = [*S.SHOPS["gearvn"].headers]
    cells = pa.table({n: [f"{n} {i} {i * 7919}" for i in range(rows)] for n in names})
    os.makedirs(os.path.dirname(path))
    pq.write_table(cells, path, row_group_size=rows // 4, compression="none", use_dictionary=False)
    at = pq.ParquetFile(path).metadata.row_group(3).column(0).data_page_offset
    with open(path, "r+b") as f:
        f.seek(at)
        f.write(b"\xff" * 4000)


def test_half_readable_shard_is_kept_and_listed(spark, tmp_path):
    bronze, silver, catalog, bad = (str(tmp_path / d) for d in ("bronze", "silver", "catalog", "bad"))
    sink.write_shard(shard(spark, "gearvn", 1, "r1", ["a", "b"]), bronze)
    broken = f"{bronze}/store=gearvn/chunk=2/run=r1/part-0.parquet"
    half_damaged(broken)
    assert source.read_shards(spark, bronze, "gearvn").count() == 2  # whole files only
    report = jobs.merge_and_publish(spark, bronze, silver, catalog, tidy=True, unreadable=bad)
    assert {(r.sheet_name, r.n_rows) for r in report.collect()} >= {("GearVN", 2)}
    listed = spark.read.parquet(bad).collect()
    assert [r.file.endswith("chunk=2/run=r1/part-0.parquet") for r in listed] == [True] and listed[0].error
    assert glob.glob(f"{bronze}/store=gearvn/chunk=*/run=r1/part-*.parquet") == [broken]  # merged ones went, this stays
    with pytest.raises(ValueError):
        jobs.merge_and_publish(spark, bronze, str(tmp_path / "s2"), str(tmp_path / "c2"), tidy=True)
    assert os.path.exists(broken)


def test_files_of_every_kind_are_judged(spark, tmp_path):
    bronze = str(tmp_path / "a b")
    sink.write_shard(shard(spark, "tgdd", 1, "2026-07-01 10:00", ["a", "b"]), bronze)
    good = glob.glob(f"{bronze}/store=tgdd/chunk=1/*/part-*.parquet")[0]
    with open(good, "rb") as f:
        whole = f.read()
    cut = f"{bronze}/store=tgdd/chunk=2/run=r/part-0.parquet"
    os.makedirs(os.path.dirname(cut))
    with open(cut, "wb") as f:
        f.write(whole[: len(whole) // 2])
    none = f"{bronze}/store=tgdd/chunk=3/run=r/part-0.parquet"
    os.makedirs(os.path.dirname(none))
    pq.write_table(pa.table({S.NAME: pa.array([], pa.string())}), none)
    put(f"{bronze}/store=tgdd/chunk=1/notes.txt", "x")
    rows, found = source.checked_shards(spark, bronze)
    assert sorted(r[S.LINK] for r in rows.collect()) == ["a", "b"] and {r.run for r in rows.collect()} == {"2026-07-01 10:00"}
    judged = {os.path.basename(os.path.dirname(os.path.dirname(r.file))): (r.rows, r.error) for r in found.collect()}
    assert judged == {"chunk=1": (2, None), "chunk=2": (0, "no footer with rows"), "chunk=3": (0, "no footer with rows")}
    assert source.read_shards(spark, str(tmp_path / "nothing")).count() == 0
    assert source.shard_files(spark, str(tmp_path / "nothing")).columns == found.columns


def test_a_file_changed_since_it_was_read_is_not_removed(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    sink.write_shard(shard(spark, "tgdd", 1, "r1", ["a"]), bronze)
    sink.write_shard(shard(spark, "tgdd", 2, "r:2", ["b"]), bronze)
    found = source.shard_files(spark, bronze)
    changed = glob.glob(f"{bronze}/store=tgdd/chunk=1/*/part-*.parquet")[0]
    os.utime(changed, (1, 1))
    sink.remove_merged(found)
    sink.remove_merged(found)  # done again after a failure: what is gone stays gone
    assert glob.glob(f"{bronze}/store=tgdd/chunk=*/*/part-*.parquet") == [changed]


def test_workbook_steps(spark, tmp_path):
    root, path = str(tmp_path / "root"), str(tmp_path / "book")
    assert jobs.build_workbook(spark, root, path) == [s.topic_sheet for s in S.SHOPS.values()] and not os.path.exists(path)
    assert jobs.repair_workbook(spark, root, path) == []
    cells = f"`{S.NAME}` string, `{S.PRICE}` string, `{S.LIST_PRICE}` string, `{S.DISCOUNT}` string"
    texts = [("x", "8.000.000₫", "10.000.000₫", ""), ("y", None, "1đ*", "-9%"), ("z", "5", "5", None)]
    spark.createDataFrame(texts, cells).write.parquet(f"{root}/laptop_rtx3050_tgdd")
    numbers = [("n", 8000000.0, 10000000.0), ("m", None, float("nan"))]
    spark.createDataFrame(numbers, f"`{S.NAME}` string, `{S.PRICE}` double, `{S.LIST_PRICE}` double").write.parquet(f"{root}/laptop_rtx3050_gearvn")

    assert jobs.build_workbook(spark, root, path) == ["FPT Shop", "Phong Vu", "CellphoneS"]
    book = lambda: {r[S.NAME]: r for r in source.read_workbook(spark, path, S.WORKBOOK).collect()}
    first = book()
    assert {n: r[S.PRICE] for n, r in first.items()} == {"x": 8e6, "y": None, "z": 5.0, "n": 8e6, "m": None}
    assert {r[S.DISCOUNT] for r in first.values()} == {None} and first["y"][S.LIST_PRICE] == 1.0
    for _ in range(2):  # a step done again changes nothing
        assert len(jobs.repair_workbook(spark, root, path)) == 2
    assert {n: r[S.DISCOUNT] for n, r in book().items()} == {"x": "-20%", "y": "", "z": "", "n": None, "m": None}
    assert {r[S.NAME]: r[S.DISCOUNT] for r in spark.read.parquet(f"{root}/laptop_rtx3050_tgdd").collect()} == {"x": "-20%", "y": "", "z": ""}
    jobs.clean_workbook(spark, path)
    clean = source.read_workbook(spark, path)
    assert S.DISCOUNT not in clean.columns
    assert {r[S.NAME]: (r[S.PRICE], r[S.LIST_PRICE]) for r in clean.collect()} == {
        "x": ("8000000", "10000000"), "y": ("", "1"), "z": ("5", "5"), "n": ("8000000", "10000000"), "m": ("", ""),
    }


def test_two_streams_share_a_catalog(spark, tmp_path):
    dst = str(tmp_path / "dst")
    for name in ("one", "two", "one"):  # the third has lost its checkpoint
        src = str(tmp_path / name)
        spark.createDataFrame([(name,)], "url string").write.mode("overwrite").parquet(src)
        append.stream_append(append.read_new(spark, src, "url string"), dst, str(tmp_path / f"ckpt{len(glob.glob(dst + '/*'))}"))
    assert sorted(r.url for r in spark.read.parquet(dst).collect()) == ["one", "one", "two"]


def test_sitemaps_with_equal_file_names_keep_the_order_of_paths(spark, tmp_path):
    for folder, day in (("z_first", "1"), ("a_second", "2")):
        put(str(tmp_path / folder / "s.xml"), f"<urlset><url><loc>https://x/products/laptop-1</loc><lastmod>{day}</lastmod></url></urlset>")
    for paths in ([f"{tmp_path}/z_first/s.xml", f"{tmp_path}/a_second/s.xml"], [f"{tmp_path}/z_first", f"{tmp_path}/a_second"]):
        found = sitemaps.sitemap_links(sitemaps.read_sitemap(spark, paths), "gearvn").collect()
        assert [(r.url, r.lastmod) for r in found] == [("https://x/products/laptop-1", "1")]


def test_store_overwrite_and_rewrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("x", 1), ("y", 2)], "store string, v int")
    sink.write_stores(df, path)
    sink.write_stores(df.filter("store = 'x'").withColumn("v", F.lit(5)), path)
    assert sorted((r.store, r.v) for r in spark.read.parquet(path).collect()) == [("x", 5), ("y", 2)]
    sink.rewrite(spark.read.parquet(path).withColumn("v", F.col("v") + 1), path)
    assert sorted((r.store, r.v) for r in spark.read.parquet(path).collect()) == [("x", 6), ("y", 3)]


def test_registered_tables(spark, tmp_path):
    shard(spark, "tgdd", 1, "r", ["a"]).write.parquet(str(tmp_path / "laptop_tgdd_all"))
    names = {s.key: f"laptop_{s.key}_all" for s in S.SHOPS.values()}
    found, missing = source.read_registered(spark, str(tmp_path), names)
    assert list(found) == ["tgdd"] and missing == ["fptshop", "phongvu", "cellphones", "gearvn"]
    report = audit.store_report(records.union_stores(found), S.registry(spark))
    assert {r.status for r in report.collect()} == {"ok", "missing", "total"}


def test_plan_and_resume(spark, tmp_path):
    known = spark.createDataFrame([(f"u{i}", str(i)) for i in range(10)], "url string, lastmod string")
    plan = jobs.plan_shards(known, "tgdd", 4)
    by_chunk = {}
    for r in plan.orderBy("chunk", "idx").collect():
        by_chunk.setdefault(r.chunk, []).append((r.idx, r.url, r.lastmod))
    assert [len(v) for v in by_chunk.values()] == [3, 3, 3, 1] and by_chunk[2][0] == (1, "u3", "3")

    outcome = F.when(F.col("chunk") == 2, "fail").otherwise("ok")
    pending = jobs.after_run(plan.withColumn("outcome", outcome))
    assert sorted(r.url for r in pending.collect()) == ["u3", "u4", "u5"]
    path = str(tmp_path / "pending")
    text_sink.write_pending(pending, path)
    assert os.listdir(path + "/store=tgdd/") == ["chunk=2"]
    again = jobs.plan_shards(known, "tgdd", 4, pending)
    assert sorted((r.chunk, r.url) for r in again.collect()) == [(2, "u3"), (2, "u4"), (2, "u5")]
    assert jobs.plan_shards(known, "gearvn", 4, pending).count() == 0
    with pytest.raises(ValueError):
        jobs.plan_shards(known.limit(0), "tgdd", 4)
    assert source.stage_input(spark, None, known, None) is known
    assert source.stage_input(spark, pending.limit(0), None, lambda: "found") == "found"
    assert source.stage_input(spark, pending, known, None) is pending


def test_shard_tables_job(spark):
    html = "<title>t</title><h1>Laptop</h1><p class='box-price-present'>19.000.000₫</p><p class='box-price-old'>20.000.000₫</p>"
    rows = [
        ("tgdd", 1, "r", "u1", html), ("tgdd", 1, "r", "u2", html.replace("<title>t", "<title>Cloudflare gaming laptop")),
        ("tgdd", 1, "r", "u3", html),
    ]
    pages = spark.createDataFrame(rows, "store string, chunk int, run string, url string, html string").withColumn(
        "captured_at", F.lit("2026-07-01 17:00:00").cast("timestamp")
    )
    lastmods = spark.createDataFrame([("u1", "2026-06-01")], "url string, lastmod string")
    got = jobs.shard_tables(pages, "tgdd", lastmods).orderBy(S.LINK).collect()
    assert [(r[S.LINK], r[S.DISCOUNT], r[S.LASTMOD], r[S.CRAWLED], r.chunk) for r in got] == [
        ("u1", "-5%", "2026-06-01", "2026-07-02 00:00:00", 1), ("u2", "-5%", "", "2026-07-02 00:00:00", 1), ("u3", "-5%", "", "2026-07-02 00:00:00", 1),
    ]


def test_interstitial_pages_of_the_shops_that_show_them(spark):
    rows = [("fptshop", 1, "r", "u1", "<title>Just a moment...</title><h1>x</h1>"), ("fptshop", 1, "r", "u2", "<title>t</title><h1>L</h1>")]
    pages = spark.createDataFrame(rows, "store string, chunk int, run string, url string, html string").withColumn(
        "captured_at", F.lit("2026-07-01 17:00:00").cast("timestamp")
    )
    kept = jobs.shard_tables(pages, "fptshop").collect()
    assert "u1" not in {v for r in kept for v in r if isinstance(v, str)}


def test_topic_job(spark):
    row = "<tr class='gvn-spec-row'><th>{}</th><td>{}</td></tr>"
    page = "<div class='product-info'><div class='product-name'><h1>L</h1></div></div><table id='gvn-specs-container-table'>{}</table>"
    htmls = [page.format(row.format("VGA", v) + row.format("CPU", "i5 3050")) for v in ("RTX 3050", "RTX 4050")]
    pages = spark.createDataFrame(list(enumerate(htmls)), "i int, html string").withColumn("url", F.col("i").cast("string"))
    got = jobs.topic_table(pages, "3050").collect()
    assert [(r[S.LINK], r[S.SPECS]) for r in got] == [("0", "VGA: RTX 3050 | CPU: i5 3050")]


def test_text_dumps(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", "2₫"), (1, "a", "1₫"), (3, "c", "3₫")], f"pos int, `{S.NAME}` string, `{S.PRICE}` string")
    got = [r.value.split("\n")[0] for r in text_sink.sample_lines(df, ["pos"], 2).collect()]
    assert got == ["[1] a", "[2] b"]
    pairs = spark.sql("select array(struct('CPU' key, 'i5' value)) specs")
    text_sink.write_lines(text_sink.pair_lines(pairs), str(tmp_path / "p"))
    assert [r.value for r in spark.read.text(str(tmp_path / "p")).collect()] == ["CPU: i5"]


def test_append_stream(spark, tmp_path):
    src, dst, ckpt = (str(tmp_path / d) for d in ("src", "dst", "ckpt"))
    schema = "url string, at timestamp"

    def arrive(*urls):
        rows = spark.createDataFrame([(u,) for u in urls], "url string")
        rows.withColumn("at", F.lit("2026-07-01").cast("timestamp")).coalesce(1).write.mode("append").parquet(src)

    def run(target, checkpoint, **kw):
        append.stream_append(append.read_new(spark, src, schema), target, checkpoint, **kw)
        return sorted(r.url for r in spark.read.parquet(target).collect())

    arrive("a", "b", "a")
    assert run(dst, ckpt) == ["a", "a", "b"]
    assert run(dst, ckpt) == ["a", "a", "b"]  # nothing new
    arrive("c", "a")
    assert run(dst, ckpt) == ["a", "a", "a", "b", "c"]  # appended, no de-duplication across runs
    unique = run(dst + "2", ckpt + "2", event_time="at", dedup=["url"])
    assert unique == ["a", "b", "c"]
    arrive("c", "d")
    assert run(dst + "2", ckpt + "2", event_time="at", dedup=["url"]) == ["a", "b", "c", "d"]


def test_links_keep_first_over_sources(spark):
    a = spark.createDataFrame([("x", 1)], "url string, pos int")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "url string, pos int")
    assert sorted(map(tuple, links.keep_first(records.union_tables([a, b]), ["url"], ["pos"]).collect())) == [("x", 1), ("y", 3)]


def test_crawl_log_outcomes(spark):
    ok = "<title>t</title><script type='application/ld+json'>{\"@type\":\"Product\",\"name\":\"L\"}</script>"
    htmls = {"u1": ok, "u2": "<title>Just a moment...</title>", "u3": "<title>t</title>", "u4": None, "u5": "<h1>GearVN.com</h1>"}
    pages = spark.createDataFrame(list(htmls.items()), "url string, html string")
    work = spark.createDataFrame([("gearvn", 1, i, f"u{i}", "") for i in range(1, 7)], "store string, chunk int, idx int, url string, lastmod string")
    log = jobs.crawl_log(work, pages, "gearvn")
    assert [r.outcome for r in log.orderBy("idx").collect()] == ["ok", "fail", "neutral", "fail", "fail", "fail"]
    assert sorted(r.url for r in jobs.after_run(log).collect()) == ["u3", "u4", "u5", "u6"]
    assert jobs.crawl_log(work, pages, "tgdd").filter("outcome = 'ok'").count() == 3


def test_drop_staged(spark):
    path = stage_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    drop_staged(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_damaged_files_are_listed_and_delay_nothing(spark, tmp_path):
    src, dst, bad, ckpt = (str(tmp_path / n) for n in ("src", "dst", "bad", "ckpt"))

    def run():
        quarantine.append_files(quarantine.new_files(spark, src, most=2), "url string, n int", dst, bad, ckpt)
        rows = spark.read.parquet(dst).select("url", "n").collect()
        listed = spark.read.parquet(bad).collect() if os.path.isdir(bad) else []
        return sorted(tuple(r) for r in rows), sorted(os.path.basename(r.file) for r in listed)

    frame = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "url string, n int").repartition(3)
    frame.write.parquet(src)
    assert run() == ([("a", 1), ("b", 2), ("c", 3)], [])
    whole = sorted(glob.glob(src + "/*.parquet"))
    with open(whole[0], "rb") as f:
        content = f.read()
    (tmp_path / "src" / "cut.parquet").write_bytes(content[: len(content) // 2])
    (tmp_path / "src" / "none.parquet").write_bytes(b"")
    spark.createDataFrame([("d", 4), ("e", 5)], "url string, n int").repartition(2).write.mode("append").parquet(src)
    want = [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]
    assert run() == (want, ["cut.parquet"])
    assert run() == (want, ["cut.parquet"])


def test_first_per_key_over_runs(spark, tmp_path):
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    schema = "url string, n int"

    def run(rows, expiry=None):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        append.stream_append(first_per_key(append.read_new(spark, src, schema), ["url"], ["n"], expiry), dst, ckpt)
        return sorted((r.url or "", r.n) for r in spark.read.parquet(dst).collect())

    assert run([("a", 2), ("a", 1), ("b", 5), (None, 7)]) == [("", 7), ("a", 1), ("b", 5)]
    assert run([("a", 0), ("c", 1), ("c", 1), (None, 3)]) == [("", 7), ("a", 1), ("b", 5), ("c", 1)]
    assert run([("b", 1), ("d", 9)]) == [("", 7), ("a", 1), ("b", 5), ("c", 1), ("d", 9)]


def test_first_per_key_of_many_keys(spark, tmp_path):
    """Keys and numbers beyond the doubles, nulls among them, more rows than are reduced at once; no call per key."""
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    schema = "k bigint, n bigint, m int"
    big = 2**60
    for run in range(2):
        key = F.when(F.col("id") % 1000 != 0, F.col("id") % 40_000 + big + run * 20_000)
        order = F.when(F.col("id") % 7 != 0, big - F.col("id"))
        rows = spark.range(0, 300_000, 1, 4).select(key.alias("k"), order.alias("n"), (F.col("id") % 11).cast("int").alias("m"))
        rows.write.mode("append").parquet(src)
        append.stream_append(first_per_key(append.read_new(spark, src, schema), ["k"], ["n", "m"]), dst, ckpt)
        if run == 0:
            want = rows.groupBy("k").agg(F.min(F.struct("n", "m")).alias("r"))
        else:
            want = want.unionByName(rows.join(want, rows["k"].eqNullSafe(want["k"]), "left_anti").groupBy("k").agg(F.min(F.struct("n", "m")).alias("r")))
    got = sorted(map(tuple, spark.read.schema(schema).parquet(dst).select(F.coalesce("k", F.lit(-1)), F.coalesce("n", F.lit(-1)), "m").collect()))
    assert got == sorted(map(tuple, want.select(F.coalesce("k", F.lit(-1)), F.coalesce("r.n", F.lit(-1)), "r.m").collect()))
    assert len(got) > 59_000


def test_first_per_key_with_expiry(spark, tmp_path):
    """One batch per run: a state with a timeout asks for batches without end."""
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    schema = "url string, n int"
    for rows in ([("a", 2), ("a", 1), (None, 7)], [("a", 0), ("b", 1)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        firsts = first_per_key(append.read_new(spark, src, schema), ["url"], ["n"], 10**9)
        save = lambda batch, _: batch.write.mode("append").parquet(dst)
        firsts.writeStream.foreachBatch(save).option("checkpointLocation", ckpt).trigger(once=True).start().awaitTermination()
    assert sorted((r.url or "", r.n) for r in spark.read.parquet(dst).collect()) == [("", 7), ("a", 1), ("b", 1)]


def test_page_files_are_written_by_many_tasks(spark, tmp_path):
    from pricetide.plans.queries import page_files
    from pricetide.session import shared_dir

    spark.range(20).select(F.col("id").alias("s_suppkey"), F.lit("S").alias("s_name")).coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    before = set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/pricetide-*/saved-*"))
    assert page_files(spark, str(tmp_path)).count() == 50
    (root,) = set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/pricetide-*/saved-*")) - before
    written = [f.rsplit("/", 1)[1] for f in glob.glob(f"{root}/s_suppkey=*/part-*")]
    assert len(written) == 20 and len({name.split("-")[1] for name in written}) > 1
