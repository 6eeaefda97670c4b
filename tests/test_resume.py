"""Pending table, resumable discovery, early end of a listing scan, publishing with states, spec multimap."""

import datetime as dt
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricetide.functions import specs
from pricetide.operators import audit
from pricetide.plans import jobs, resume
from pricetide.sinks.pending import read_pending, update_pending
from pricetide.sources import listings
from pricetide.sinks import text as text_sink

LINKS = "store string, chunk int, idx bigint, url string, lastmod string"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_pending_table_updates_single_shards(spark, tmp_path):
    root = str(tmp_path / "pending")
    assert read_pending(spark, root) is None

    def rows(*shards):
        return spark.createDataFrame([(s, c, 1, f"{s}{c}", None) for s, c in shards], LINKS)

    update_pending(rows(("a", 1), ("a", 2), ("b", 1)), rows(("a", 1), ("a", 2), ("a", 3), ("b", 1)), root)
    kept = os.listdir(f"{root}/store=b/chunk=1")
    # One shard is replaced, one done, one not run at all.
    update_pending(rows(("a", 2)), rows(("a", 1), ("a", 2)), root)
    assert {(r.store, r.chunk) for r in read_pending(spark, root).collect()} == {("a", 2), ("b", 1)}
    assert os.listdir(f"{root}/store=b/chunk=1") == kept
    update_pending(rows(), rows(("a", 2), ("b", 1)), root)
    assert read_pending(spark, root) is None
    update_pending(rows(), rows(), root)


def sitemap(tmp_path, name, *entries):
    body = "".join(f"<url><loc>{u}</loc><lastmod>{m}</lastmod></url>" for u, m in entries)
    return put(tmp_path / f"{name}.xml", f"<urlset>{body}</urlset>")


def test_discovery_opens_recent_sitemaps_only(spark, tmp_path):
    names = ["sitemap-product-2026-5", "sitemap-product-2026-4", "sitemap-product-2025-12", "sitemap-news"]
    sitemap(tmp_path, names[0], ("https://h/laptop/x", "new"), ("https://h/tv/x", ""))
    sitemap(tmp_path, names[1], ("https://h/laptop/x", "old"), ("https://h/laptop/y", "y"))
    # The third and the fourth are not there: opening them would fail.
    index = put(tmp_path / "index.xml", "<s>" + "".join(f"<sitemap><loc>https://h/{n}</loc></sitemap>" for n in names) + "</s>")
    locate = lambda loc: f"{tmp_path}/{loc.rsplit('/', 1)[1]}.xml"
    found = resume.discover(spark, [index], "tgdd", dt.date(2026, 6, 2), locate=locate)
    assert {tuple(r) for r in found.collect()} == {("https://h/laptop/x", "new"), ("https://h/laptop/y", "y")}
    assert sorted(os.path.basename(f) for f in found.inputFiles()) == [f"{n}.xml" for n in sorted(names[:2])]
    with pytest.raises(ValueError):
        resume.discover(spark, [index], "tgdd", dt.date(2027, 6, 2), locate=locate)


def test_steps_are_found_again(spark, tmp_path):
    source = put(tmp_path / "in" / "a.txt", "x")
    root, made = str(tmp_path / "steps"), []

    def run(inputs):
        return resume.step(spark, root, "links", inputs, lambda: made.append(1) or spark.read.text(source)).collect()

    key = resume.file_key(spark, str(tmp_path / "in"))
    assert run([key, 1]) == run([key, 1]) and len(made) == 1
    run([key, 2])
    put(tmp_path / "in" / "b.txt", "longer")
    assert resume.file_key(spark, str(tmp_path / "in")) != key and len(made) == 2
    # A result without the writer's last mark was not finished.
    for path in (tmp_path / "steps").glob("*/_SUCCESS"):
        path.unlink()
    run([key, 1])
    assert len(made) == 3


def test_work_by_precedence(spark, tmp_path):
    pending, stored = str(tmp_path / "pending"), str(tmp_path / "links")
    known = spark.createDataFrame([(f"u{i}", str(i)) for i in range(6)], "url string, lastmod string")

    def never():
        raise AssertionError("discovery ran")

    assert resume.work_list(spark, "tgdd", 2, pending, stored, lambda: known).count() == 6
    text_sink.write_links(known.limit(4), stored)
    work = resume.work_list(spark, "tgdd", 2, pending, stored, never)
    assert work.count() == 4
    pages = spark.createDataFrame([("u0", "<h1>a</h1>"), ("u1", "<h1>a</h1>")], "url string, html string")
    left = resume.crawl_run(work.withColumn("chunk", F.lit(1)).withColumn("idx", F.substring("url", 2, 1).cast("long") + 1), pages.limit(1), "tgdd", pending)
    assert sorted(r.url for r in left.collect()) == ["u1", "u2", "u3"]
    again = resume.work_list(spark, "tgdd", 2, pending, stored, never)
    assert sorted(r.url for r in again.collect()) == ["u1", "u2", "u3"]
    assert resume.work_list(spark, "gearvn", 2, pending, stored, never).count() == 0
    all_pages = spark.createDataFrame([(f"u{i}", "<h1>a</h1>") for i in range(4)], "url string, html string")
    assert resume.crawl_run(again, all_pages, "tgdd", pending).count() == 0 and read_pending(spark, pending) is None


def test_listing_scan_stops(spark, tmp_path):
    def page(n, *rows):
        text = "\n".join('{"listing": "%s", "body": "{\\"data\\":{\\"products\\":[%s]}}"}' % (k, ",".join('{\\"canonical\\":\\"%s\\"}' % c for c in v)) for k, v in rows)
        put(tmp_path / f"page={n}" / "r.json", text)

    page(1, ("a", ["x"]), ("b", ["y"]))
    page(2, ("a", ["z"]), ("b", []))
    page(3, ("a", ["w"]), ("b", ["late"]))
    page(4, ("a", []))
    # Damaged: reading it would fail the job.
    put(tmp_path / "page=10" / "r.json.gz", "no archive")
    got = listings.scan_listing(spark, str(tmp_path), "https://h", ["listing"], "listing string, body string", ahead=1)
    assert {(r.listing, r.page, r.url) for r in got.collect()} == {
        ("a", 1, "https://h/x"), ("a", 2, "https://h/z"), ("a", 3, "https://h/w"), ("b", 1, "https://h/y")
    }


def test_publish_reports_four_states(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("good", "none", "gone", "bad")}
    rows = spark.range(5).withColumn("t", F.lit("x"))
    rows.write.parquet(paths["good"])
    rows.limit(0).write.parquet(paths["none"])
    rows.coalesce(1).write.parquet(paths["bad"])
    put(tmp_path / "bad" / "part-9.parquet", "no table")
    catalog = str(tmp_path / "catalog")
    for _ in range(2):
        report = jobs.publish_stores(spark, paths, catalog, "r1", rows.schema, {"good": "Good"})
        lines = {r.sheet_name: (r.status, r.n_rows) for r in report.collect()}
        assert lines == {"Good": ("ok", 5), "none": ("empty", 0), "gone": ("missing", 0), "bad": ("error", 0), "TOTAL": ("total", 5)}
    assert {(r.store, r["count"]) for r in spark.read.parquet(catalog).groupBy("store").count().collect()} == {("good", 5)}
    assert "bad: lỗi" in [r.value for r in audit.report_lines(report).collect()]


TEXTS = ["", " | ", "CPU: i5 | CPU: i7 | RAM: 8", "a: 1 | b: 2 | a: 3", "no colon | k: v | x", ": v", "k:v", "k: ", "a: b: c |  | d", "\n: \n"]


def test_spec_multimap(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    m = specs.spec_multimap(F.col("t"))
    got = {r.t: r for r in df.select("t", m.alias("m"), specs.multimap_text(m).alias("back"), specs.values_of(m, "CPU").alias("cpu")).collect()}
    assert all(r.back == t for t, r in got.items())
    assert [(e.key, e["values"]) for e in got["CPU: i5 | CPU: i7 | RAM: 8"].m] == [("CPU", ["i5", "i7"]), ("RAM", ["8"])]
    assert [(e.key, e["values"]) for e in got["no colon | k: v | x"].m] == [("", ["no colon"]), ("k", ["v"]), ("", ["x"])]
    assert got["CPU: i5 | CPU: i7 | RAM: 8"].cpu == ["i5", "i7"] and got[None].m is None and got[None].back is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab:| \n", max_size=14), min_size=20, max_size=40))
def test_spec_multimap_round_trip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(r.t == r.back for r in df.select("t", specs.multimap_text(specs.spec_multimap(F.col("t"))).alias("back")).collect())


def test_spec_multimap_cuts_a_text_once(spark):
    df = spark.createDataFrame([("a: 1 | a: 2 | b | a: 3",), (None,), ("",)], "t string").select(specs.spec_multimap(F.col("t")).alias("m"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    got = [r.m and [(e.key, e["values"]) for e in r.m] for r in df.collect()]
    assert got == [[("a", ["1", "2"]), ("", ["b"]), ("a", ["3"])], None, [("", [""])]]
