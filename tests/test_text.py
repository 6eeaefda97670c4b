from pyspark.sql import functions as F

from pricetide.functions import dates, specs, text


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("o")).first().o


def test_white_space(spark):
    messy = "  a 　 b\t\n\x1c"
    assert one(spark, messy, text.pystrip) == messy.strip()
    assert one(spark, messy, text.collapse) == " ".join(messy.split())
    assert one(spark, "﻿x\x1c", text.jstrim) == "x\x1c"


def test_every_space_is_stripped(spark):
    spaces = [ch for ch in map(chr, range(0x110000)) if ch.isspace()]
    df = spark.createDataFrame([(f"{ch}{ch}a{ch}b{ch}",) for ch in [*spaces, "\u200b", "\ufeff"]], "v string")
    rows = df.select("v", text.pystrip(F.col("v")).alias("o"), text.collapse(F.col("v")).alias("c")).collect()
    assert all(r.o == r.v.strip() and r.c == " ".join(r.v.split()) for r in rows)


def test_first_non_empty(spark):
    df = spark.createDataFrame([("  ", None, " b "), ("a", "c", "b"), (None, None, "")], "x string, y string, z string")
    got = df.select(text.first_non_empty(F.col("x"), F.col("y"), F.col("z")).alias("o")).collect()
    assert [r.o for r in got] == ["b", "a", ""]


def test_promo_line(spark):
    assert one(spark, "\n- Giảm 5%\n\n  - quà\n\n", text.promo_line) == "Giảm 5% - quà"
    assert one(spark, "a\n\nb", text.promo_line) == "a - b"
    assert one(spark, " - ", text.promo_line) == ""
    assert one(spark, "ưu đãi THEO phạm vi  Giảm 1%", text.drop_scope_label) == "Giảm 1%"


def test_titles(spark):
    df = spark.createDataFrame([("t ", " n"), ("t", " "), (None, None)], "a string, b string")
    got = df.select(text.title_with_note(F.col("a"), F.col("b")), text.title_dash_note(F.col("a"), F.col("b")))
    assert [tuple(r) for r in got.collect()] == [("t (n)", "t - n"), ("t", "t -"), ("", "-")]


def test_keep_lines(spark):
    df = spark.createDataFrame([(["b", "", "-", None, "a", "b"],)], "v array<string>")
    c = F.col("v")
    row = df.select(
        text.keep_lines(c), text.keep_lines(c, distinct=False), text.join_list(text.keep_lines(c), as_set=True)
    ).first()
    assert tuple(row) == (["b", "a"], ["b", "a", "b"], "a | b")


def test_urls(spark):
    assert one(spark, "/a/b?x=1", lambda c: text.drop_query(text.absolute_url(c, "https://h"))) == "https://h/a/b"
    assert one(spark, "x.html", lambda c: text.absolute_url(c, "https://h")) == "x.html"
    assert one(spark, "https://h/a/slug", text.last_segment) == "slug"


def test_spec_map(spark):
    df = spark.sql("select array(struct('a' key,'1' value), struct('b' key,'2' value), struct('a' key,'3' value)) v")
    row = df.select(specs.spec_map(F.col("v")), specs.spec_map(F.col("v"), "first")).first()
    assert list(row[0].items()) == [("a", "3"), ("b", "2")]
    assert list(row[1].items()) == [("a", "1"), ("b", "2")]


def test_spec_text_round_trip(spark):
    for sep in (" | ", "\n"):
        row = spark.sql(
            "select array(struct('CPU' key,'i7 | 12: cores' value), struct('RAM' key,'16 GB' value)) v"
        ).select(specs.parse_spec_text(specs.spec_text(F.col("v"), sep)).alias("v")).first()
        # A ' | ' before text with a colon cannot be told from a border.
        assert [tuple(p) for p in row.v][0][0] == "CPU" and ("RAM", "16 GB") in [tuple(p) for p in row.v]
    plain = spark.sql("select 'A: x | y\nB:  2 ' v").select(specs.parse_spec_text(F.col("v")).alias("v")).first()
    assert [tuple(p) for p in plain.v] == [("A", "x | y"), ("B", "2")]


def test_clean_and_find(spark):
    df = spark.sql(
        "select array(struct(' VGA ' key,'RTX 3050' value), struct('Xem Thêm' key,'3050' value), struct('k' key,' ' value)) v"
    )
    row = df.select(
        specs.clean_pairs(F.col("v"), ["xem thêm"]),
        specs.any_spec(F.col("v"), ["card", "vga"], "3050"),
        specs.any_spec(F.col("v"), ["cpu"], "3050"),
    ).first()
    assert [tuple(p) for p in row[0]] == [("VGA", "RTX 3050")] and row[1] is True and row[2] is False


def test_local_time_in_any_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # The second instant lies in the hour that occurs twice in that zone.
        df = spark.sql("select timestamp'2026-07-01 18:30:05Z' a, timestamp'2026-11-01 06:30:00Z' b, timestamp_ntz'2026-07-01 18:30:05' c")
        shown = df.select(*[dates.local_time_text(F.col(c)).alias(c) for c in "abc"])
        assert tuple(shown.first()) == ("2026-07-02 01:30:05", "2026-11-01 13:30:00", "2026-07-02 01:30:05")
        back = shown.select(F.unix_seconds(dates.parse_local_time(F.col("a"))).alias("s")).first()
        assert back.s == 1782930605
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hrefs_in_any_quoting(spark):
    from pricetide.functions import markup

    html = """<a href="/a?x=1&amp;y=2">1</a><a class='k' href='/b'>2</a><A HREF=/c>3</A><a data-href="/no" href="/d" title="href='/t'">4</a>
      <a title="x > y" href = "/e">5</a><a name="none">6</a><abbr href="/f">7</abbr><a
      href="/g">8</a>"""
    got = spark.createDataFrame([(html,)], "html string").select(markup.hrefs(F.col("html"))).first()[0]
    assert got == ["/a?x=1&y=2", "/b", "/c", "/d", "/e", "/g"]


def test_lazy_pairs_match_the_pattern_and_take_linear_time(spark):
    import random
    import re
    import time

    from pricetide.functions import markup

    rng = random.Random(1)
    bits = ['"displayName":"A"', '"displayName":"B"', '"value":"1"', '"value":"2"', "\n", ",{}", '"displayName":""', '"value":""', '"displayName":"two\nlines"']
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, html string").select("i", markup.embedded_pairs(F.col("html"), "lazy_value").alias("p"))
    for r in got.collect():
        want = re.findall(r'"displayName":"([^"]+)".*?"value":"([^"]+)"', texts[r.i])
        assert [(p.key, p.value) for p in r.p] == want, texts[r.i]
    page = spark.createDataFrame([('"displayName":"CPU",' * 50_000,)], "html string")
    page.select(F.size(markup.embedded_pairs(F.col("html"), "lazy_value"))).first()
    start = time.perf_counter()
    assert page.select(F.size(markup.embedded_pairs(F.col("html"), "lazy_value"))).first()[0] == 0
    assert time.perf_counter() - start < 3


def test_spec_pairs_are_made_once(spark):
    df = spark.createDataFrame([("CPU: i7: x | RAM: 8 | y | CPU: i9",), ("A:\nB: b",), ("",), (None,)], "v string")
    got = df.select(specs.spec_map(specs.parse_spec_text(F.col("v"))).alias("m"))
    assert [r.m for r in got.collect()] == [{"CPU": "i9", "RAM": "8 | y"}, {"B": "b"}, {}, None]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
