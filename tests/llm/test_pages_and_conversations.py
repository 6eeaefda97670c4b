"""Page extraction, conversation repair and the prefix trie against plain code."""

import hashlib
import itertools
import math
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pricetide.llm import extraction, prefix_trie, queries, repair

SF = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string"


def conversations(spark, rows, schema=CONV):
    return spark.createDataFrame(rows, schema)


# --- page extraction ---------------------------------------------------------------------------

ARTICLE = "".join(f"<p>Paragraph {i} of a text that is long enough, with a comma, and goes on for a while.</p>" for i in range(6))
TEXT = "\n\n".join(f"Paragraph {i} of a text that is long enough, with a comma, and goes on for a while." for i in range(6))


def test_article_without_what_surrounds_it():
    html = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x:y}}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=/a>Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div><div class="ad">Buy now</div>
<article><header><h1>Head &amp; line</h1></header>{ARTICLE}<form><label>Mail</label><input></form><script>var x = "</p>";</script>
<section id="comments"><article class="comment">First!</article></section><p>Short.</p></article>
<aside>Other</aside><footer>&copy; me</footer></body></html>"""
    assert extraction.main_text(html) == f"Head & line\n\n{TEXT}\n\nShort."


def test_article_without_its_element():
    body = f'<div id="top" class="menu"><a href=1>One</a> <a href=2>Two</a></div><div class="page nav-open"><h1>H</h1>{ARTICLE}</div>'
    links = '<div class="more">' + "".join(f"<a href={i}>Link {i}</a> " for i in range(9)) + "</div>"
    assert extraction.main_text(f"<body>{body}{links}</body>") == f"H\n\n{TEXT}"


def test_sections_beside_the_densest_one_stay():
    html = f"<body><main><section>{ARTICLE}</section><section><h2>Two</h2><p>Only this.</p></section></main></body>"
    assert extraction.main_text(html) == f"{TEXT}\n\nTwo\n\nOnly this."
    half = ARTICLE.replace("Paragraph", "Part")
    assert extraction.main_text(f"<body><div><div>{ARTICLE}</div><div>{half}</div></div></body>") == f"{TEXT}\n\n{TEXT.replace('Paragraph', 'Part')}"


def test_white_space_references_and_broken_markup():
    html = "<article><p><b>One\n\t two<br>three &#x2014;&eacute;&nbsp;x &lt;p&gt; &am<p>Four</b> <i>fi</i>ve</p><ul><li>a<li>b</ul><p>cut <a hr"
    assert extraction.main_text(html) == "One two three —é x <p> &am\n\nFour five\n\na\n\nb\n\ncut"
    assert extraction.main_text("just text") == "just text"
    for nothing in (None, "", "<html></html>", "<body><nav>x</nav></body>", "<p", "<!--", "<script>x"):
        assert extraction.main_text(nothing) == ""


def test_table_cells_and_deep_pages():
    html = "<article><table><tr><td>a<td>b<tr><td>c</table><p>x</p></article>"
    assert extraction.main_text(html) == "a\n\nb\n\nc\n\nx"
    deep = "<div>" * 20_000 + "<p>here</p>"
    assert extraction.main_text(deep) == "here"
    long = "<article>" + "<p>word word</p>" * 50_000 + "</article>"
    assert extraction.main_text(long).count("\n\n") == 49_999


def test_densities_are_those_of_the_formula():
    root = extraction.parse("<body><div><p>abcdefghij<a>klmno</a></p><p>pqrst</p></div></body>")
    body = root.items[0]
    extraction._weigh(extraction._order(root), body)
    div = body.items[0]
    c, lc, t, lt = 20, 5, 3, 1
    base = math.log(c / 15 * lc + lc / c * c + math.e)
    assert math.isclose(div.density, c / t * math.log(c / lc * t / lt) / math.log(base))
    assert math.isclose(div.sum, sum(p.density for p in div.items))


def test_pages_query(spark):
    """All pages of the table are of one shape: the article's blocks are its heading and paragraphs."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op11_extraction(spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        html = pages[r.page_id].html
        article = re.search(r"(?s)<article>(.*?)</article>", html)[1]
        blocks = [extraction.unescape(re.sub("<[^>]*>", "", b)) for b in re.split(r"</?(?:h1|p)>", article.replace("<br>", " "))]
        want = "\n\n".join(" ".join(b.split()) for b in blocks if b.split())
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


def test_pages_defined_cases(spark):
    schema = "text string, page_id long, url string, html string, n_chars int"
    rows = [("x", 1, None, None, 5), ("x", None, "u", "<p>a</p>", 5), ("x", 2, "u", "<p>a</p>", 5), ("x", 2, "u", "<p>a</p>", 5)]
    got = extraction.extract(spark.createDataFrame(rows, schema))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, None, "", 0), (None, "u", "a", 1), (2, "u", "a", 1), (2, "u", "a", 1)], key=str)
    assert extraction.extract(spark.createDataFrame([], schema)).count() == 0


# --- conversation repair -----------------------------------------------------------------------

BLANK = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Faults and the cheapest edits of one conversation, by a forward search over (cost, letters)."""
    def tie(r):
        return (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest())

    rows = sorted(((t, r, x) for _, t, r, x in rows), key=tie)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts, faults, seen = defaultdict(int), [], set()
    for _, role, text in rows:
        body = text.rstrip(BLANK)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        counts[fault] += 1
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    nexts = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    # Two strings of one cost in one state: neither begins with the other, so the lesser one stays the lesser.
    paths = {"": {(0, "", ())}}

    def best(found):
        return {min(found)}

    def spread(paths):
        grown = {s: set(f) for s, f in paths.items()}
        for _ in range(2):
            for state, found in list(grown.items()):
                for cost, letters, lines in list(found):
                    for new, role in (("u", "user"), ("a", "assistant")):
                        if new in nexts[state]:
                            grown.setdefault(new, set()).add((cost + 5, letters + "I", (*lines, f"{role}:")))
        return {s: best(f) for s, f in grown.items()}

    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = defaultdict(set)
        for state, found in spread(paths).items():
            for cost, letters, lines in found:
                after[state].add((cost + 2, letters + "D", lines))
                if fault in ("blank", "duplicate"):
                    continue
                extra = 5 if fault == "truncated" else 0
                new = nexts[state].get(role[:1])
                if new is not None:
                    after[new].add((cost + extra, letters + "K", (*lines, f"{role}:{text}")))
                for new, given in (("u", "user"), ("a", "assistant")):
                    if new in nexts[state]:
                        after[new].add((cost + extra + 1, letters + "R", (*lines, f"{given}:{text}")))
        paths = {s: best(f) for s, f in after.items()}
    ends = [f for s, found in spread(paths).items() if s in ("", "a") for f in found]
    cost, audit, lines = min(ends)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def by_conv(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    return groups


def random_conversations(seed, n, longest, clean=0.7):
    pick = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(pick.randrange(longest)):
            role = pick.choice(["system", "user", "assistant", "user", "assistant", "tool", ""])
            text = pick.choice(["Yes.", "No!", "Why", "", " \n", "Well... yes? ", f"T{turn}."]) if pick.random() > clean else f"{conv} {turn}."
            rows.append((conv, pick.choice([turn, turn, turn, turn * 2, None]), role, text))
    return rows


@pytest.mark.parametrize("chunk", [2, 65_536])
def test_repair_equals_a_search_over_all_edits(spark, chunk):
    rows = list(dict.fromkeys(random_conversations(3, 40, 14)))
    got = repair.repair(conversations(spark, rows), chunk)
    want = {c: plain_repair(r) for c, r in by_conv(rows).items()}
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got.collect()} == want


def test_chunks_run_again_only_until_vectors_differ_by_constants():
    pick = random.Random(5)
    costs = repair.Costs()
    for _ in range(200):
        codes = [pick.choice([0, 1, 2, 3, 4, 9, 14, 15, 2, 3, 2, 3]) for _ in range(pick.randrange(1, 60))]
        cut = pick.randrange(1, len(codes) + 1)
        whole, start, shift = costs.back(codes, repair.END)
        behind, tail, tail_shift = costs.back(codes[cut:], repair.END)
        first, head, head_shift = costs.back(codes[:cut], repair.END)
        head, head_shift = costs.again(codes[:cut], first, head, head_shift, tail)
        assert (first + behind, head, head_shift + tail_shift) == (whole, start, shift)


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in queries.op12_repair(spark, SF).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    damaged = by_conv(plain_damage(rows))
    assert got == {c: plain_repair(damaged[c]) if c in damaged else nothing for c in by_conv(rows)}


def test_repair_defined_cases(spark):
    rows = [
        (None, 1, "user", "a."), (None, None, None, None), (1, None, None, None), (1, 2, "user", None), (2, 1, "x", "é" * 50_000 + "."),
        (2, 1, "x", "é" * 50_000 + "."), (3, 5, "assistant", "."), (3, 5, "system", "."), (4, 0, "user", "😀?"), (4, 9, "assistant", "b"),
    ]
    schema = "conv_id long, turn long, role string, text string, idx int, gaps string"
    got = repair.repaired(conversations(spark, [(*r, 1, "g") for r in rows], schema))
    damaged = by_conv(plain_damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got.columns == ["conv_id", *COLUMNS]
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got.collect()} == {
        c: plain_repair(damaged[c]) if c in damaged else nothing for c in by_conv(rows)
    }
    assert repair.repaired(conversations(spark, [])).count() == 0


def test_one_long_conversation(spark):
    rows = [(7, t, ["user", "assistant"][t % 2] if t % 97 else "user", f"{t % 1000}." if t % 31 else "") for t in range(4000)]
    few, many = repair.repair(conversations(spark, rows), 100_000), repair.repair(conversations(spark, rows), 50)
    assert [tuple(r) for r in few.collect()] == [tuple(r) for r in many.collect()]


# --- prefix trie -------------------------------------------------------------------------------


def plain_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()[:32], text or ""))
    turns = {c: [(t[2], t[4]) for t in sorted(ts, key=lambda t: t[:4])] for c, ts in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        seq = turns.get(c - c % 100, [])[:h] + turns[c][h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        children[node[:-1]] += bool(node)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (m[0], len(n), members[n[:-1]][0] if n else -1, len(m), children[n], leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, m in members.items()
    )


def nodes(frame):
    assert frame.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in frame.collect())


def test_extents_equal_a_walk():
    pick = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 100):
        lcp = pick.integers(0, 4, n)
        lcp[0] = -1
        row, depth = pick.integers(0, n, 300), pick.integers(0, 5, 300)
        left, right = prefix_trie.extents(prefix_trie.sparse_table(lcp), row, depth)
        for i, d, lo, hi in zip(row, depth, left, right, strict=True):
            while i - lo > 0 and not (lcp[lo + 1 : i + 1] >= d).all():
                pytest.fail("left too far")
            assert lo == 0 or lcp[lo] < d
            assert (lcp[i + 1 : hi + 1] >= d).all() and (hi == n - 1 or lcp[hi + 1] < d)


@pytest.mark.parametrize(("segment", "shard"), [(2, 200_000), (1, 5), (1024, 6)])
def test_trie_equals_a_dictionary(spark, monkeypatch, segment, shard):
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", shard)
    monkeypatch.setattr(prefix_trie, "RUN_IDS", 3)
    monkeypatch.setattr(prefix_trie, "HOT", 4)
    pick = random.Random(segment)
    rows = []
    for conv in [*range(0, 60), *range(100, 140), *range(250, 260), 1000]:
        kind = pick.randrange(4)
        for turn in range(pick.randrange(1, 12)):
            rows.append((conv, turn if pick.random() > 0.05 else None, "ua"[turn % 2], "same" * turn if kind else str(pick.randrange(2))))
    rows.append((3, 99, None, None))
    rows.append((None, 1, "u", "x"))
    assert nodes(prefix_trie.prefix_trie(conversations(spark, rows), segment)) == plain_trie(rows)


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(queries.op13_trie(spark, SF)) == plain_trie(rows)


def test_trie_defined_cases(spark):
    schema = "pos long, conv_id long, turn long, role string, text string, depth int"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    rows = [(205, None, None, None), (205, 1, "u", "é" * 30_000), (205, 1, "u", "é" * 30_000), (299, 0, "a", "😀"), (200, 4, "u", "")]
    wide = spark.createDataFrame([(1, *r, 2) for r in rows], schema)
    assert nodes(prefix_trie.prefix_trie(wide)) == plain_trie(rows)
    # Every turn is borrowed from a base that is not there: only the root is left.
    lone = next(c for c in range(301, 399) if zlib.crc32(str(c).encode()) % 6 == 5)
    assert nodes(prefix_trie.prefix_trie(conversations(spark, [(lone, 0, "u", "x")]))) == plain_trie([(lone, 0, "u", "x")])


def test_trie_of_copies_and_a_long_conversation(spark):
    copies = [(c, t, "u", "one" if t else "first") for c in range(0, 3000, 100) for t in range(3)]
    long = [(50_000, t, "u", str(t % 7)) for t in range(400)]
    want = plain_trie(copies + long)
    assert nodes(prefix_trie.prefix_trie(conversations(spark, copies + long), 16)) == want
