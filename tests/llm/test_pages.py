import html
import random
import re
from os.path import commonprefix

import pytest
from pyspark.sql import functions as F

from alambique.llm import pages
from alambique.llm.pages import ARTICLE, OPEN, blocks, extract, shared_lines

SCHEMA = "page_id long, url string, html string, text string, lines int"


def texts(spark, data):
    table = spark.createDataFrame([(*d, "clash", 0) for d in data], SCHEMA)
    return {r.page_id: r for r in extract(table).collect()}


def test_given_pages(spark, small_dir):
    """These pages have one plain article; a few regular expressions read it."""
    table = spark.read.parquet(f"{small_dir}/pages.parquet")
    found = {r.page_id: r for r in extract(table).collect()}
    for page in table.collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer|\Z)", page.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)[^>]*>", re.sub(r"<!--.*?-->", "", inner, flags=re.S))
        lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in parts]
        text = "\n".join(line for line in lines if line)
        assert found[page.page_id].text == text
        assert found[page.page_id].n_chars == len(text) and found[page.page_id].url == page.url


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header>Site</header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Head&shy;line &amp; more</h1></header><p>One <b>bold</b>
  line<br>goes&nbsp;on &lt;p&gt;<p>Two<script>var x = "</p>";</script>
<ul><li>a<li>b</ul><div class="ad">Buy</div><form><input><label>Name</label></form>
<aside>Side</aside><!-- <p>no</p> --><table><tr><td>c</td><td>d</td></tr></table>
<section id="comments"><article class="comment"><p>First!</p></article></section></article>
<footer>&copy;</footer></body></html>"""


def test_zones_and_references(spark):
    (row,) = texts(spark, [(1, "http://h/a", PAGE)]).values()
    assert row.text.split("\n") == [
        "Head\xadline & more", "One bold line goes on <p>", "Two", "a", "b", "c", "d"
    ]
    assert row.certainty == ARTICLE


def test_pages_without_a_mark_are_differenced(spark):
    def page(body):
        return f"<body><p>Welcome to us</p>{body}<div>Call 555</div></body>"

    data = [
        (1, "http://h/news/a", page("<p>Alpha</p><p>shared by far pages</p>")),
        (2, "https://h/news/b?x=1", page("<p>Beta</p>")),
        (3, "http://h/shop/z", page("<p>Zeta</p><p>shared by far pages</p>")),
        (4, "http://other/news/a", page("<p>Lone</p>")),
        (5, "http://copy/x", page("<p>Twin</p>")),
        (6, "http://copy/x#top", page("<p>Twin</p>")),
    ]
    found = texts(spark, data)
    assert found[1].text == "Alpha\nshared by far pages" and found[2].text == "Beta"
    assert found[3].text == "Zeta\nshared by far pages"
    assert found[4].text == "Welcome to us\nLone\nCall 555"  # its host has no other page
    assert found[5].text == found[6].text == "Welcome to us\nTwin\nCall 555"  # copies
    assert {r.certainty for r in found.values()} == {OPEN}


def test_alignment_is_a_longest_common_subsequence():
    def longest(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                one = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
                table[i + 1][j + 1] = one
        return table[-1][-1]

    draw = random.Random(1)
    for _ in range(500):
        a, b = ([draw.randrange(5) for _ in range(draw.randrange(14))] for _ in "ab")
        found, rest = shared_lines(a, b), iter(b)
        assert len(found) == longest(a, b) and all(a[i] in rest for i in found)


@pytest.mark.parametrize("bits", [1, 40, 1 << 28])
def test_halved_alignments_are_as_long(monkeypatch, bits):
    draw = random.Random(2)
    pairs = [([draw.randrange(4) for _ in range(draw.randrange(40))], [draw.randrange(4) for _ in range(30)]) for _ in range(60)]
    expected = [len(shared_lines(a, b)) for a, b in pairs]
    monkeypatch.setattr(pages, "KEPT_BITS", bits)
    for (a, b), n in zip(pairs, expected):
        found, rest = shared_lines(a, b), iter(b)
        assert len(found) == n and all(a[i] in rest for i in found)


def test_a_block_that_moved_far_is_aligned():
    block, own, other = (list(range(k, k + 5000)) for k in (0, 10_000, 20_000))
    assert len(shared_lines([*own[:4000], *block], [*block, *other[:4000]])) == 5000


def test_equal_pages_have_equal_texts(spark):
    def page(body):
        return f"<body><p>Welcome to us</p>{body}<div>Call 555</div></body>"

    data = [(1, "http://h/a", page("<p>Alpha</p>")), (9, "http://h/z", page("<p>Omega</p>"))]
    data += [(2 + i, f"http://h/m{i}", page("<p>Twin</p>")) for i in range(4)]
    found = texts(spark, data)
    assert {found[i].text for i in range(2, 6)} == {"Twin"}
    assert (found[1].text, found[9].text) == ("Alpha", "Omega")


def test_lines_of_articles_that_recur_over_the_host(spark):
    def page(i):
        more = "<p>Read more in our app</p>" if i != 3 else ""
        twice = "<p>Told by two pages</p>" if i in (4, 5) else ""
        return f"<body><nav>Menu {i}</nav><article><p>Story {i}</p>{more}{twice}</article></body>"

    data = [(i, f"http://h/{i}", page(i)) for i in range(8)]
    found = texts(spark, data)
    assert all(found[i].text.startswith(f"Story {i}") for i in found)
    # The neighbours of page 3 are compared with the other one beside them.
    assert all("app" not in found[i].text for i in (0, 1, 5, 6, 7))
    assert "Told by two pages" in found[4].text and "Told by two pages" in found[5].text
    assert found[0].n_deleted == 1 and found[3].n_deleted == 0


def brute(table):
    """Whole texts of pages by the definition, host by host on plain lists."""
    hosts = {}
    for r in table:
        read = list(blocks(r.html or ""))
        hosts.setdefault(re.sub(r"^https?://([^/?#]*).*", r"\1", r.url).lower(), []).append((r, read))
    for rows_ in hosts.values():
        path = lambda r: re.sub(r"^https?://[^/?#]*([^?#]*).*", r"\1", r.url)
        distinct = {}
        for r, read in rows_:
            key = tuple(t for t, *_ in read)
            distinct[key] = min(distinct.get(key, path(r)), path(r))
        order = sorted(distinct, key=lambda k: (distinct[k].encode(),))
        often = {t for t in {t for k in distinct for t in k}
                 if sum(t in k for k in distinct) >= max(pages.RECURS_PAGES, pages.RECURS_SHARE * len(distinct))}
        for r, read in rows_:
            key = tuple(t for t, *_ in read)
            i = order.index(key)
            near = [order[j] for j in (i - 1, i + 1) if 0 <= j < len(order)]
            same = lambda k: len(commonprefix([distinct[k], distinct[key]]))
            at = set(shared_lines(key, max(near, key=same))) if near else set()
            best = max((s for _, s, noise in read if not noise), default=0)
            lost = {j for j in at if best < 2 or key[j] in often}
            main = [t for j, (t, s, noise) in enumerate(read) if not noise and s == best and j not in lost]
            yield r.page_id, "\n".join(main)


@pytest.mark.parametrize("marked", [True, False])
def test_against_brute_force(spark, small_dir, marked):
    table = spark.read.parquet(f"{small_dir}/pages.parquet")
    if not marked:
        table = table.withColumn("html", F.regexp_replace("html", "<(/?)article>", "<$1div>"))
    found = {(r.page_id, r.text) for r in extract(table).collect()}
    assert found == set(brute(table.collect()))


def test_broken_markup():
    assert [t for t, *_ in blocks("<p>a <b>b<p>c</b> d</div> <unclosed 'x> e < f")]
    assert list(blocks("<!-- never closed <p>x</p>")) == []
    assert [t for t, *_ in blocks("<script>x = 1 < 2")] == []
    assert [t for t, *_ in blocks("plain")] == ["plain"]
    assert len(list(blocks("<div>" * 3000 + "deep"))) == 1
    assert len(list(blocks("<p>x</p>" * 20_000))) == 20_000


def test_awkward_rows(spark):
    data = [(1, None, None), (2, "", ""), (None, "http://h", "<article>x</article>"), (3, "no url", "y")]
    data += [(4, "http://h/p", PAGE), (4, "http://h/p", PAGE)]
    table = spark.createDataFrame([(*d, "clash", 0) for d in data], SCHEMA)
    found = extract(table).collect()
    assert len(found) == 6
    assert sorted(r.text for r in found if r.page_id in (1, 2)) == ["", ""]
    assert [r.text for r in found if r.page_id is None] == ["x"]
    assert extract(table.limit(0)).isEmpty()
    assert extract(table.select(F.lit(1).alias("x"), "*")).columns[0] == "page_id"
