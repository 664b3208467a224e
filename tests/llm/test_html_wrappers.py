"""Main text by wrappers: tokens, inference, regions and the operator."""

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from indexkit.llm import html_extract, queries, wrappers
from indexkit.llm.html_tokens import tokens

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def plain_article(page):
    """The test tables' articles, by plain text search."""
    inner = re.sub(r"<[^>]*>", lambda m: "\n" if re.match(r"</?(p|h1)\b", m[0]) else " " if m[0] == "<br>" else "",
                   page[page.index("<article>") + 9:page.index("</article>")])
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in inner.split("\n")) if x)


def test_tokens():
    page = ("<!-- a > b --><!DOCTYPE html><P class='x>y' data-a=\"<b>\">a &lt; b &amp c</P ><script>var t='</p>';</script>"
            "3 < 4 <br/>end<!--> x <a title=it's>")
    assert list(tokens(page)) == [
        ("start", "p", " class='x>y' data-a=\"<b>\""), ("text", "a < b & c", ""), ("end", "p", " "), ("start", "script", ""),
        ("end", "script", ""), ("text", "3 < 4 ", ""), ("start", "br", "/"), ("text", "end", ""), ("text", " x ", ""),
        ("start", "a", " title=it's")]
    assert list(tokens("text <a href='x")) == [("text", "text ", "")]
    assert list(tokens("a<script>never closed <p>")) == [("text", "a", ""), ("start", "script", "")]


@pytest.mark.parametrize("part", ["<a ", "<a x=\"", "<a x=' <b", "<!--", "</", "<script>", "<p><div>", "&am", "< a", "<p class='ad'>x"])
def test_hostile_pages_take_linear_time(part):
    page = part * (400_000 // len(part))
    start = time.process_time()
    html_extract.text_of(page, None)
    assert time.process_time() - start < 20
    html_extract.text_of(page + ">", None)


def strip(item):
    return item[:3] + ([strip(x) for x in item[6]] if item[6] else [])


def test_optional_repeated_and_slots():
    pages = ["<div><h2>A</h2><p>one</p><p>two</p><ul><li>x</ul></div>", "<div><h2>A</h2><p>other</p></div>"]
    a, b = (wrappers.pattern(html_extract.page_tree(p)) for p in pages)
    w = wrappers.merged(a, b)
    div = w[6][0]
    assert [(i[0], i[1], i[2]) for i in div[6]] == [("h2", False, False), ("p", False, True), ("ul", True, False)]
    assert div[6][0][6][0][5] is not None and div[6][1][6][0][5] is None  # constant heading, slot in the paragraph
    assert strip(wrappers.merged(b, a)) == strip(w)


def test_squares_of_several_blocks():
    page = "<div>" + "<h2>t</h2><p>a</p><p>b</p><table><tr><td>1</table>" * 4 + "<h2>t</h2></div>"
    div = wrappers.pattern(html_extract.page_tree(page))[6][0]
    assert [(i[0], i[2]) for i in div[6]] == [("()", True), ("h2", False)]
    assert [(i[0], i[2]) for i in div[6][0][6]] == [("h2", False), ("p", True), ("table", False)]


def test_wrapper_does_not_grow_with_pages():
    import json
    rng = random.Random(1)
    whole, sizes = None, []
    for k in range(150):
        blocks = "".join(f"<{rng.choice(['p', 'h2', 'div'])} class='c{rng.choice('abcdefgh') * rng.randint(1, 30)}'>t{k}" for _ in range(40))
        page = wrappers.pattern(html_extract.page_tree(f"<body>{blocks}</body>"))
        whole = page if whole is None else wrappers.joined(whole, page)
        sizes.append(wrappers.size(whole))
    assert max(sizes) <= wrappers.ITEMS_MOST and len(json.dumps(whole)) < 500_000


LAYOUTS = {
    "marked.example": ("<header><h2>Site</h2></header><nav><a>Home</a></nav><div class='cookie-notice'>We use cookies</div>"
                       "<article class='post-{k}'><header><h1>{t}</h1></header>{body}<aside>See also</aside>"
                       "<form><label>Mail</label><input></form></article>"
                       "<section id='comments'><article class='comment'><p>reader {k}</p></article></section>"
                       "<footer>&copy; {k}</footer>"),
    "plain.example": ("<div id='top'>Welcome</div><div class='menu'><ul><li>a<li>b</ul></div>"
                      "<div id='page'><div class='left sidebar'><p>links {k}</p></div><div id='content-{k}'><h1>{t}</h1>{body}"
                      "<p class='advert'>Buy {k}</p></div></div><div class='footer'>end {k}</div>"),
    "nested.example": ("<table><tr><td class='navigation'>x<td><main role='main'><h1>{t}</h1>{body}"
                       "<div class='share'>Share</div></main></table><div role='contentinfo'>c</div>"),
}


def corpus(n=12, seed=3):
    rng, data = random.Random(seed), []
    for host, layout in LAYOUTS.items():
        for k in range(n):
            title = f"Title {rng.random():.6f} &amp; more"
            paragraphs = [" ".join(f"w{rng.randint(0, 9999)}" for _ in range(rng.randint(5, 60))) for _ in range(rng.randint(1, 6))]
            body = "".join(rng.choice(["<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div><p>{}</p></div>"]).format(p) for p in paragraphs)
            page = "<html><head><title>no</title><style>p{}</style></head><body>" + \
                layout.format(k=k, t=title, body=body) + ("</body></html>" if k % 3 else "")
            data.append((len(data), f"https://{host}/{k}", page, "\n".join([html.unescape(title), *paragraphs])))
    return data


def test_layouts_are_read_whole(spark):
    data = corpus()
    df = spark.createDataFrame([d[:3] for d in data], PAGES).repartition(4)
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {d[0]: d[3] for d in data}


def test_query_on_the_tables(spark):
    got = {r.page_id: r for r in queries.op12_html_wrappers(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == plain_article(p.html)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_merging_in_a_tree_gives_the_same_regions(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "FAN_IN", 2)
    monkeypatch.setattr(html_extract, "HOSTS", 2)
    data = corpus()
    df = spark.createDataFrame([d[:3] for d in data], PAGES).repartition(7)
    found = html_extract.infer(df, "html", F.lit("one")).collect()
    assert len(found) == 1
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {d[0]: d[3] for d in data}


ODD = [(1, "http://a/", None), (2, None, ""), (None, "http://a/", "<p>a</p>"), (3, None, "no markup &amp; text"),
       (4, "http://b/", "<div>" * 3000 + "deep" + "<p>after"), (5, "http://b/", "<script>only</script>"),
       (6, "http://c/", "<p>" + "long " * 200_000), (6, "http://c/", "<p>" + "long " * 200_000),
       (7, "http://d/", "</p></div>x<!-- never"), (8, "http://d/", "<p>a<a href='b"), (9, "http://e/", "<p><span class=ad>buy<p>text"),
       (10, "http://f/", "<html><body class='has-sidebar'><p>kept</p></body></html>"), (11, "http://f/", "<nav>only menu</nav>")]
WANT = {1: "", 2: "", None: "a", 3: "no markup & text", 4: "deep\nafter", 5: "", 6: ("long " * 200_000).strip(), 7: "x",
        8: "a", 9: "text", 10: "kept", 11: ""}


def test_odd_pages(spark):
    df = spark.createDataFrame(ODD, PAGES).withColumn("regions", F.lit(1)).withColumn("text", F.lit("x")).withColumn("host", F.lit(2))
    out = html_extract.extract(df)
    got = [(r.page_id, r.text) for r in out.collect()]
    assert len(got) == len(ODD) and dict(got) == WANT
    assert {"page_id", "url", "regions", "host", "text", "n_chars"} == set(out.columns)
    assert html_extract.extract(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("text", ["a\xa0b c", "&nbsp;x&#8195;y&nbsp;"])
def test_white_space(text):
    assert html_extract.text_of(f"<p>{text}</p>", None) == " ".join(html.unescape(text).split())
