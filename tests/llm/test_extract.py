import re
from html import unescape

from pyspark.sql import functions as F

from argent.llm import extract as M


def article(html):
    a = html[html.index("<article>") + 9:html.index("</article>")]
    parts = re.split(r"</?(?:p|h1|h2|li|ul)\b[^>]*>", a)
    return "\n".join(t for t in (" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts) if t)


def test_whole_table(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = M.op10_html_text(spark, sf).collect()
    assert sorted(r.page_id for r in out) == sorted(pages)
    assert all(r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) for r in out)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site-header"><a href="/">Home page of ours</a></header>
<div class="cookie-notice"><p>We use cookies, as many as we can get. Accept them all.</p></div><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div class="post-content"><h1>The  title &amp; more</h1><p>First paragraph, with <b>bold</b>
text and an &eacute;, long enough to be counted as text.<p>Second paragraph is here, too, and it has a comma.</p>
<div class="ad">Buy now, buy here, buy more.</div><ul><li>One item of the list</li><li>Other item</li></ul></div>
<aside class="sidebar"><p>Related things that nobody reads, but they are there.</p></aside>
<form action="/s"><p>Search us</p><input name="q"></form><section class="comments"><p>Reader comment, long enough to look like text, really.</p></section>
<footer><p>Copyright, all rights reserved by us.</p></footer><script>var x = "</p>";</script></body></html>"""


def test_unseen_markup_with_trained_trees(spark, sf):
    trees = M.trained(spark.read.parquet(f"{sf}/pages.parquet"))
    df = spark.createDataFrame([(1, PAGE, "x"), (1, PAGE, "x"), (2, None, None), (3, "", ""), (4, "<", ""), (5, "<p", "")],
                               "page_id long, html string, text string")
    out = M.extracted(df.select("page_id", "html"), ["page_id"], trees).collect()
    want = ("The title & more\nFirst paragraph, with bold text and an é, long enough to be counted as text.\n"
            "Second paragraph is here, too, and it has a comma.\nOne item of the list\nOther item")
    assert [r.text for r in out if r.page_id == 1] == [want, want]
    assert all(r.text == "" for r in out if r.page_id in (2, 3)) and len(out) == 6


def test_no_page_to_train_on(spark):
    df = spark.createDataFrame([(1, "<body><div><p>Some words in a paragraph that is long.</p></div><nav>menu</nav></body>")], "page_id long, html string")
    assert M.trained(df) is None and M.trained(df.limit(0)) is None
    assert M.extracted(df, ["page_id"], None).first().text == "Some words in a paragraph that is long."
    assert M.extracted(df.limit(0), ["page_id"], None).count() == 0


def test_rare_named_articles_train_the_trees(spark, sf):
    named = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html") \
        .orderBy(F.xxhash64("page_id", F.octet_length("html")).desc()).limit(8)
    plain = spark.range(20_000).selectExpr(
        "id + 1000000 as page_id", "concat('<body><article><div><p>Words of page ', id, '.</p></div></body>') as html")
    assert M.variant(plain.first().html, 0, "truth") is None  # never closed
    assert M.trained(plain.union(named)) is not None
    assert M.trained(plain) is None


def test_choices_never_contradict():
    import numpy as np

    r = np.random.default_rng(2)
    blocks = M.parse(PAGE)
    for _ in range(50):
        text = M.kept_text(blocks, r.normal(0, 3, len(blocks)))
        assert "var x" not in text and "p{}" not in text and "Search us" not in text


def test_long_and_broken_markup():
    deep = "<div>" * 3000 + "<p>deep text</p>"
    assert M.parse(deep)[-1].depth == 3001
    M.features(M.parse(deep))
    assert M.parse("<p title='x>y'>a</p>")[1].pieces == ["a"]
    assert M.parse("<!-- never closed <p>x")[0].pieces == []


def test_training_is_bounded_and_blind_to_the_pages_own_attributes(spark, sf):
    page = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").first()
    own = page.html.replace("<article", "<article data-truth='x' truth=\"0\"").replace("<nav", "<nav data-truth=\"\"")
    mark = M.unused_mark(own)
    assert mark not in own and any(b.truth == 1 for b in M.parse(M.variant(own, 0, mark), mark))
    assert all(b.truth is None for b in M.parse(own)) and len(M.training_rows(own, 1)) > 0
    many = spark.createDataFrame([(page.page_id, own)] * 400 + [(k, own) for k in range(5)], "page_id long, html string")
    trees = M.trained(many)
    out = M.extracted(many, ["page_id"], trees).select("text").distinct().collect()
    assert len(out) == 1 and out[0].text


def test_broken_pages_take_linear_time():
    import time

    for html in ("<a " * 350_000, "<div>" * 50_000 + "</p>" * 50_000, "</x>" * 100_000, "".join(f"<t{k}>" for k in range(100_000)),
                 "<!" * 300_000, "<p \"" * 200_000, "<p '>" * 100_000, "<tr></tr>" * 40_000, "<x>" * 40_000 + "<tr></tr>" * 40_000):
        began = time.time()
        M.features(M.parse(html))
        assert time.time() - began < 5, html[:40]


def test_ends_without_a_closing_bracket():
    text = lambda html: "".join(p for p in M.parse(html)[0].pieces if isinstance(p, str))
    assert text("a <b") == "a <b" and text("a <!-- x") == "a " and text("a <!-- x > y") == "a "
    assert text("a <b> c <!-- d") == "a  c " and text("a <!-- b --> c") == "a  c" and text("a <b>c <d") == "a c <d"
