from __future__ import annotations

import random
import re
import time
from html import unescape
from itertools import product

import duckdb
import pytest

from pyspark.sql import functions as F
from tallyloom.llm import html, langid, queries

SMALL = "/root/testdata/sf0.001"


def article(page: str) -> str:
    """The test pages' own markup: everything inside the article element, cut at its paragraphs and heading."""
    inside = re.search(r"(?s)<article>(.*)</article>", page)[1].replace("<br>", " ")
    blocks = (" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inside))
    return "\n".join(x for x in blocks if x)


def test_test_pages(spark):
    pages = duckdb.connect().execute(f"select page_id, html from '{SMALL}/pages.parquet'").fetchall()
    rows = {r.page_id: r for r in queries.op7_html_text(spark, SMALL).collect()}
    assert {i: r.text for i, r in rows.items()} == {i: article(p) for i, p in pages}
    assert all(r.n_chars == len(r.text) for r in rows.values())


PAGE = """<html><head><title>t</title></head><body class="has-sidebar"><header><p>Site name and slogan.</p></header>
<div id="cookie-notice"><p>We use cookies to make this site work better for you, please accept.</p></div>
<div class="layout">%s<div class="sidebar"><h3>Related</h3><p>Long text at the side of the page, which goes on and on, in sentences.</p></div>
</div><section id="comments"><h2>3 comments</h2><div class="comment"><p>I liked this article a lot, thank you for writing it.</p></div></section>
<form><p>Sign up for our letter today, it is free and comes weekly, with news.</p></form><footer>(c) 2020</footer>"""
BODY = """<h1>A &lt;big&gt; title</h1><p>First para is long enough to be article text, it has many words in it and goes on.
<p>Short.<p>Another&nbsp;&eacute; paragraph with <a href="x>y">a link</a> in<b>side</b>.<script>if (a < b) { "</p>" }</script><ul><li>one item<li>two items</ul>"""
TEXT = """A <big> title
First para is long enough to be article text, it has many words in it and goes on.
Short.
Another é paragraph with a link inside.
one item
two items"""


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", '<div class="post-content">%s</div>', "<div>%s</div>"])
def test_boilerplate_goes(wrap):
    assert html.main_text(PAGE % (wrap % BODY)) == TEXT


def test_comments_inside_the_article_go():
    page = '<article><p>The text of the article, long enough to count.</p><aside>Advert here.</aside><div class="comments"><p>A reader says so.</p></div></article>'
    assert html.main_text(page) == "The text of the article, long enough to count."


@pytest.mark.parametrize(
    "start",
    [
        '<div data-title="The hidden valley">', '<div data-overflow="hidden">', '<div data-hidden="false">', '<div data-id="comments">',
        "<div title='class=sidebar'>", '<div data-class=menu x-style="display:none">', '<div style="--display: none; display: block">',
        '<article class="post category-legal tag-cookies">', '<main class="tag-2020-cookies">', '<div class="hentry post post_tag-social type-post">',
    ],
)
def test_what_only_looks_like_a_boilerplate_attribute(start):
    tag = re.match(r"<(\w+)", start)[1]
    assert html.main_text(PAGE % f"{start}{BODY}</{tag}>") == TEXT


@pytest.mark.parametrize(
    "start",
    [
        "<div hidden>", "<div title=x HIDDEN=''>", '<div style="color: red; display : none !important">', "<div aria-hidden=true>", "<div data-x='y'class=sidebar>",
        '<div id="comments" id="content">', '<article class="comment tag-x">', '<div class="category-menu">', '<div class="share&#45;bar">',
    ],
)
def test_boilerplate_attributes(start):
    tag = re.match(r"<(\w+)", start)[1]
    assert html.main_text(f"{start}{BODY}</{tag}>") == ""


LONG = " ".join(["This paragraph tells the story of a place, and it goes on for quite a while, as the text of an article does."] * 3)


@pytest.mark.parametrize(
    "page",
    [
        '<article class="popular-science">%s</article>', '<article id="notice-board-reopens">%s</article>', '<article class="legal">%s</article>',
        '<div class="social-security">%s</div>', '<div class="market-share"><div class="market-share-today" id="weather-alert">%s</div></div>',
        '<main class="legal-content"><article>%s</article></main>', '<div class="single-post comments-open"><article>%s</article></div>',
        '<form id="aspnetForm"><nav>Home</nav><div>%s</div></form>', '<form><div>Menu</div><table><tr><td>%s</td></tr></table><form>Search</form></form>',
        '<article><p class="share-price">' + LONG + "</p>%s</article>", "<p data-x=it's>" + LONG + " It doesn't end.</p>%s",
        '<section class="story">%s</section>', '<div role="main">%s</div>', "<center><font size=2>%s</font></center>",
    ],
)
def test_long_paragraphs_stay(page):
    lines = html.main_text("<html><body>" + page % f"<p>{LONG}</p>").split("\n")
    assert LONG in lines and all(x.startswith("This paragraph") for x in lines)
    assert len(lines) == 1 + page.count(LONG)


@pytest.mark.parametrize(
    "start",
    [
        '<div class="cookie-notice">', '<div class="site-notice">', '<div id="post-comments">', '<div class="social-links">', '<ul class="popular-posts">',
        '<div class="ad-slot-3">', '<div class="sidebar sidebar-left">', '<section class="entry-footer">', '<form action="x">',
    ],
)
def test_compound_names_of_boilerplate(start):
    tag = re.match(r"<(\w+)", start)[1]
    assert html.main_text(f"<p>{LONG}</p><article><p>{LONG}</p></article>{start}<p>{LONG}</p></{tag}>") == f"{LONG}\n{LONG}"


def test_deep_and_doubtful_pages_are_linear():
    begin = time.process_time()
    html.main_text("<div>" * 8000 + "<p>some text here</p>" * 8000)
    html.main_text("<p><table><tr><td>" + "<div>" * 8000 + "text")
    doubtful = {i: 900 if i % 2 else -900 for i in range(8000)}
    chain = {i: {j: 1200 for j in (i - 1, i + 1) if j in doubtful} for i in doubtful}
    html.max_flow_side(doubtful, chain)
    assert time.process_time() - begin < 3


def test_odd_pages(spark):
    rows = [(1, None, "a"), (1, "", "b"), (2, "<<< <p", "c"), (3, "<!-- never closed", "d"), (4, "<p>" + "word " * 50_000, "e")]
    rows += [(5, "<div>" * 3000 + "deep" + "</div>" * 10, "f"), (6, "a < b and b > c &amp; &#65; &nosuch; &#xD800;", "g")]
    rows += [(7, "<p>x</p>" * 3000, "h"), (8, "<script>never closed <p>text</p>", "i")]
    frame = html.extract_text(spark.createDataFrame(rows, "id int, html string, text string"))
    assert frame.columns == ["id", "text"]
    found = [(r.id, r.text) for r in frame.collect()]
    assert found.count((1, "")) == 2 and (3, "") in found and (8, "") in found and len(found) == len(rows)
    assert (4, ("word " * 50_000).strip()) in found
    assert html.extract_text(frame.withColumn("html", F.lit("x")).limit(0)).count() == 0


def test_minimum_cut_is_minimal():
    rng = random.Random(6)
    for _ in range(200):
        n = rng.randint(1, 7)
        odds = [rng.choice([-2, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(n)]
        edges = [(i, j, rng.choice([0.3, 0.8, 1.4])) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(labels, odds=odds, edges=edges):
            own = sum(max(o, 0) if not x else max(-o, 0) for o, x in zip(odds, labels, strict=True))
            return own + sum(w for i, j, w in edges if labels[i] != labels[j])

        best = min(cost(x) for x in product([False, True], repeat=n))
        assert cost(html.min_cut(odds, edges)) == pytest.approx(best)


def test_language_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    truth = dict(duckdb.connect().execute(f"select doc_id, lang from '{folder}/documents.parquet'").fetchall())
    rows = queries.op10_language_id(spark, folder).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 250
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) < 10
    assert {r.doc_id for r in held} == {d for d in truth if __import__("zlib").crc32(str(d).encode()) % 3 == 1}


def test_odd_texts_and_models(spark):
    known = [(i, t, lang, "k") for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr")] * 10)]
    schema = "doc_id long, text string, lang string, score string"
    labelled = spark.createDataFrame([*known, (90, "x", None, "k"), (91, None, "en", "k")], schema)
    model = langid.fit(labelled)
    assert sorted(set(model.langs)) == ["en", "fr"]
    texts = [None, "", " 12 !?", "THE CAT", "le chien", "a", "чужой язык", "the dog " * 400_000]
    frame = spark.createDataFrame([(i, t, None, "k") for i, t in enumerate(texts)], schema)
    rows = {r.doc_id: r for r in langid.identify(frame, model).collect()}
    assert [rows[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and all(rows[i].rejected for i in (0, 1, 2, 6))
    assert [rows[i].lang_pred for i in (3, 4, 7)] == ["en", "fr", "en"] and not rows[7].rejected
    assert langid.identify(frame, model).columns == ["doc_id", "text", "lang", "lang_pred", "score", "rejected"]
    nothing = langid.fit(labelled.limit(0))
    assert {(r.lang_pred, r.rejected) for r in langid.identify(frame, nothing).collect()} == {("und", True)}
    assert langid.identify(frame.limit(0), model).count() == 0


def test_only_letters_make_a_language(spark):
    """Fractions, circled digits, powers and Roman numerals are no letters, in training or prediction."""
    no, yes = ["½", "①②", "²", "Ⅳ Ⅸ", "٣", "😀", "_-_"], ["½a", "é", "ª", "中", "1st"]
    assert not any(map(langid.has_letter, no)) and all(map(langid.has_letter, yes)) and not langid.has_letter(None)
    frame = spark.createDataFrame(list(enumerate(no + yes)), "doc_id long, text string")
    model = langid.fit(frame.withColumn("lang", F.when(F.col("doc_id") < len(no), "xx").otherwise("en")))
    assert set(model.langs) == {"en"}
    found = {r.doc_id: r.lang_pred for r in langid.identify(frame, model).collect()}
    assert [found[i] for i in range(len(found))] == ["und"] * len(no) + ["en"] * len(yes)


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGS", 5)
    frame = spark.createDataFrame([(i, "some text", f"l{i}") for i in range(6)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="over 5"):
        langid.fit(frame)
    assert len(set(langid.fit(frame.where("doc_id < 5"), train_docs=2).langs)) == 5


def test_the_sample_is_bounded(spark):
    rows = [(1, f"word{i} and more", "en") for i in range(500)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), train_docs=20)
    assert set(model.langs) <= {"en"}


@pytest.mark.parametrize("withheld", ["de", "en", "es", "fr"])
def test_an_unknown_language_is_rejected(spark, withheld):
    """One language is withheld, and each of the others has labelled junk without letters."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    junk = spark.createDataFrame([(-i, t, lang) for i, t in enumerate(["", "12 34", "?! --", "—"], 1) for lang in ("de", "en", "es", "fr")], docs.schema)
    known = F.crc32(F.col("doc_id").cast("string")) % 2 == 1
    model = langid.fit(docs.where(known).union(junk).where(F.col("lang") != withheld), train_docs=4096)
    rows = langid.identify(docs.where(~known), model).collect()
    others = [r for r in rows if r.lang != withheld]
    unknown = [r for r in rows if r.lang == withheld and len(r.text) > 500]
    assert sum(r.lang_pred == r.lang for r in others) > 0.97 * len(others)
    assert sum(r.rejected for r in others) <= 0.02 * len(others)
    assert len(unknown) > 20 and sum(r.rejected for r in unknown) > 0.95 * len(unknown)


def test_every_language_is_learned(spark):
    """Hundreds of languages with few sampled rows each; many rows are copies of one another."""
    rows = [(i, f"word{chr(97 + i % 26)} and {i}", f"l{i % 300}") for i in range(6000)] + [(7, "copy of one text", "l7")] * 3000
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.fit(frame, train_docs=600)
    assert set(model.langs) == {f"l{i}" for i in range(300)}
