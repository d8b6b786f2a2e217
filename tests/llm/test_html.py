"""Main texts of the given pages and of pages of other kinds."""

import html
import re
import time
from collections import Counter

import pytest

from tradeloom.llm.html import count_kinds, extract, learn_weights, main_text, op2_html_extraction, tokens, weights

SF = "/root/testdata/sf0.01"


def article_of(page):
    """The article of a page of the given tables, whose markup is regular."""
    part = page[page.index("<article>") + 9 : page.index("</article>")]
    part = re.sub(r"</?(?:p|h1)>", "\0", part.replace("<b>", "").replace("</b>", ""))
    lines = [" ".join(html.unescape(re.sub(r"<[a-z/!][^>]*>", " ", p)).split()) for p in part.split("\0")]
    return "\n".join(line for line in lines if line)


@pytest.fixture(scope="module")
def known(spark):
    return learn_weights(spark.read.parquet(f"{SF}/pages.parquet"))


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op2_html_extraction(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, article_of(pages[r.page_id].html), len(r.text))


STORY = ["The river rose again last night, and the lower road was closed to all traffic until noon.",
         "Council members met early; they agreed on sand bags &amp; pumps for 1 &lt; 2 streets.",
         "By evening the water had fallen by half a metre, says the gauge at the old mill."]
TEXT = [html.unescape(s) for s in STORY]


@pytest.mark.parametrize("page, expected", [
    # no article element: only the parts' names tell
    ("<html><head><title>T</title></head><body><div id='header'>Site name and slogan for all readers</div><ul class=menu><li><a href=/>Home page</a></ul>"
     "<div class='content'><h1>Flood</h1>{0}</div><div class='sidebar'><p>Most read stories of the week in town</p></div><div id=footer>&copy; all rights reserved by us</div></body>",
     "Flood\n{0}"),
    # parts inside the article
    ("<main><header><h1>Flood</h1></header>{0a}<aside><p>Sign up now for letters from us</p></aside><div class='ad-slot'>Buy boots today, half price</div>{0b}"
     "<section id='comments'><h3>Comments</h3><p>I was there, it was bad and it was cold and wet.</p></section></main><p>Imprint and other things</p>",
     "Flood\n{0}"),
    # forms, scripts, styles and remarks
    ("<body><nav>One Two Three</nav><article><script>if (a < b) document.write('<p>No</p>')</script>{0a}<form><label>Name</label><input><p>Send us a message</p></form>"
     "<style>p > b {{ color: red }}</style><!-- <p>old text of a remark</p> --><noscript>Turn scripts on</noscript>{0b}</article>",
     "{0}"),
    # a list, a table and links within the article
    ("<article>{0a}<ul><li>sand <a href='/x'>bags</a></li><li>two<br>pumps</li></ul><table><tr><td>mill</td><td>1.2 m</td></tr></table>{0b}</article>",
     "{a}\nsand bags\ntwo pumps\nmill\n1.2 m\n{b}"),
    # states of containers, the article's own header, a comment that is an article
    ("<body class='has-sidebar comments-open'><main class='with-ads'><article class='post no-comments'><div class='post-header'><h1>Flood</h1></div>{0}"
     "<p class='byline'>By our own reporter</p></article><article class='comment'><p>I was there and I saw all of it happen.</p></article></main>",
     "Flood\n{0}\nBy our own reporter"),
    # attributes with > and capital tags, unclosed elements
    ("<BODY><DIV CLASS='cookie-notice' data-x='a>b'>We use cookies on this site</DIV><ARTICLE>{0u}", "{0}"),
])
def test_other_pages(known, page, expected):
    p = [f"<p class=\"x>y\">{s}</p>" for s in STORY]
    page = (
        page.replace("{0a}", p[0]).replace("{0b}", "".join(p[1:])).replace("{0u}", "".join(q.removesuffix("</p>") for q in p))
        .replace("{0}", "".join(p)).replace("{{", "{").replace("}}", "}"))
    expected = expected.replace("{0}", "\n".join(TEXT)).replace("{a}", TEXT[0]).replace("{b}", "\n".join(TEXT[1:]))
    assert main_text(page, known) == expected


def test_the_stretch_has_the_highest_sum():
    """Against trying all stretches, with weights that differ by kind."""
    import random

    from tradeloom.llm import html as module

    rng = random.Random(8)
    known = {"word p": 1.0, "word div": 0.4, "tag p": -0.7, "tag div": -2.0, "tag inline": -1.3, "word body": 0.9, "word p off": -2.0}
    for _ in range(60):
        page = "".join(rng.choice(["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "one ", "two words "]) for _ in range(14))
        items = list(module.pieces(page))
        scores = [(len(t.split()) if k.startswith("word") else 1) * module.weight(known, k) for k, t, *_ in items]
        best = max([0.0] + [sum(scores[i:j]) for i in range(len(items)) for j in range(i + 1, len(items) + 1)])
        chosen = main_text(page, known)
        options = {""}
        for i in range(len(items) + 1):
            for j in range(i, len(items) + 1):
                if abs(sum(scores[i:j]) - best) < 1e-9:
                    part = "\n".join("" if b else t for _, t, b, _ in items[i:j])
                    options.add(" ".join(part.split()))
        assert " ".join(chosen.split()) in options


def test_odd_rows(spark, known):
    pages = [(1, None, "u"), (2, "", None), (3, "plain words only", "u"), (4, "<", "u"), (5, "<p>a<p>b", "u"), (6, "<article></article>", "u"),
             (6, "<article></article>", "u"), (None, "<script>never closed <p>x</p>", "u"), (8, "<p>" + "long word &eacute; " * 60_000, "u"), (9, "<div>" * 5000 + "deep", "u")]
    df = spark.createDataFrame(pages, "page_id bigint, html string, text string")
    rows = extract(df, known).collect()
    assert len(rows) == len(pages) and set(rows[0].asDict()) == {"page_id", "html", "text", "n_chars"}
    by_html = {r.html: r for r in rows}
    assert all(r.n_chars == len(r.text) for r in rows)
    assert by_html[None].text == by_html[""].text == by_html["<article></article>"].text == ""
    assert by_html["plain words only"].text == "plain words only" and by_html["<p>a<p>b"].text == "a\nb"
    assert by_html[pages[8][1]].text == "long word é " * 59_999 + "long word é"
    assert extract(df.limit(0), known).collect() == []


def test_without_labelled_pages(spark):
    none = spark.createDataFrame([("<p>no article here</p>",), (None,)], "html string")
    assert learn_weights(none) == {} and weights(Counter()) == {} and count_kinds("<p>x</p>") == Counter()
    assert main_text("<nav>Menu here</nav><p>Some words of text</p>", {}) == "Some words of text"


@pytest.mark.parametrize("page", [
    "<a " * 333_000, "<a" * 500_000, "<![CDATA[" * 111_000, "<b>x " * 200_000, "<b>" * 160_000 + "</i>" * 160_000,
    "<a \"" * 250_000, "<a '\"" * 200_000, "<a \"'" * 200_001 + ">", "<!" * 500_000, "</a " * 250_000, "<p class=\"" * 100_000,
], ids=lambda page: page[:9])
def test_malformed_pages_take_linear_time(page):
    start = time.perf_counter()
    main_text(page, {})
    assert time.perf_counter() - start < 15


@pytest.mark.parametrize("page, expected", [
    ("a < b", ["a ", "<", " b"]),
    ("<a 'x>y\" z>t", ["<", "a 'x>y\" z>t"]),
    ("<a b='>' c>t</A >", [("", "a", " b='>' c"), "t", ("/", "a", " ")]),
    ("<![CDATA[ <p> ]]>t<![CDATA[ <p>u", ["t", "u"]),
    ("<!doctype html>t<!open", ["t", "<", "!open"]),
    ("t<!-- <p> --><br/>u<!-- <p>", ["t", ("", "br", "/"), "u"]),
])
def test_tokens(page, expected):
    assert [text if name is None else (text, name, rest) for text, name, rest in tokens(page)] == expected


def test_numeric_references_of_any_length():
    assert main_text("<p>x &#" + "9" * 6000 + "; &#000065; &#x42;</p>", {}) == "x � A B"
