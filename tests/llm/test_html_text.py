"""Main text of pages: the given pages against an independent parser, page shapes the tables lack, broken markup."""

import time
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF_MID, SF_SMALL
from tables import awkward, write

from shopsignal.llm import html_text
from shopsignal.llm.html_text import main_text
from shopsignal.llm.queries import QUERIES

PROSE = "It was the best of times and it was the worst of times, for that is the way of things in this city of ours."


class Article(HTMLParser):
    """Texts of p and h1 elements inside <article>, the library's parser doing the work."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.found = False, [[]]

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        if tag in ("p", "h1", "article"):
            self.found.append([])
        elif tag == "br":
            self.found[-1].append(" ")

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        if tag in ("p", "h1", "article"):
            self.found.append([])

    def handle_data(self, data):
        if self.inside:
            self.found[-1].append(data)


def expected(page):
    parser = Article()
    parser.feed(page)
    parser.close()
    texts = (" ".join("".join(x).split()) for x in parser.found)
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("folder", [SF_SMALL, SF_MID])
def test_given_pages(spark, folder):
    pages = pq.read_table(f"{folder}/pages.parquet").to_pylist()
    got = {r["page_id"]: r for r in QUERIES["op11_html_text"](spark, folder).collect()}
    assert len(got) == len(pages)
    for p in pages:
        text = expected(p["html"])
        r = got[p["page_id"]]
        assert (r["text"], r["n_chars"], r["url"]) == (text, len(text), p["url"])


def test_page_without_an_article_goes_by_density_and_neighbours():
    page = f"""<html><body><div id="top"><a href="/">Home</a> | <a href="/x">News</a></div>
    <div><h2>A short heading</h2><div>{PROSE}</div><p>Yes.</p><p>{PROSE} Again.</p></div>
    <div><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></div><div>&copy; 2024 the owner of this and of that</div></body></html>"""
    assert main_text(page).split("\n") == ["A short heading", PROSE, "Yes.", f"{PROSE} Again."]


def test_boilerplate_around_and_inside_an_article():
    page = f"""<body class="with-sidebar"><header><h1>The Site</h1><p>{PROSE}</p></header>
    <div class="cookie-notice"><p>{PROSE}</p></div><form action=/s><label>Search the site</label><input name=q><button>Go</button></form>
    <main><article class="post has-comments"><header><h1>Title</h1></header><p>{PROSE}</p>
    <div class="ad-slot">Buy this</div><aside>{PROSE}</aside><p>Short &amp; true.<br>Next&nbsp;line</p>
    <table><tr><td>Cell one<td>Cell two</table><ul><li>First<li>Second</ul>
    <blockquote>Said so</blockquote><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul><p><a href=/more>Read on</a></p>
    <section id="reader-comments"><article class="comment"><p>{PROSE}</p></article></section></article></main>
    <div class="sidebar"><p>{PROSE}</p></div><p>{PROSE}</p><footer><p>{PROSE}</p></footer></body>"""
    assert main_text(page).split("\n") == [
        "Title", PROSE, "Short & true. Next line", "Cell one", "Cell two", "First", "Second", "Said so", "Read on"]


def test_form_around_the_whole_page():
    assert main_text(f"<form><nav>Menu</nav><article><p>{PROSE}</p></article><p>Send</p></form>") == PROSE


@pytest.mark.parametrize("page,text", [
    ("", ""), ("   \n", ""), (f"<p>{PROSE}", PROSE), (f"<p>{PROSE}</p><p>a < b and c > d", f"{PROSE}\na < b and c > d"),
    (f"<article><p>{PROSE}<!-- never closed <p>lost", PROSE), (f"<article><p>{PROSE}<p class='x", PROSE),
    (f"<article><p>{PROSE}</p><script>if (a</p>b) '<p>x</p>'", PROSE),
    (f"<article></div></p></li><p>{PROSE}</article></article>", PROSE),
    ("<article><p>one<p>two</article>", "one\ntwo"), ("<article>&#x41;&lt;b&gt;&zzz; &eacute</article>", "A<b>&zzz; é"),
    ("<ARTICLE><P>Loud</P></ARTICLE>", "Loud"), ("<title>Only</title>", ""), ("<nav><p>" + PROSE + "</p></nav>", ""),
    ("<p>just a few words</p>", "just a few words"),
])
def test_broken_and_small_pages(page, text):
    assert main_text(page) == text


def test_long_pages_take_linear_time():
    n = 200_000
    for page in ("<div>" * n + "x", "<p>a" * n, "</b></i></div>" * n, "<a href='" * n, "<" * n, "&" * n, "<!--" * n,
                 "<ul>" + "<li>x" * n, "<script>" * n, "x" * 10 * n, "<table>" + "<tr><td>x" * n):
        begun = time.monotonic()
        main_text(f"<article><p>{PROSE}</p>{page}")
        assert time.monotonic() - begun < 20


def test_null_html_and_clashing_columns(spark):
    rows = spark.createDataFrame(
        [(1, None, "old", 5, "z"), (2, f"<p>{PROSE}</p>", "old", 6, "y"), (2, f"<p>{PROSE}</p>", "old", 6, "y"), (None, "", None, None, None)],
        "page_id bigint, HTML string, Text string, n_chars int, __html string")
    got = html_text.extract(rows, "html")
    assert got.columns == ["page_id", "__html", "text", "n_chars"]
    assert sorted(map(repr, got.collect())) == sorted(
        f"Row(page_id={p}, __html={h!r}, text={t!r}, n_chars={len(t)})" for p, h, t in
        [(1, "z", ""), (2, "y", PROSE), (2, "y", PROSE), (None, None, "")])


def test_awkward_texts(spark, tmp_path):
    docs = awkward()
    folder = write(tmp_path / "pages", docs)
    got = QUERIES["op11_html_text"](spark, folder).collect()
    assert len(got) == len(docs) and all(r["n_chars"] == len(r["text"]) for r in got)
