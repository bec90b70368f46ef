import re
import time
from html.parser import HTMLParser

import pytest

from casewright.llm import html_text
from casewright.llm.queries import QUERIES


class Article(HTMLParser):
    """The blocks inside <article>, by the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag == "br":
            self.handle_data(" ")
        if tag in ("p", "h1", "article"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_query(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op8_html_extraction"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        plain = Article()
        plain.feed(pages[r.page_id].html)
        plain.close()
        assert r.text == "\n".join(x for b in plain.blocks if (x := " ".join(b.split()))), r.page_id
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


LONG = "This is a sentence of the article with enough words in it to matter. "


def test_parts_beside_the_text():
    page = f"""<!DOCTYPE html><html><head><title>t</title><style>p {{}}</style></head><body class="nav-open">
      <header><a href="/">Home</a> Site name of some length that is not in the article at all</header>
      <nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav><div class="cookie-notice"><p>{LONG}</p></div>
      <div role="search"><form><input><label>Find</label></form></div>
      <article><header><h1>The &amp; title</h1></header><p>{LONG}<b>bold</b><i>er</i> x &lt; y<p>Short.<script>var x = "</p><p>no</p>";</script>
      <div class="ad">Buy <p>now {LONG}</p></div><ul><li>first<li>second   item&nbsp;here</ul><!-- <p>no</p> -->
      <aside>{LONG}</aside><table><tr><td>a<td>b</table>Loose text<br>next line
      <div id="comments"><article class="comment"><p>{LONG}</p></article></div></article>
      <div class="sidebar">{LONG}</div><footer>{LONG}</footer></body></html>"""
    assert html_text.main_text(page) == "\n".join(["The & title", LONG + "bolder x < y", "Short.", "first", "second item here", "a", "b", "Loose text next line"])


def test_without_an_article():
    page = f"<body><div class=menu>{LONG}</div><div><a href=1>{LONG}</a></div><div>x</div><div></div><h1>Title</h1>" + f"<p>{LONG * 3}</p>" * 4 + f"<div class='social share'>{LONG}</div>" + "<div>&copy; me</div>"
    text = html_text.main_text(page)
    assert text.startswith("x\nTitle\nThis is" ) or text.startswith("Title\nThis is")
    assert text.count(LONG.strip()) == 12 and "me" not in text.splitlines()


def test_broken_and_empty_pages(spark):
    pages = ["", None, "plain text only", "a < b and c > d", "<p>cut of<b", "<p>open <!-- comment", "<script>never closed <p>x</p>", "<article><p>fine &am", "<<p>>x", "<p title='a>b'>quoted</p>", "</div></p>x",
             "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "<article>" + "word " * 100_000 + "</article>"]
    rows = [(i, h, "u", "old", 5) for i, h in enumerate(pages)] + [(2, pages[2], "u", "old", 5)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, html string, url string, text string, __n int")).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and got[0].__fields__ == ["page_id", "url", "__n", "text", "n_chars"]
    assert texts[0] == texts[1] == texts[6] == "" and texts[2] == "plain text only" and texts[3] == "a < b and c > d"
    assert texts[4] == "cut of" and texts[5] == "open" and texts[7] == "fine &am" and texts[9] == "quoted" and texts[10] == "x" and texts[11] == "deep"
    assert len(texts[12]) == 499_999
    assert html_text.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_short_sections_and_closing_lines_stay():
    adverts = "<div class='ad'>Buy now</div>" * 4
    page = f"<body>{f'<p>{LONG * 5}</p>' * 4}<p>One.</p><p>Two.</p><p>Three.</p><p>The end.</p>{adverts}<p>{LONG}</p>{adverts}<div><a href=x>{LONG}</a></div></body>"
    assert html_text.main_text(page).splitlines() == [(LONG * 5).strip()] * 4 + ["One.", "Two.", "Three.", "The end.", LONG.strip()]


def test_a_teaser_is_not_the_article():
    page = f"<body><div>{f'<p>{LONG}</p>' * 8}</div><article class='teaser'><p>Read this too.</p></article></body>"
    assert html_text.main_text(page).splitlines() == [LONG.strip()] * 8 + ["Read this too."]


def test_a_form_around_the_page_and_names_of_states():
    body = f"<p>{LONG}</p>" * 3
    text = [LONG.strip()] * 3
    for name in ("aspnetForm", "form1"):
        assert html_text.main_text(f"<body><form id='{name}'><input>{body}</form></body>").splitlines() == text
    assert html_text.main_text(f"<body>{body}<form><p>Your name, please, and all of your address in full in this line</p></form></body>").splitlines() == text
    for name in ("no-sidebar", "has-header", "content with-sidebar", "search-results", "post-content no-comments"):
        assert html_text.main_text(f"<body><div class='{name}'>{body}</div></body>").splitlines() == text, name
    assert html_text.main_text(f"<body><div class='entry-header'><h1>Title</h1></div>{body}</body>").splitlines() == ["Title", *text]
    for name in ("sidebar", "x site-header", "ad-box2", "post-comments", "cookie-notice"):
        assert html_text.main_text(f"<body>{body}<div class='{name}'>{LONG}</div></body>").splitlines() == text, name


def test_without_the_article_tag(spark, sf):
    """The same pages with a div in the article's place: the distribution of text has to find the article's text by itself."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    for r in pages:
        plain = Article()
        plain.feed(r.html or "")
        plain.close()
        want = "\n".join(x for b in plain.blocks if (x := " ".join(b.split())))
        assert html_text.main_text(re.sub(r"<(/?)article\b[^>]*>", r"<\1div>", r.html or "")) == want, r.page_id


def test_closing_lines_headlines_and_anchors():
    body, text = f"<p>{LONG}</p>" * 4, [LONG.strip()] * 4
    adverts = "<div class='ad'>Buy now</div>"
    assert html_text.main_text(f"<body>{body}{adverts * 3}<p>The end. Thanks.</p></body>").splitlines() == [*text, "The end. Thanks."]
    for top in ("<body>", "<article>"):
        assert html_text.main_text(f"{top}<h1><a href='x'>The headline</a></h1>{body}").splitlines() == ["The headline", *text]
        for anchor in ("<a name='top'>", "<p><a href=x>", "<a name=a><a id=b>"):
            assert html_text.main_text(f"{top}{anchor}{body}").splitlines() == text
    assert html_text.main_text(f"<a href=x><div><p>{LONG}</p></div></a>" + body).splitlines() == text


def test_lists_of_links_are_dives_also_in_an_article():
    body, links = f"<p>{LONG}</p>", "<ul>" + "".join(f"<li><a href={i}>Link {i}</a>" for i in range(3)) + "</ul>"
    for top in ("body", "article"):
        page = f"<{top}>{links}{body}<p><a href=x>One link</a></p>{body}{links}<p>Yes.</p>{links}</{top}>"
        assert html_text.main_text(page).splitlines() == [LONG.strip(), "One link", LONG.strip(), "Yes."]


@pytest.mark.parametrize("weights, want", [([], []), ([0, 0], []), ([5], [(0, 1)]), ([0, 5, 0, 0, 1], [(1, 5)]), ([0, 5, 0, 0, 0, 1], [(1, 2), (5, 6)]), ([1, 0, 2, 0, 0, 0, 0, 3, 4], [(0, 3), (7, 9)])])
def test_stretches(weights, want):
    assert [(r.start, r.stop) for r in html_text.stretches(weights)] == want


def test_deep_nesting_takes_time_in_proportion():
    start = time.process_time()
    assert html_text.main_text("<div>" * 200_000 + "deep" + "</div>" * 200_000) == "deep"
    assert html_text.main_text("<section><b>" * 100_000 + "open") == "open"
    assert time.process_time() - start < 60
