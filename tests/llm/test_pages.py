"""Main text of pages."""

import time

import pytest

from strata.llm import pages

LONG = "The river ran under the old bridge, past the mill, and on to the sea. " * 3

SITE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no";</script></head>
<body class="has-sidebar"><header><a href="/">Site</a></header>
<nav><ul><li><a href="/a">News</a></li><li><a href="/b">Sport</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, please agree, thank you very much indeed for that.</p></div>
<div id="content"><article><h1>A &amp;amp; title</h1>
<p>First{LONG}</p><!-- note --><div class="ad">Buy now, buy here, buy cheap.</div>
<p>Second &eacute;&nbsp;&#233; <b>bold</b> and <a href="x">link</a>,<br>after   a break. {LONG}</p>
<ul><li>Point one</li><li>Point two</ul><form><p>Your name?</p></form>
<aside><p>Related: {LONG}</p></aside></article></div>
<div class="comments"><p>Great article, {LONG}</p></div>
<footer><p>&copy; Site, all rights reserved.</p></footer></body></html>"""


def blocks(page):
    return pages.main_text(page).split("\n\n") if pages.main_text(page) else []


def test_article_alone_is_kept():
    found = blocks(SITE)
    assert found[0] == "A &amp; title"
    assert found[1] == " ".join(f"First{LONG}".split())
    assert found[2].startswith("Second é é bold and link, after a break. The river")
    assert found[3:] == ["Point one", "Point two"]


@pytest.mark.parametrize("page", [None, "", " \n", "<p>", "<", "<!-- only", "<script>x", "<nav><p>menu</p></nav>"])
def test_pages_without_text(page):
    assert pages.main_text(page) == ""


def test_text_without_markup():
    assert pages.main_text("just  a\nline") == "just a line"


@pytest.mark.parametrize("cut", range(0, len(SITE), 97))
def test_pages_may_end_anywhere(cut):
    text = pages.main_text(SITE[:cut])
    assert "<" not in text and "Buy now" not in text and "Great article" not in text


def test_unclosed_and_misnested_elements():
    page = f"<article><h1>T</h1><p><b>One {LONG}<br><p>Two {LONG}</b></p><p>Three</article><footer>&copy; x"
    assert [b.split()[0] for b in blocks(page)] == ["T", "One", "Two", "Three"]


def test_containers_without_names_are_found_by_their_points():
    links = "".join(f'<div><a href="/{i}">Link number {i}</a></div>' for i in range(30))
    page = f"<body><div>{links}</div><div><div><p>{LONG}</p><p>{LONG}</p><p>Short.</p></div></div></body>"
    found = blocks(page)
    assert len(found) == 3 and found[2] == "Short."


def test_siblings_that_look_like_text_are_kept():
    parts = "".join(f"<section><p>{LONG * 2} {i}</p><p>{LONG}</p></section>" for i in range(3))
    assert len(blocks(f"<body><main>{parts}</main></body>")) == 6


def test_all_of_the_article_around_the_best_container_is_kept():
    body = f"<div><p>{LONG}</p><p>{LONG}</p></div>"
    short = "<section><h2>More</h2><p>It rained.</p><p>Nobody came.</p></section>"
    links = '<ul><li><a href="/a">Other news</a></li><li><a href="/b">More news</a></li><li>Now</li></ul>'
    head = '<h1><a href="/">Title</a></h1><p>Short lead.</p>'
    long = " ".join(LONG.split())
    expected = ["Title", "Short lead.", long, long, "More", "It rained.", "Nobody came."]
    for page in (
        f"<article>{head}{body}{short}{links}</article>",
        f"<main>{head}<article>{body}{short}</article>{links}</main>",
        f"<main><article>{head}{body}{short}</article><article><p>Another one.</p></article></main>",
    ):
        assert blocks(f"<body>{page}<p>Buy now.</p></body>")[: len(expected)] == expected
        assert not {"Other news", "Now", "Another one."} & set(blocks(f"<body>{page}</body>"))
    assert blocks(f"<body><div><h1>Title</h1><p>Short lead.</p>{body}</div></body>") == ["Title", "Short lead.", long, long]
    sections = f"<section><p>{LONG * 6}</p><p>{LONG * 6}</p></section>{short}"
    assert blocks(f"<body><main>{sections}</main></body>")[2:] == expected[4:]


@pytest.mark.parametrize(
    "attributes",
    ['class="content with-sidebar"', 'id="page" class="header-fixed"', 'class="sidebar-left layout"', 'class="sidebar"'],
)
def test_names_do_not_cut_what_holds_the_article(attributes):
    long = " ".join(LONG.split())
    comments = f'<div class="comments"><article><p>Me too.</p></article><p>{LONG}</p></div>'
    inner = f"<h1>Title</h1><p>{LONG}</p><p>{LONG}</p>"
    for page in (f"<article>{inner}</article>", f"<main>{inner}</main>", f"<div>{inner}</div>"):
        assert blocks(f"<body><div {attributes}>{page}</div></body>") == ["Title", long, long]
    assert blocks(f"<body><div {attributes}><article>{inner}</article>{comments}</div></body>") == ["Title", long, long]


def test_names_inside_articles():
    long = " ".join(LONG.split())
    page = f"""<article><div class="article-header"><h1>Title</h1></div><p>{LONG}</p>
    <section class="share-prices"><h2>Prices</h2><p>They fell.</p></section>
    <div class="share-buttons"><a href="/x">Share</a></div><div class="related-posts"><p>Read on.</p></div>
    <p>Mass is <math><semantics><mi>m</mi><annotation encoding="TeX">m_0</annotation></semantics></math> here.</p></article>"""
    assert blocks(page) == ["Title", long, "Prices", "They fell.", "Mass is m here."]
    banner = f'<article><div class="banner"><h1>Title</h1></div><p>{LONG}</p></article>'
    assert blocks(banner) == ["Title", long]


def test_names_count_as_whole_words_only():
    assert blocks(f'<body><div class="shadows adventure"><p>{LONG}</p></div></body>') == [" ".join(LONG.split())]


def test_deep_and_long_pages_take_time_in_proportion():
    began = time.perf_counter()
    deep = "<div>" * 20_000 + f"<p>{LONG}</p>" + "x</div>" * 20_000
    assert "river" in pages.main_text(deep)
    assert "river" in pages.main_text("<b>" * 20_000 + f"<p>{LONG}" * 2_000)
    assert pages.main_text("<p a='" + "x" * 200_000) == ""
    assert time.perf_counter() - began < 30


def test_page_table(spark):
    rows = [(1, "u", SITE, "x"), (1, "u", SITE, "x"), (None, None, None, None), (2, "v", "", "y")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, _key string")
    found = sorted(pages.page_texts(table).collect(), key=str)
    assert [r.n_chars for r in found] == [len(r.text) for r in found]
    assert sorted(str(r.page_id) for r in found) == ["1", "1", "2", "None"]
    assert pages.page_texts(table.limit(0)).count() == 0
