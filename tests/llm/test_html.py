import html
import re

from ledgerlens.llm import html_extract
from ledgerlens.llm.queries import op1_html_extraction

PAGE = """<html><head><title>x</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><a href=/>home</a></header><div id="mainMenu"><a href=1>One</a> <a>Two</a></div>
<div class="content"><h2>Title here</h2><p>Para one is long enough to be counted, surely &amp; more &lt;b&gt;.</p>
<div class="notice">Subscribe now to this very long notice with a lot of words in it.</div><p>Short.</p>
<script>var t = "</p><p>no";</script><ul><li>item one<li>item two</ul><blockquote>A quote that matters</blockquote>
<p>Another long paragraph\n\tfollows  here&nbsp;with many <b>bold <i>words</i></b>, and<br>a second line</div>
<div class="sidebar"><p>Some long sidebar text that reads like content but is not content at all.</p></div>
<section id="comments"><div class="comment"><p>A reader comment with long text that looks like an article.</p></div></section>
<form><p>Your email and a long explanation of why</p></form><footer>Copyright 2024</footer></body></html>"""


def test_page_without_article_element():
    assert html_extract.main_text(PAGE) == "\n\n".join([
        "Title here", "Para one is long enough to be counted, surely & more <b>.", "Short.", "item one", "item two",
        "A quote that matters", "Another long paragraph follows here with many bold words, and a second line"])


def test_article_with_own_header_and_comments_as_articles():
    page = ("<main><article class='post'><header><h1>Head</h1></header><p>One text of some length here.</p><p>Two.</p>"
            "<aside>By the way</aside></article><article class='comment'><p>A very long comment " + "x " * 200
            + "</p></article></main><nav><p>" + "menu " * 100 + "</p></nav>")
    assert html_extract.main_text(page) == "Head\n\nOne text of some length here.\n\nTwo."


def test_odd_pages():
    for page, want in ((None, ""), ("", ""), ("just text", "just text"), ("<nav>menu</nav>", ""), ("<p>a<p>b<script>x<", "a\n\nb"),
                       ("<p>&#233;&eacute;&bogus;</p>", "éé&bogus;"), ("<!-- c --><p>t</p", "t"), ("<p>" + "w " * 50_000, ("w " * 50_000).strip())):
        assert html_extract.main_text(page) == want


def test_smoothing_keeps_a_constant_and_spreads_a_peak():
    assert abs(html_extract.smoothed(html_extract.np.ones(9)) - 1).max() < 1e-12
    peak = html_extract.smoothed(html_extract.np.array([0, 0, 0, 9.0, 0, 0, 0]))
    assert peak[3] > peak[2] == peak[4] > peak[1] > 0


def test_query_equals_the_article_element(spark):
    """The test pages' articles, cut by pattern and stripped of tags."""
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op1_html_extraction(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_edge_rows(spark):
    pages = spark.createDataFrame([(1, None, None, 3), (None, "u", "<p>x</p>", None), (2, "u", "", 1), (2, "u", "", 1)],
                                  "page_id long, url string, html string, text int")
    assert sorted(map(str, html_extract.extract(pages).collect())) == sorted(map(str, html_extract.extract(
        pages.repartition(3)).collect()))
    assert {(r.page_id, r.text) for r in html_extract.extract(pages).collect()} == {(1, ""), (None, "x"), (2, "")}
    assert html_extract.extract(pages.limit(0)).count() == 0


LONG = "<p>" + "A sentence of the long section that goes on for a while. " * 40 + "</p>"
SHORT = "<p>A short section of two sentences. It belongs to the article as well.</p>"
FOOT = "<div><a href=/>Home</a> <a href=/b>More pages</a></div>"


def paragraphs(page):
    return [" ".join(x.split()) for x in re.findall("<(?:p|h2)[^>]*>(.*?)</(?:p|h2)>", page)]


def test_uneven_sections_all_stay():
    for parts in ([LONG, SHORT], [SHORT, LONG], [LONG + LONG, SHORT, LONG], [SHORT, LONG * 3, "<h2>End</h2>" + SHORT]):
        for tag in ("div", "section"):
            page = "<body><div id=content>" + "".join(f"<{tag}>{p}</{tag}>" for p in parts) + f"</div>{FOOT}</body>"
            assert html_extract.main_text(page).split("\n\n") == paragraphs(page)
    table = f"<table><tr><td>{LONG}</td><td>{SHORT}</td></tr></table>"
    assert html_extract.main_text(table).split("\n\n") == paragraphs(table)


def test_a_teaser_article_does_not_replace_the_text():
    middle = "<p>" + "Words of a middling paragraph. " * 10 + "</p>"
    page = f"<body><div><div>{middle * 5}</div><div>{middle * 4}{SHORT}</div></div><article class=card>{middle}</article></body>"
    assert html_extract.main_text(page).split("\n\n")[:10] == paragraphs(page)[:10]


def test_sibling_articles_all_stay():
    page = f"<body><div>{FOOT}<ul><li><article>{LONG}{SHORT}</article><li><h2>Next</h2><article>{SHORT}</article></ul></div></body>"
    assert html_extract.main_text(page).split("\n\n") == paragraphs(page)


def test_names_made_from_headings_lose_nothing():
    for part in (f"<section id=discussion><h2>Discussion</h2>{SHORT}</section>", f"<h2 id=related-work>Related work</h2>{SHORT}",
                 f"<h2 id=search-algorithms>Search algorithms</h2>{SHORT}", f"<p id=privacy>{SHORT[3:]}",
                 f"<div class=section id=privacy><h2>Privacy</h2>{SHORT}</div>", f"<p class=discussion>{SHORT[3:]}"):
        page = f"<body><article>{LONG}{part}{LONG}</article>{FOOT}</body>"
        assert html_extract.main_text(page).split("\n\n") == paragraphs(page), part


def test_wrappers_of_the_main_text_are_not_marked():
    for name in ("content-sidebar-wrap", "with-sidebar", "page sidebar", "has_widgets"):
        for inner in (f"<article>{SHORT}{LONG}</article>", f"<main>{SHORT}</main>", f"<div>{SHORT}{LONG}</div>"):
            page = f"<body><div class='{name}'>{inner}<div class=sidebar>{SHORT}</div></div>{FOOT}</body>"
            assert html_extract.main_text(page).split("\n\n") == paragraphs(inner), (name, inner)


def test_parts_beside_the_article_are_still_marked():
    for name in ("class=sidebar", "class='page-footer'", "id=mainMenu", "id=comments", "class=related", "class='has-x sidebar-1'"):
        for inner in (SHORT, f"<article class=card>{SHORT}</article>"):
            page = f"<body><div><div {name}>{inner}</div><article>{LONG}</article></div></body>"
            assert html_extract.main_text(page).split("\n\n") == paragraphs(LONG), (name, inner)


def test_an_advert_longer_than_the_article_stays_marked():
    page = f"<body><div class=ad>{SHORT}{SHORT}</div><article><h2>Head</h2><p>Two words.</p></article></body>"
    assert html_extract.main_text(page) == "Head\n\nTwo words."


TEXT = "<p>" + "A plain paragraph that says enough to be counted. " * 4 + "</p>"


def flat(monkeypatch):
    """Every unmarked line counts as content: no ratio, no smoothing, no threshold."""
    def all_lines(lines):
        shown = html_extract.np.array([not x.beside for x in lines])
        return shown, shown, [x.chars if s else 0 for x, s in zip(lines, shown)]

    monkeypatch.setattr(html_extract, "clustered", all_lines)


CLUSTERED = {
    "three divs": f"<body><div>Subscribe now</div><div>{TEXT}<p>Short.</p>{TEXT}</div><div>Call us</div><div>Opening hours</div></body>",
    "flat page": f"<body><p>Home</p><p>Login</p>{TEXT}<p>Short.</p>{TEXT}<p>Copyright 2020</p></body>",
    "in an article": f"<body><article><h1>Head</h1><div>By Jane</div>{TEXT}<p>Short.</p>{TEXT}<div>Share this</div></article></body>",
}


def test_clusters_choose_the_blocks():
    for name, page in CLUSTERED.items():
        text = html_extract.main_text(page).split("\n\n")
        want = [x for x in paragraphs(page) if x not in ("Home", "Login", "Copyright 2020")]
        assert text == (["Head", "By Jane", *want] if "article" in name else want), name


def test_without_ratios_the_text_differs(monkeypatch):
    with_ratios = {name: html_extract.main_text(page) for name, page in CLUSTERED.items()}
    flat(monkeypatch)
    for name, page in CLUSTERED.items():
        assert html_extract.main_text(page) != with_ratios[name], name


def test_lists_of_links_in_an_article_stay_whole():
    refs = "<ul><li><a href=/1>Ref one</a><li><a href=/2>Ref two</a></ul>"
    page = f"<body><article>{LONG}{SHORT}{refs}</article>{FOOT}</body>"
    assert html_extract.main_text(page).split("\n\n") == [*paragraphs(page), "Ref one", "Ref two"]


def test_adverts_and_comments_named_without_headings_go():
    comment = "<p>A reader says something long enough to look like a paragraph of the article itself.</p>"
    for part in (f"<p class=ad>{SHORT[3:]}", f"<div class=ad-top>{SHORT}</div>", f"<div id=discussion>{comment * 3}</div>"):
        page = f"<body><article>{TEXT}{part}{TEXT}</article>{FOOT}</body>"
        assert html_extract.main_text(page).split("\n\n") == paragraphs(TEXT * 2), part


def test_deep_pages_take_linear_time_and_memory():
    import time
    import tracemalloc

    def cost(page):
        begin = time.monotonic()
        tracemalloc.start()
        text = html_extract.main_text(page)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return text, peak, time.monotonic() - begin

    for page in ("<div>t" * 50_000, "<div class=ad>" * 25_000 + "t", "<ul><li>t" * 25_000, "<span>" * 25_000 + "</b></p>" * 25_000 + "t"):
        text, peak, seconds = cost(page)
        assert peak < 150e6 and seconds < 40, (page[:20], peak, seconds)
    assert len(html_extract.main_text("<div>t" * 50_000).split()) == 50_000
