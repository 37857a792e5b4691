import pytest

from pulsegrid.llm import html, queries

LONG = "A sentence of the article that is long enough to count as text of a page, with commas, and an end."


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("<html><head><title>T</title></head><body></body></html>", ""),
        (f"<nav><a href='/'>Home</a></nav><article><h1>Title</h1><p>{LONG}</p><p>End.</p></article><footer>&copy; us</footer>", f"Title\n{LONG}\nEnd."),
        (f"<article><p>{LONG}<p>Two &amp; three<br>lines&nbsp;&lt;b&gt;<script>var a = '<p>no</p>';</script></article>", f"{LONG}\nTwo & three lines <b>"),
        (f'<div class="ad">{LONG}</div><article><p>{LONG} &eacute; &#x263a;</p><!-- <p>no</p> --></article>', f"{LONG} é ☺"),
        (f'<article><p>{LONG}</p><div class="comments"><p>{LONG}</p></div></article>', LONG),
        (f"<main><p>{LONG}</p><form><p>{LONG}</p></form><aside>{LONG}</aside></main>", LONG),
        (f"<article><p>{LONG}</p><p>cut <b>off<", f"{LONG}\ncut off<"),
        (f"<article><p>{LONG}</p><p>cut <a href='x", f"{LONG}\ncut"),
        (f"<article><p>{LONG}</p><style>p {{ x }}", LONG),
        (f"<ARTICLE><P CLASS=x>{LONG}</P></ARTICLE>", LONG),
        (f'<article><a title="a > b" href="/x">{LONG}</a></article>', LONG),
        (f"<article><p> in<b>li</b>ne  \n\t text {LONG}</p></article>", f"inline text {LONG}"),
        (f'<header><div id="cookie-notice">{LONG}</div></header><div hidden>{LONG}</div><article><header><h1>Of the article</h1></header><p>{LONG}</p></article>', f"Of the article\n{LONG}"),
    ],
)
def test_pages(page, text):
    assert html.main_text(page) == text


def test_tree_fits_its_table():
    for page in html.LABELLED:
        texts, table = html.blocks("".join(part for part, _ in page))
        assert len(texts) == len(page)
        assert html.decide(html.tree(), table).tolist() == [y for _, y in page]


def test_neighbours_and_links():
    _, table = html.blocks("<p>one two</p><p><a>three</a> four</p><p>five</p>")
    assert table[:, :6].tolist() == [[2, 0, 0, 0, 2, 0.5], [2, 0.5, 2, 0, 1, 0], [1, 0, 2, 0.5, 0, 0]]


def test_edge_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, f"<article><p>{LONG}</p></article>", "x"), (2, None, "", "x"), (2, "v", "<p>" * 20_000 + LONG, "x"), (3, "w", "<" * 1000, "x")]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    got = out.collect()
    assert out.columns == ["page_id", "url", "text", "n_chars"] and len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert {(r.page_id, r.url): r.text for r in got if r.page_id != 3} == {(1, "u"): "", (None, None): LONG, (2, None): "", (2, "v"): LONG}
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_keeps_articles(spark, small):
    import re

    rows = {r.page_id: r for r in queries.op6_html(spark, small).collect()}
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*?)(</article>|\Z)", p.html, re.S)[1]
        parts = [" ".join(html.html.unescape(re.sub(r"</?(b|i|a|em)\b[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", body)]
        assert rows[p.page_id].text == "\n".join(x for x in parts if x) and rows[p.page_id].n_chars == len(rows[p.page_id].text)


@pytest.mark.parametrize(
    "page,text",
    [
        (f'<html class="has-banner"><body class="no-sidebar sidebar"><article><p>{LONG}</p></article></body></html>', LONG),
        (f'<div class="content with-sidebar"><article class="post comments-open"><p>{LONG}</p></article></div>', LONG),
        (f'<article><p>{LONG}</p></article><article class="comment"><p>{LONG}</p></article><div class="main-sidebar"><p>{LONG}</p></div>', LONG),
        (f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> so</p></article>", f"{LONG} x=2 so"),
        (f"<article><button>Share<p>{LONG}</p><select><option>a<p>{LONG}</p><noscript>x<p>End.</p></article>", f"{LONG}\n{LONG}\nEnd."),
        (f"<article><p>{LONG}</p><button>One<p>{LONG}</p><button>Two</button></article>", f"{LONG}\n{LONG}"),
    ],
)
def test_articles_inside_flags_and_unclosed_elements_are_kept(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "around",
    [
        '<div id="content-sidebar-wrap">', '<div class="layout-sidebar-right">', '<div class="legal-news">', '<section class="tags-page">', '<form id="aspnetForm">', '<div data-class="ad" class="post">',
        '<div title="no class=ad here">', '<div class="page-with-comments-wrapper">', '<div class="search-results-container">',
    ],
)
@pytest.mark.parametrize("inner", [f"<h1>Title</h1><p>{LONG}</p><p>{LONG}</p>", f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></article>"])
def test_elements_around_the_page_decide_nothing(around, inner):
    name = around[1:].split()[0]
    page = f'<nav><a href="/">Home</a></nav>{around}{inner}<div class="sidebar"><p>{LONG}</p></div></{name}><footer>us</footer>'
    assert html.main_text(page) == f"Title\n{LONG}\n{LONG}"


@pytest.mark.parametrize(
    "side",
    [
        f'<p class="advert">{LONG}</p>', f"<p hidden>{LONG}</p>", f"<ul><li class=\"comment\">{LONG}</li></ul>", f'<ol class="commentlist"><li><p>{LONG}</p><li>{LONG}</ol>', f'<span class="ad">{LONG}</span>',
        f'<p><span class="ad">{LONG} <span>{LONG}</span></span></p>', f'<p style="display: none">{LONG}</p>', f'<div class="post-comments">{f"<p>{LONG}</p>" * 9}</div>', f"<form><p>{LONG}</p></form>",
        f'<div class="comment-list">{f"<p>{LONG}</p>" * 9}</div>', f'<div class="google-ad-slot"><p>{LONG}</p></div>',
    ],
)
def test_side_matter_inside_the_article_goes(side):
    assert html.main_text(f"<article><h1>Title</h1><p>{LONG}</p>{side}<p>{LONG} End.</p></article>") == f"Title\n{LONG}\n{LONG} End."


def test_marks_end_with_their_element():
    page = f'<article><p class="ad">{LONG}<p>{LONG}</p><ul><li class="ad">{LONG}<li>Kept<ul><li hidden>no<li>Yes</ul></li><li>Last</ul><p>In <span class="promo">{LONG}</span>line <b hidden>x</b>end</p><p>A <i class="ad">cut<p>{LONG}</article>'
    assert html.main_text(page) == f"{LONG}\nKept\nYes\nLast\nIn line end\nA\n{LONG}"


@pytest.mark.parametrize("unit", ["<button>a", "<select><p>", "<noscript>x", "<svg>", "<div>", "<li>", "<li><ul><div>", '<div class="ad-x">', "<span class=ad>", "</div>", "<form>"])
def test_time_is_linear_in_unclosed_elements(unit):
    import time

    def seconds(n):
        start = time.process_time()
        html.main_text(unit * n + f"<p>{LONG}</p>")
        return time.process_time() - start

    seconds(100)
    assert seconds(16_000) < 8 * max(seconds(4_000), 0.02)


def test_random_pages_against_their_trees():
    """Pages written from random trees: the blocks, and which are apart, follow from the tree."""
    import random

    random_ = random.Random(4)
    marks = [("", 0), ("", 0), (' class="ad"', 2), (' id="comments"', 2), (' class="lead"', 0), (" hidden", 2), (' data-id="menu"', 0)]

    def text():
        return " ".join(random_.choice(["one", "two", "three &amp; more", "f&uuml;r", "5 &lt; 6"]) for _ in range(random_.randint(1, 6)))

    def line(apart, out):
        written, said = [], []
        for _ in range(random_.randint(1, 3)):
            name, mark = random_.choice([("b", ""), ("span", ""), ("em", ' class="ad"'), ("span", " hidden"), ("a", ' href="/x"'), ("", "")])
            own = text()
            written.append(f"<{name}{mark}>{own}</{name}>" if name else own)
            said.append("" if "ad" in mark or "hidden" in mark else own)
        whole = " ".join(html.html.unescape(" ".join(said)).split())
        if whole:
            out.append((whole, apart))
        return " ".join(written)

    def node(depth, apart, out):
        mark, level = random_.choice(marks)
        name = random_.choice(["div", "section", "p", "ul", "td", "article"] if depth else ["p"])
        if name == "article":
            level = 2 * (level == 2)
        below = apart or level == 2
        if name == "p":
            return f"<p{mark}>{line(below, out)}" + random_.choice(["</p>", ""])
        if name == "ul":
            items = []
            for _ in range(random_.randint(1, 3)):
                mark_, level_ = random_.choice(marks)
                items.append(f"<li{mark_}>" + (node(depth - 1, below or level_ == 2, out) if random_.random() < 0.5 else line(below or level_ == 2, out)) + random_.choice(["</li>", ""]))
            return f"<ul{mark}>{''.join(items)}</ul>"
        return f"<{name}{mark}>{''.join(node(depth - 1, below, out) for _ in range(random_.randint(1, 3)))}</{name}>"

    for _ in range(300):
        out = []
        page = f"<body>{''.join(node(3, False, out) for _ in range(3))}</body>"
        texts, table = html.blocks(page)
        assert list(zip(texts, (table[:, 6] > 0).tolist(), strict=True)) == out, page
