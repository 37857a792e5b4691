"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into text blocks at block-level tags. A block has its number of words and its share of words in links,
those of the blocks before and after it, whether it is a heading, and what surrounds it (an article or main element; an element whose name,
class, id or role is that of a menu, header, footer, sidebar, notice, advert, form or of comments). A name that only
holds such a word among others, and a form, may as well stand around the page itself: they count only where they don't
hold most of its text. Hidden and advert elements inside a line are left out of it. A decision tree, grown on the small
labelled table below, keeps or drops each block; kept blocks are joined in page order.

Null html is an empty page; a page without kept blocks has an empty text. Cut-off pages are read as far as they go: a
tag without its end is markup, an element without its end holds what follows. Scripts, styles, the head's title and
comments in the markup are no text. Character references are decoded once, white space in a block is one space; a
line break element is white space. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that hold no text of the page, and elements that don't break a block.
SILENT = {"script", "style", "title", "noscript", "template", "svg", "iframe", "object", "select", "textarea", "button", "canvas", "video", "audio"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"} | {
    "math", "semantics", "annotation", "annotation-xml", "mrow", "mi", "mo", "mn", "ms", "mtext", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mover", "munder", "munderover", "mtable", "mtr", "mtd",
    "mstyle", "mspace", "mpadded", "mphantom", "menclose", "merror", "mmultiscripts", "mprescripts",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
#: Elements, and words of classes, ids and roles, around what is not the article.
APART = {"nav", "footer", "aside", "form", "menu", "dialog"}
APART_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "overlay",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "sidebar", "side", "aside", "widget", "related", "recommended", "share", "social", "newsletter",
    "subscribe", "signup", "login", "search", "searchbox", "footer", "contentinfo", "complementary", "masthead", "comment", "comments", "disqus", "replies", "respond", "toolbar", "tags", "legal", "copyright", "disclaimer", "form", "alertdialog",
    "commentlist", "commentform", "adbox", "adslot", "adsense",
}
#: Those of readers' comments, and of adverts, which may also stand inside a line.
COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus", "replies"}
AD_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "adbox", "adslot", "adsense"}
#: Words after which a name means the same, and words that make it the name of content.
TAILS = {"list", "area", "box", "section", "block", "inner", "links", "items", "item", "buttons", "bar", "left", "right", "top", "bottom", "primary", "secondary"}
CONTENT = {"news", "page"}
#: Elements around a whole page or article, to which words don't apply, or only as a whole class; words of classes that
#: tell of a layout or a state and not of what the element is.
WHOLE, ARTICLE = {"html", "body", "main"}, "article"
FLAGS, STATES = {"no", "not", "with", "without", "has", "have", "is", "hide", "show", "layout", "theme", "template", "cols", "columns"}, {"open", "opened", "closed", "enabled", "disabled", "on", "off"}
#: Silent elements that can't hold another of their kind, and what may stand in one that isn't closed.
FLAT = {"select", "button", "noscript", "iframe", "canvas", "video", "audio"}
HELD = {"option", "optgroup", "source", "track", "param"}
HEAD_WORDS = {"header", "topbar", "site-header"}
HEADINGS = {"h1", "h2", "h3", "h4"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++)))?""")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_PART = re.compile(r"[a-z]+(?:-header)?|[A-Z][a-z]*")

#: Columns of a block's row.
COLUMNS = ("words", "links", "words_before", "links_before", "words_after", "links_after", "apart", "article", "head", "heading")


@lru_cache(1 << 14)
def _apart(name: str, rest: str) -> tuple[int, bool, bool]:
    """Whether an element surrounds what isn't the article (2 surely, 1 if it doesn't hold most of the page), whether it
    is a header, and whether it is left out of a line."""
    apart, head, silent = 2 * (name in APART and name != "form"), name == "header", False
    if name == "form":
        apart = 1
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or key == "style" and _NONE.search(value):
            apart, silent = 2, True
        elif key == "aria-hidden" and value.lower() == "true":
            apart = 2
        elif key in ("class", "id", "role"):
            for token in value.split():
                mark, top, ad = _token(name, token)
                apart, head, silent = max(apart, mark), head or top, silent or ad
    return apart, head, silent


def _token(name: str, token: str) -> tuple[int, bool, bool]:
    """``_apart`` for one class, id or role."""
    words = [p.lower() for p in _PART.findall(token)]
    if not words or name in WHOLE or len(words) > 1 and (words[0] in FLAGS or name in (ARTICLE, "div", "section") and words[-1] in STATES):
        return 0, False, False
    if name == ARTICLE:
        return 2 * (token.lower() in APART_WORDS), token.lower() in HEAD_WORDS, False
    parts = {p.lower() for p in re.split(r"[^A-Za-z]+", token)} | set(words)
    head = not parts.isdisjoint(HEAD_WORDS)
    size = len(words)
    while size > 1 and words[size - 1] in TAILS:
        size -= 1
    own = words[:size]
    if token.lower() in APART_WORDS or set(own) <= APART_WORDS or own[-1] in COMMENT_WORDS:
        return 2, head, set(own) <= AD_WORDS
    return int(words[-1] not in CONTENT and not parts.isdisjoint(APART_WORDS)), head, False


def _block_end(page: str, at: int) -> int:
    """Where the next block-level tag is."""
    for tag in _TAG.finditer(page, at):
        name = (tag["name"] or tag["name2"] or "").lower()
        if name and name not in INLINE and name not in HELD:
            return tag.start()
    return len(page)


class _Element(NamedTuple):
    """An open element: how many around a block are surely not the article, are it, and are headers; which of the page's
    doubtful elements it is; and where the list item is that a next one ends."""

    name: str
    apart: int = 0
    article: int = 0
    heads: int = 0
    doubt: int = -1
    item: int = 0


def _settle(table: np.ndarray, doubts: list[list[int]], tops: list[int], mains: list[int]) -> None:
    """Marks the blocks of doubtful elements, but for elements that hold most of the page's text. An element's blocks are
    a range; ``tops`` are the blocks of first headings, ``mains`` those at which articles start."""
    words = np.r_[0, np.cumsum(table[:, 0] * (table[:, 6] == 0))]
    for first, end, form in doubts:
        share = (words[end] - words[first]) / max(words[-1], 1)
        top = any(first <= k < end for k in tops)
        if form:
            around = share > 0.8 or top or any(first <= k < end for k in mains)
        else:
            around = share > 0.5 or top and share > 0.25
        if not around:
            table[first:end, 6] = 1


def blocks(page: str) -> tuple[list[str], np.ndarray]:
    """Text blocks of a page in order, and their rows of ``COLUMNS``."""
    texts: list[str] = []
    rows: list[list[float]] = []
    parts: list[tuple[str, bool]] = []
    stack = [_Element("")]
    opened: Counter[str] = Counter()
    doubts: list[list[int]] = []
    tops: list[int] = []
    mains: list[int] = []
    ends: dict[str, re.Match | None] = {}
    # Inside a paragraph that is apart; the element left out of a line, and how many of its name are open.
    aside, mute, muted = False, "", 0
    link, at = 0, 0

    def close() -> None:
        nonlocal muted
        muted = 0
        if not parts:
            return
        whole = " ".join("".join(p for p, _ in parts).split())
        if whole:
            words = whole.count(" ") + 1
            linked = sum(len(p.split()) for p, in_link in parts if in_link)
            texts.append(whole)
            around = stack[-1]
            rows.append([words, min(1.0, linked / words), 0, 0, 0, 0, float(aside or around.apart > 0), float(around.article > 0), float(around.heads > 0), float(around.name in HEADINGS)])
        parts.clear()

    def leave(k: int) -> None:
        for element in stack[k:]:
            opened[element.name] -= 1
            if element.doubt >= 0:
                doubts[element.doubt][1] = len(texts)
        del stack[k:]

    def say(raw: str) -> None:
        if raw and not muted:
            parts.append((html.unescape(raw) if "&" in raw else raw, link > 0))

    while at < len(page):
        tag = _TAG.search(page, at)
        if tag is None:
            say(page[at:])
            break
        say(page[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            if tag[0].startswith("<![CDATA["):
                say(tag[0][9:].removesuffix("]]>"))
            continue
        end, rest = bool(tag["end"] or tag["end2"]), tag["rest"] or tag["rest2"] or ""
        if name in SILENT and not end:
            if name not in ("select", "button", "textarea", "object", "title"):
                close() if name not in INLINE else None
            if not rest.endswith("/"):
                # The next end tag of each name is looked for once.
                if name not in ends or ends[name] is not None and ends[name].start() < at:
                    ends[name] = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I).search(page, at)
                over = ends[name]
                again = over and name in FLAT and re.compile(rf"<{re.escape(name)}(?=[\s/>])", re.I).search(page, at, over.start())
                if over and not again:
                    at = over.end()
                else:
                    at = len(page) if name in ("script", "style") else _block_end(page, at)
            continue
        if name in INLINE and name not in VOID:
            if muted:
                muted += (name == mute) * (-1 if end else not rest.endswith("/"))
            elif rest and not end and not rest.endswith("/") and _apart(name, rest)[2]:
                mute, muted = name, 1
        if name == "a":
            link = 0 if end else 1
            continue
        if name == "br":
            parts.append((" ", False))
            continue
        if name in INLINE:
            continue
        close()
        link, aside = 0, False
        if name == "p":
            aside = not end and rest != "" and _apart(name, rest)[0] == 2
            continue
        if name in VOID or (rest.endswith("/") and not end):
            continue
        if end:
            if opened[name] > 0:
                k = len(stack) - 1
                while stack[k].name != name:
                    k -= 1
                leave(k)
            continue
        if name == "li" and stack[-1].item:
            leave(stack[-1].item)
        if name == "h1":
            tops.append(len(texts))
        apart, head, _ = _apart(name, rest)
        above = stack[-1]
        main = name in ("article", "main") or 'role="main"' in rest
        if main:
            mains.append(len(texts))
        doubt = -1
        if apart == 1:
            doubt = len(doubts)
            doubts.append([len(texts), -1, int(name == "form")])
        item = len(stack) if name == "li" else 0 if name in ("ul", "ol", "menu", "dir") else above.item
        # A header inside the article belongs to it.
        stack.append(_Element(name, above.apart + (apart == 2), above.article + main, above.heads + (head and not above.article and not main), doubt, item))
        opened[name] += 1
    close()
    leave(1)
    table = np.array(rows, float).reshape(-1, len(COLUMNS))
    if len(table):
        _settle(table, doubts, tops, mains)
        table[1:, 2:4] = table[:-1, 0:2]
        table[:-1, 4:6] = table[1:, 0:2]
    return texts, table


#: The labelled table: pages as blocks, each with 1 for article text and 0 for the rest.
LABELLED: list[list[tuple[str, int]]] = [
    [
        ('<header><div class="logo">The Daily Record</div>', 0), ('<nav><ul><li><a href="/">Home</a></li>', 0), ('<li><a href="/world">World news</a></li></ul></nav></header>', 0),
        ("<article><h1>Bridge opens after three years of works</h1>", 1), ("<p>The new bridge over the river opened on Monday morning, and the first cars crossed it before sunrise under a clear sky.</p>", 1),
        ("<p>It is long.</p>", 1), ('<p>Engineers from the <a href="/x">city</a> had worked on the pillars since spring and finished them last week, as planned.</p></article>', 1),
        ('<div class="comments"><p>What a fine bridge, I drove over it today with my whole family and we loved it.</p>', 0), ("<p>Me too.</p></div>", 0), ("<footer>All rights reserved by the record company</footer>", 0),
    ],
    [
        ('<div id="menu"><a href="/a">Recipes</a></div>', 0), ('<div class="cookie-notice">We use cookies to make this site better for you, and you may read more about them in our policy.</div>', 0),
        ("<main><h2>Bread with seeds</h2>", 1), ("<div>Mix the flour with water, salt and yeast, and let the dough rest in a warm place until it has twice the size.</div>", 1),
        ("<ul><li>One pound of flour</li>", 1), ("<li>Salt</li></ul>", 1), ("<p>Serve it warm.</p></main>", 1),
        ('<aside><h3>More recipes</h3>', 0), ('<a href="/cake">Cake with apples and cream</a></aside>', 0), ('<form><label>Your mail address for our letter</label></form>', 0),
    ],
    [
        ('<div class="ad">Buy the best shoes of the town now, they cost half of what they did in the last year and are twice as good.</div>', 0),
        ("<article><p>Short note.</p>", 1), ('<p><a href="/long">This whole sentence is a link to the longer report on the matter, which many people have read.</a></p>', 1), ("<p>Fin.</p></article>", 1),
        ('<div class="sidebar"><p>Weather for tomorrow: rain in the west, and sun in the east of the country for most of the day.</p></div>', 0), ("<footer><p>Contact</p></footer>", 0),
    ],
    [
        ('<div><a href="/">Start</a> <a href="/b">Archive</a> <a href="/c">About us</a></div>', 0), ("<div>Login</div>", 0),
        ("<div>On the last day of the year the village meets at the old mill, where everyone brings wood for the fire and something to eat, and the oldest tells a story.</div>", 1),
        ("<div>The story is never the same, though it always starts with a fox that could not sleep and ends before the bells ring at midnight over the frozen fields.</div>", 1),
        ('<div><a href="/p">Previous page</a> | <a href="/n">Next page</a></div>', 0), ("<div>Imprint</div>", 0),
    ],
    [
        ("<table><tr><td><a href='/1'>News</a></td></tr></table>", 0), ("<h1>How tides work</h1>", 1),
        ("<p>The moon pulls at the water of the seas, and the water on the near side is pulled more than the ground below it, so it rises towards the moon.</p>", 1),
        ("<p>On the far side the ground is pulled more than the water, which stays behind, and so a second hill of water stands there at the same time.</p>", 1),
        ('<p><a href="/more">More about seas and oceans</a> <a href="/all">All topics</a></p>', 0), ("<div>Site map</div>", 0),
    ],
    [
        ('<div class="topbar header">Free delivery for all orders over forty until the end of this month only</div>', 0), ("<article><header><h1>Test of a lamp</h1>", 1), ("<p>By our editor</p></header>", 1),
        ("<p>The lamp shines.</p>", 1), ('<div class="share"><a href="/s">Share this</a></div>', 0), ("<p>It shone for nine hours on one load, which is more than the maker says and more than any other that we have had here.</p>", 1),
        ('<div class="advert">Lamps at a low price, only today and only here, as long as there are any left in our store.</div>', 0), ("<p>Good.</p></article>", 1), ('<section id="comments"><p>Nice test, thank you.</p></section>', 0),
    ],
    [
        ('<div class="ad">A new car for you.</div>', 0),
        ("<article><p>Long before the first houses stood here there was a ford, where drivers of cattle crossed the stream twice a year on their way to the markets in the north, and where they slept under the trees.</p></article>", 1),
        ("<p>Later a wooden bridge was laid beside the ford, and a family that took a coin from everyone who crossed it built the first house, which stands to this day at the end of the road to the church.</p>", 1),
        ('<div class="promo">Only this week: all books about bridges, fords and cattle at half the price, with free delivery to every house in the land, and a map of the old roads for those who buy three of them.</div>', 0),
        ('<div class="sidebar"><p>Our readers also liked the story of the mill, the story of the church and its bell, and the one about the family that took a coin from everyone who crossed the bridge to the market.</p></div>', 0),
        ("<footer>Town museum, open every day but Monday</footer>", 0),
    ],
    [
        ('<nav><a href="/">Home</a></nav>', 0), ("<article><h1>Notes</h1>", 1), ("<p>Rain.</p>", 1), ("<p>It rained all day and all night, and in the morning the cellar was full of water up to the third step of the stairs, so we stayed upstairs and read.</p>", 1),
        ("<p>More rain.</p>", 1), ("<p>Sun.</p>", 1), ("<p>Wind.</p>", 1), ('<p><a href="/w">Weather map</a></p>', 1), ("<ul><li>Boots</li>", 1), ("<li>Hats</li></ul>", 1), ("<p>The sun came out at last, the water ran off, and we carried the chairs and the books out into the garden to let them dry before the evening.</p>", 1),
        ("<p>End.</p></article>", 1), ("<div>Older notes</div>", 0), ("<div>Contact</div>", 0), ("<div>Imprint</div>", 0),
    ],
    [("<p>The ferry does not run today because of the storm, and the next one is expected to leave on Thursday.</p>", 1)],
    [
        ("<div>Home</div>", 0), ("<p>There is no better time to plant a tree than the autumn, when the ground is still warm and wet enough for new roots.</p>", 1),
        ("<p>Dig a hole twice as wide as the roots, put the tree in, fill the hole with the same earth and give it two cans of water.</p>", 1), ("<div>Contact</div>", 0),
    ],
    [
        ("<div><a href='/'>Home</a></div>", 0), ("<p>The library is open again from Monday on, and those who have kept a book since the winter may bring it back without a fine.</p>", 1), ("<div>Imprint</div>", 0),
    ],
    [
        ('<nav><a href="/">Home</a></nav>', 0), ('<div id="outer-sidebar-wrap"><h1>Fog</h1>', 1),
        ("<p>Fog lay over the harbour until noon, and none of the boats that were to leave at dawn had left by the time the church bells rang.</p>", 1),
        ("<h2>Later</h2>", 1), ("<p>It cleared in the afternoon, when a wind from the north came up, and the boats left one after the other, the smallest first.</p>", 1),
        ("<h3>Latest</h3>", 0), ('<ul><li><a href="/1">A storm in the south of the country</a></li>', 0), ('<li><a href="/2">New boats for the harbour</a></li></ul>', 0), ("</div><footer>Harbour news</footer>", 0),
    ],
    [
        ('<div><a href="/">Home</a></div>', 0), ('<form id="page"><h1>Owls in the barn</h1>', 1),
        ("<p>Two owls have moved into the barn behind the school, where the children watch them from the window of the second floor every evening.</p>", 1),
        ("<p>Nobody knows yet whether there are eggs, as the nest is too high up to be seen without a ladder, and the owls are not to be disturbed.</p>", 1),
        ("<h2>More</h2>", 0), ('<div><a href="/cats">Cats</a> <a href="/dogs">Dogs</a></div>', 0), ("<div>Contact</div></form>", 0),
    ],
    [
        ('<div class="banner">Win a trip</div>', 0),
        ("<h1>Night trains</h1>", 1),
        ("<p>Night trains are back, and those who ride them say that they sleep better in them than in any hotel, as long as the train does not stop too often and nobody opens the door to ask for a ticket at four.</p>", 1),
        ('<div class="notice">This page was changed on the second of May because a reader told us that the train to the south leaves an hour later than we had written, for which we are thankful to him.</div>', 0),
        ("<p>They are slow, though.</p>", 1), ("<p>The oldest line runs along the coast and takes fourteen hours from end to end, with a stop for breakfast at a station that has been out of use for any other train for thirty years.</p>", 1),
        ('<div class="comment"><p>I took the one along the coast twice, and both times we were late by three hours because of a cow that stood on the line, but the breakfast at the old station was worth it.</p></div>', 0),
    ],
]


def grow(rows: np.ndarray, label: np.ndarray, depth: int = 6) -> tuple:
    """A decision tree by Gini impurity: ``(column, limit, below, above)``, or the label of a leaf."""
    share = label.mean()
    if depth == 0 or share in (0.0, 1.0):
        return (int(share >= 0.5),)
    best = (share * (1 - share) - 1e-9, None, None)
    for c in range(rows.shape[1]):
        values = np.unique(rows[:, c])
        for limit in (values[:-1] + values[1:]) / 2:
            left = rows[:, c] <= limit
            parts = [label[left], label[~left]]
            mixed = sum(len(p) * p.mean() * (1 - p.mean()) for p in parts) / len(label)
            if mixed < best[0]:
                best = (mixed, c, limit)
    if best[1] is None:
        return (int(share >= 0.5),)
    left = rows[:, best[1]] <= best[2]
    return best[1], best[2], grow(rows[left], label[left], depth - 1), grow(rows[~left], label[~left], depth - 1)


def decide(tree: tuple, rows: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(rows), tree[0])
    column, limit, below, above = tree
    left = rows[:, column] <= limit
    out = np.empty(len(rows), int)
    out[left], out[~left] = decide(below, rows[left]), decide(above, rows[~left])
    return out


@lru_cache(1)
def tree() -> tuple:
    rows, label = [], []
    for page in LABELLED:
        texts, table = blocks("".join(part for part, _ in page))
        if len(texts) != len(page):
            raise ValueError("a labelled page has a block without a label")
        rows.append(table)
        label += [y for _, y in page]
    return grow(np.concatenate(rows), np.array(label, float))


def main_text(page: str) -> str:
    texts, table = blocks(page)
    if not texts:
        return ""
    return "\n".join(t for t, keep in zip(texts, decide(tree(), table), strict=True) if keep)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [main_text(page.as_py() or "") for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(made, pa.string())], names=["id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``id_col``, ``url_col``, ``text``, ``n_chars``, one row per row of ``pages``."""
    types = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    made = rows.mapInArrow(_texts, f"id {types[0]}, url {types[1]}, text string")
    return made.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
