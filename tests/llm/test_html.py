"""Main text of small pages, each with something that must go or stay."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assayframe.llm import html

LONG = "This sentence is long enough to be a paragraph, with commas, and some more words in it."
MORE = "Another paragraph of the article, which is also long, and has its own commas, three of them."


def page(body):
    return f"<!DOCTYPE html><html><head><title>No title</title><style>p{{}}</style></head><body class='has-sidebar'>{body}</body></html>"


CASES = {
    "article": (f"<nav><a href=x>Menu</a></nav><article><h1>Title</h1><p>{LONG}</p><p>No.</p></article><footer>end</footer>", ["Title", LONG, "No."]),
    "unclosed": (f"<article><p><b>{LONG}<br><p>{MORE}<p>x</article>", [LONG, MORE, "x"]),
    "plain divs": (f"<div id=top class=menu><a href=1>One</a> <a href=2>Two</a></div><div class=content><div>{LONG}</div><div>{MORE}</div></div><div class=footer>c</div>", [LONG, MORE]),
    "advert": (f"<article><p>{LONG}</p><div class='ad'>{MORE}</div><p>{MORE}</p></article>", [LONG, MORE]),
    "comments": (f"<div><div class=post><p>{LONG}</p><p>{MORE}</p></div><section id=comments><p>{MORE} {MORE}</p><p>{MORE}</p><p>{LONG}</p></section></div>", [LONG, MORE]),
    "comment articles": (f"<article><p>{LONG}</p><p>{MORE}</p></article><article class='comment'><p>{LONG} {LONG}</p><p>{MORE}</p></article>", [LONG, MORE]),
    "article head": (f"<header><p>{MORE}</p></header><article><header class=entry-header><h1>Head, kept</h1></header><p>{LONG}</p></article>", ["Head, kept", LONG]),
    "links": (f"<div><ul><li><a href=a>{MORE}</a></li><li><a href=b>{MORE}</a></li></ul></div><div><p>{LONG}</p><p>{MORE}</p></div>", [LONG, MORE]),
    "scripts": (f"<article><p>{LONG}</p><script>var t='</p>'; if (a<b) x();</script><style>p>a{{}}</style><!-- <p>gone</p> --><p>{MORE}</p><form><p>{LONG}</p></form></article>", [LONG, MORE]),
    "references": ("<article><p>a &amp; b&nbsp;&lt;c&gt; &eacute;&#233;&#x1F600; &unknown; &copy &middot; and long enough\n  \t to count</p></article>", ["a & b <c> éé😀 &unknown; © · and long enough to count"]),
    "lists and tables": (f"<article><p>{LONG}</p><ul><li>one<li>two <b>bold</b></ul><table><tr><td>a<td>b<tr><td>c</table></article>", [LONG, "one", "two bold", "a b", "c"]),
    "sections": (f"<main><section><p>{LONG}</p><p>{MORE}</p></section><section><p>{MORE}</p><p>{LONG}</p></section></main>", [LONG, MORE, MORE, LONG]),
    "cookie notice": (f"<div class='cookie-banner'>{LONG} {LONG}</div><div><p>{LONG}</p><p>{MORE}</p></div>", [LONG, MORE]),
    "hidden": (f"<article><p>{LONG}</p><p style='display: none'>{MORE}</p><div hidden>{MORE}</div></article>", [LONG]),
    "short article": (f"<div class=ad>{LONG}</div><article><p>Short.</p></article>", ["Short."]),
    "no article at all": ("<nav>menu</nav>just words", ["just words"]),
    "layout class": (f"<div class='with-sidebar'><p>{LONG}</p><p>{MORE}</p></div>", [LONG, MORE]),
    "stray ends": (f"</p></div><article></b><p>{LONG}</i></section></p></article></table>", [LONG]),
    "nothing": ("<nav>menu</nav><footer>foot</footer>", []),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    body, blocks = CASES[name]
    assert html.extract(page(body)) == "\n\n".join(blocks)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<", ">", "&amp", "<!--", "-->", "<script>", "</script>", "<a href=\"x>", "<td", LONG, " x ", "<li>", "<article>", "</article>", "<b"]), max_size=25))
def test_never_fails(parts):
    html.extract("".join(parts))


MB = 1 << 20
LONG_PAGES = {
    "nested div": "<div>" * (MB // 5),
    "unclosed i": "<i>" * (MB // 3),
    "paragraphs within unclosed b": "<b>" * (MB // 6) + f"<p>{LONG}</p>" * (MB // 2 // (len(LONG) + 7)),
    "nested lists": "<ul><li>" * (MB // 8),
    "nested tables": "<table><tr><td>" * (MB // 15),
    "stray end tags": "<div>" * 1000 + "</i>" * (MB // 4),
    "no tag ends": "<a" * (MB // 2),
    "declarations without end": "<p>x</p>" + "<!" * (MB // 2),
    "a tag that never closes": "<a" * (MB // 2) + f" <p>{LONG}</p>",
    "open quotes": "<a href=\"" * (MB // 9),
    "one long attribute": f"<p class=\"{'a ' * (MB // 2)}\">{LONG}</p>",
}


@pytest.mark.parametrize("name", LONG_PAGES)
def test_long_pages_take_linear_time(name):
    def seconds(text):
        start = time.process_time()
        html.extract(text)
        return time.process_time() - start

    text = LONG_PAGES[name]
    assert seconds(text) < 8 * max(seconds(text[:len(text) // 4]), 0.25)


def test_long_pages_keep_their_text():
    assert html.extract("<div>" * 3000 + LONG) == LONG
    many = "".join(f"<p>{LONG} {i}</p>" for i in range(20_000))
    assert html.extract(f"<article>{many}</article>").count("\n\n") == 19_999
    assert html.extract(f"<p>{LONG}</p><!-- no end <p>{LONG}</p> x") == LONG
    assert html.extract(f"<p>{LONG}</p>after <!-- no end") == f"{LONG}\n\nafter"
    assert html.extract(f"<p>{LONG}</p>a < b") == f"{LONG}\n\na < b"


def plain_points(page, size, links, commas, gone):
    """Points by walking up from every paragraph, element by element."""
    points = {}
    for i, tag in enumerate(page.tag):
        inner = [j for j in range(len(page.tag)) if page.tag[j] in html.BLOCKS and i in ancestors(page, j)]
        if gone[i] or size[i] < html.LEAST_PARAGRAPH or not (tag in ("p", "pre", "td", "li", "dd") or tag in html.BLOCKS and not inner):
            continue
        given, share = (1 + commas[i] + min(size[i] // 100, 3)) * (1 - links[i] / size[i]), 1.0
        for up in ancestors(page, i):
            if up > 0 and share > 0.05 and (page.tag[up] in html.BLOCKS or page.tag[up] == "td"):
                points[up] = points.get(up, 0) + given * share
                share /= 2
    return {i: n * (1 - links[i] / max(size[i], 1)) for i, n in points.items()}


def ancestors(page, i):
    out = []
    while page.parent[i] >= 0:
        i = page.parent[i]
        out.append(i)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<span>", "</span>", "<ul>", "<li>", "</ul>", "<table><tr><td>", "</table>", "<a href='x'>", "</a>", LONG, LONG, "a, b, c, and some more words, all of them plain"]), max_size=40))
def test_points_like_a_plain_walk(parts):
    page = html.parse("".join(parts))
    size, links, commas, gone = html._texts(page)
    best, points = html.best_container(page, size, links, commas, gone)
    want = plain_points(page, size, links, commas, gone)
    assert points.keys() == want.keys() and all(abs(points[i] - want[i]) < 1e-9 for i in want)
    assert best == -1 if not any(n > 0 for n in want.values()) else want[best] >= max(want.values()) - 1e-9


def test_table(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "v", page(CASES["article"][0])), (3, "v", page(CASES["article"][0])), (None, "w", "plain")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "5 as text", "'k' as n")
    got = html.extract_text(pages)
    assert got.columns == ["page_id", "url", "html", "n", "text", "n_chars"]
    want = f"Title\n\n{LONG}\n\nNo."
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in got.collect()) == [("1", "", 0), ("2", "", 0), ("3", want, len(want)), ("3", want, len(want)), ("None", "plain", 5)]
    assert html.extract_text(pages.limit(0), keep=["url"]).columns == ["url", "text", "n_chars"]
    assert html.extract_text(pages.limit(0)).count() == 0
