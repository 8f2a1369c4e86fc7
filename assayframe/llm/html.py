"""Main text of web pages by tree scoring.

Paragraphs give points, for their length and commas, to the elements around them; an
element's points count less the more of its text is in links. The element with the most
points, and those of its neighbours that read like it, hold the main text. Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments are
taken out first, wherever they stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from assayframe.llm.scratch import small_batches

# Element names of HTML by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer form head iframe input label menu nav noembed noframes noscript object "
    "optgroup option script search select style svg template textarea title video".split()
)
SPACES = frozenset("br td th img hr wbr".split()) - {"wbr", "img"}
# Words in class, id and role that mark what is not the article.
MARKS = frozenset(
    "ad ads adsense adslot adunit advert advertisement advertising adverts alert alertdialog banner breadcrumb breadcrumbs "
    "comment commentlist comments complementary consent contentinfo cookie cookiebar cookies dialog disqus footer form gdpr "
    "masthead menu modal nav navbar navigation navigations newsletter notice notification overlay pager pagination paywall popup promo "
    "promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription toolbar widget widgets".split()
)
STATES = frozenset(["has", "is", "no", "not", "show", "with", "without"])  # such names tell of the page, not of the element
HEADS = frozenset(["header", "topbar"])
ROOTS = frozenset(["html", "body", "article", "main"])
# Elements whose opening ends an open one of the first kind, up to the second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # comment
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+|[^<>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([A-Za-z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

LEAST_PARAGRAPH = 25


@dataclass
class Page:
    """Elements and pieces of text in page order. A piece None ends a block."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    drop: list[int] = field(default_factory=list)  # 0 kept, 1 perhaps, by its marks, 2 surely
    first: list[int] = field(default_factory=list)
    last: list[int] = field(default_factory=list)
    pieces: list[tuple[int, str | None]] = field(default_factory=list)


def _verdict(tag: str, attributes: str, inside: bool) -> int:
    """Whether an element is to be dropped; ``inside``: within an article or main element."""
    if tag in DROPPED or tag == "header" and not inside:
        return 2
    if not attributes or tag in ("html", "body"):
        return 0
    marks = set()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return 2
        if name in ("class", "id", "role") and tag not in ROOTS or name == "class" and tag == "article":
            for one in unescape(value).split():
                parts = [x.lower() for x in _PART.findall(one)]
                if parts and parts[0] not in STATES:
                    marks.update(parts)
    return int(bool(marks & MARKS) or not inside and bool(marks & HEADS))


def parse(html: str) -> Page:
    """A tolerant reading: missing and stray tags never fail.

    Where the open elements of a name are is noted, so no tag looks through all that are
    open, and the time taken is in proportion to the length of the page.
    """
    page = Page()
    stack: list[int] = []
    places: dict[str, list[int]] = {}  # by name: the places of open elements in the stack
    blocks: list[int] = []  # those of blocks

    def open_(tag, verdict):
        page.tag.append(tag)
        page.parent.append(stack[-1] if stack else -1)
        page.drop.append(verdict)
        page.first.append(len(page.pieces))
        page.last.append(-1)
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS:
            blocks.append(len(stack))
        stack.append(len(page.tag) - 1)

    def close(depth):
        while len(stack) > depth:
            node = stack.pop()
            places[page.tag[node]].pop()
            if page.tag[node] in BLOCKS:
                blocks.pop()
                page.pieces.append((node, None))
            page.last[node] = len(page.pieces)

    def top(names):
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def innermost(names, until):
        """The place of the last open element of these names, or 0 if one of ``until`` is open within it."""
        depth = top(names)
        return depth if depth >= (blocks[-1] if until is BLOCKS and blocks else top(until)) else 0

    open_("#page", 0)
    at = 0
    # no tag ends after this place, so none is looked for
    end = html.rfind(">") + 1
    while at < len(html):
        m = _TOKEN.search(html, at, end) if at < end else None
        if m is None:
            # only a comment without an end may follow
            page.pieces.append((stack[-1], re.split(r"<!--|<!\[CDATA\[", html[at:], maxsplit=1)[0]))
            break
        if m.end() == end < len(html) and m[0].startswith(("<!--", "<![CDATA[")) and not m[0].endswith(("-->", "--!>", "<!-->", "]]>")):
            page.pieces.append((stack[-1], html[at:m.start()]))
            break
        if m.start() > at:
            page.pieces.append((stack[-1], html[at:m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            # an inline end tag never closes a block
            depth = innermost({tag}, () if tag in BLOCKS or tag in ("td", "th") else BLOCKS)
            if depth:
                close(depth)
            continue
        if tag in BLOCKS:
            depth = innermost({"p"}, {"button", "table", "td", "th", "li", "div", "article", "section", "main", "blockquote"})
            if depth:
                close(depth)
        if tag in IMPLIED and (depth := innermost(*IMPLIED[tag])):
            names = IMPLIED[tag][0]
            while depth > 1 and page.tag[stack[depth - 1]] in names:
                depth -= 1
            close(depth)
        if tag in BLOCKS:
            page.pieces.append((stack[-1], None))
        elif tag in SPACES:
            page.pieces.append((stack[-1], " "))
        if tag in VOID:
            continue
        open_(tag, _verdict(tag, m[3], bool(places.get("article") or places.get("main"))))
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = len(html) if stop is None else stop.start()
        elif m[3].rstrip().endswith("/") and tag in ("path", "use", "circle", "rect"):
            close(len(stack) - 1)
    close(0)
    return page


def _texts(page: Page) -> tuple[list[int], list[int], list[int], list[bool]]:
    """For each element: characters, characters in links, commas; and whether it is dropped."""
    n = len(page.tag)
    gone, linked = [False] * n, [False] * n
    for i in range(n):
        p = page.parent[i]
        gone[i] = page.drop[i] == 2 or p >= 0 and gone[p]
        linked[i] = page.tag[i] == "a" or p >= 0 and linked[p]
    for surely in (True, False):
        size, links, commas = [0] * n, [0] * n, [0] * n
        for node, text in page.pieces:
            if text and not gone[node]:
                k = len(text.strip())
                size[node] += k
                links[node] += k if linked[node] else 0
                commas[node] += text.count(",") + text.count("、") + text.count("，")
        for i in range(n - 1, 0, -1):
            p = page.parent[i]
            size[p] += size[i]
            links[p] += links[i]
            commas[p] += commas[i]
        if surely:
            # without an article element, a mark on nearly all of the page is taken for its layout
            marked = [False] * n
            for i in range(n):
                p = page.parent[i]
                marked[i] = page.drop[i] > 0 or p >= 0 and marked[p]
            named = any(t in ("article", "main") and size[i] and not marked[i] for i, t in enumerate(page.tag))
            most = size[0] if named else 0.9 * size[0]
            for i in range(n):
                p = page.parent[i]
                gone[i] = gone[i] or page.drop[i] == 1 and size[i] <= most or p >= 0 and gone[p]
    return size, links, commas, gone


def best_container(page: Page, size: list[int], links: list[int], commas: list[int], gone: list[bool]) -> tuple[int, dict[int, float]]:
    """The element with the most points, or -1, and the points of all that have some."""
    points: dict[int, float] = {}
    holds_block = [False] * len(page.tag)
    # the nearest element around each that can get points
    around = [0] * len(page.tag)
    for i in range(1, len(page.tag)):
        p = page.parent[i]
        around[i] = p if page.tag[p] in BLOCKS or page.tag[p] == "td" else around[p]
    for i in range(len(page.tag) - 1, 0, -1):
        if page.tag[i] in BLOCKS or holds_block[i]:
            holds_block[page.parent[i]] = True
    for i, tag in enumerate(page.tag):
        if gone[i] or size[i] < LEAST_PARAGRAPH or not (tag in ("p", "pre", "td", "li", "dd") or tag in BLOCKS and not holds_block[i]):
            continue
        given, up, share = 1 + commas[i] + min(size[i] // 100, 3), around[i], 1.0
        given *= 1 - links[i] / size[i]
        while up > 0 and share > 0.05:
            points[up] = points.get(up, 0) + given * share
            share /= 2
            up = around[up]
    best, most = -1, 0.0
    for i in sorted(points):
        points[i] *= 1 - links[i] / max(size[i], 1)
        if points[i] > most:
            best, most = i, points[i]
    return best, points


def main_parts(page: Page) -> tuple[list[int], list[bool]]:
    """The elements whose text is the main text, in page order, and what is dropped in them."""
    size, links, commas, gone = _texts(page)
    best, points = best_container(page, size, links, commas, gone)
    named = [i for i, t in enumerate(page.tag) if t in ("article", "main") and not gone[i] and size[i]]
    if best < 0:
        bodies = [i for i, t in enumerate(page.tag) if t == "body" and not gone[i]]
        return [max(named, key=lambda i: size[i]) if named else bodies[0] if bodies else 0], gone
    # an article around the best part is whole
    up = best
    while up > 0:
        if page.tag[up] == "article":
            best = up
        up = page.parent[up]
    parent, most = page.parent[best], points.get(best, 0.0)
    kept = []
    for i in range(len(page.tag)):
        if i == best:
            kept.append(i)
        elif page.parent[i] == parent and not gone[i] and size[i]:
            density = links[i] / size[i]
            heading = page.tag[i] in ("h1", "h2") and i < best and not density
            paragraph = page.tag[i] == "p" and (size[i] > 80 and density < 0.25 or size[i] <= 80 and not density and page.tag[best] != "article")
            if heading or paragraph or points.get(i, 0) * (1 - density) >= max(10, most / 5):
                kept.append(i)
    return kept, gone


def extract(html: str | None) -> str:
    """The main text: blocks in page order, parted by an empty line; "" if there is none."""
    if not html:
        return ""
    page = parse(html)
    parts, gone = main_parts(page)
    blocks, open_ = [], []
    for part in parts:
        for node, text in page.pieces[page.first[part]:page.last[part]]:
            if text is None:
                blocks.append("".join(open_))
                open_ = []
            elif not gone[node]:
                open_.append(unescape(text))
        blocks.append("".join(open_))
        open_ = []
    return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def extract_text(pages: DataFrame, *, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns of ``pages`` if None), ``text`` and ``n_chars`` (code points).

    Null, empty and text-less pages give an empty text. Pages without any paragraph give
    their article, main or body element. Columns of ``pages`` named text or n_chars give
    way. Rows are independent; a page is held whole by one task.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(batch.schema.get_field_index(html))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=[*kept, "text", "n_chars"],
            )

    return small_batches(pages).select(*dict.fromkeys([*kept, html])).mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), "text string", "n_chars bigint"]))
