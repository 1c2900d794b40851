"""Main text of web pages by composite text density.

Every element below ``body`` gets its characters per tag, adjusted for links:
with C characters, T tags, LC link characters, LT link tags (each at least 1)
and the body's own C and LC,

    density = C / T * log_b(C / LC * T / LT),
    b = ln(C / (C - LC) * LC + LC_body / C_body * C + e).

The sum of its children's densities shows how much dense text an element
gathers. The element of the largest sum is the heart of the page; the smallest
density on its path to the body is the threshold, and elsewhere only subtrees
at or above the threshold count as content. The result is the smallest element
around all content, or, if that is the body, the content subtrees alone.

Elements that are never article text (navigation, forms, scripts, notices,
adverts, reader comments: by tag, role or class words) are cut out before, and
inline markup is not counted as elements, so a paragraph is one leaf.

Defined cases: null or empty html gives an empty text; unclosed, misnested and
unknown tags, broken references and comments without an end are read as
browsers do, as far as text is concerned; pages of any size are read whole;
repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from paysignal.llm.batches import slices, strings

# HTML's element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address details summary center fieldset hgroup "
    "head nav header footer aside form menu dialog search button select object canvas video audio".split()
)
#: Never part of an article, wherever they stand.
CUT_TAGS = frozenset("head nav footer aside menu dialog search button select object canvas video audio".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Words of a class or id that mark what is no article text, unless the element holds the article or its heading.
CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar footer header masthead topbar cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "comment comments disqus replies reply respond widget toolbar pagination pager skip hidden".split()
)
#: Words of layout, which say nothing about what an element holds: ``site-footer`` is a footer, ``share-price`` no sharing.
LAYOUT_WORDS = frozenset(
    "site page main global top bottom left right upper lower primary secondary first last inner outer box bar list item items "
    "wrapper wrap container content block section area slot unit banner button buttons link links icon icons text title js u".split()
)
#: A start tag of the key ends an open element of the values.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",),
}
#: Where the search for an element to end stops.
SCOPE = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
    "tbody": ("table",), "tfoot": ("table",), "body": (),
}

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}


def _hint(attrs: str) -> int:
    """2: hidden; 1: marked as no article text; 0: neither."""
    found = 0
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDES.search(value)):
            return 2
        if name == "role" and value in CUT_ROLES or name in ("class", "id") and any(map(_marks, value.split())):
            found = 1
    return found


def _marks(token: str) -> bool:
    """A class or id of cut words, with nothing but layout words beside them."""
    words = _WORD.findall(token)
    return not CUT_WORDS.isdisjoint(words) and all(w in CUT_WORDS or w in LAYOUT_WORDS for w in words)


class _Page:
    """Elements in page order, as parallel lists; element 0 is the page."""

    def __init__(self) -> None:
        self.tag, self.parent, self.hint = ["#page"], [-1], [0]
        self.chars, self.tags, self.link_chars, self.link_tags = [0], [0], [0], [0]
        #: (element, text); an empty text ends a block.
        self.runs: list[tuple[int, str]] = []


def _parse(source: str) -> _Page:
    page = _Page()
    stack, link, at = [0], 0, 0  # link: the stack's depth at an open link, or 0
    open_: dict[str, int] = {}  # open elements by name: the stack is searched only for what is in it

    def text(piece: str) -> None:
        piece = entities.unescape(piece)
        n = len("".join(piece.split()))
        here = stack[-1]
        if n:
            page.chars[here] += n
            if link:
                page.link_chars[here] += n
        if piece:
            page.runs.append((here, piece))

    def pop(depth: int) -> None:
        nonlocal link
        for i in stack[depth:]:
            open_[page.tag[i]] -= 1
        del stack[depth:]
        page.runs.append((stack[-1], ""))
        if link > depth:
            link = 0

    def push(tag: str, hint: int) -> None:
        page.tags[stack[-1]] += 1
        page.tag.append(tag)
        page.parent.append(stack[-1])
        page.hint.append(hint)
        for counts in (page.chars, page.tags, page.link_chars, page.link_tags):
            counts.append(0)
        stack.append(len(page.tag) - 1)
        open_[tag] = open_.get(tag, 0) + 1

    def end(names: tuple[str, ...], stop: tuple[str, ...]) -> None:
        depth = len(stack) - 1
        while depth > 0 and any(open_.get(x) for x in names):
            tag = page.tag[stack[depth]]
            if tag in names:
                pop(depth)
            elif tag in stop:
                return
            depth -= 1

    while at < len(source):
        m = _TAG.search(source, at)
        if m is None:
            text(source[at:])
            break
        if m.start() > at:
            text(source[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "a":
                link = 0
            elif open_.get(tag) and (tag in BLOCK or tag == "span"):
                for depth in range(len(stack) - 1, 0, -1):
                    if page.tag[stack[depth]] == tag:
                        pop(depth)
                        break
            continue
        attrs = m[3] if m[3] is not None else m[6] or ""
        if tag in RAW:
            closing = _RAW_END[tag].search(source, at)
            if not attrs.rstrip().endswith("/") or tag not in ("svg", "math"):
                at = closing.end() if closing else len(source)
        elif tag == "br":
            page.runs.append((stack[-1], " "))
        elif tag == "hr":
            end(("p",), ("td", "th", "button"))
            page.runs.append((stack[-1], ""))
        elif tag == "a":
            page.tags[stack[-1]] += 1
            page.link_tags[stack[-1]] += 1
            link = len(stack)
        elif tag in BLOCK:
            if tag in ENDS:
                end(ENDS[tag], SCOPE[tag])
            end(("p",), ("td", "th", "button", "object"))
            if tag[0] == "h" and tag[1:].isdigit() and page.tag[stack[-1]][:1] == "h" and page.tag[stack[-1]][1:].isdigit():
                pop(len(stack) - 1)
            page.runs.append((stack[-1], ""))
            push(tag, _hint(attrs) if attrs else 0)
        elif tag not in VOID and attrs and (tag == "span") and _hint(attrs):
            push(tag, _hint(attrs))
    return page


def _cut(page: _Page) -> list[bool]:
    """Which elements are cut out, with all below them."""
    tags, parent = page.tag, page.parent
    core = [t in ("article", "main", "h1") for t in tags]
    if not any(core):  # No element names the article: those with most of the text outside links are spared.
        gone = [False] * len(tags)
        for i in range(1, len(tags)):
            gone[i] = gone[parent[i]] or tags[i] in CUT_TAGS or page.hint[i] == 2
        text = [0 if g else a - b for g, a, b in zip(gone, page.chars, page.link_chars, strict=True)]
        for i in range(len(tags) - 1, 0, -1):
            text[parent[i]] += text[i]
        core = [2 * x > text[0] for x in text]
    for i in range(len(tags) - 1, 0, -1):
        if core[i]:
            core[parent[i]] = True
    cut, within = [False] * len(tags), [False] * len(tags)
    for i in range(1, len(tags)):
        tag, up = tags[i], parent[i]
        within[i] = within[up] or tag in ("article", "main")
        own = tag in ("html", "body", "article", "main")
        cut[i] = (
            cut[up]
            or tag in CUT_TAGS
            or page.hint[i] == 2 and not own
            or page.hint[i] == 1 and not own and not core[i]
            or tag == "form" and not core[i]
            or tag == "header" and not within[up]
        )
    return cut


def extract(source: str) -> str:
    """The article's blocks, white space inside a block as one space, joined by newlines."""
    if not source:
        return ""
    page = _parse(source)
    tags, parent = page.tag, page.parent
    cut = _cut(page)
    n = len(tags)
    chars, count = page.chars[:], page.tags[:]
    link_chars, link_tags = page.link_chars[:], page.link_tags[:]
    for i in range(n - 1, 0, -1):
        up = parent[i]
        if cut[i]:
            count[up] -= not cut[up]
            continue
        chars[up] += chars[i]
        count[up] += count[i]
        link_chars[up] += link_chars[i]
        link_tags[up] += link_tags[i]

    body = next((i for i in range(n) if tags[i] == "body" and not cut[i]), 0)
    share = link_chars[body] / chars[body] if chars[body] else 0.0
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if cut[i]:
            continue
        c, t, lc, lt = chars[i], max(1, count[i]), max(1, link_chars[i]), max(1, link_tags[i])
        if c:
            base = math.log(c / max(1, c - link_chars[i]) * lc + share * c + math.e)
            density[i] = c / t * math.log(c / lc * t / lt) / math.log(base)
        if i:
            total[parent[i]] += density[i]
    if not chars[body]:
        body = 0

    inside = [False] * n
    inside[body] = True
    for i in range(body + 1, n):
        inside[i] = not cut[i] and inside[parent[i]]
    leaf = [True] * n
    for i in range(1, n):
        if inside[i]:
            leaf[parent[i]] = False
    weight = [density[i] if leaf[i] else total[i] for i in range(n)]
    heart = max((i for i in range(body, n) if inside[i] and not leaf[i]), key=lambda i: (total[i], i), default=body)

    path, i = [heart], heart
    while i != body:
        i = parent[i]
        path.append(i)
    threshold = min(density[i] for i in path)
    chosen = [False] * n
    # In each subtree at or above the threshold, its element of the largest sum is content.
    most = list(range(n))
    for i in range(n - 1, body, -1):
        if inside[i] and weight[most[i]] > weight[most[parent[i]]]:
            most[parent[i]] = most[i]
    goes, content = [False] * n, []
    for i in range(body, n):
        if inside[i] and (i == body or goes[parent[i]]) and not chosen[i] and density[i] >= threshold - 1e-9 and chars[i]:
            goes[i] = True
            if not chosen[most[i]]:
                chosen[most[i]] = True
                content.append(most[i])
    around = content[0] if content else heart
    for i in content[1:]:
        above = {around}
        while around != body:
            around = parent[around]
            above.add(around)
        while i not in above:
            i = parent[i]
        around = i
    if around != body:
        chosen = [False] * n
        chosen[around] = True
    for i in range(1, n):
        chosen[i] = (chosen[i] or chosen[parent[i]]) and not cut[i]

    blocks, words = [], []
    for i, piece in page.runs:
        if not piece:
            if words:
                blocks.append(" ".join("".join(words).split()))
                words = []
        elif chosen[i]:
            words.append(piece)
    if words:
        blocks.append(" ".join("".join(words).split()))
    return "\n".join(b for b in blocks if b)


def main_text(df: DataFrame, html: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``carry`` columns, ``text`` and ``n_chars`` (code points) of every row."""
    schema = T.StructType(
        [df.schema[c] for c in carry] + [T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_html"):
                found = [extract(s) for s in strings(part, "_html")]
                kept = [part.column(i) for i in range(len(carry))]
                made = [pa.array(found, type=pa.string()), pa.array(list(map(len, found)), type=pa.int64())]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    rows = df.select(*[df[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(carry)], df[f"`{html}`"].alias("_html"))
    return rows.mapInArrow(run, schema)
