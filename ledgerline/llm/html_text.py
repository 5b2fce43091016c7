"""HTML extraction by minimum-cut labelling.

A page becomes a row of text blocks. Each block has a price for being called
content and one for being called boilerplate (terminal capacities); blocks
next to each other, or close in the DOM, have a price for being told apart
(smoothness edges). The cheapest labelling is a minimum cut, found by maximum
flow.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded_batches, column

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>")
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: An element that is not shown: the attribute ``hidden`` (its value apart), or a style that says so.
QUOTED = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*')")
HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])", re.I)
UNSEEN = re.compile(r"(?<![\w-])style\s*=\s*[\"'][^\"']*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
# Elements of HTML by how their text counts.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "annotation", "canvas", "object", "select", "title", "head", "audio", "video"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
          "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
FORMULA = {"math", "semantics", "menclose", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover", "mpadded", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle",
           "msub", "msubsup", "msup", "mtext", "munder", "munderover"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: An opening tag ends an open element of its own kind (paragraphs: any block does).
SELF_ENDING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CHROME = {"nav", "footer", "aside", "button", "menu", "dialog"}
#: Furniture if their text is mostly that of their controls.
FORMS = {"form", "fieldset"}
CONTROLS = {"input", "select", "textarea", "button"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words that name page furniture: a class, id, role or label does if it is made of these and NEUTRAL words only.
FURNITURE = {"ad", "ads", "adbox", "adsbygoogle", "adslot", "advert", "advertising", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "cookie", "cookies", "consent", "gdpr", "notice",
             "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "share", "sharing", "social", "related", "recommended", "sidebar", "side",
             "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "comment", "commentlist", "comments", "respond", "responses", "disqus", "reply",
             "replies", "toolbar", "pagination", "pager", "login", "signup", "search", "contentinfo", "complementary", "widget", "tags", "skip"}
NEUTRAL = {"site", "page", "container", "wrapper", "wrap", "box", "block", "area", "list", "section", "bar", "inner", "outer", "link", "links", "button", "buttons",
           "item", "items", "body", "content", "form", "title", "left", "right", "top", "bottom", "primary", "secondary", "global", "main", "post", "posts", "article",
           "articles", "text", "message", "policy", "group", "row", "col", "wp", "js", "to", "icons", "media"}
BODY = {"article", "main"}
BODY_WORDS = {"article", "main", "content", "entry", "post", "story", "prose"}
SURE = 1e6
#: Price of a cut between neighbours, and between the next two blocks of one parent.
NEXT, SIBLING = 1.6, 2.4
#: Parts of a block's score, chosen with the edges' prices on every other page of a table of 2,500 whose article and main were made plain
#: divisions: what speaks for text at all, for a heading, for an article around it; the least that its length and end take away.
START, HEADED, IN_ARTICLE, FLOOR = 0.7, 2.5, 3.4, -3.2
#: What a name of furniture takes from a block's score. It does not count for an element with more than half of the page's words, and
#: LONG at least, if articles outside have less than a tenth of them; nor for a form with PER_CONTROL words for each control and one more.
NAMED, LONG, PER_CONTROL = 5.0, 50, 8


@dataclass
class Mark:
    """An element that is furniture by its name, or a form; settled when the page is read."""

    form: bool
    outer: Mark | None
    words: float = 0.0
    controls: int = 0
    stands: bool = True


@dataclass
class Element:
    name: str
    up: Element | None
    furniture: bool  # for sure: not shown, or an element of HTML for it
    body: bool
    depth: int
    mark: Mark | None = None


@dataclass
class Block:
    parent: Element
    heading: bool
    text: str = ""
    linked: int = 0
    parts: list = field(default_factory=list)


def _names_of(name: str, attributes: str) -> list[set[str]]:
    """The words of each class, id, role and label; ids of headings and sections are places to link to, and tell nothing."""
    out: list[set[str]] = []
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "id" and (name == "section" or name in HEADINGS):
            continue
        for one in value.split() if kind in ("class", "role") else [value]:
            out.append({w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", one).lower()) if w})
    return out


def _hidden(attributes: str) -> bool:
    return bool(HIDDEN.search(QUOTED.sub("", attributes)) or UNSEEN.search(attributes))


def _element(name: str, attributes: str, up: Element) -> Element:
    names = _names_of(name, attributes) if attributes.strip() else []
    if up.body:  # the page has a header; an article's own header holds its title
        names = [w - {"header"} for w in names]
    elif name == "header":
        names.append({"header"})
    whole = name in ("html", "body")  # classes there speak of the page, not of a part of it
    named = not whole and any(w & FURNITURE and w <= FURNITURE | NEUTRAL for w in names)
    body = up.body or name in BODY or not whole and not named and any(w & BODY_WORDS and not w & FURNITURE for w in names)
    furniture = up.furniture or name in CHROME or not whole and _hidden(attributes)
    mark = up.mark
    if name in BODY and not up.body:
        mark = up.mark if named else None  # an article in a wrapper is no furniture, unless it is called so too
    elif name in FORMS or named and name not in BODY:
        mark = Mark(not named, up.mark)
    return Element(name, up, furniture, body, up.depth + 1, mark)


def _settle(blocks: list[Block], marks: list[Mark]) -> None:
    """Decide which marks stand, from the words outside links."""
    total = articles = 0.0
    for b in blocks:
        if not b.parent.furniture:
            words = (b.text.count(" ") + 1) * (1 - min(1.0, b.linked / max(1, len(b.text))))
            total += words
            if b.parent.mark:
                b.parent.mark.words += words
            elif b.parent.body:
                articles += words
    for m in reversed(marks):
        if m.outer:
            m.outer.words += m.words
            m.outer.controls += m.controls
    for m in marks:
        if m.form:
            own = m.words < PER_CONTROL * (m.controls + 1)
        else:
            own = m.words < LONG or m.words * 2 <= total or articles * 10 >= m.words
        m.stands = own or m.outer is not None and m.outer.stands


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order. Markup, comments, scripts and hidden elements have no text."""
    top = Element("", None, False, False, 0)
    at, here, out, links = 0, top, [], 0
    marks: list[Mark] = []
    block: Block | None = None

    def say(s: str) -> None:
        nonlocal block
        if s:
            if block is None:
                block = Block(here, here.name in HEADINGS)
            block.parts.append(s)
            if links:
                block.linked += len(s.strip())

    def end() -> None:
        nonlocal block
        if block is not None:
            block.text = " ".join(html.unescape("".join(block.parts)).split())
            if block.text:
                out.append(block)
            block = None

    while True:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        if lt > at:
            say(page[at:lt])
        if page.startswith("<!--", lt):
            stop = page.find("-->", lt + 4)
            at = len(page) if stop < 0 else stop + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            stop = page.find(">", lt)
            at = len(page) if stop < 0 else stop + 1
            continue
        m = TAG.match(page, lt)
        if not m:
            if not re.match(r"</?[a-zA-Z]", page[lt:lt + 3]):
                say("<")  # a plain less-than sign
                at = lt + 1
            else:  # an unfinished tag, or one with an open quote
                stop = page.find(">", lt)
                at = len(page) if stop < 0 else stop + 1
            continue
        at = m.end()
        closing, name, attributes = m[1], m[2].lower(), m[3]
        if name == "a":
            links = 0 if closing else 1
        if name == "br":
            say(" ")
        if name in CONTROLS and not closing and here.mark and not HIDDEN.search(attributes):
            here.mark.controls += 1
        if name in INLINE or name in FORMULA or name in VOID and name != "hr":
            continue
        if name in RAW and name != "head":  # within a paragraph it does not end it
            if not closing and not attributes.rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else len(page)
            continue
        end()
        if closing:
            e = here
            while e.up is not None and e.name != name:
                e = e.up
            if e.up is not None:
                here = e.up
                links = 0
            continue
        if name == "hr":
            continue
        if here.name == "p":
            here = here.up
        for e in SELF_ENDING.get(name, ()):
            if here.name == e:
                here = here.up
        here = _element(name, attributes, here)
        if here.mark and here.mark is not here.up.mark:
            marks.append(here.mark)
    end()
    _settle(out, marks)
    return out


def price(b: Block) -> tuple[float, float]:
    """(price of calling it boilerplate, price of calling it content): sides of a log-odds score, or sure."""
    if b.parent.furniture:
        return 0.0, SURE
    words = b.text.count(" ") + 1
    linked = min(1.0, b.linked / max(1, len(b.text)))
    named = b.parent.mark is not None and b.parent.mark.stands
    inside = b.parent.body and not named
    if inside and (linked <= 0.8 or words >= 12 or b.heading):  # no line of a menu
        linked /= 6
    score = START + max(FLOOR, 1.2 * math.log(words / 8) + (1.0 if b.text[-1] in ".!?…\"'»)" else -0.7))
    score += 0.8 * (b.parent.name == "p") + HEADED * b.heading + IN_ARTICLE * inside - 6.0 * linked - NAMED * named
    return max(0.0, score), max(0.0, -score)


def near(a: Block, b: Block) -> int:
    """Steps between the blocks' parents in the DOM."""
    x, y, steps = a.parent, b.parent, 0
    while x is not y:
        if x.depth >= y.depth:
            x = x.up
        else:
            y = y.up
        steps += 1
    return steps


def min_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source in a minimum cut (Dinic's maximum flow; edges hold both ways)."""
    n = len(source)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(there)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i in range(n):  # what both terminals ask cancels out
        both = min(source[i], sink[i])
        if source[i] > both:
            link(s, i, source[i] - both, 0.0)
        elif sink[i] > both:
            link(i, t, sink[i] - both, 0.0)
    for a, b, w in edges:
        link(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[s], queue = 0, deque([s])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if cap[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        start = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:  # one path after the other in the levels, without recursion
            if a == t:
                flow = min(cap[e] for e in path)
                for k, e in enumerate(path):
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if cap[e] <= 1e-12)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while start[a] < len(out[a]):
                e = out[a][start[a]]
                if cap[e] > 1e-12 and level[to[e]] == level[a] + 1:
                    break
                start[a] += 1
            if start[a] < len(out[a]):
                path.append(out[a][start[a]])
                a = to[path[-1]]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                start[a] += 1
            else:
                break


def labels(blocks: list[Block]) -> list[bool]:
    """True: content."""
    if not blocks:
        return []
    prices = [price(b) for b in blocks]
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT / (1 + near(blocks[i - 1], b))))
        up = b.parent.up or b.parent
        if id(up) in last and last[id(up)] != i - 1:
            edges.append((last[id(up)], i, SIBLING))
        last[id(up)] = i
    return min_cut([p[0] for p in prices], [p[1] for p in prices], edges)


def main_text(page: str | None) -> str:
    """The content blocks of a page, one a line; '' if there are none."""
    blocks = blocks_of(page or "")
    return "\n".join([b.text for b, keep in zip(blocks, labels(blocks)) if keep])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page; a null or empty page has the text ''.

    Repeated rows get equal results; other columns of ``pages`` are ignored.
    """

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p) for p in batch], dtype=object)

    bounded_batches(pages.sparkSession)
    return (pages.select(column(pages, id_col).alias("page_id"), column(pages, url_col).alias("url"), text_of(column(pages, html_col)).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
