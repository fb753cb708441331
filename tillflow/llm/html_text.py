"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page is parsed to a tree of block elements. Every element has features of itself (tag,
tokens of its class and id), its subtree (text, links, density of tags), its depth, its
siblings and its ancestors; boosted trees give the log odds that it belongs to the article.
The decoding takes the most likely consistent choice: what lies in a rejected element
is rejected, too. The trees are fitted to pages whose layouts are drawn from a grammar,
as many as a parameter says, since no page comes with labels.
"""

from __future__ import annotations

import html
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import boosting

#: Fixed sets of element names.
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "math", "canvas", "title", "textarea"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
#: An element of the first name ends an open one of the others, if there is no border between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
BORDERS = {"ul", "ol", "dl", "table", "select", "body"}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    tag: str
    tokens: tuple[str, ...]
    parent: int
    depth: int
    chars: int = 0  # of its own text, inline elements included
    linked: int = 0  # of these, in links
    links: int = 0
    stops: int = 0  # ends of sentences
    inputs: int = 0
    children: list[int] = field(default_factory=list)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The block elements in page order and the pieces of text (element, text): text that no
    border of a block interrupts is one piece. Never fails: tags without an end or a
    beginning are closed or passed over."""
    nodes = [Node("body", (), -1, 0)]
    pieces: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("body", 0)]  # open elements; inline ones point to their block
    run: list[str] = []
    anchors = linked = 0
    at, end = 0, len(page)

    def close_run() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                node = stack[-1][1]
                own = nodes[node]
                own.chars += len(text)
                own.linked += min(linked, len(text))
                own.stops += text.count(". ") + text.count("! ") + text.count("? ") + (text[-1] in ".!?")
                pieces.append((node, text))
        linked = 0

    while at < end:
        found = TOKEN.search(page, at)
        text = page[at:found.start()] if found else page[at:]
        if text:
            run.append(text)
            if anchors:
                linked += len(text)
        if not found:
            break
        at = found.end()
        name = found[2]
        if name is None:
            continue  # comments and declarations
        name = name.lower()
        if found[1]:
            if name in INLINE:
                if name == "a":
                    anchors = max(0, anchors - 1)
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k]
                        break
                    if stack[k][0] not in INLINE:
                        break
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close_run()
                    del stack[k:]
                    anchors = 0
                    break
            else:
                if name == "p":
                    close_run()
            continue
        if name in RAW:
            closing = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if not (found[3] or "").endswith("/"):
                at = closing.end() if closing else end
            continue
        if name in VOID:
            if name in ("br", "wbr", "img"):
                run.append(" " if name != "wbr" else "")
            elif name == "input":
                nodes[stack[-1][1]].inputs += 1
            elif name == "hr":
                close_run()
            continue
        if name in ("html", "body", "head"):
            if name == "head":
                closing = re.compile(r"</head\s*>|<body[\s>]", re.I).search(page, at)
                if closing:
                    at = closing.start() if closing[0][1] != "/" else closing.end()
            continue
        if name in INLINE:
            if name == "a":
                anchors += 1
                nodes[stack[-1][1]].links += 1
            stack.append((name, stack[-1][1]))
            continue
        close_run()
        anchors = 0
        # A block ends an open paragraph; an item ends the item before it.
        ended = ENDS.get(name, set()) | {"p"}
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in ended:
                del stack[k:]
                break
            if stack[k][0] in BORDERS or (stack[k][0] not in INLINE and name not in ENDS):
                break
        attributes = found[3] or ""
        tokens = tuple(t.lower() for m in ATTRIBUTE.finditer(attributes)
                       for t in PIECES.findall(m[1] or m[2] or m[3] or "")) if "=" in attributes else ()
        parent = stack[-1][1]
        nodes.append(Node(name, tokens, parent, nodes[parent].depth + 1))
        nodes[parent].children.append(len(nodes) - 1)
        stack.append((name, len(nodes) - 1))
    close_run()
    return nodes, pieces


# --- features --------------------------------------------------------------------

class Weights:
    """How far the tag and the attribute tokens of an element speak for the article: smoothed
    log odds from the training pages; 0 for those not seen there."""

    def __init__(self, seen: dict[str, list[int]] | None = None, total: tuple[int, int] = (1, 1)):
        yes, no = total
        self.known = {
            t: float(np.log((c[1] + 1) / (yes + 2)) - np.log((c[0] + 1) / (no + 2))) for t, c in (seen or {}).items()}

    def of(self, names: tuple[str, ...]) -> tuple[float, float]:
        values = [self.known.get(n, 0.0) for n in names]
        return (min(values, default=0.0), max(values, default=0.0))


def features(nodes: list[Node], weights: Weights) -> list[list[float]]:
    """A row for each node but the root."""
    n = len(nodes)
    chars, linked, tags, links, stops, inputs = ([0] * n for _ in range(6))
    for k in range(n - 1, -1, -1):
        node = nodes[k]
        chars[k] += node.chars
        linked[k] += node.linked
        links[k] += node.links
        stops[k] += node.stops
        inputs[k] += node.inputs + (node.tag in ("form", "button", "select"))
        tags[k] += 1
        if k:
            for total in (chars, linked, tags, links, stops, inputs):
                total[node.parent] += total[k]
    low, high, tag = [0.0] * n, [0.0] * n, [0.0] * n
    above_low, above_high, above_tag = [0.0] * n, [0.0] * n, [0.0] * n
    rows = []
    page_chars = max(1, chars[0])
    for k in range(1, n):
        node, up = nodes[k], nodes[k].parent
        low[k], high[k] = weights.of(node.tokens)
        tag[k] = weights.of((f"<{node.tag}>",))[0]
        above_low[k] = min(above_low[up], low[up])
        above_high[k] = max(above_high[up], high[up])
        above_tag[k] = tag[up] if abs(tag[up]) > abs(above_tag[up]) else above_tag[up]
        family = nodes[up].children
        alike = sum(nodes[s].tag == node.tag for s in family) if len(family) < 400 else len(family)
        rows.append([
            low[k], high[k], tag[k], above_low[k], above_high[k], above_tag[k], node.depth,
            chars[k], chars[k] / page_chars, chars[k] / tags[k], linked[k] / max(1, chars[k]), links[k], tags[k],
            stops[k], stops[k] / max(1, chars[k]) * 100, inputs[k], node.chars, node.links,
            len(family), alike, (chars[up] - chars[k]) / max(1, len(family) - 1),
            linked[up] / max(1, chars[up]), chars[up] / page_chars, len(node.children),
            node.depth and k / n,
        ])
    return rows


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """Which elements belong to the article: the best choice in which nothing in a rejected
    element is accepted. An element counts by its own text."""
    n = len(nodes)
    own = [0.0] + [float(o) * (0.25 + np.log1p(nodes[k + 1].chars)) for k, o in enumerate(odds)]
    dropped, kept = [0.0] * n, [0.0] * n
    for k in range(n - 1, -1, -1):
        dropped[k] -= own[k]
        kept[k] += own[k]
        if k:
            up = nodes[k].parent
            dropped[up] += dropped[k]
            kept[up] += max(kept[k], dropped[k])
    accepted = [False] * n
    accepted[0] = True
    for k in range(1, n):
        accepted[k] = accepted[nodes[k].parent] and kept[k] > dropped[k]
    return accepted


# --- training ---------------------------------------------------------------------

#: Names that layouts are drawn with: for parts of the article, and for all else.
ARTICLE_NAMES = ["content", "article", "post", "entry", "main", "story", "text", "body", "article-body",
                 "post-content", "entry-content", "page-content", "section", "wrapper", "container", ""]
OTHER_NAMES = {
    "nav": ["nav", "menu", "navbar", "breadcrumb", "navigation", "top-menu", "toc"],
    "header": ["header", "masthead", "site-header", "branding", "topbar", "banner"],
    "footer": ["footer", "site-footer", "copyright", "bottom", "legal", "colophon"],
    "aside": ["sidebar", "aside", "related", "widget", "recommended", "popular", "tags", "more"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "adsense"],
    "notice": ["notice", "cookie", "cookie-banner", "consent", "alert", "gdpr", "popup", "newsletter", "subscribe",
               "message", "disclaimer", "modal"],
    "form": ["form", "search", "login", "signup", "search-form", "contact"],
    "comments": ["comments", "comment", "comment-list", "reply", "respond", "discussion", "disqus", "replies"],
    "share": ["share", "social", "sharing", "share-buttons", "follow"],
}


class Layouts:
    """Random pages; whether an element is of the article stands in its ``data-y``."""

    def __init__(self, seed: int):
        self.rnd = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        n = self.rnd.randint(low, high)
        words = ["".join(self.rnd.choice("aeiourstnlm") for _ in range(self.rnd.randint(1, 9))) for _ in range(n)]
        for k in range(7, n, 9):
            words[k] += self.rnd.choice([".", ",", "."])
        return " ".join(words).capitalize() + self.rnd.choice([".", ".", "", "!"])

    def element(self, tag: str, name: str, y: int, inner: str) -> str:
        attribute = self.rnd.choice(["class", "class", "id"]) if name else ""
        naming = f' {attribute}="{name}"' if attribute else ""
        closing = "" if tag in ("p", "li") and self.rnd.random() < 0.15 else f"</{tag}>"
        return f'<{tag}{naming} data-y="{y}">{inner}{closing}'

    def links(self, n: int, y: int = 0) -> str:
        items = [self.element("li", "", y, f'<a href="/x">{self.words(1, 4)}</a>') for _ in range(n)]
        return self.element(self.rnd.choice(["ul", "ul", "ol"]), "", y, "".join(items))

    def article(self) -> str:
        rnd = self.rnd
        parts = [self.element("h1", "", 1, self.words(2, 14))] if rnd.random() < 0.85 else []
        if rnd.random() < 0.15:
            parts = [self.element("header", "", 1, "".join(parts) or self.words(3, 9))]
        for _ in range(rnd.randint(1, 14)):
            kind = rnd.random()
            text = self.words(*rnd.choice([(1, 8), (5, 30), (20, 90), (60, 220)]))
            if rnd.random() < 0.3:
                text = f"<b>{text}</b>" if rnd.random() < 0.5 else text + f' <a href="/y">{self.words(1, 5)}</a> ' + self.words(3, 20)
            if kind < 0.76:
                parts.append(self.element("p", "", 1, text))
            elif kind < 0.82:
                parts.append(self.element(rnd.choice(["h2", "h3"]), "", 1, self.words(1, 9)))
            elif kind < 0.88:
                items = [self.element("li", "", 1, self.words(2, 25)) for _ in range(rnd.randint(1, 7))]
                parts.append(self.element(rnd.choice(["ul", "ol"]), "", 1, "".join(items)))
            elif kind < 0.92:
                parts.append(self.element("blockquote", "", 1, self.element("p", "", 1, text)))
            elif kind < 0.95:
                rows = [self.element("tr", "", 1, "".join(self.element("td", "", 1, self.words(1, 5)) for _ in range(3)))
                        for _ in range(rnd.randint(1, 5))]
                parts.append(self.element("table", "", 1, "".join(rows)))
            else:
                parts.append(self.element("div", rnd.choice(["", "text", "section"]), 1, text))
        # What is not of the article may stand in its middle.
        if rnd.random() < 0.25:
            parts.insert(rnd.randint(0, len(parts)), self.other(rnd.choice(["ad", "share", "aside", "notice"])))
        if rnd.random() < 0.08:
            parts.append(self.other(rnd.choice(["comments", "footer"])))
        return "".join(parts)

    def other(self, kind: str) -> str:
        rnd = self.rnd
        name = rnd.choice(OTHER_NAMES[kind])
        tags = {"nav": ["nav", "nav", "div", "ul"], "header": ["header", "header", "div"],
                "footer": ["footer", "footer", "div"], "aside": ["aside", "aside", "div", "section"],
                "form": ["form", "form", "div"], "comments": ["div", "section", "ol"]}
        tag = rnd.choice(tags.get(kind, ["div", "div", "section", "p", "span" if rnd.random() < 0.1 else "div"]))
        named = name if tag in ("div", "section", "p", "ul", "ol", "span") or rnd.random() < 0.5 else ""
        if kind == "nav" or (kind in ("aside", "share", "footer") and rnd.random() < 0.5):
            inner = self.links(rnd.randint(1, 12)) if tag != "ul" else "".join(
                self.element("li", "", 0, f'<a href="/x">{self.words(1, 3)}</a>') for _ in range(rnd.randint(2, 9)))
        elif kind == "form":
            inner = '<input name="q">' + self.element("button", "", 0, self.words(1, 2)) + (
                self.element("label", "", 0, self.words(1, 5)) if rnd.random() < 0.5 else "")
        elif kind == "comments":
            inner = "".join(
                self.element(rnd.choice(["div", "li", "article"]), rnd.choice(["comment", "reply", ""]), 0,
                             self.element("p", "", 0, self.words(3, 60))) for _ in range(rnd.randint(1, 6)))
        else:
            inner = self.words(*rnd.choice([(1, 6), (3, 14), (8, 40)]))
            if rnd.random() < 0.5:
                inner = self.element(rnd.choice(["p", "p", "div", "h3", "h4"]), "", 0, inner)
            if kind == "footer":
                inner = "&copy; " + inner
        return self.element(tag, named, 0, inner)

    def page(self) -> str:
        rnd = self.rnd
        holder = rnd.choice(["article", "article", "main", "div", "div", "section"])
        body = self.element(holder, rnd.choice(ARTICLE_NAMES) if holder != "article" or rnd.random() < 0.4 else "", 1,
                            self.article())
        for _ in range(rnd.choice([0, 0, 1, 2])):
            body = self.element(rnd.choice(["div", "main", "section"]), rnd.choice(ARTICLE_NAMES), 1, body + (
                self.other(rnd.choice(["aside", "comments", "share", "ad"])) if rnd.random() < 0.3 else ""))
        before = [self.other(k) for k in ("header", "nav", "ad", "notice", "form") if rnd.random() < 0.5]
        after = [self.other(k) for k in ("aside", "comments", "share", "ad", "notice", "form") if rnd.random() < 0.35]
        rnd.shuffle(before)
        rnd.shuffle(after)
        if rnd.random() < 0.8:
            after.append(self.other("footer"))
        return "<html><body>" + "".join(before) + body + "".join(after) + "</body></html>"


MARK = re.compile(r'<([a-z0-9]+)[^>]*? data-y="([01])"')


@dataclass
class Extractor:
    weights: Weights
    model: boosting.Boosted

    def texts(self, pages: list[str]) -> list[str]:
        parsed = [parse(p) for p in pages]
        rows = [features(nodes, self.weights) for nodes, _ in parsed]
        every = [r for page in rows for r in page]
        odds = self.model.log_odds(np.array(every, np.float64)) if every else np.zeros(0)
        found, at = [], 0
        for (nodes, pieces), own in zip(parsed, rows, strict=True):
            accepted = decode(nodes, odds[at:at + len(own)])
            at += len(own)
            # Bare text of the body counts where there are no blocks to judge.
            bare = len(nodes) == 1
            found.append("\n\n".join(t for k, t in pieces if accepted[k] and (k or bare)))
        return found


def train(pages: int = 700, seed: int = 5) -> Extractor:
    """Fits the trees to ``pages`` random layouts: that bounds the training sample."""
    layouts = Layouts(seed)
    seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    total, parsed = [0, 0], []
    for _ in range(pages):
        page = layouts.page()
        nodes, _ = parse(page)
        labels = [int(y) for tag, y in MARK.findall(page) if tag not in INLINE]
        parsed.append((nodes, labels))
        for node, y in zip(nodes[1:], labels, strict=True):
            total[y] += 1
            for name in {f"<{node.tag}>", *node.tokens}:
                seen[name][y] += 1
    weights = Weights(seen, (total[1], total[0]))
    rows = np.array([r for nodes, _ in parsed for r in features(nodes, weights)], np.float64)
    return Extractor(weights, boosting.fit(rows, np.array([y for _, labels in parsed for y in labels], np.float64)))


def extract(pages: DataFrame, extractor: Extractor | None = None, page_id: str = "page_id", url: str = "url",
            markup: str = "html", group: int = 200) -> DataFrame:
    """Per row of ``pages``: page_id, url, text.

    Character references are decoded, white space inside a block is one blank, blocks stand
    in page order with an empty line between. A null or empty page has the empty text, as
    has one without an article; a page without any element is taken as it is. Broken and
    very long markup is parsed as far as it goes. Repeated rows are answered each; other
    columns are ignored; an empty table gives an empty one. ``group`` is the number of
    pages whose elements are scored at once.
    """
    extractor = extractor or train()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, group):
                part = batch.slice(at, group)
                texts = extractor.texts(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(markup), F.lit("")).alias("html"),
    ).mapInArrow(work, "page_id long, url string, text string")
