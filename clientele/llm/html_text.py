"""Main text of web pages by boosted trees over DOM nodes and consistent decoding.

A tolerant parser builds the tree of a page; every stretch of text that no block element interrupts
is a leaf. Nodes and leaves are described by their tag, the words of class, id and role, what holds
them, text and link density of the subtree, depth and place among their siblings. Boosted trees give
each the probability of holding main text, and a pass over the tree picks the most likely labels in
which nothing below a rejected node is kept.

The trees are fitted on at most ``SAMPLE`` pages (smallest hashes, up to ``LONGEST`` characters
each), labelled by rules: a leaf is main text if an article or main element holds it and no
navigation, header, footer, aside, form or element of such a class lies between. Each page is used
as it is and in a variant with the article renamed and typical boxes put in, so that no one feature
of one template carries the decision.

Defined results: null, empty and text-free pages give an empty text; unclosed and stray tags are
closed and ignored as browsers do; scripts, styles, templates and comments are never text; repeated
rows get equal results; an empty table gives an empty result; very long pages are read in whole.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.boosting import BoostedTrees

SAMPLE, LONGEST = 300, 50_000
#: HTML's own lists and words that name boxes.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("script style noscript template iframe object svg math textarea title head".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub"
    " sup time tt u var wbr".split()
)
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main"
    " menu nav ol p pre section table ul".split()
)
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}}
SAME_CLOSES |= {"th": {"td", "th"}, "option": {"option"}}
SCOPES = set("article aside body div dl figure footer form header html main nav ol section table ul blockquote".split())
BOX_TAGS = set("nav header footer aside form menu button select dialog label fieldset".split())
MAIN_TAGS = {"article", "main"}
BOX_WORDS = set(
    "ad ads advert advertisement sponsor sponsored promo banner sidebar widget menu nav navbar navigation breadcrumb"
    " breadcrumbs header masthead footer copyright legal cookie cookies consent notice alert popup modal newsletter subscribe"
    " signup login search share sharing social related recommended comment comments reply replies respond disqus pagination"
    " pager toolbar tags meta byline".split()
)
MAIN_WORDS = set("article content main post entry story body text prose".split())


class Node:
    __slots__ = ("tag", "parent", "children", "words", "href", "text", "stats", "p")

    def __init__(self, tag: str, parent: Node | None, words: frozenset[str] = frozenset()):
        self.tag, self.parent, self.words = tag, parent, words
        self.children: list[Node] = []
        self.text: list[tuple[str, bool]] | None = None  # of a leaf: pieces, and whether in a link


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None)
        self.open = [self.root]
        self.inline: list[str] = []
        self.hidden: list[str] = []
        self.leaf: Node | None = None

    def _close_to(self, tags: set[str]) -> None:
        """Closes the nearest open element of ``tags`` that lies within the current scope."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                self.inline, self.leaf = [], None
                return
            if self.open[k].tag in SCOPES:
                return

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            if tag == self.hidden[-1]:
                self.hidden.append(tag)
            return
        if tag in HIDDEN:
            self.hidden.append(tag)
            return
        if tag in ("html", "body"):
            return
        if tag in INLINE:
            if tag == "br":
                self._add(" ")
            elif tag not in VOID:
                self.inline.append(tag)
            return
        if tag in CLOSES_P:
            self._close_to({"p"})
        if tag in SAME_CLOSES:
            self._close_to(SAME_CLOSES[tag])
        self.leaf = None
        if tag in VOID:
            return
        named = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        node = Node(tag, self.open[-1], frozenset(re.findall(r"[a-z]+", named.lower())))
        self.open[-1].children.append(node)
        self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE | HIDDEN | {"html", "body"}:
            self.handle_endtag(tag)
        elif tag in HIDDEN or tag in INLINE - VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.hidden:
            if tag in (self.hidden[-1], "head"):
                self.hidden = self.hidden[:-1] if tag != "head" else []
            return
        if tag in INLINE:
            if tag in self.inline:
                del self.inline[len(self.inline) - 1 - self.inline[::-1].index(tag) :]
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                self.inline, self.leaf = [], None
                return

    def _add(self, data: str) -> None:
        if self.leaf is None:
            if not data.strip():
                return
            self.leaf = Node("#text", self.open[-1])
            self.leaf.text = []
            self.open[-1].children.append(self.leaf)
        self.leaf.text.append((data, "a" in self.inline))

    def handle_data(self, data):
        if not self.hidden:
            self._add(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    # A head that holds text or blocks is a page without a body tag.
    builder.feed(re.sub(r"(?is)</?head\b[^>]*>", "", html))
    builder.close()
    return builder.root


def plain(leaf: Node) -> str:
    return " ".join("".join(t for t, _ in leaf.text).split())


def below(root: Node) -> list[Node]:
    """All nodes, parents before their children, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(node.children))
    return out


def boxed(node: Node) -> bool:
    return node.tag in BOX_TAGS or bool(node.words & BOX_WORDS)


def mainly(node: Node) -> bool:
    return node.tag in MAIN_TAGS or bool(node.words & MAIN_WORDS)


def features(nodes: list[Node]) -> np.ndarray:
    """One row of small integers per node."""
    for node in reversed(nodes):
        if node.text is not None:
            text = plain(node)
            linked = sum(len(t.strip()) for t, a in node.text if a)
            marks = sum(text.count(c) for c in ".,;:!?")
            node.stats = [len(text), min(linked, len(text)), marks, 1, 1, 0]
        else:
            own = [sum(c.stats[k] for c in node.children) for k in range(5)]
            node.stats = [*own[:4], own[4] + 1, max((int(mainly(c)) or c.stats[5] for c in node.children), default=0)]
    whole = max(1, nodes[0].stats[0])
    rows, held = [], {}
    for node in nodes:
        up = node.parent
        depth, in_box, in_main, place, siblings = held[id(up)] if up is not None else (-1, 0, 0, 0, 1)
        if up is not None:
            place = place_of[id(node)]
        else:
            place_of = {}
        in_box, in_main = int(in_box or boxed(node)), int(in_main or mainly(node))
        held[id(node)] = (depth + 1, in_box, in_main, 0, len(node.children))
        for k, child in enumerate(node.children):
            place_of[id(child)] = 10 * k // max(1, len(node.children))
        length, linked, marks, leaves, size, has_main = node.stats
        rows.append(
            [
                int(node.tag in BOX_TAGS),
                int(node.tag in MAIN_TAGS),
                int(bool(node.words & BOX_WORDS)),
                int(bool(node.words & MAIN_WORDS)),
                in_box,
                in_main,
                has_main,
                int(node.text is not None),
                int(node.tag in ("p", "blockquote", "pre")),
                int(node.tag in ("ul", "ol", "li", "dl", "table")),
                int(re.fullmatch("h[1-6]", node.tag) is not None),
                min(depth + 1, 15),
                int(math.log2(1 + length)),
                10 * linked // max(1, length),
                int(math.log2(1 + length / size)),
                10 * length // whole,
                min(100 * marks // max(1, length), 15),
                int(math.log2(1 + (siblings if up is not None else 1))),
                place,
                min(leaves, 15),
            ]
        )
    return np.array(rows, np.int64)


def rule_labels(nodes: list[Node]) -> list[int]:
    """1 for leaves that the rules take for main text and for all that holds one."""
    state, label = {}, {}
    for node in nodes:
        main, box = state.get(id(node.parent), (False, False))
        if node.tag in MAIN_TAGS or node.words & MAIN_WORDS:
            main = True
        box = box or boxed(node)
        state[id(node)] = (main, box)
        label[id(node)] = int(node.text is not None and main and not box)
    for node in reversed(nodes):
        if node.parent is not None and label[id(node)]:
            label[id(node.parent)] = 1
    return [label[id(n)] for n in nodes]


def varied(html: str, spare: str, dice: random.Random) -> str:
    """The page with its article renamed and boxes with the words of another page put in."""
    words = re.sub(r"<[^>]*>", " ", spare).split()[:400] or ["x"]

    def some(n: int) -> str:
        at = dice.randrange(len(words))
        return " ".join((words[at:] + words)[:n]).replace("<", "&lt;")

    tag, word = dice.choice([("article", ""), ("main", ""), ("div", "content"), ("div", "post"), ("section", "entry")])
    named = f' class="{word}"' if word else ""
    html = re.sub(r"<article\b[^>]*>", f"<{tag}{named}>", html).replace("</article>", f"</{tag}>")
    for _ in range(4):
        box = dice.choice(sorted(BOX_WORDS) + sorted(BOX_TAGS) * 3)
        open_, close = (f"<{box}>", f"</{box}>") if box in BOX_TAGS else (f'<div class="{box}">', "</div>")
        body = "".join(f"<p>{some(dice.randrange(2, 60))}</p>" for _ in range(dice.randrange(1, 4)))
        edges = [m.end() for m in re.finditer(r"</(?:p|h1|nav|body|article|main|section|div)>", html)] or [len(html)]
        at = dice.choice(edges)
        html = html[:at] + open_ + body + close + html[at:]
    return html


def fit(pages: DataFrame, sample: int = SAMPLE) -> BoostedTrees:
    chosen = pages.select("html").where(F.char_length("html").between(1, LONGEST))
    chosen = [r.html for r in chosen.orderBy(F.xxhash64("html"), "html").limit(sample).collect()]
    dice, rows, labels = random.Random(7), [], []
    for k, html in enumerate(chosen):
        for page in (html, varied(html, chosen[k - 1], dice), varied(html, chosen[k - 2], dice)):
            nodes = below(parse(page))
            rows.append(features(nodes))
            labels += rule_labels(nodes)
    x = np.concatenate(rows) if rows else np.zeros((0, 20), np.int64)
    return BoostedTrees.fit(x, labels, np.ones(len(labels)), rounds=40, depth=4)


def decoded(nodes: list[Node], p: np.ndarray) -> list[int]:
    """The most likely labels in which a node of label 0 has only such below it."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    index = {id(n): k for k, n in enumerate(nodes)}
    none, some = np.log(1 - p), np.log(p)
    for k in range(len(nodes) - 1, 0, -1):
        up = index[id(nodes[k].parent)]
        none[up] += none[k]
        some[up] += max(none[k], some[k])
    label = [int(some[0] >= none[0])]
    for k in range(1, len(nodes)):
        label.append(int(label[index[id(nodes[k].parent)]] and some[k] >= none[k]))
    return label


def main_text(html: str | None, trees: BoostedTrees) -> str:
    nodes = below(parse(html or ""))
    if len(nodes) < 2:
        return ""
    label = decoded(nodes, trees.scores(features(nodes)))
    return "\n\n".join(plain(n) for n, keep in zip(nodes, label) if keep and n.text is not None)


def extract(pages: DataFrame, trees: BoostedTrees | None = None) -> DataFrame:
    """``pages`` packed as ``row``, with the main ``text`` of ``html``."""
    trees = trees or fit(pages)
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([main_text(h, shared.value) for h in htmls], dtype=object)

    return pages.select(F.struct("*").alias("row"), read("html").alias("text"))
