"""Main text of web pages by a site style tree.

The DOMs of one host are merged: element nodes with the same path (tags and
class / id words from the root) become one node of the host's style tree.
Two statistics say how much a node matters:

* presentation: the entropy of its child-tag sequences over the host's pages;
* content: one minus the mean entropy of its text blocks, where a block that
  fills n of the node's m places has entropy log n / log m - menus and
  notices repeat and come near one, articles do not.

The importance of a node with text of its own is the mean of its content value
and the larger of the two; a pure container has that of what it contains, so
it is not judged itself.  Branches whose importance stays below ``threshold`` on a
host with at least ``least_pages`` pages are noise and are removed from each
page.  Branches that HTML itself marks as something else than the article
(nav, footer, aside, form, script, a class like "ad" or "comments") have no
importance on any host.  Of these marks a listed word, a form, fieldset or object
is weak: it can as well be on a wrapper of the whole page.  An article or main
inside weak marks counts if the page has none outside and its text is longer
than all unmarked text, and a page without any unmarked text or main keeps that
with the fewest weak marks around it.  Words like "has-comments" or
"no-sidebar" are no marks, and of an article's or main's own words only the
first of class and of id is.  Where a page has an article or main element, its text
is the main text, and the tree judges the nodes inside it too; elsewhere it
judges all unmarked text.  A page that the tree alone would leave empty keeps
its unmarked text, and so does an article of which the tree would take more
than half and over ``LONG`` characters: that is a copied article (under another
headline, say), not a notice.

Copies must not make their own text look like a menu, so pages are not counted
as such: a block of a node counts once for each different surrounding, which
is one block of the page's other nodes, chosen by a minimum of hashes weighted
by length.  Equal pages have one surrounding, near copies few, and a notice has
as many as there are articles around it.  A style counts once a page text.

The statistics are map-side combined counts over (host, node, style) and (host,
node, block), so a host with a third of all pages is spread over tasks; only
noise nodes are joined back, by host, and that join may be split.

Text: references decoded, white space within a block one space, trimmed,
blocks joined by one space.  Defined results: a null or empty html gives an
empty text; a url that is null or names no host has no tree;
unclosed, misnested or cut-off markup is read to its end; very long pages are
read whole; repeated rows give equal results; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layercake.llm.common import arrow_batches, materialize

# Kinds of HTML elements.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var".split())
NOISE = frozenset("head nav footer aside form script style noscript template button select option textarea iframe "
                  "svg canvas object menu dialog title audio video map fieldset datalist".split())
MAIN = frozenset(("article", "main"))
WRAPPERS = frozenset("form fieldset object".split())
STATES = frozenset("has no with without".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice "
    "notices paywall popup promo promotion related reply replies respond search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe subscription toolbar widget widgets disqus".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert "
                        "alertdialog".split())
LONG = 500
# an element of these kinds ends an open p; li, td and the like end their own kind
ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 "
                   "h6 header hr main menu nav ol p pre section table ul".split())
ENDS_OWN = {"li": "li", "dt": "dt dd", "dd": "dt dd", "td": "td th", "th": "td th", "tr": "tr td th",
            "option": "option"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*+(?:>|\Z)|<\?[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _listed(tag: str, named: tuple[str, str]) -> bool:
    """Whether class or id calls an element noise."""
    for value in named:
        for token in value.split():
            words = _WORDS.findall(_CAMEL.sub(" ", token).lower())
            if tag in MAIN:
                if words and words[0] in NOISE_WORDS:
                    return True
                break
            if words and words[0] not in STATES and not NOISE_WORDS.isdisjoint(words + _WORDS.findall(token.lower())):
                return True
    return False


def _kind(tag: str, attributes: str) -> tuple[str, int]:
    """Label of an element in the tree, and whether its markup calls it noise:
    0 no, 1 weakly, 2 yes."""
    mark = 0 if tag not in NOISE else 1 if tag in WRAPPERS else 2
    if attributes in ("", ">", "/>"):
        return tag, mark
    values = {}
    for name, value in _ATTRIBUTE.findall(attributes.rstrip("/>")):
        values.setdefault(name.lower(), value.strip("\"'"))
    both = values.get("class", ""), values.get("id", "")
    named = " ".join(both)
    named = _WORDS.findall((named + " " + _CAMEL.sub(" ", named) if _CAMEL.search(named) else named).lower())
    if (values.get("role", "").lower() in NOISE_ROLES or "hidden" in values
            or values.get("aria-hidden", "").lower() == "true"
            or "display:none" in values.get("style", "").replace(" ", "").lower()):
        mark = 2
    elif not mark and tag not in ("html", "body") and not NOISE_WORDS.isdisjoint(named) and _listed(tag, both):
        mark = 1
    return tag + "".join("." + w for w in named), mark


def _key(parent: int, label: str) -> int:
    """Node of the tree, as a signed 64-bit number."""
    x = xxhash.xxh64_intdigest(label.encode("utf-8", "replace"), parent & (1 << 64) - 1)
    return x - (1 << 64) if x >> 63 else x


class Page:
    """One page read into blocks: (text, nodes from the root, weak, base).

    ``weak``: weak marks on the branch; ``base``: those around its outermost
    article or main element, None outside of them.  Text inside a branch that
    the markup surely calls noise is left out.  ``empty``: whether the page has
    no unmarked article or main.  ``styles``: child-tag sequences by node."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, tuple, int, int | None]] = []
        self.empty = True
        self.styles: dict[int, int] = {}
        self.parts: list[str] = []
        # open elements: tag, node, surely noise, weak marks, base, nodes
        self.stack: list[tuple[str, int, bool, int, int | None, tuple]] = [("", 0, False, 0, None, None)]
        at = 0
        while True:
            m = _TOKEN.search(source, at)
            self._text(source[at:m.start()] if m else source[at:])
            if m is None:
                break
            at = m.end()
            if m[2]:
                at = self._tag(source, at, bool(m[1]), m[2].lower(), m[3])
        self._block()

    def _text(self, text: str) -> None:
        if text:
            self.parts.append(html.unescape(text) if "&" in text else text)

    def _block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                _, _, sure, weak, base, nodes = self.stack[-1]
                if not sure:
                    self.blocks.append((text, nodes, weak, base))
            self.parts = []

    def _close(self, depth: int) -> None:
        self._block()
        del self.stack[depth:]

    def _tag(self, source: str, at: int, closing: bool, tag: str, rest: str) -> int:
        if tag in INLINE:
            if not closing and not rest.endswith("/>"):
                noise = _kind(tag, rest)[1] if rest not in ("", ">") else 0
                if not noise:
                    return at
            elif not any(s[0] == tag for s in self.stack):
                return at
        if closing:
            if tag == "br" or tag == "p":
                self._block() if tag == "p" else self.parts.append(" ")
            for depth in range(len(self.stack) - 1, 0, -1):
                if self.stack[depth][0] == tag:
                    self._close(depth)
                    break
            return at
        if tag == "br":
            self.parts.append(" ")
            return at
        if tag in VOID:
            if tag == "hr":
                self._block()
            return at
        self._block()
        if tag in ENDS_P and self.stack[-1][0] == "p":
            self._close(len(self.stack) - 1)
        own = ENDS_OWN.get(tag)
        if own and self.stack[-1][0] in own.split():
            self._close(len(self.stack) - 1)
        label, mark = _kind(tag, rest)
        _, parent, sure, weak, base, nodes = self.stack[-1]
        if tag == "header" and base is None:
            mark = 2
        if tag in MAIN and label == tag:
            mark = 0
        self.styles[parent] = _key(self.styles.get(parent, 1), label)
        if tag in RAW:  # its content is not markup
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(source, at)
            return end.end() if end else len(source)
        node = _key(parent, label)
        if tag in MAIN and base is None and not mark and not sure:
            base = weak
            self.empty = self.empty and weak > 0
        self.stack.append((tag, node, sure or mark == 2, weak + (mark == 1), base, (nodes, node)))
        return at


def _chain(nodes) -> list[int]:
    out = []
    while nodes:
        nodes, node = nodes
        out.append(node)
    return out


def candidates(page: Page) -> tuple[list, bool]:
    """Blocks of a page that the tree judges, and whether they are an article's."""
    clean = [b for b in page.blocks if not b[2]]
    article = [b for b in clean if b[3] == 0]
    if not article:
        wrapped = [b for b in page.blocks if b[3] and b[2] == b[3]]
        if page.empty and sum(len(b[0]) for b in wrapped) > sum(len(b[0]) for b in clean):
            article = wrapped
        elif page.empty and not clean and page.blocks:
            least = min(b[2] for b in page.blocks)
            clean = [b for b in page.blocks if b[2] == least]
    return article or clean, bool(article)


def main_text(source: str, noise: frozenset = frozenset()) -> str:
    """Main text of one page, given its host's noise nodes."""
    blocks, article = candidates(Page(source))
    if noise:
        kept = [b for b in blocks if noise.isdisjoint(_chain(b[1]))]
        before, after = (sum(len(b[0]) for b in x) for x in (blocks, kept))
        if kept and not (article and before - after > max(after, LONG)):
            blocks = kept
    return " ".join(b[0] for b in blocks)


def host_of(url: str = "url") -> Column:
    """Lower-case host of a URL that names one, however odd the rest of it; else null.

    Statistics and removal both use it, so no page is judged by one and not the other."""
    host = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:@\s]+)", 1)
    return F.nullif(F.lower(host), F.lit(""))


def _surroundings(blocks) -> dict[int, int]:
    """By node with text, the block that stands for the text of the other nodes
    (0: no other has text).

    Every block draws a number from its hash, smaller for longer ones, so two
    pages draw the same with the share of text they have in common."""
    least = {}
    for node, value, size in blocks:
        drawn = -math.log(((value & (1 << 64) - 1) + 1) / (1 << 64)) / size, value
        if node not in least or drawn < least[node]:
            least[node] = drawn
    first, second = (sorted((d, node) for node, d in least.items()) + [((0.0, 0), 0)] * 2)[:2]
    return {node: (second if node == first[1] else first)[0][1] for node in least}


def style_tree(pages: DataFrame) -> DataFrame:
    """Nodes of all hosts: host, node, pages (different surroundings), importance."""
    def walk(batches):
        for b in batches:
            rows = []
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                page = Page(source)
                blocks = [(nodes[1], _key(2, text), len(text)) for text, nodes, *_ in candidates(page)[0] if nodes]
                whole = _key(3, repr(blocks))
                rows += [(host, node, 0, style, whole) for node, style in page.styles.items() if node]
                around = _surroundings(blocks)
                rows += {(host, node, 1, block, around[node]) for node, block, _ in blocks}
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                ["host", "node", "kind", "value", "around"])

    judged = pages.select(host_of().alias("host"), "html").where("host is not null and html <> ''")
    values = (judged.mapInArrow(walk, "host string, node long, kind int, value long, around long")
              .distinct().groupBy("host", "node", "kind", "value").agg(F.count("*").alias("n")))
    # per node and kind: sum n and sum n ln n are enough for either entropy
    sums = values.groupBy("host", "node", "kind").agg(
        F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
    h = F.when(F.col("m") > 1, 1 - F.col("s") / F.col("m") / F.log(F.greatest("m", F.lit(2)))).otherwise(1.0)
    content, style = (F.max(F.when(F.col("kind") == k, F.col("h"))) for k in (1, 0))
    return (sums.withColumn("h", h).groupBy("host", "node")
            .agg(F.max("m").alias("pages"), style.alias("style"), content.alias("content"))
            .withColumn("importance", F.when(F.col("content").isNull(), 1.0).otherwise(
                (F.col("content") + F.greatest("style", "content")) / 2)))


def extract(spark: SparkSession, pages: DataFrame, threshold: float = 0.3, least_pages: int = 4) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""
    arrow_batches(spark, 500)
    pages = pages.select("page_id", "url", "html")
    noise = materialize(style_tree(pages).where((F.col("importance") < threshold) & (F.col("pages") >= least_pages))
                        .groupBy("host").agg(F.collect_list("node").alias("noise")), spark, "noise_nodes")
    joined = pages.withColumn("host", host_of()).join(noise, "host", "left").select("page_id", "url", "html", "noise")

    def run(batches):
        for b in batches:
            texts = [main_text(source or "", frozenset(nodes or ()))
                     for source, nodes in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
