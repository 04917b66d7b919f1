"""Main text of web pages by tag-path ratios.

A page is read once into text blocks, each with its root-to-leaf path of
block-level tags.  Text length and punctuation are summed per path and
divided by the path's text nodes; both ratios are smoothed over the paths in
page order and fused, and the paths above a threshold mark the content.  The
article or main element that holds most of the marked text is the article,
else the smallest element that holds all of it: all of its blocks are
returned in page order, except menus, adverts, notices, forms and reader
comments, known by element, role or class name.  Where only the whole page
holds the marked text, containers that are mostly links are left out too.

Edge cases: NULL, empty or text-free html gives the empty string; unclosed
and stray tags follow the usual implied ends; broken character references
stay as they are; repeated pages give repeated rows; an empty table gives an
empty result; extra columns pass through, clashing ones are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import apart, small_batches, strings, table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(script|style|textarea|title|noscript|iframe|template|svg)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>",
    re.S | re.I)
# what a tag looks like where quotes do not count
PLAIN_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(script|style|textarea|title|noscript|iframe|template|svg)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S | re.I)
_TAG_START = re.compile(r"</?[a-zA-Z]")
# attributes in order, values consumed whole, so that no value is taken for a name
ATTR = re.compile(r"([^\s/=][^\s/=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|(\S*+)))?+")
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# elements, roles and class or id words that hold no article text
LEAVE_TAGS = frozenset("nav header footer aside form button select option dialog menu object canvas head".split())
LEAVE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
LEAVE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices notification notifications alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs "
    "masthead footer sidebar aside widget comment comments reply replies respond discussion disqus share sharing social "
    "related recommended recommendations newsletter subscribe subscription signup login search pagination pager toolbar "
    "banner header topbar".split())
OWN_WORDS = frozenset("article post entry content story main body page".split())
# elements of text: their ids name a place in the article, not a part of the page
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figure figcaption caption tr td th address summary".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
                     "p pre section table ul".split())
CLOSES = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
SCOPE = frozenset("ul ol dl table div article section main body".split())
PUNCT = re.compile(r"[.,;:!?…。，、！？；：]")
INSIDE = 0.9  # share of the marked text an article or main element must hold
PAGE_WIDE = ("", "html", "body")


def _leave(tag: str, attrs: str) -> bool:
    if tag in LEAVE_TAGS:
        return True
    seen = set()
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in seen:  # the first of repeated attributes counts
            continue
        seen.add(name)
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in LEAVE_ROLES:
            return True
        if (name == "class" or name == "id" and tag not in TEXT_TAGS) and tag not in ("html", "body", "article", "main"):
            for token in value.split():
                parts = set(re.split(r"[-_]+", token))
                hit = parts & LEAVE_WORDS
                if hit and not (hit <= {"header", "banner"} and parts & OWN_WORDS):
                    return True
    return False


class Page:
    """A page's elements, numbered in page order (0: the page itself), and its text blocks.

    Parents have smaller numbers than their children, so sums over elements
    are made in one pass from the last to the first, and an element's
    descendants are a range of numbers.
    """

    def __init__(self):
        self.tag, self.parent, self.path, self.container = [""], [0], [0], [0]
        self.paths: dict[tuple[int, str], int] = {}  # (path of the parent, tag) -> path
        self.blocks: list[Block] = []

    def open(self, tag: str, parent: int) -> int:
        element = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.path.append(self.paths.setdefault((self.path[parent], tag), len(self.paths) + 1))
        self.container.append(self.container[parent] if tag in TEXT_TAGS else element)
        return element

    def summed(self, values: list) -> list:
        """Per element, the sum of ``values`` over itself and its descendants."""
        out = list(values)
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def last(self) -> list[int]:
        """Per element, its last descendant."""
        out = list(range(len(self.tag)))
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] = max(out[self.parent[e]], out[e])
        return out


class Block:
    __slots__ = ("element", "link", "nodes", "path", "text")

    def __init__(self, path, element, text, nodes, link):
        self.path, self.element, self.text, self.nodes, self.link = path, element, text, nodes, link


def tokens(page: str) -> Iterator[re.Match]:
    """Tags, comments and raw elements in order, each character looked at a bounded number of times.

    Behind the last ``>`` no tag can end.  Where a tag's quotes swallow all
    that is left, it and all later tags end at their first ``>``.
    """
    final, rule, at = page.rfind(">"), TOKEN, 0
    while (at := page.find("<", at)) >= 0:
        if at > final and not page.startswith("<!--", at):
            return
        m = rule.match(page, at)
        if m is None and rule is TOKEN and _TAG_START.match(page, at):
            rule = PLAIN_TOKEN
            m = rule.match(page, at)
        if m is None:
            at += 1
        else:
            yield m
            at = m.end()


def read_page(page: str) -> Page:
    """The page's elements, and its text blocks outside left-out elements, in page order."""
    out = Page()
    stack: list[tuple[str, bool, int]] = []  # tag, left out, element number
    opened: dict[str, int] = {}  # tags in the stack
    parts: list[str] = []
    linked: list[str] = []  # the parts inside links
    nodes = links = 0

    def plain(pieces):
        return " ".join(html.unescape("".join(pieces)).split())

    def flush():
        nonlocal nodes
        if parts:
            text = plain(parts)
            if text and not (stack and stack[-1][1]):
                element = stack[-1][2] if stack else 0
                out.blocks.append(Block(out.path[element], element, text, nodes, len(plain(linked))))
            parts.clear()
            linked.clear()
        nodes = 0

    def pop_to(tags, stop):
        if not any(opened.get(t) for t in tags):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                for tag, _, _ in stack[k:]:
                    opened[tag] -= 1
                del stack[k:]
                return
            if stack[k][0] in stop:
                return

    at = 0
    for m in tokens(page):
        if m.start() > at:
            piece = page[at:m.start()]
            parts.append(piece)
            if not piece.isspace():
                nodes += 1
                if links:
                    linked.append(piece)
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if m[2] else 1))
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        if m[2]:
            if opened.get(tag):
                pop_to((tag,), ())
            links = 0
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            pop_to(("p",), SCOPE)
        if tag in CLOSES:
            pop_to(CLOSES[tag].split(), SCOPE)
        left = bool(stack and stack[-1][1]) or _leave(tag, m[4])
        if not m[4].endswith("/"):
            stack.append((tag, left, out.open(tag, stack[-1][2] if stack else 0)))
            opened[tag] = opened.get(tag, 0) + 1
    if at < len(page):
        parts.append(page[at:])
        nodes += 1
    flush()
    return out


def path_scores(found: list[Block]) -> dict[int, float]:
    """Smoothed and fused text and punctuation ratios of each path."""
    sums: dict[int, list[float]] = {}
    for b in found:
        s = sums.setdefault(b.path, [0.0, 0.0, 0.0])
        s[0] += max(len(b.text) - b.link, 0)
        s[1] += len(PUNCT.findall(b.text))
        s[2] += b.nodes
    text = [s[0] / max(s[2], 1) for s in sums.values()]
    marks = [s[1] / max(s[2], 1) for s in sums.values()]

    def smooth(x):
        n = len(x)
        return [(x[max(i - 1, 0)] + 2 * x[i] + x[min(i + 1, n - 1)]) / 4 for i in range(n)]

    return {p: t * (1 + k) for p, t, k in zip(sums, smooth(text), smooth(marks))}


def main_text(html_text: str | None) -> str:
    page = read_page(html_text or "")
    found, names = page.blocks, page.tag
    if not found:
        return ""
    scores = path_scores(found)
    values = list(scores.values())
    mean = sum(values) / len(values)
    deviation = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
    threshold = min(mean, deviation) if deviation > 0 else mean

    def over(blocks, value, at=lambda b: b.element):
        out = [0] * len(names)
        for b in blocks:
            out[at(b)] += value(b)
        return out

    def container(b):  # the innermost element around a block that is not one of text
        return page.container[b.element]

    text = page.summed(over(found, lambda b: len(b.text)))
    link = page.summed(over(found, lambda b: b.link))
    count = page.summed(over(found, lambda b: 1))
    own_text, own_link = over(found, lambda b: len(b.text), container), over(found, lambda b: b.link, container)

    def prose(b):
        e = container(b)
        return names[e] in PAGE_WIDE or 2 * link[e] <= text[e] or 2 * own_link[e] <= own_text[e]

    marked = [b for b in found if scores[b.path] >= threshold]
    marked = [b for b in marked if prose(b)] or marked
    total = sum(len(b.text) for b in marked)
    held = page.summed(over(marked, lambda b: len(b.text)))
    # elements are numbered in page order, so the last large enough one is the smallest;
    # an element of one block is a paragraph, not the article around it
    large = [e for e, (n, k) in enumerate(zip(held, count)) if k and n >= INSIDE * total and (k > 1 or len(found) == 1)]
    article = max((e for e in large if names[e] == "article"), default=0) or max(
        (e for e in large if names[e] == "main"), default=0) or max((e for e in large if held[e] == total), default=0)
    end = page.last()[article]
    inside = [b for b in found if article <= b.element <= end]
    return " ".join(b.text for b in inside if names[article] not in PAGE_WIDE or prose(b))


EXTRACTED = T.StringType()


@F.pandas_udf(EXTRACTED)
def _extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield pd.Series([main_text(p) for p in strings(batch)], dtype=object)


@apart("page_id", "url", "html")
def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with text and n_chars in place of html."""
    small_batches(pages.sparkSession)
    out = pages.withColumn("text", _extract("html")).drop("html")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op8_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
