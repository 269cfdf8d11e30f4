"""Main text of web pages by template deduction over equivalence classes.

Every page becomes a sequence of tokens: its elements, told apart by their
path, and its blocks of text, told apart by path and content.  Per host, all
tokens with the same occurrence vector (how often in which page) form an
equivalence class; the vectors are compared by a digest that adds up over
pages in any order, so hosts of any size are aggregated map-side.  Classes
of at least two tokens that cover nearly all pages of a host are valid, where
pages that differ in markup alone count once (copies share their article too); the
element tokens among them are the host's frame.  Valid text classes outside
the article, and those inside whose path lies in the frame, nest in it:
together they are the template.  What the
template does not hold are the slots.

A page's text is read from its slots: blocks of the template are left out,
and so are regions that their markup declares as menu, header, footer,
sidebar, notice, advert, form, script, style or reader comment.  Of the rest
the article (or main) element counts; of pages without one all of it does,
whatever elements hold it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import broadcast_if_small, once, slices, stored, table, whole_text
from .url_rules import host_path

#: A class is valid from this many pages of different content and this share of a host's on.
LEAST_PAGES = 5
SUPPORT = 0.9
#: A template that would take this share of an article's characters takes none of them.
MOST = 0.5

# HTML element names.
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp", "noembed", "noframes"])
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"])
INLINE = frozenset(["a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
                    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"])
CLOSES_P = frozenset(["address", "article", "aside", "blockquote", "details", "dialog", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form",
                      "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"])
#: Elements that end an open one of the same kind.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset(["ul", "ol", "dl", "table", "select", "menu"])
ASIDE_TAGS = frozenset(["nav", "footer", "aside", "form", "head", "button", "select", "menu", "dialog", "fieldset", "object", "canvas", "audio", "video"])
ASIDE_ROLES = frozenset(["navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"])
# Words in class and id that name a region beside the article.
ASIDE_WORDS = frozenset([
    "ad", "ads", "adsense", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar",
    "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "widget", "footer", "header", "masthead", "cookie", "cookies", "consent", "gdpr",
    "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "comment",
    "comments", "commentlist", "reply", "replies", "respond", "disqus", "discussion", "share", "sharing", "social", "related", "recommended",
    "recommendations", "pagination", "pager", "copyright", "search", "toolbar", "toc", "disclaimer", "paywall"])
#: Words that name the page's frame or the article itself: they outweigh the words above but for STRONG.
BODY_WORDS = frozenset(["article", "body", "container", "content", "entry", "layout", "main", "page", "post", "story", "wrap", "wrapper"])
STRONG = frozenset(["ad", "ads", "advert", "advertisement", "comment", "comments", "footer", "menu", "nav", "navigation", "related", "sidebar", "share"])

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?>"[^"]*"|'[^']*'|[^'">])*+>|[^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b""")
_WORDS = re.compile(r"[a-z]+")


class Block(NamedTuple):
    """A run of text without a block boundary inside."""
    text: str
    path: int
    in_article: bool


class Element:
    __slots__ = ("tag", "path", "out", "article")

    def __init__(self, tag: str, path: int, out: bool, article: bool) -> None:
        self.tag, self.path, self.out, self.article = tag, path, out, article


def hashed(*parts: object) -> int:
    h = xxhash.xxh64_intdigest("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def is_aside(tag: str, attributes: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element's markup sets it apart from the article; its class
    and id words, without numbers."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return tag in ASIDE_TAGS or tag == "header" and not in_article, ""
    words: set[str] = set()
    apart = tag in ASIDE_TAGS or tag == "header" and not in_article
    for name, value, hidden in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            words.update(_WORDS.findall(value))
        elif name == "role":
            apart |= value in ASIDE_ROLES
        elif hidden or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            apart = True
    named = words & ASIDE_WORDS
    if in_article:
        named = named - {"header"}
    if named and (not words & BODY_WORDS or named & STRONG) and tag not in ("html", "body", "main"):
        apart = True
    return apart, " ".join(sorted(words))


def parse(page: str) -> tuple[list[Block], Counter]:
    """Blocks of text outside the regions set apart, and the paths of all elements."""
    blocks: list[Block] = []
    paths: Counter = Counter()
    root = Element("", 0, False, False)
    stack, run = [root], []
    # where each tag, and any block, is open in the stack: no end tag walks it in vain
    opened: dict[str, list[int]] = {}
    block_at = [0]

    def last(tag: str) -> int:
        return (opened.get(tag) or [0])[-1]

    def end_block() -> None:
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                inner = stack[-1]
                blocks.append(Block(text, inner.path, inner.article))

    def close(index: int) -> None:
        if any(e.tag not in INLINE for e in stack[index:]):
            end_block()
        for e in stack[index:]:
            opened[e.tag].pop()
            if e.tag not in INLINE:
                block_at.pop()
        del stack[index:]

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        upto = m.start() if m else size
        if upto > at and not stack[-1].out:
            run.append(html.unescape(page[at:upto]))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, attributes = m[2].lower(), m[3]
        if m[1]:
            # an inline end does not reach beyond its block
            if last(tag) and (tag not in INLINE or last(tag) > block_at[-1]):
                close(last(tag))
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at) if not attributes.endswith("/>") else None
            if not attributes.endswith("/>"):
                at = end.end() if end else size
            if tag not in INLINE:
                end_block()
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag not in INLINE:
            if tag in CLOSES_P and last("p") and last("p") == block_at[-1]:
                close(last("p"))
            if tag in SIBLINGS and (before := max(map(last, SIBLINGS[tag]))) and before >= max(map(last, LISTS)):
                close(before)
            end_block()
        if tag in VOID or attributes.endswith("/>") and tag in INLINE:
            continue
        inner = stack[-1]
        apart, words = is_aside(tag, attributes, inner.article)
        starts = tag in ("article", "main") and not apart
        path = inner.path if tag in INLINE else hashed(inner.path, tag, words)
        if tag not in INLINE:
            paths[path] += 1
        if apart and not inner.out:
            end_block()
        opened.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            block_at.append(len(stack))
        stack.append(Element(tag, path, inner.out or apart, inner.article or starts and not inner.out))
    end_block()
    return blocks, paths


def host_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (host, page, html) to tokens: elements (0), texts outside (1)
    and inside the article (2)."""
    for b in slices(batches):
        out: list[tuple] = []
        for host, page, source in zip(*(c.to_pylist() for c in b.columns), strict=True):
            blocks, paths = parse(source)
            out += [(host, page, 0, p, n, p) for p, n in paths.items()]
            texts = Counter((1 + x.in_article, hashed(x.path, x.text), x.path) for x in blocks)
            out += [(host, page, kind, t, n, p) for (kind, t, p), n in texts.items()]
        names = ["host", "page", "kind", "token", "n", "path"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string() if i == 0 else pa.int64()) for i in range(6)], names=names)


def templates(pages: DataFrame) -> DataFrame:
    """One row per host: ``texts`` (tokens of template texts) from rows of
    (host, page, html)."""
    spark = pages.sparkSession
    raw = pages.select("host", "page", "html").mapInArrow(host_tokens, "host string, page long, kind long, token long, n long, path long")
    tokens = stored(spark, raw.groupBy("host", "kind", "token").agg(
        F.count(F.lit(1)).alias("n_pages"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.min("path").alias("path")), "page-tokens")
    n_pages = pages.groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    known = tokens.join(n_pages, "host").where((F.col("n_pages") >= LEAST_PAGES) & (F.col("n_pages") >= SUPPORT * F.col("of")))
    size = Window.partitionBy("host", "vector", "n_pages")
    valid = known.withColumn("size", F.count(F.lit(1)).over(size)).where("size > 1")
    # at most 1/SUPPORT times as many tokens as a page has
    frames = valid.groupBy("host").agg(F.collect_set(F.when(F.col("kind") == 0, F.col("token"))).alias("frame"),
                                       F.collect_set(F.when(F.col("kind") > 0, F.struct("token", "path", "kind"))).alias("found"))
    texts = frames.select("host", F.transform(F.filter("found", lambda t: (t["kind"] == 1) | F.array_contains("frame", t["path"])), lambda t: t["token"]).alias("texts"))
    return n_pages.join(texts, "host", "left").select("host", "texts")


def main_text(page: str, template: frozenset[int], blocks: list[Block] | None = None) -> str:
    """``blocks``: those of the page, where it is parsed already."""
    blocks = parse(page)[0] if blocks is None else blocks
    slots = [x for x in blocks if hashed(x.path, x.text) not in template] if template else blocks
    article = [x for x in blocks if x.in_article]
    if article:
        slots = [x for x in slots if x.in_article]
        if sum(len(x.text) for x in slots) <= (1 - MOST) * sum(len(x.text) for x in article):
            slots = article
    return " ".join(x.text for x in slots)


def extract(pages: DataFrame, source: str = "html", url: str = "url", columns: list[str] | None = None) -> DataFrame:
    """The ``columns`` of ``pages`` (default: all) with ``text`` and
    ``n_chars`` (code points); they replace columns of the same name.

    Null html counts as empty and gives empty text; null urls, and urls
    without a host, form one host of their own.  Repeated pages are returned
    like any other, but count once for the template; hosts with few pages
    of different content have none, and their pages are read by their
    markup alone.  An empty table gives no rows.
    """
    spark = pages.sparkSession
    names = [c for c in columns or pages.columns if c not in ("text", "n_chars")]
    host = host_path(F.col(f"`{url}`"))[0]
    rows = pages.select(host.alias("__host"), whole_text(F.col(f"`{source}`")).alias("__html"), *[F.col(f"`{c}`") for c in names])
    content = F.xxhash64(F.regexp_replace("__html", r"<[^<>]*+>|\s+", "")).cast("string")
    keyed = once(rows.select(F.col("__host").alias("host"), F.col("__html").alias("html"), content.alias("content")), "host", "content")
    found = stored(spark, templates(keyed.select("host", "html", F.xxhash64("content").alias("page"))).withColumnRenamed("host", "__host"), "templates")
    size = found.agg(F.coalesce(F.sum(F.size(F.coalesce("texts", F.array())) + 4), F.lit(0))).first()[0]
    joined = rows.join(broadcast_if_small(found, size), "__host", "left").select("__html", "texts", *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            text = [main_text(h, frozenset(t or ())) for h, t in zip(*(b.column(i).to_pylist() for i in range(2)), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                             names=[*names, "text", "n_chars"])

    schema = StructType([*joined.schema.fields[2:], StructField("text", StringType()), StructField("n_chars", LongType())])
    return joined.mapInArrow(run, schema)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), columns=["page_id", "url"])
