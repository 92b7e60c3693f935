"""Main text of web pages, with site templates removed.

1. Each page is parsed once into a tree that follows HTML's rules for void elements,
   optional end tags and raw text. Elements that are boilerplate by kind (menus, headers,
   footers, sidebars, notices, adverts, forms, scripts, styles, comments of readers) are
   left out: by tag, by role, or by a word of class or id. If the page has an article or
   main element, only what is inside it counts.
2. Every remaining element's subtree gets a hash (tags, classes and text). Its blocks of
   text carry the hashes of the elements around them.
3. Spark counts each hash over the distinct pages of its host. A subtree that recurs on
   many of them is a site template, and the blocks in it are deleted. Pages whose main text
   is equal count once, so copies of an article do not make a template of it; an article,
   a main element and the paragraphs, headings and list items of an article are never
   deleted for recurring, as quoted passages recur too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrspark.session import scratch_path

LEAST_PAGES = 5
LEAST_SHARE = 0.3

# Element kinds of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES: dict[str, set[str]] = {  # a start tag closes an open element of these kinds
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"},
    "thead": {"tr", "td", "th", "tbody"},
}
SCOPES = {"ul", "ol", "dl", "table", "select", "article", "section", "div", "body", "html"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

# What marks boilerplate.
BOILERPLATE_TAGS = RAW | set(
    "head nav footer aside form button select input dialog menu svg canvas object audio video map datalist".split()
)
BOILERPLATE_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
BOILERPLATE_WORDS = set(
    "ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead comment comments respond replies reply disqus share sharing social related recommended newsletter "
    "subscribe subscription signup login paywall pagination pager skip toolbar topbar widget adsbygoogle adbox adslot "
    "mainnav topnav subnav sitenav commentlist commentform colophon".split()
)
LAYOUT_WORDS = set("has no with without is wp".split())
ARTICLE_WORDS = set("article entry post story content title".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<]*\Z", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_WORD = re.compile(r"[a-z0-9]+")


class Element:
    __slots__ = ("tag", "digest", "drop", "main", "number")

    def __init__(self, tag: str, drop: bool, main: bool, number: int, start: str):
        self.tag, self.drop, self.main, self.number = tag, drop, main, number
        self.digest = hashlib.blake2b(start.encode("utf-8", "surrogatepass"), digest_size=8)


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if "=" in text else {}


def is_boilerplate(tag: str, marks: dict[str, str], inside_main: bool) -> bool:
    """By tag, role, or a word of class or id.

    Names that speak of the layout around an element ("has-sidebar", "no-nav") say nothing
    about it, and the header of an article is part of it.
    """
    if tag in BOILERPLATE_TAGS or tag == "header" and not inside_main:
        return True
    if marks.get("role", "").lower() in BOILERPLATE_ROLES:
        return True
    if tag in ("body", "html", "main"):
        return False
    words: set[str] = set()
    for name in f"{marks.get('class', '')} {marks.get('id', '')}".lower().split():
        parts = _WORD.findall(name)
        if parts and parts[0] not in LAYOUT_WORDS:
            words.update(parts)
    if words & BOILERPLATE_WORDS:
        return True
    return "header" in words and not inside_main and not words & ARTICLE_WORDS


class Parsed:
    """A page's blocks: text, whether inside an article, and the elements around it."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, bool, list[int]]] = []
        self.digests: dict[int, int] = {}  # elements that may be templates


def parse(html: str) -> Parsed:
    out = Parsed()
    stack: list[Element] = []
    parts: list[str] = []
    around: list[int] = []
    in_main = dropped = 0
    made = 0

    def flush() -> None:
        nonlocal parts
        text = " ".join("".join(parts).split())
        parts = []
        if text:
            out.blocks.append((text, in_main > 0, list(around)))

    def add(text: str) -> None:
        nonlocal around
        if dropped:
            return
        text = unescape(text) if "&" in text else text
        if not parts or not any(not p.isspace() for p in parts):
            around = [e.number for e in stack if e.tag not in INLINE]
        parts.append(text)
        for e in stack:
            e.digest.update(text.encode("utf-8", "surrogatepass"))

    def close(to: int) -> None:
        nonlocal in_main, dropped
        while len(stack) > to:
            e = stack.pop()
            if e.tag not in INLINE:
                flush()
            dropped -= e.drop
            in_main -= e.main
            if not e.drop and not dropped and e.tag not in INLINE:
                value = int.from_bytes(e.digest.digest(), "little", signed=True)
                text_like = e.tag in HEADINGS or e.tag in ("p", "li", "blockquote", "pre", "td", "dd", "dt")
                if not (e.main or e.tag in ("body", "html") or in_main and text_like):
                    out.digests[e.number] = value

    at, n = 0, len(html)
    while at < n:
        token = _TOKEN.search(html, at)
        add(html[at : token.start() if token else n])
        if token is None:
            break
        at = token.end()
        tag = token[2]
        if tag is None:
            continue
        tag = tag.lower()
        if token[1]:
            spot = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)
            if spot is not None and not (tag in INLINE and any(e.tag not in INLINE for e in stack[spot:])):
                close(spot)
            continue
        if tag not in INLINE:
            flush()
            if tag != "hr":  # an open paragraph ends where a block begins
                spot = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == "p" or stack[i].tag in ("button", "td", "th")), None)
                if spot is not None and stack[spot].tag == "p":
                    close(spot)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in CLOSES.get(tag, ()):
                    close(i)
                    if tag not in ("tr", "tbody", "thead"):
                        break
                elif stack[i].tag in SCOPES:
                    break
        elif tag == "br":
            add(" ")
        if tag in VOID:
            continue
        marks = attributes(token[3])
        drop = is_boilerplate(tag, marks, in_main > 0)
        main = not drop and not dropped and (tag in ("article", "main") or marks.get("role", "").lower() in ("main", "article"))
        made += 1
        for e in stack:
            e.digest.update(b"<" + tag.encode("utf-8", "surrogatepass"))
        element = Element(tag, drop, main, made, f"{tag} {marks.get('class', '')}")
        stack.append(element)
        dropped += drop
        in_main += main
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.start() if end else n
    flush()
    close(0)
    return out


def host_of(url: str | None) -> str:
    match = re.match(r"\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "", re.I)
    return match[1].lower() if match else ""


PARSED = "page_id long, url string, host string, main long, texts array<string>, inside array<array<long>>"


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Blocks of `pages(page_id, url, html)` with the hashes of the subtrees around them."""
    names = ["page_id", "url", "host", "main", "texts", "inside"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*batch.columns):
                page = parse(html.as_py() or "")
                blocks = page.blocks
                if any(main for _, main, _ in blocks):
                    blocks = [b for b in blocks if b[1]]
                texts = [text for text, _, _ in blocks]
                inside = [[page.digests[e] for e in around if e in page.digests] for _, _, around in blocks]
                main = hashlib.blake2b("\n".join(texts).encode("utf-8", "surrogatepass"), digest_size=8)
                rows.append((page_id.as_py(), url.as_py(), host_of(url.as_py()), int.from_bytes(main.digest(), "little", signed=True), texts, inside))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int64()))]
            columns = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    narrow = pages.select(*(F.col(c).cast(k).alias(c) for c, k in (("page_id", "long"), ("url", "string"), ("html", "string"))))
    return narrow.mapInArrow(run, PARSED)


def main_texts(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """page_id, url, text and n_chars for every row of `pages(page_id, url, html)`.

    Character references are decoded, white space inside a block becomes one space, blocks
    are joined by line feeds in page order. A subtree is a template of its host if at least
    `least_pages` distinct pages and `least_share` of the host's distinct pages have it. A
    host's templates are then few (each page can hold only so many subtrees, and a third of
    pages must share one), and are joined to its pages as one array; a host with very many
    pages is split by adaptive execution.

    Null and empty html: empty text, 0. Null url or url without host: the host "". Null and
    repeated page_id: kept, one row each. Cut or malformed pages are parsed as far as they
    go. Other columns are ignored. No pages: no rows.
    """
    spark = pages.sparkSession
    place = scratch_path(spark, "parsed")
    parsed_pages(pages).write.option("compression", "zstd").parquet(place)
    parsed = spark.read.schema(PARSED).parquet(place)
    distinct = parsed.select("host", "main", F.array_distinct(F.flatten("inside")).alias("hashes"))
    sizes = distinct.select("host", "main").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    seen = distinct.select("host", "main", F.explode("hashes").alias("hash")).distinct()
    counts = seen.groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    recurring = counts.join(sizes, "host").where(F.col("n") >= least_share * F.col("pages"))
    templates = recurring.groupBy("host").agg(F.collect_set("hash").alias("templates"))
    place = scratch_path(spark, "templates")
    templates.write.parquet(place)
    templates = spark.read.schema(templates.schema).parquet(place)
    joined = parsed.join(templates, "host", "left")
    blocks = F.arrays_zip("texts", "inside")
    kept = F.filter(blocks, lambda b: ~F.coalesce(F.arrays_overlap(b["inside"], F.col("templates")), F.lit(False)))
    text = F.array_join(F.transform(kept, lambda b: b["texts"]), "\n")
    return joined.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))
