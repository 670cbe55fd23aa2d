"""Main text of web pages by site style trees.

1. Each page is read into nodes, named by the path of elements, their classes and their
   places: the second box of a page is another node than the first, while paragraphs,
   items, rows and headings of a parent are one. Pages of one host are merged: for every
   node, the tree counts on how many pages it stands, with which texts, and with which
   children (its presentation).
2. A text that stands on n of the m pages of a node has entropy log n / log m; content
   importance is one less the mean entropy of the node's texts, so a text that repeats
   over the host is noise and one that stands on a single page is content. Varied
   presentation adds importance. Where a host has few pages for a node, what its
   elements are for (menus, footers, adverts) stands in for pages not seen.
3. Nodes of low importance leave, and so do elements that are no article by their name
   alone. What a page marks as its article needs stronger evidence to be noise than a
   box that says nothing of itself. A branch leaves when all its nodes do.

Only hashes and counts are shuffled for the tree; equal pages of a host count once. A
host may hold a third of all pages: its counts are combined on the map side. What
comes back is, for each host, the short list of its noisy nodes; it is a written table,
so that Spark broadcasts it if its files are small, and joins with skew handling if not.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import raw_values, shared_folder

#: Nodes of lower importance are noise: inside a marked article, and elsewhere.
MIN_IMPORTANCE = 0.35
MIN_IMPORTANCE_UNMARKED = 0.85
#: Different pages on which a node that nothing marks has to stand before it can be noise.
MIN_PAGES = 5
#: Pages that the purpose of a node's elements counts for.
PRIOR_PAGES = 10
#: Share of content, against presentation, in a node's importance.
CONTENT_SHARE = 0.9

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noframes".split())
NOT_TEXT = RAW | frozenset("head template svg math object select button canvas audio video datalist".split())
NOT_ARTICLE = frozenset("nav header footer aside form dialog menu".split())
NOT_ARTICLE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split()
)
NOT_ARTICLE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar"
    " navigation breadcrumb breadcrumbs sidebar footer header masthead comment comments disqus reply replies respond"
    " cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe signup login"
    " share sharing social related recommended widget toolbar pagination pager".split()
)
ARTICLE = frozenset(("article", "main"))
#: Elements that repeat below a parent and are one node there.
REPEATED = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
#: Elements that end an open paragraph, and what ends an open item of its kind.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main"
    " menu nav ol p pre section table ul".split()
)
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table article main body html div section".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: Class names of an article that say what it is about or goes with, not what it is.
_ABOUT = re.compile(r"(?<!\S)(?:category|tag|has|with|no)-\S*")


class _Node:
    """An open element: its label and path, what it is for, and what stands in it."""

    __slots__ = ("block", "children", "kept", "path", "places", "skipped", "tag")

    def __init__(self, tag: str, path: int, block: "_Node | None", kept: bool, skipped: bool):
        self.tag, self.path, self.kept, self.skipped = tag, path, kept, skipped
        self.block = block or self
        self.children: list[str] = []
        self.places: dict[str, int] = {}


def _purpose(tag: str, raw: str) -> tuple[str, bool]:
    """Label of an element, and whether by its names it may be part of an article."""
    if tag in NOT_ARTICLE:
        return tag, False
    if not raw or raw.isspace():
        return tag, True
    given = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        given.setdefault(name.lower(), next(filter(None, values), ""))
    names = f"{given.get('class', '')} {given.get('id', '')}"
    label = f"{tag}.{re.sub(r'[0-9]+', '', names).strip()}" if names != " " else tag
    hidden = "hidden" in given or given.get("aria-hidden") == "true"
    hidden |= "display:none" in given.get("style", "").replace(" ", "").lower()
    role = given.get("role", "").lower() in NOT_ARTICLE_ROLES
    if tag == "article":
        names = _ABOUT.sub("", names)
    named = tag not in ("main", "html", "body")
    named = named and any(part.lower() in NOT_ARTICLE_NAMES for part in _NAME.findall(names))
    return label, not (hidden or role or named)


def blocks(html: str) -> tuple[list[tuple[int, bool, bool, str]], dict[int, tuple[int, bool, bool]]]:
    """Texts of a page in order as (path, may be article, inside an article, text), and the
    presentation of each node: hash of its children's labels, whether it may be article, and
    whether it stands inside a marked one."""
    found: list[tuple[int, bool, bool, str]] = []
    shapes: dict[int, tuple[int, bool, bool]] = {}
    root = _Node("", 0, None, True, False)
    stack, parts, inside = [root], [], 0

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                node = stack[-1]
                found.append((node.block.path, node.kept, inside > 0, text))

    def pop() -> None:
        nonlocal inside
        node = stack.pop()
        if node.block is node:
            shapes[node.path] = (xxhash.xxh64_intdigest(" ".join(node.children)), node.kept, inside > 0)
        inside -= node.tag in ARTICLE and node.kept

    def close(tags: tuple[str, ...], scopes: frozenset[str]) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].tag in tags:
                flush()
                while len(stack) > at:
                    pop()
                return
            if stack[at].tag in scopes:
                return

    at, end = 0, len(html)
    while at < end:
        match = _MARKUP.search(html, at)
        start = match.start() if match else end
        if start > at and not stack[-1].skipped:
            parts.append(html[at:start])
        if not match:
            break
        at = match.end()
        tag = (match.group(2) or match.group(5) or "").lower()
        if not tag:
            continue
        closing = match.group(1) or match.group(4)
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    if tag not in INLINE:
                        flush()
                    while len(stack) > depth:
                        if stack[-1].tag not in INLINE:
                            flush()
                        pop()
                    break
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                flush()
            continue
        raw = match.group(3) or match.group(6) or ""
        if tag in CLOSES_P:
            close(("p",), _SCOPES)
        if tag in CLOSES:
            close(CLOSES[tag], _SCOPES)
        if tag in RAW:  # no markup inside
            over = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            at = over.end() if over else end
            continue
        if tag not in INLINE:
            flush()
        parent = stack[-1]
        label, kept = _purpose(tag, raw)
        skipped = parent.skipped or tag in NOT_TEXT
        if tag in INLINE:
            node = _Node(tag, parent.path, parent.block, parent.kept and kept, skipped)
        else:
            step = label
            if not inside and tag not in REPEATED:
                place = parent.block.places[label] = parent.block.places.get(label, 0) + 1
                step = f"{label}#{place}"
            path = xxhash.xxh64_intdigest(f"{parent.path:x}/{step}")
            node = _Node(tag, path, None, parent.kept and kept, skipped)
            siblings = parent.block.children
            if not siblings or siblings[-1] != label:
                siblings.append(label)
        stack.append(node)
        inside += tag in ARTICLE and node.kept
    flush()
    while len(stack) > 1:
        pop()
    return found, shapes


def main_text(html: str, noisy: frozenset[int]) -> str:
    """The article of a page: the texts of nodes that are neither noisy nor of another purpose.

    Where a page marks its article, nothing outside it is taken. Articles of another purpose
    or of noise alone (comments, adverts) mark nothing, nor do articles that are shorter
    together than the rest that stays (teasers beside the main text).
    """
    found, _ = blocks(html)
    stays = [(inside, text) for path, kept, inside, text in found if kept and _signed(path) not in noisy]
    inner = sum(len(text) for inside, text in stays if inside)
    marked = inner > 0 and 2 * inner >= sum(len(text) for _, text in stays)
    return " ".join(text for inside, text in stays if inside >= marked)


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, expected, marked, m, importance) of every node of every host, merged from its pages."""
    schema = "host string, page long, node long, kind int, feature long, expected boolean, marked boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, rows = [], []
            for number, raw in enumerate(raw_values(batch.column(1))):
                found, shapes = blocks(raw.decode("utf-8", "replace"))
                page = _signed(xxhash.xxh64_intdigest(raw))
                for path, (shape, kept, marked) in shapes.items():
                    rows.append((page, _signed(path), 2, _signed(shape), kept, marked))
                texts = {(path, kept, marked, xxhash.xxh64_intdigest(text)) for path, kept, marked, text in found}
                rows += [(page, _signed(path), 1, _signed(text), kept, marked) for path, kept, marked, text in texts]
                owner += [number] * (len(shapes) + len(texts))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_())
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            hosts = batch.column(0).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [hosts, *arrays], names=["host", "page", "node", "kind", "feature", "expected", "marked"]
            )

    seen = pages.select(_host(F.col("url")).alias("host"), "html").mapInArrow(run, schema)
    # every page has one presentation of a node that stands on it, so those rows count its pages
    counts = seen.groupBy("host", "node", "kind", "feature").agg(
        F.countDistinct("page").alias("n"), F.min("expected").alias("expected"), F.max("marked").alias("marked")
    )
    m = F.sum(F.when(F.col("kind") == 2, F.col("n")))
    nodes = counts.groupBy("host", "node").agg(
        m.alias("m"),
        F.min("expected").alias("expected"),
        F.max("marked").alias("marked"),
        F.avg(F.when(F.col("kind") == 1, F.ln("n"))).alias("text_log"),
        F.sum(F.when(F.col("kind") == 2, F.col("n") * F.ln("n"))).alias("shape_log"),
    )
    base = F.ln(F.greatest(F.col("m"), F.lit(2)))
    content = 1 - F.coalesce(F.col("text_log"), F.lit(0.0)) / base
    presentation = F.when(F.col("m") > 1, (base - F.col("shape_log") / F.col("m")) / base).otherwise(1.0)
    seen_importance = CONTENT_SHARE * content + (1 - CONTENT_SHARE) * presentation
    prior = F.col("expected").cast("double")
    blended = (F.col("m") * seen_importance + PRIOR_PAGES * prior) / (F.col("m") + PRIOR_PAGES)
    return nodes.select("host", "node", "expected", "marked", "m", blended.alias("importance"))


def extracted(
    pages: DataFrame, min_importance: float = MIN_IMPORTANCE, min_unmarked: float = MIN_IMPORTANCE_UNMARKED
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Null and empty pages have the empty text. Pages without a url are one host. Rows
    that repeat count once in their host's tree and are extracted alike; other columns
    are left out; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    least = F.when(F.col("marked") | ~F.col("expected"), F.lit(min_importance))
    least = least.when(F.col("m") >= MIN_PAGES, F.lit(min_unmarked)).otherwise(F.lit(min_importance))
    noisy = style_tree(pages).where(F.col("importance") < least)
    written = f"{shared_folder(spark)}/style-trees-{uuid.uuid4().hex}"
    noisy.groupBy("host").agg(F.collect_set("node").alias("noisy")).write.parquet(written)
    lists = spark.read.parquet(written).withColumnRenamed("host", "_host")
    known = pages.select("page_id", "url", "html", _host(F.col("url")).alias("_own"))
    joined = known.join(lists, F.col("_own") == F.col("_host"), "left").select("page_id", "url", "html", "noisy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(raw.decode("utf-8", "replace"), frozenset(nodes.as_py() or ()))
                for raw, nodes in zip(raw_values(batch.column(2)), batch.column(3), strict=True)
            ]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    kinds = {field.name: field.dataType.simpleString() for field in pages.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    return joined.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
