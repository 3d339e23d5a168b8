"""Main text of web pages by site style trees.

The element trees of one host's pages are merged: elements with the same path of tags and marks
(class, id, role) from the root are one element node. A node knows in how many pages it stands (m), which sequences
of children it has there, and which text blocks and link targets lie in it. Its importance is, as in the
literature on style trees,

    (1 - g**l) * max(presentation, content) + g**l * content

where l is the number of its child sequences, presentation their entropy to the base m, and content one less the
mean entropy of its features: a feature in d of m pages has ln(d) / ln(m), so what stands on every page adds
nothing. Template branches (the same layout, the same words) come near 0, articles near 1. Branches below a threshold
are removed from each page (a wrapper of regular layout but distinct content has to stay, hence the maximum); nodes of the same path of all hosts together are a second tree, for hosts with few pages
and for texts that rotate through a network of hosts.

Entropy cannot tell a site's menu from an article where a host shows one page, so marks that say what a branch
is (a nav element, class="cookie-notice") count as importance 0, and article and main elements as 1.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.frames import arrow_map, batch_of, stored, tidy

#: Branches below it go; weight of a child sequence; a node is judged on so many pages at least, and on this share of its host's.
LEAST, GAMMA, PAGES, SHARE = 0.6, 0.9, 8, 0.01
#: Most low nodes of all hosts that are sent to every task; more meet the pages by a shuffle, in groups of so many pages of a host.
SENT_NODES, GROUP_PAGES = 500_000, 100_000
#: Levels of the style tree below the root; deeper elements count as part of their ancestor there.
LEVELS = 24

# Element and mark names of HTML.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes plaintext".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_HIDDEN = set("head script style template noscript iframe noembed noframes object embed canvas svg math audio video textarea select button input option datalist title".split())
_NOISE = set("nav aside footer form dialog menu".split())
_NOISE_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist status log".split())
_NOISE_MARKS = set(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promoted promotion banner banners nav navbar navigation topnav subnav "
    "menu menus submenu breadcrumb breadcrumbs footer sidebar sidebars sidenav aside cookie cookies consent gdpr notice notices notification notifications alert alerts popup "
    "modal overlay newsletter subscribe subscription signup login signin search searchbox searchform form comment comments commentlist disqus reply replies respond share sharing sharebar social "
    "related recommended recommendations pagination pager toolbar copyright disclaimer skip skiplink".split()
)
_TEASERS = set("comment comments reply related sponsored ad promo teaser".split())
_HEADER_MARKS = set("header topbar masthead".split())
_CONTENT = set("article main".split())
_CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": set(), "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
_BARRIERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
#: Elements that hold text rather than parts of a page's layout; only with a mark of their own are they judged.
_TEXT = set("p h1 h2 h3 h4 h5 h6 li dt dd td th tr tbody thead tfoot blockquote pre br hr figure figcaption caption center address details summary body html".split()) | _INLINE

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|$)|=\s*'[^']*(?:'|$)|[^>])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_WORD = re.compile(r"[a-z]+(?![a-z])|[A-Z]+(?![a-z])|[A-Z][a-z]*")


@functools.lru_cache(100_000)
def _path(above: int, tag: str, marks: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{above}>{tag} {marks}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class Node:
    """An element: tag, marks (class, id, role, with 0 for every number), children (elements and text), hash of its
    path, and whether an article stands in it."""

    __slots__ = ("tag", "marks", "attributes", "children", "path", "level", "holds")

    def __init__(self, tag: str, attributes: dict[str, str], up: Node | None) -> None:
        marks = " ".join(re.sub(r"\d+", "0", attributes[a]).strip() for a in ("class", "id", "role") if attributes.get(a))
        self.tag, self.marks, self.attributes, self.children, self.holds = tag, marks, attributes, [], False
        self.level = up.level + 1 if up else 0
        self.path = up.path if up and self.level > LEVELS else _path(up.path if up else 0, tag, marks)


def parsed(text: str) -> Node:
    """The element tree of a page. End tags that HTML implies are added, stray ones ignored, unended tags end with the page."""
    root = Node("#", {}, None)
    stack, at = [root], 0

    def add(words: str) -> None:
        if words:
            stack[-1].children.append(words)

    def close(until: set[str], barrier: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in until:
                del stack[k:]
                return
            if stack[k].tag in barrier:
                return

    for found in _TOKEN.finditer(text):
        if found.start() < at:
            continue
        add(html.unescape(text[at : found.start()]))
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "br":
                add("\n")
            if tag == "p" and not any(x.tag == "p" for x in stack):
                continue
            close({tag}, {"table", "td", "th"} - {tag} if tag in _INLINE or tag == "p" else set())
            continue
        if tag in _CLOSES_P:
            close({"p"}, {"button", "td", "th", "table", "object", "body", "div", "article", "section", "li"})
        if tag in _SIBLINGS:
            while True:
                before = len(stack)
                close(_SIBLINGS[tag], _BARRIERS.get(tag, {"table"}))
                if len(stack) == before:
                    break
        attributes = {a.lower(): html.unescape((v or "").strip("\"'")) for a, v in _ATTRIBUTE.findall(found[3])}
        node = Node(tag, attributes, stack[-1])
        stack[-1].children.append(node)
        if _is_content(node) and not noise(node, False):
            for x in stack:
                x.holds = True
        if tag in _RAW:
            end = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(text, at)
            at = text.find(">", end.start()) + 1 if end and text.find(">", end.start()) >= 0 else len(text)
        elif tag not in _VOID and not found[3].rstrip().endswith("/"):
            stack.append(node)
        elif tag not in _VOID and tag not in ("svg", "math"):  # HTML ignores the slash of other elements
            stack.append(node)
    add(html.unescape(text[at:]))
    return root


@functools.lru_cache(100_000)
def _words(marks: str) -> frozenset[str]:
    return frozenset(x.lower() for x in _WORD.findall(marks)) | frozenset(re.split(r"[^a-z]+", marks.lower()))


def noise(node: Node, in_article: bool) -> bool:
    """Whether an element's name, role or marks say that it is not of the article. What holds an article is none of these."""
    if node.tag in _HIDDEN or "hidden" in node.attributes or node.attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "style" in node.attributes and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", node.attributes["style"], re.I):
        return True
    if node.holds or node.tag in ("html", "body", "#"):
        return False
    words = _words(node.marks) if node.marks else frozenset()
    if _is_content(node):  # a comment, a teaser
        return bool(words & _TEASERS)
    if node.tag in _NOISE or node.attributes.get("role", "").strip().lower() in _NOISE_ROLES or words & _NOISE_MARKS:
        return True
    return not in_article and (node.tag == "header" or bool(words & _HEADER_MARKS))


def _is_content(node: Node) -> bool:
    return node.tag in _CONTENT or node.attributes.get("role", "").lower() in ("main", "article")


def _judged(node: Node) -> bool:
    """Whether a node is a branch of the layout: it may go for its importance."""
    return 0 < node.level <= LEVELS and not _is_content(node) and node.tag not in ("html", "body", "#") and (node.tag not in _TEXT or bool(node.marks))


def _features(root: Node) -> dict[int, tuple[list[str], set[str]]]:
    """For every judged path of a page: its child sequences, and the text blocks and link targets in it."""
    out: dict[int, tuple[list[str], set[str]]] = {}
    # walked with an own stack, since pages nest deeper than calls may
    todo: list[tuple[Node, tuple[int, ...], bool]] = [(root, (), False)]
    while todo:
        node, above, in_article = todo.pop()
        if node.level and noise(node, in_article):
            continue
        inside = in_article or _is_content(node)
        if _judged(node) and node.path not in above:
            above = (*above, node.path)
            out.setdefault(node.path, ([], set()))
        if _judged(node):
            shape = [f"{x.tag} {x.marks}" if isinstance(x, Node) else "#" for x in node.children if isinstance(x, Node) or x.strip()]
            out[node.path][0].append(">".join(a for k, a in enumerate(shape) if k == 0 or a != shape[k - 1]))
        for x in node.children:
            if isinstance(x, Node):
                todo.append((x, above, inside))
                found = [x.attributes[a] for a in ("href", "src") if x.attributes.get(a)] if above else ()
            else:
                found = [" ".join(x.split())] if above else ()
            for words in filter(None, found):
                for path in above:
                    out[path][1].add(words)
    return out


def main_text(root: Node, low: set[int]) -> str:
    """The text of a page without noise and without branches of the paths `low`, blocks joined by one space.

    Where article or main elements are left, only the outermost of them count.
    """
    pieces: list[tuple[bool, str]] = []  # (whether in an article, text or a break between blocks)
    # entries: a node with whether it is inside an article, or a break to be noted
    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        item, inside = todo.pop()
        if isinstance(item, str):
            pieces.append((inside, item))
            continue
        if item.level and (noise(item, inside) or _judged(item) and item.path in low):
            pieces.append((inside, "\n"))
            continue
        inside = inside or _is_content(item)
        block = item.tag not in _INLINE
        if block:
            pieces.append((inside, "\n"))
            todo.append(("\n", inside))
        todo += [(x, inside) for x in reversed(item.children)]
    whole = any(kept for kept, x in pieces if x.strip())
    return " ".join("".join(x for kept, x in pieces if kept or not whole).split())


def host_of(url: Column) -> Column:
    """The lower-cased host of an address, without user, port and a leading www; empty if there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


@tidy
def style_importance(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host (null: all hosts together), path, pages, shapes, presentation, content, importance of every judged node.

    Pages report distinct features per path, and these are counted with map-side combining, so a host with many pages
    is spread over its features. Null pages count as empty, a page without host stands in the tree of all hosts only.
    """
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda x: int.from_bytes(hashlib.blake2b(x.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
        for batch in batches:
            counts: dict[tuple, int] = {}
            for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for path, (shapes, words) in _features(parsed(text)).items():
                    # (a shape's, a feature's) rows: of a page one shape, and every feature once
                    for key in [(host, path, True, digest("|".join(dict.fromkeys(shapes)))), *((host, path, False, digest(x)) for x in words)]:
                        counts[key] = counts.get(key, 0) + 1
            if counts:
                columns = list(zip(*counts, strict=True))
                yield batch_of(host=pa.array(columns[0]), path=pa.array(columns[1], pa.int64()), shape=pa.array(columns[2]), feature=pa.array(columns[3], pa.int64()), n=pa.array(list(counts.values()), pa.int64()))

    found = arrow_map(rows, features, "host string, path bigint, shape boolean, feature bigint, n bigint")
    counts = stored(found.groupBy("host", "path", "shape", "feature").agg(F.sum("n").alias("n")), "style-features")
    every = counts.groupBy(F.lit(None).cast("string").alias("host"), "path", "shape", "feature").agg(F.sum("n").alias("n"))
    counts = counts.where("host <> ''").unionByName(every)
    n, log = F.col("n").cast("double"), F.log(F.col("n").cast("double"))
    sums = counts.groupBy("host", "path").agg(
        F.sum(F.when(F.col("shape"), F.col("n"))).alias("pages"), F.count_if("shape").alias("shapes"), F.sum(F.when(F.col("shape"), n * log)).alias("_shape"),
        F.count_if(~F.col("shape")).alias("features"), F.coalesce(F.sum(F.when(~F.col("shape"), log)), F.lit(0.0)).alias("_feature"),
    )
    m = F.col("pages").cast("double")
    base = F.when(F.col("pages") > 1, F.log(m))
    presentation = F.coalesce((F.log(m) - F.col("_shape") / m) / base, F.lit(1.0))
    content = F.coalesce(1 - F.col("_feature") / F.col("features") / base, F.when(F.col("pages") > 1, 0.0).otherwise(1.0))
    weight = F.pow(F.lit(GAMMA), F.col("shapes").cast("double"))
    shown = sums.select("host", "path", "pages", "shapes", presentation.alias("presentation"), content.alias("content"))
    return shown.withColumn("importance", (1 - weight) * F.greatest("presentation", "content") + weight * F.col("content"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: float = LEAST, pages_least: int = PAGES) -> DataFrame:
    """`id_col`, `url_col`, text (main text, empty if none) and n_chars (code points) of every row.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one. Null
    pages are empty texts; null and repeated ids and addresses stay as they are; a page of any length is parsed whole;
    other columns are not read. A host's list of low paths holds nodes on at least `pages_least` pages and on a
    hundredth of its host's pages, hence at most a hundred times the elements of its mean page. Pages stay where they are
    if the lists of all hosts together hold at most SENT_NODES nodes; else lists are copied to salted groups of a host's pages.
    """
    host, total = host_of(F.col(url_col)), pages.count()
    low = stored(style_importance(pages, url_col, html_col).where((F.col("importance") < least) & (F.col("pages") >= pages_least)), "low-nodes")
    everywhere = {r["path"] for r in low.where(F.col("host").isNull() & (F.col("pages") >= SHARE * total)).select("path").collect()}  # bounded as above
    sizes = pages.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("all_pages"))
    chosen = stored(low.join(sizes, "host").where(F.col("pages") >= SHARE * F.col("all_pages")).select("host", "path", "all_pages"), "low-of-hosts")
    lists = chosen.groupBy("host").agg(F.collect_set("path").alias("low"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"), host.alias("host"))
    if chosen.count() <= SENT_NODES:
        rows = rows.join(F.broadcast(lists), "host", "left")
    else:
        salts = -(-chosen.agg(F.max("all_pages")).first()[0] // GROUP_PAGES)
        lists = lists.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("url", "id", "html"), F.lit(salts))).join(lists, ["host", "salt"], "left").drop("salt")
    rows = rows.drop("host")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(parsed(x), everywhere.union(y or ())) for x, y in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist(), strict=True)]
            yield batch_of(id=batch.column("id"), url=batch.column("url"), text=pa.array(texts, pa.string()), n_chars=pa.array([len(x) for x in texts], pa.int64()))

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = arrow_map(rows, extract, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars bigint")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
