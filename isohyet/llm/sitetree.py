"""Main-text extraction with site style trees.

All pages of a host are merged into one style tree. Its nodes are the block elements by their path of tags
with class and id; each counts on how many different pages it occurs, how its presentation (the sequence of
its children) varies between them and how its content does. Both are entropies over the log of the number of
pages. From the leaves up, the importance of a node is

    1 - (1 - presentation) * (1 - importance of its most important child),

that of a leaf (or of text beside children) the entropy of its content; a node on few pages is held important
(``prior``). A branch of low importance looks alike and in all its parts reads alike on the host's pages; it
is removed from each of them. What HTML itself
declares to be no article (menus, forms, scripts, ...) and elements of a few plain class names go on any
host, so a host of a single page is cleaned as well; the tree has their nodes too.

A page is read in one pass. A tag that never closes is text, and elements nested more than ``DEEPEST`` deep
count as part of the one they are in, so time and space are in proportion to the page.
"""

from __future__ import annotations

import html as entities
import re
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm import common

DEEPEST = 64
_SPECIAL = re.compile("[>\"']")
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACES = re.compile(r"[ \t\n\r\f\v ]+")
# Element classes of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_NEVER = frozenset("head nav header footer aside form script style textarea title noscript template iframe xmp button select option input label fieldset dialog menu svg canvas object embed audio video map".split())
_WALLS = ("article", "main", "table", "td")  # which the end tag of an inline element does not close
_ENDS_P = _BLOCK - {"body", "html"}
#: Whole class names, ids or roles (lower case, '-' for '_') of branches that are no article.
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo banner "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination header site-header masthead footer site-footer copyright "
    "sidebar side-bar widget related-posts share-buttons social-links "
    "comments comment-list comment-form reader-comments disqus notice notices cookie-notice cookie-banner cookie-consent popup modal "
    "newsletter newsletter-signup search-form complementary contentinfo".split()
)


@cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*>", re.I)


def pieces(page: str):
    """(text, tag) in page order: the text before each tag, and the tag's inside ('' after the last).

    Comments and declarations are passed over, quoted attribute values may hold '>', raw elements (script
    and such) come without what is in them. A comment or raw element that never ends goes on to the end of
    the page; a tag without any '>' after it is text.
    """
    at, last, quotes, none = 0, page.rfind(">"), True, {}
    start = 0  # of the text not yet given

    def end_of(k: int) -> int:
        nonlocal quotes
        pos = k
        while quotes:
            m = _SPECIAL.search(page, pos)
            if not m:
                quotes = False  # odd quotes: from here on a tag ends at its first '>'
            elif m[0] == ">":
                return m.start()
            elif m.start() >= none.get(m[0], len(page)):
                pos = m.end()
            elif (close := page.find(m[0], m.end())) < 0:
                none[m[0]] = m.start()
                pos = m.end()
            else:
                pos = close + 1
        return page.find(">", k)

    while (k := page.find("<", at)) >= 0:
        mark = page[k + 1 : k + 2]
        if mark in ("!", "?"):
            opens, closes = next((x for x in (("<!--", "-->"), ("<![CDATA[", "]]>")) if page.startswith(x[0], k)), ("<!", ">"))
            end = page.find(closes, k + len(opens))
            if end < 0:
                yield page[start:k], ""
                return
            at = end + len(closes)
            yield page[start:k], "!"
        elif k < last and (m := _NAME.match(page, k + 1, min(len(page), k + 64))):
            end = end_of(k + 1)
            tag, at = page[k + 1 : end], end + 1
            yield page[start:k], tag
            name = m[1].lower()
            if name in _RAW and mark != "/":
                ends = _end_of(name).search(page, at)
                at = ends.end() if ends else len(page)
        else:
            at = k + 1
            continue
        start = at
    yield page[start:], ""


def _attrs(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)}


class _Element:
    """An open element, ``at`` its place on the stack. ``block`` is the block element that it is or is in; style and
    content are running hashes of a block element's children and of all text in it."""

    __slots__ = ("tag", "declared", "at", "block", "node", "depth", "article", "style", "content", "text")

    def __init__(self, tag, declared, at, block=None, node=0, depth=0, article=False):
        self.tag, self.declared, self.at, self.block, self.node, self.depth, self.article = tag, declared, at, block or self, node, depth, article
        self.style = self.content = self.text = 0


def _join(a: int, b: int) -> int:
    return hash((a, b)) & 0x7FFFFFFFFFFFFFFF


def parse(page: str):
    """(nodes, blocks) of a page.

    nodes: node -> [parent, depth, in an article, style, content, has text of its own], parents first.
    blocks: (chain, text, declared) in page order; chain has the nodes from the root on, declared says whether
    markup alone rules the block out. White space is closed up; a <br> counts as white space.
    """
    import xxhash

    digest = xxhash.xxh64_intdigest
    root = _Element("", False, 0, node=1)
    stack, words, blocks = [root], [], []
    opened: dict[str, list[int]] = {t: [] for t in _WALLS}  # places on the stack by tag
    nodes: dict[int, list] = {1: [0, 0, False, 0, 0, 0]}

    def end_block():
        if words:
            text = _SPACES.sub(" ", entities.unescape("".join(words))).strip(" ")
            words.clear()
            if text:
                block = stack[-1].block
                block.content = _join(block.content, digest(text))
                block.text = 1
                blocks.append((block.node, text, block.declared))

    def settle(e: _Element):
        own = nodes[e.node]
        own[3], own[4], own[5] = _join(own[3], e.style), _join(own[4], e.content), own[5] | e.text

    def close(k: int):
        while len(stack) > k:
            if stack[-1].tag in _BLOCK:
                end_block()
            e = stack.pop()
            opened[e.tag].pop()
            if e.block is e:
                settle(e)
                if e.content:
                    above = stack[-1].block
                    above.content = _join(above.content, e.content)

    for text, inside in pieces(page):
        if text and stack[-1].declared <= stack[-1].block.declared:  # no text of buttons and the like in a paragraph
            words.append(text)
        if not inside or inside == "!":
            continue
        tag = _NAME.match(inside)[1].lower()
        if inside[0] == "/":
            if tag == "br":
                words.append(" ")
            if opened.get(tag):
                k = opened[tag][-1]
                if tag in _BLOCK or not any(opened[t] and opened[t][-1] > k for t in _WALLS):
                    close(k)
            continue
        if tag in _VOID or tag in _RAW:
            if tag == "br":
                words.append(" ")
            elif tag == "hr":
                end_block()
            continue
        if tag in _ENDS_P:
            end_block()
            k = stack[-1].block.at
            if k and (stack[k].tag == "p" or (tag == stack[k].tag and tag in ("li", "dd", "dt", "tr", "td", "th"))):
                close(k)
        attrs = _attrs(inside[len(tag) :]) if len(inside) > len(tag) else {}
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
        hinted = tag not in ("body", "html", "article", "main") and any(w.lower().replace("_", "-") in _HINTS for w in (*names, *attrs.get("role", "").split()))
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true"
        above = stack[-1]
        declared = above.declared or hinted or hidden or (tag in _NEVER and not (tag == "header" and opened.get("article")))
        if inside.endswith("/"):
            continue
        block = above.block
        if tag not in _BLOCK:
            element = _Element(tag, declared, len(stack), block)
        else:
            label = digest(f"{tag}.{' '.join(sorted(names))}")
            deep = block.depth >= DEEPEST
            node, depth = (block.node, block.depth) if deep else (_join(block.node, label), block.depth + 1)
            element = _Element(tag, declared, len(stack), None, node, depth, block.article or tag in ("article", "main"))
            block.style = _join(block.style, label)
            nodes.setdefault(node, [block.node, depth, element.article, 0, 0, 0])
        stack.append(element)
        opened.setdefault(tag, []).append(element.at)
    close(1)
    end_block()
    settle(root)

    chains: dict[int, list[int]] = {}

    def chain(node: int) -> list[int]:
        if node not in chains:
            own, at = [], node
            while at:
                own.append(at)
                at = nodes[at][0]
            chains[node] = own[::-1]
        return chains[node]

    return nodes, [(chain(node), text, declared) for node, text, declared in blocks]


def host_of(url):
    """Host part of an address; '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


_NODE = "node: long, parent: long, depth: int, article: boolean, style: long, content: long, text: int"
PARSED = f"page_id long, url string, host string, page long, chains array<array<long>>, texts array<string>, nodes array<struct<{_NODE}>>"


def parsed(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, host, page (a hash of all its text and nodes), chains and texts of the blocks
    that markup doesn't rule out, and all its style nodes, each once."""

    def run(batches):
        import pyarrow as pa

        fields = [c.split(": ")[0] for c in _NODE.split(", ")]
        node = pa.struct(list(zip(fields, (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32()), strict=True)))
        for batch in batches:
            whole, chains, texts, trees = [], [], [], []
            for page in batch.column("html").to_pylist():
                nodes, blocks = parse(page)
                chains.append([c for c, _, declared in blocks if not declared])
                texts.append([t for _, t, declared in blocks if not declared])
                trees.append([dict(zip(fields, (k, *v), strict=True)) for k, v in nodes.items()])
                whole.append(_join(nodes[1][4], hash(tuple((k, v[3]) for k, v in nodes.items()))))
            made = [pa.array(whole, pa.int64()), pa.array(chains, pa.list_(pa.list_(pa.int64()))), pa.array(texts, pa.list_(pa.string())), pa.array(trees, pa.list_(node))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host")), *made], ["page_id", "url", "host", "page", "chains", "texts", "nodes"])

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return source.withColumn("host", host_of(F.col("url"))).mapInArrow(run, PARSED)


def style_tree(parses: DataFrame, *, prior: float = 2.0) -> DataFrame:
    """(host, node, article, pages, importance) of every style node.

    Equal pages of a host count once; they and counts of equal presentations and contents are combined before
    each shuffle, and a host with a third of all pages is spread over its different values. The importance on n
    pages is taken as that on n pages and ``prior`` more on which nothing repeats. It is worked out from the
    deepest nodes up, level by level: as many small joins as the tree is deep, ``DEEPEST`` at most.
    """
    different = parses.groupBy("host", "page").agg(F.first("nodes").alias("nodes"))
    each = different.select("host", F.explode("nodes").alias("n")).select("host", "n.*")
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("style").alias("value")), F.struct(F.lit(1).alias("kind"), F.col("content").alias("value"))))
    seen = each.select("host", "node", "parent", "depth", "article", "text", kinds.alias("k")).select("*", "k.*")
    counts = seen.groupBy("host", "node", "parent", "depth", "article", "kind", "value").agg(F.count("*").alias("n"), F.max("text").alias("text"))
    of = lambda kind, column: F.sum(F.when(F.col("kind") == kind, column))
    stats = counts.groupBy("host", "node", "parent", "depth", "article").agg(of(0, F.col("n")).alias("pages"), of(0, F.col("n") * F.log("n")).alias("same_style"), of(1, F.col("n") * F.log("n")).alias("same_content"), F.max("text").alias("text"))
    entropy = lambda same: F.when(F.col("pages") > 1, 1 - F.col(same) / F.col("pages") / F.log("pages")).otherwise(1.0)
    nodes = common.materialise(stats.select("host", "node", "parent", "depth", "article", "pages", "text", entropy("same_style").alias("style"), entropy("same_content").alias("content")), "style-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    levels = []
    for depth in range(deepest, -1, -1):
        level = nodes.where(F.col("depth") == depth)
        if levels:
            kids = levels[-1].groupBy(F.col("host").alias("k_host"), F.col("parent").alias("k_node")).agg(F.max("raw").alias("below"))
            level = level.join(kids, (F.col("host") == F.col("k_host")) & (F.col("node") == F.col("k_node")), "left")
        else:
            level = level.withColumn("below", F.lit(None).cast("double"))
        own = F.when((F.col("text") > 0) | F.col("below").isNull(), F.col("content"))
        raw = F.when(F.col("below").isNull(), own).otherwise(1 - (1 - F.col("style")) * (1 - F.greatest("below", own)))
        levels.append(common.materialise(level.select("host", "node", "parent", "article", "pages", raw.alias("raw")), "style-level"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionAll(level)
    value = (F.col("pages") * F.col("raw") + prior) / (F.col("pages") + prior)
    out = common.materialise(out.select("host", "node", "article", "pages", value.alias("importance")), "style-tree")
    for table in (nodes, *levels):
        common.discard(table)
    return out


@common.shipped
def extract(pages: DataFrame, *, threshold: float = 0.3, article_threshold: float = 0.05, tree_limit: int = 200_000) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    A branch goes if its markup declares it (see ``parse``) or if its style node has an importance below
    ``threshold`` (in an <article> or <main> ``article_threshold``: the author's markup is evidence too); a
    page whose blocks are all of low importance, as in a host that serves one page under many addresses,
    keeps those that markup does not declare. Null html gives an empty text; null url is the host ''; repeated
    rows each get a row; other columns are not read. Unclosed elements end with their parents. The nodes to
    remove are broadcast if there are ``tree_limit`` at most, else joined by host and node.
    """
    parses = common.materialise(parsed(pages).withColumn("row", F.monotonically_increasing_id()), "parsed")
    low = common.materialise(style_tree(parses).where(F.col("importance") < F.when(F.col("article"), article_threshold).otherwise(threshold)).select(F.col("host").alias("l_host"), F.col("node").alias("l_node")), "low-nodes")
    if low.count() <= tree_limit:  # 8 bytes a node and its host's name
        noise = F.broadcast(low.groupBy("l_host").agg(F.collect_set("l_node").alias("noise")))
        joined = parses.join(noise, F.col("host") == F.col("l_host"), "left")
    else:
        on_page = parses.select("row", "host", F.explode("nodes.node").alias("node"))
        hits = on_page.join(low, (F.col("host") == F.col("l_host")) & (F.col("node") == F.col("l_node"))).groupBy(F.col("row").alias("l_row")).agg(F.collect_list("node").alias("noise"))
        joined = parses.join(hits, F.col("row") == F.col("l_row"), "left")
    left = F.filter("texts", lambda text, k: ~F.arrays_overlap(F.element_at("chains", k + 1), F.col("noise")))
    kept = F.when(F.col("noise").isNull() | (F.size(left) == 0), F.col("texts")).otherwise(left)
    return joined.select("page_id", "url", F.array_join(kept, "\n\n").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
