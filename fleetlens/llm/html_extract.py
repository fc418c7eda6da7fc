"""Main text of web pages by wrapper induction.

Pages of one host share a template, or one of a few.  A page is aligned with
two references: the page of its host whose html hashes lowest, and the shape
of its own DOM tree, which it shares with the host's pages of the same layout.
The alignment is simple tree matching (the largest order-keeping match of
equally labelled nodes under matched parents); siblings in a row with one label
count as one repeated slot.  Slots at both ends with equal labels are matched in turn, and the dynamic
programme weighs the whole rest, row by row (every so many rows are kept, those between are made again
on the way back).  Spark sums over all distinct pages (copies count
once), per reference, node and text hash: pages and length of the text.  The
text that most pages have at a node is *template* there, if enough pages share
it (``MIN_PAGES``, ``NODE_SHARE``, ``HOST_SHARE``).
The *content root* is the lowest node that holds most of the varying text that
is not links, nor in elements that never hold an article (menus, forms, ...).

A page's text is what lies under its node aligned with the content root of the
host's reference, else of its own shape's, without the nodes that have the
template text of either and without such elements.  A page that aligns with
neither falls back on its own ``article``, ``main`` or ``body``.
"""

from __future__ import annotations

import html as html_lib
import json
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import others, read, written
from fleetlens.llm.urls import host_of

#: A text is template inside the content root if at least so many distinct pages share it there (elsewhere it does not matter),
MIN_PAGES = 8
#: which are this share of the distinct pages that have the node,
NODE_SHARE = 0.5
#: and this share of all distinct pages of the host.
HOST_SHARE = 0.1
#: Share of the varying text that the content root holds.
ROOT_SHARE = 0.6

#: Elements nested deeper stand beside each other at this depth (their text stays).
MAX_DEPTH = 200
# A level of nested nodes takes some frames.
sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * MAX_DEPTH))
#: Rows of a dynamic programme that are kept at once, at least.
KEPT_ROWS = 64
#: Weights of one page that are remembered; beyond that they are forgotten and may be found again.
REMEMBERED = 1 << 20
#: Attributes up to so many characters are remembered with what they mean.
SHORT_ATTRS = 200

_TAG = re.compile(r"""<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*(?:>|$)|<(?=[a-zA-Z/])[^>]*$""", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
#: Start tags that end an open paragraph, and tags that end an open sibling.
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
                   "section table ul".split())
ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",)}
LISTS = frozenset("ul ol dl table select body".split())
#: Elements that hold no article text, by tag and by words of class, id or role.
NEVER = frozenset("script style noscript template iframe nav aside footer form button select textarea input head menu dialog svg object".split())
_NEVER_WORDS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alert|popup|modal|newsletter|"
                          r"subscribe|nav\w*|menu|breadcrumbs?|sidebar|widget|related|share|social|comments?|replies|respond|disqus|"
                          r"footer|header|masthead|pagination|complementary|contentinfo|search)(?:$|[\s_-])", re.I)


def named(tag: str, attrs: str) -> tuple[str, bool]:
    """(label, whether it never holds an article) of an element."""
    found = " ".join(f"{k.lower()}={v.strip(chr(34) + chr(39))}" for k, v in sorted(_ATTR.findall(attrs))) if "=" in attrs else ""
    never = tag in NEVER or bool(found) and tag not in ("html", "body") and bool(_NEVER_WORDS.search(
        " ".join(p.partition("=")[2] for p in found.split(" ") if "=" in p) or found))
    return f"{tag} {found}" if found else tag, never


_named = lru_cache(20_000)(named)


class Node:
    __slots__ = ("tag", "label", "never", "children", "slots")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag = tag
        self.label, self.never = _named(tag, attrs) if len(attrs) <= SHORT_ATTRS else named(tag, attrs)
        self.children: list[Node | str] = []
        self.slots: list[list[Node]] | None = None


def parse(text: str) -> Node:
    """A forgiving DOM: unclosed paragraphs, items and inline tags end where HTML ends them."""
    root = Node("html")
    stack = [root]
    open_tags: Counter[str] = Counter()

    def close(i: int) -> None:
        open_tags.subtract(n.tag for n in stack[i:])
        del stack[i:]

    at = 0
    while at <= len(text):
        m = _TAG.search(text, at)
        piece = text[at:m.start()] if m else text[at:]
        if piece:
            stack[min(len(stack) - 1, MAX_DEPTH)].children.append(html_lib.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag or tag == "html":
            continue
        if m.group(1):
            for i in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break                      # a stray inline end tag closes no block
            continue
        if tag in ENDS_P and open_tags["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag not in INLINE:
                    break
        ends = ENDS_SAME.get(tag, ())
        for i in range(len(stack) - 1, 0, -1) if any(open_tags[t] for t in ends) else ():
            if stack[i].tag in LISTS:
                break
            if stack[i].tag in ends:
                close(i)
                break
        node = Node(tag, m.group(3))
        stack[min(len(stack) - 1, MAX_DEPTH)].children.append(node)
        if tag in RAW and not m.group(3).endswith("/"):
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(text, at)
            at = end.end() if end else len(text) + 1
        elif tag not in VOID and not m.group(3).endswith("/"):
            stack.append(node)
            open_tags[tag] += 1
    return root


def slots(node: Node) -> list[list[Node]]:
    """Child elements of a parsed node, equally labelled neighbours together; inline elements are text."""
    if node.slots is not None:
        return node.slots
    out: list[list[Node]] = []
    for c in node.children:
        if isinstance(c, Node) and c.tag not in INLINE:
            if out and out[-1][0].label == c.label:
                out[-1].append(c)
            else:
                out.append([c])
    node.slots = out
    return out


def shape(node: Node) -> list:
    """[label, [shape of each child slot]]; a repeated slot is a leaf."""
    return [node.label, [shape(s[0]) if len(s) == 1 else [s[0].label, []] for s in slots(node)]]


def numbered(tree: list, out: list | None = None, parent: int = -1) -> list[tuple[int, list]]:
    """(parent, shape) of every reference node, in preorder."""
    out = [] if out is None else out
    me = len(out)
    out.append((parent, tree))
    for child in tree[1]:
        numbered(child, out, me)
    return out


def sizes(tree: list) -> int:
    """Nodes of a shape, so that a child's number follows from its elder siblings."""
    return 1 + sum(map(sizes, tree[1]))


class Weights:
    """Weights of a page's nodes against a reference's, remembered by their structures."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.by_node: dict[int, int] = {}
        self.weights: dict[tuple[int, int], int] = {}

    def _number(self, key: tuple) -> int:
        return self.numbers.setdefault(key, len(self.numbers))

    def of_slot(self, slot: list[Node]) -> int:
        """Number of a page slot's structure."""
        if len(slot) > 1:
            return self._number(("slot", slot[0].label))
        known = self.by_node.get(id(slot[0]))
        if known is None:
            known = self.by_node[id(slot[0])] = self._number(("page", slot[0].label, *map(self.of_slot, slots(slot[0]))))
        return known

    def of_tree(self, tree: list) -> int:
        """Number of a reference node's structure."""
        known = self.by_node.get(id(tree))
        if known is None:
            known = self.by_node[id(tree)] = self._number(("tree", tree[0], *map(self.of_tree, tree[1])))
        return known

    def weigh(self, slot: list[Node], tree: list) -> int:
        if slot[0].label != tree[0]:
            return 0
        if len(slot) > 1 or not tree[1]:
            return 1
        key = self.of_slot(slot), self.of_tree(tree)
        found = self.weights.get(key)
        if found is None:
            if len(self.weights) >= REMEMBERED:
                self.weights.clear()
            found = self.weights[key] = match(slot[0], tree, 0, {}, self)
        return found


def best_pairs(mine: list[list[Node]], theirs: list[list], weights: Weights) -> tuple[int, list[tuple[int, int]]]:
    """(weight, pairs from the last to the first) of the heaviest order-keeping match of slots.  Time grows with the product
    of their numbers, memory with the reference's times the root of the page's."""
    kinds, first, kind = np.unique([weights.of_tree(t) for t in theirs], return_index=True, return_inverse=True)
    samples = [theirs[j] for j in first.tolist()]
    known: dict[int, np.ndarray] = {}

    def gains(x: int) -> np.ndarray:
        key = weights.of_slot(mine[x])
        found = known.get(key)
        if found is None:
            if len(known) * len(kinds) >= REMEMBERED:
                known.clear()
            found = known[key] = np.array([weights.weigh(mine[x], t) for t in samples], np.int64)
        return found

    def after(row: np.ndarray, x: int) -> np.ndarray:
        gain = gains(x)[kind]
        out = row.copy()
        np.maximum(out[1:], np.where(gain > 0, row[:-1] + gain, 0), out=out[1:])
        return np.maximum.accumulate(out)

    stride = max(KEPT_ROWS, isqrt(len(mine)))
    rows = [np.zeros(len(theirs) + 1, np.int64)]
    kept = rows[:]
    for x in range(len(mine)):
        if x and x % stride == 0:
            rows = rows[-1:]
            kept += rows
        rows.append(after(rows[-1], x))
    weight, pairs = int(rows[-1][-1]), []
    x, y = len(mine), len(theirs)
    while x and y:
        start = (len(kept) - 1) * stride
        while x > start and y:
            gain = int(gains(x - 1)[kind[y - 1]])
            here, above = rows[x - start], rows[x - start - 1]
            if gain and here[y] == above[y - 1] + gain:
                x, y = x - 1, y - 1
                pairs.append((x, y))
            elif here[y] == above[y]:
                x -= 1
            else:
                y -= 1
        kept.pop()
        if x and y:
            rows = kept[-1:]
            for before in range(start - stride, start):
                rows.append(after(rows[-1], before))
    return weight, pairs


def match(node: Node, tree: list, number: int, found: dict[int, list[Node]], weights: Weights | None = None) -> int:
    """Simple tree matching of a page node with a reference node of the same label; fills number -> page nodes."""
    found[number] = [node]
    mine, theirs = slots(node), tree[1]
    if not mine or not theirs:
        return 1
    weights = weights or Weights()
    starts, at = [], number + 1
    for t in theirs:
        starts.append(at)
        at += sizes(t)

    def pair(i: int, j: int) -> int:
        if len(mine[i]) == 1 and theirs[j][1]:
            return match(mine[i][0], theirs[j], starts[j], found, weights)
        found[starts[j]] = mine[i]
        return 1

    weight, head, tail, shorter = 1, 0, 0, min(len(mine), len(theirs))
    while head < shorter and mine[head][0].label == theirs[head][0]:
        weight += pair(head, head)
        head += 1
    while tail < shorter - head and mine[-1 - tail][0].label == theirs[-1 - tail][0]:
        weight += pair(len(mine) - 1 - tail, len(theirs) - 1 - tail)
        tail += 1
    if head + tail == shorter:
        return weight
    more, pairs = best_pairs(mine[head:len(mine) - tail], theirs[head:len(theirs) - tail], weights)
    for x, y in pairs:
        pair(head + x, head + y)
    return weight + more


def aligned(page: Node, tree: list | None) -> dict[int, list[Node]]:
    """What ``match`` finds for a page and a reference; without one, for its own shape, where all match."""
    found: dict[int, list[Node]] = {}
    if tree is not None:
        match(page, tree, 0, found)
        return found

    def walk(node: Node) -> None:
        found[len(found)] = [node]
        for slot in slots(node):
            if len(slot) == 1:
                walk(slot[0])
            else:
                found[len(found)] = slot

    walk(page)
    return found


def blocks(nodes: list[Node], drop: set[int], out: list[str], inside: bool = False) -> list[str]:
    """Block texts under the nodes, without never-nodes and those whose ``id()`` is in ``drop``."""
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    def walk(node: Node) -> None:
        for c in node.children:
            if isinstance(c, str):
                run.append(c)
            elif c.tag == "br" or c.tag == "wbr":
                run.append(" " if c.tag == "br" else "")
            elif id(c) in drop or c.never or c.tag in RAW:
                if c.tag not in INLINE:
                    flush()
            elif c.tag in INLINE:
                walk(c)
            else:
                flush()
                walk(c)
                flush()

    for n in nodes:
        flush()
        walk(n)
        flush()
    return out


def measure(nodes: list[Node]) -> tuple[int, int]:
    """(hash, length) of the text right under the nodes and in their inline and unmatched parts; links do not count for the length."""
    text: list[str] = []
    length = 0

    def walk(node: Node, link: bool) -> None:
        nonlocal length
        for c in node.children:
            if isinstance(c, str):
                text.append(c)
                length += 0 if link else len(c.strip())
            elif not c.never and c.tag not in RAW:
                walk(c, link or c.tag == "a")

    for n in nodes:
        if not n.never and n.tag not in RAW:
            walk(n, n.tag == "a")
    return zlib.crc32(" ".join("".join(text).split()).encode("utf-8", "surrogatepass")), length


def page_stats(page: Node, tree: list | None, known: dict[tuple[int, int], tuple[int, int]] | None = None) -> Iterator[tuple[int, int, int]]:
    """(reference node, text hash, text length) of every aligned node; lengths count the text of the whole node.

    Without ``tree`` the reference is the page's own shape; ``known`` remembers what was measured of this page.
    """
    known = {} if known is None else known
    for number, nodes in aligned(page, tree).items():
        key = id(nodes[0]), len(nodes)
        if key not in known:
            known[key] = measure(nodes)
        yield number, *known[key]


def induce(tree: list, stats: list[tuple], host_pages: int = 0) -> tuple[int, dict[int, int]]:
    """(content root or -1, template text hash by node) from (node, pages, lowest hash, highest hash, total length).

    A sixth and seventh number are the text hash that most pages have there and
    their number; without them only a text of all pages counts.  Pages are
    distinct; ``host_pages`` are those of the whole host, if more than the tree's.
    """
    known = {s[0]: s for s in stats}
    nodes = numbered(tree)
    varying = {n: s[4] for n, s in known.items() if s[2] != s[3]}
    whole = varying.get(0, 0)
    if not whole:
        return -1, {}                          # one page, or copies of one: nothing to tell template from content
    host_pages = max(host_pages, known[0][1])
    template = {}
    for n, s in known.items():
        text, pages = s[5:7] if len(s) > 5 else (s[2], s[1] if s[2] == s[3] else 0)
        if n and s[4] and pages >= max(MIN_PAGES, NODE_SHARE * s[1], HOST_SHARE * host_pages):
            template[n] = text
    root = 0
    while True:
        inner = [n for n, (parent, _) in enumerate(nodes) if parent == root and n not in template and varying.get(n, 0) >= ROOT_SHARE * whole]
        if not inner or nodes[inner[0]][1][0].split(" ")[0] in ("p", "h1", "h2", "h3", "li", "blockquote", "pre", "table", "ul", "ol"):
            break
        root = inner[0]
    return root, template


def main_text(html: str | None, tree: list | None, wrapper: tuple[int, dict[int, int]] | None,
              own: tuple[int, dict[int, int]] | None = None) -> str:
    """``wrapper`` belongs to ``tree``, ``own`` to the page's own shape."""
    if not html:
        return ""
    page = parse(html)
    drop: set[int] = set()
    roots = []
    for shaped, learnt in ((tree, wrapper if tree is not None else None), (None, own)):
        if learnt is None or learnt[0] < 0:
            continue
        found = aligned(page, shaped)
        drop |= {id(n) for number, text in learnt[1].items() if number in found and measure(found[number])[0] == text for n in found[number]}
        if learnt[0] > 0 and learnt[0] in found:
            roots.append(found[learnt[0]])
    for nodes in roots:
        text = "\n".join(blocks(nodes, drop, []))
        if text:
            return text
    return "\n".join(blocks(fallback(page), drop if roots else set(), []))


def fallback(page: Node) -> list[Node]:
    """The outermost ``article`` nodes of a page, else ``main``, else everything."""
    for wanted in ("article", "main"):
        found: list[Node] = []

        def walk(node: Node) -> None:
            for c in node.children:
                if isinstance(c, Node) and not c.never:
                    if c.tag == wanted:
                        found.append(c)
                    else:
                        walk(c)

        walk(page)
        if found:
            return found
    return [page]


def text_key(tree: str) -> int:
    return zlib.crc32(tree.encode("utf-8", "surrogatepass")) + 1


def shape_key(tree: list) -> int:
    return text_key(json.dumps(tree))


def wrappers(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, tree, root, nodes, texts) of every host of ``pages`` (host, html), and (host, shape, root, nodes, texts) of every shape
    that several distinct pages of a host have."""
    pages = pages.where(F.length("html") > 0)
    refs = pages.groupBy("host").agg(F.min_by("html", F.struct(F.xxhash64("html"), F.length("html"))).alias("html"))

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([json.dumps(shape(parse(h))) for h in batch.column(1).to_pylist()], pa.string())],
                                             names=["host", "tree"])

    refs = written(refs.mapInArrow(shapes, "host string, tree string"), "page-references")

    # One row per page and reference: the nodes' numbers, text hashes and lengths for the host's reference, then for the page's own shape,
    # whose tree comes once per batch.
    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, nodes, ends = [], [], [0]
            seen: set[tuple] = set()
            for host, tree, html, key in zip(*(c.to_pylist() for c in batch.columns)):
                page = parse(html)
                mine = json.dumps(shape(page))
                number = text_key(mine)
                known: dict[tuple[int, int], tuple[int, int]] = {}
                nodes += page_stats(page, json.loads(tree), known)
                ends.append(len(nodes))
                nodes += page_stats(page, None, known)
                ends.append(len(nodes))
                rows += (host, 0, key, None), (host, number, key, None if (host, number) in seen else mine)
                seen.add((host, number))
            if rows:
                node = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes), (pa.int32(), pa.int64(), pa.int64()))], ["node", "hash", "length"])
                host, number, key, mine = (pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string())))
                yield pa.RecordBatch.from_arrays([host, number, key, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), node), mine],
                                                 names=["host", "shape", "page", "nodes", "tree"])

    alignments = written(pages.join(refs, "host").select("host", "tree", "html", F.xxhash64("html").alias("page")).mapInArrow(
        stats, "host string, shape bigint, page bigint, nodes array<struct<node: int, hash: bigint, length: bigint>>, tree string"), "page-alignments")
    # Copies of a page count once; they align alike.
    once = alignments.groupBy("host", "shape", "page").agg(F.first("nodes").alias("nodes")).select("host", "shape", F.explode("nodes").alias("n")).select("host", "shape", "n.*")
    per_text = once.groupBy("host", "shape", "node", "hash").agg(F.count("*").alias("pages"), F.sum("length").alias("length"))
    per_node = per_text.groupBy("host", "shape", "node").agg(
        F.sum("pages").alias("pages"), F.min("hash").alias("low"), F.max("hash").alias("high"), F.sum("length").alias("length"),
        F.max(F.struct("pages", "hash")).alias("top"))
    node = F.struct("node", "pages", "low", "high", "length", F.col("top.hash").alias("text"), F.col("top.pages").alias("shared"))
    per_shape = written(per_node.groupBy("host", "shape").agg(F.collect_list(node).alias("stats"), F.max("pages").alias("pages")), "page-stats")
    hosts = per_shape.where("shape = 0").select("host", F.col("pages").alias("host_pages"), "stats").join(refs, "host")
    # A shape's tree comes from its pages: any one of them.
    several = per_shape.where("shape <> 0 and pages > 1").join(hosts.select("host", "host_pages"), "host")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [induce(json.loads(tree), [tuple(s.values()) for s in rows], n) for tree, rows, n in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([f[0] for f in found], pa.int32()),
                                              pa.array([list(f[1]) for f in found], pa.list_(pa.int32())),
                                              pa.array([list(f[1].values()) for f in found], pa.list_(pa.int64()))],
                                             names=["host", "shape", "tree", "root", "nodes", "texts"])

    known = alignments.where(F.col("tree").isNotNull()).groupBy("host", "shape").agg(F.min("tree").alias("tree"))
    schema = "host string, shape bigint, tree string, root int, nodes array<int>, texts array<bigint>"
    columns = ("host", "shape", "tree", "stats", "host_pages")
    of_host = hosts.withColumn("shape", F.lit(0).cast("bigint")).select(*columns).mapInArrow(learn, schema)
    of_shape = several.join(known, ["host", "shape"]).select(*columns).mapInArrow(learn, schema)
    return (written(of_host.drop("shape"), "page-wrappers"), written(of_shape.drop("tree"), "page-shape-wrappers"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html) with ``text`` ('' if none) and ``n_chars`` (its code points).

    Null and empty html give ''.  Pages of any length, nesting or number of siblings are aligned whole.  Pages without a host form a host of their
    own.  Repeated pages give the same text; a host with one page, or with
    copies of one, has no wrapper and uses the page's own article.  An empty
    table gives an empty one.  Columns called like an output are replaced.
    """
    names = ("text", "n_chars")
    out_cols = others(pages, names)
    hosted = pages.select(*[F.col(f"`{c}`") for c in out_cols], host_of(F.col("url").cast("string")).alias("__host"),
                          F.col("html").cast("string").alias("__html"))
    of_host, of_shape = wrappers(hosted.select(F.col("__host").alias("host"), F.col("__html").alias("html")))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([shape_key(shape(parse(h))) if h else None for h in batch.column(len(out_cols) + 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "__shape"])

    added = [T.StructField("__host", T.StringType()), T.StructField("__html", T.StringType()), T.StructField("__shape", T.LongType())]
    keyed = hosted.mapInArrow(keys, T.StructType([*[pages.schema[c] for c in out_cols], *added]))
    own = of_shape.where("root >= 0").select(F.col("host").alias("__of"), F.col("shape").alias("__key"), F.struct("root", "nodes", "texts").alias("own"))
    joined = keyed.join(of_host, F.col("__host") == of_host["host"], "left") \
        .join(own, (F.col("__host") == F.col("__of")) & (F.col("__shape") == F.col("__key")), "left") \
        .select(*[F.col(f"`{c}`") for c in out_cols], "__html", "tree", "root", "nodes", "texts", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, tree, root, nodes, hashes, mine in zip(*(batch.column(i).to_pylist() for i in range(len(out_cols), len(out_cols) + 6))):
                texts.append(main_text(html, json.loads(tree) if tree else None, None if root is None else (root, dict(zip(nodes, hashes))),
                                       None if mine is None else (mine["root"], dict(zip(mine["nodes"], mine["texts"])))))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(out_cols))], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=[*out_cols, *names])

    schema = T.StructType([*[pages.schema[c] for c in out_cols], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return joined.mapInArrow(run, schema)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return extract_main_text(pages).select("page_id", "url", "text", "n_chars")
