"""HTML extraction by wrapper induction.

Each page becomes a tree of its block elements; neighbouring siblings of one kind are one
node, as a wrapper's repeated slot. The pages of a host are aligned by simple tree matching
with a page of their own layout (the labels of the tree's top), their reference. For each
reference node the texts that the host's pages have there are counted: a node with mostly
one text on enough different pages is template, a node whose text varies is a slot. A slot
outside articles that holds mostly links on enough pages is a menu. The content is the
deepest node below which most of the text lies that varies; short slots beside it, adverts
and footers of changing text, go as well. A
host has references for its LAYOUTS most frequent layouts; pages of others are aligned with
that of the most frequent one. Per host only counts by (node, text hash) are shuffled, summed
before the shuffle, so a host's size doesn't matter.

A page's main text is what template nodes, menus and slots beside the content leave: of that the blocks in its article
or main element, if there are any, else all. Blocks inside elements that by name hold menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles or comments are left
out: where such a part differs from page to page, induction alone takes it for content. A
name marks what is below it only as a whole or with plain words (`site-footer`, not
`no-sidebar`), outside articles also by a part of it; nothing but comments and elements of
such kinds is left out past the beginning of an article below it. A
node inside an article counts once for all pages whose article has the same longest block
beside it: copies and near copies of one article on a host aren't its layout.
"""

from __future__ import annotations

import functools
import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patentlake.llm._io import bounded, written

MIN_PAGES = 5  # different pages on which a node must be seen before it can be template
SHARE = 0.8  # of them with one text
LINKS = 0.6  # of a menu's characters that are links
LAYOUTS = 8  # references of a host
CONTENT = 0.8  # of the varying text of all pages lies below the node that holds the article
BESIDE = 0.1  # of it lies in a slot beside that node, at most, if the slot is none of the article
TOP = 3  # levels of the tree that make a layout

_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")
_HEADING = re.compile(r"h[1-6](?![\w-])")

# Element names of HTML.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
SKIPPED = frozenset("nav header footer aside form fieldset select option button dialog menu search".split())
# Elements that may stand around a whole page.
SOFT = frozenset("form fieldset".split())
# Names that mark parts of a page other than its article.
MARKS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside complementary contentinfo notice cookie cookies consent gdpr popup modal alert comment comments reply replies disqus respond share sharing social related newsletter subscribe signup login form search widget pagination pager".split())
# Names that mark readers' comments; MARKS has them too.
COMMENTS = frozenset("comment comments reply replies disqus respond".split())
# Words that leave a mark's meaning as it is in a name of several words.
PLAIN = frozenset("site page main top bottom left right box list bar area section wrap wrapper container inner outer block slot link links unit item items content panel group primary secondary global js".split())
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


class Node:
    __slots__ = ("label", "kids", "texts", "links", "hard", "soft", "main", "tag")

    def __init__(self, tag: str, label: str, hard: bool, main: bool, soft: bool = False) -> None:
        self.tag, self.label, self.hard, self.soft, self.main = tag, label, hard, soft, main
        self.kids: list[Node] = []
        self.texts: list[str] = []
        self.links = 0  # characters that are links

    @property
    def skip(self) -> bool:
        """Left out by name. What is soft ends where an article or main element begins below it."""
        return self.hard or self.soft


@functools.lru_cache(maxsize=10_000)
def marked(attributes: str) -> tuple[list[str], str]:
    """(words of an element's class, id and role; how they mark it): `comments`, `other`, `weak` where only a part of a name does, or nothing."""
    names = [x for found in _NAMES.findall(attributes) for x in "".join(found).lower().split()]
    parts = [[x for x in _SPLIT.split(n) if x] for n in names]
    sure = [p for p in parts if any(x in MARKS for x in p) and all(x in MARKS or x in PLAIN or x.isdigit() for x in p)]
    kind = "comments" if any(x in COMMENTS for p in sure for x in p) else "other" if sure else "weak" if any(x in MARKS for p in parts for x in p) else ""
    return [x for p in parts for x in p], kind


def tokens(page: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, name, attributes) of markup in order; name is empty for comments, and begins with / for end tags. Linear in the page."""
    at, n = 0, len(page)
    while (lo := page.find("<", at)) >= 0:
        at = lo + 1
        if page.startswith(("!--", "![CDATA["), at):
            close = "-->" if page[at + 1] == "-" else "]]>"
            end = page.find(close, at)
            at = n if end < 0 else end + len(close)
            yield lo, at, "", ""
            continue
        m = _NAME.match(page, at)
        if not m and page[at : at + 1] not in ("!", "?"):
            continue
        to = m.end() if m else at
        while (stop := _STOP.search(page, to)) and stop.group() != ">":
            to = stop.end()
            if page[max(0, stop.start() - 8) : stop.start()].rstrip().endswith("="):  # other quotes are part of a name
                end = page.find(stop.group(), to)
                if end < 0:  # never closed: the tag ends at its first >
                    stop = re.compile(">").search(page, to)
                    break
                to = end + 1
        if not stop:  # no tag ends after this place
            return
        at = stop.end()
        yield lo, at, m.group().lower() if m else "", page[m.end() : stop.start()] if m else ""


def parse(page: str, names: bool = True) -> tuple[Node, list[tuple[Node, str]]]:
    """Tree of block elements (repeated siblings merged), and the page's blocks in order. Without names no element is marked by what it is called."""
    root = Node("", "", False, False)
    stack = [(root, "")]
    opened: Counter[str] = Counter()
    blocks: list[tuple[Node, str]] = []
    held: list[str] = []
    link = links = 0

    def flush() -> None:
        nonlocal links
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                node = stack[-1][0]
                node.texts.append(text)
                node.links += min(links, len(text))
                blocks.append((node, text))
        links = 0

    def pop() -> None:
        opened[stack.pop()[1]] -= 1

    at = 0
    for lo, end, tag, attributes in tokens(page):
        if lo < at:  # inside a raw element
            continue
        held.append(page[at:lo])
        links += link * len(held[-1].strip())
        at = end
        if not tag:
            continue
        closing, tag = tag[0] == "/", tag.lstrip("/")
        if not closing and tag in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag == "a":
            link = 0 if closing else 1
        if tag == "br":
            held.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if closing:
            if opened[tag]:
                while stack[-1][1] != tag:
                    pop()
                pop()
            continue
        if tag in VOID:
            continue
        while len(stack) > 1 and (stack[-1][1] == "p" or stack[-1][1] in CLOSES.get(tag, ())):  # a block ends a paragraph
            pop()
        marks, kind = marked(attributes) if attributes else ([], "")
        top = stack[-1][0]
        main = top.main or tag in ("article", "main") or "main" in marks and "role" in attributes.lower()
        if tag in ("body", "html", "article", "main"):
            kind = ""
        hard = top.hard or tag in SKIPPED and tag not in SOFT or kind == "comments"
        soft = top.soft and main <= top.main or tag in SOFT or kind == "other" or kind == "weak" and not top.main
        if not names:
            main = hard = soft = False
        label = f"{tag}.{marks[0]}" if marks else tag
        if top.kids and top.kids[-1].label == label and (top.kids[-1].hard, top.kids[-1].soft) == (hard, soft):
            node = top.kids[-1]  # a repeated sibling
        else:
            node = Node(tag, label, hard, main, soft)
            top.kids.append(node)
        stack.append((node, tag))
        opened[tag] += 1
    held.append(page[at:])
    flush()
    return root, blocks


def layout(root: Node) -> str:
    """The labels of the top of the tree."""
    out, level = [], [root]
    for _ in range(TOP):
        level = [k for n in level for k in n.kids]
        out.append(" ".join(k.label for k in level))
    return "/".join(out)


def preorder(node: Node) -> list[Node]:
    out, todo = [], [node]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += reversed(n.kids)
    return out


def skeleton(root: Node) -> str:
    """The tree without texts, as (label, number of children) in preorder."""
    return json.dumps([[n.label, len(n.kids)] for n in preorder(root)], ensure_ascii=False, separators=(",", ":"))


def from_skeleton(text: str) -> Node:
    root, todo = Node("", "", False, False), []
    for k, (label, n) in enumerate(json.loads(text)):
        node = root if not k else Node("", label, False, False)
        if k:
            todo[-1][0].kids.append(node)
            todo[-1][1] -= 1
        while todo and not todo[-1][1]:
            todo.pop()
        if n:
            todo.append([node, n])
    return root


class Matching:
    """Simple tree matching: the most pairs of nodes of equal label that keep order and ancestry.

    Equal subtrees have one number, and the score of two numbers is found once; without
    recursion, so trees may be of any depth.
    """

    def __init__(self, a: Node, b: Node) -> None:
        self.kinds: dict[tuple, int] = {}
        self.kids: list[np.ndarray] = []
        self.labels: list[str] = []
        self.sizes: list[int] = []
        self.of: dict[int, int] = {}
        for root in (a, b):
            for n in reversed(preorder(root)):  # children before parents
                kids = tuple(self.of[id(k)] for k in n.kids)
                kind = self.kinds.setdefault((n.label, kids), len(self.kinds))
                if kind == len(self.labels):
                    self.labels.append(n.label)
                    self.kids.append(np.array(kids, dtype=np.int64))
                    self.sizes.append(1 + sum(self.sizes[k] for k in kids))
                self.of[id(n)] = kind
        self.known: dict[tuple[int, int], int] = {}
        self.roots = a, b

    def _trimmed(self, x: int, y: int) -> tuple[int, int, int]:
        """Children that both lists begin and end with: matching equal ones is never worse; and the score of these."""
        p, q = self.kids[x], self.kids[y]
        n = min(len(p), len(q))
        head = int(np.argmin(np.append(p[:n] == q[:n], False)))
        tail = int(np.argmin(np.append(p[::-1][: n - head] == q[::-1][: n - head], False)))
        return head, tail, sum(self.sizes[k] for k in (*p[:head].tolist(), *p[len(p) - tail :].tolist()))

    def _middle(self, x: int, y: int) -> tuple[np.ndarray, np.ndarray, int, int]:
        head, tail, score = self._trimmed(x, y)
        p, q = self.kids[x], self.kids[y]
        return p[head : len(p) - tail], q[head : len(q) - tail], head, score

    def _weights(self, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of the different children of both, and which of them each child is."""
        (ps, i), (qs, j) = np.unique(p, return_inverse=True), np.unique(q, return_inverse=True)
        return np.array([[self._simple(a, b) if self._simple(a, b) is not None else self.known[a, b] for b in qs.tolist()] for a in ps.tolist()], dtype=np.int64).reshape(len(ps), len(qs)), i, j

    def _simple(self, x: int, y: int) -> int | None:
        if self.labels[x] != self.labels[y]:
            return 0
        if x == y:
            return self.sizes[x]
        return 1 if not len(self.kids[x]) or not len(self.kids[y]) else None

    @staticmethod
    def _rows(w: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[np.ndarray]:
        """Best scores of the first children of the one with each number of the other's."""
        row, held = np.zeros(len(j) + 1, dtype=np.int32), {}
        yield row
        for k in i.tolist():
            gain = held.get(k)
            if gain is None:
                gain = w[k, j].astype(np.int32)
                if len(held) < 256:
                    held[k] = gain
            both = row[:-1] + gain
            np.maximum(both, row[1:], out=both)
            row = np.empty_like(row)
            row[0] = 0
            np.maximum.accumulate(both, out=row[1:])
            yield row

    def score(self, x: int, y: int) -> int:
        todo = [(x, y)]
        while todo:
            a, b = todo[-1]
            if (a, b) in self.known or self._simple(a, b) is not None:
                todo.pop()
                continue
            p, q, _, score = self._middle(a, b)
            need = [(c, d) for c in set(p.tolist()) for d in set(q.tolist()) if self._simple(c, d) is None and (c, d) not in self.known]
            if need:
                todo += need
                continue
            if len(p) and len(q):
                *_, last = self._rows(*self._weights(p, q))
                score += int(last[-1])
            self.known[a, b] = score + 1
            todo.pop()
        simple = self._simple(x, y)
        return self.known[x, y] if simple is None else simple

    def _chosen(self, p: np.ndarray, q: np.ndarray) -> Iterator[tuple[int, int]]:
        """Children that are matched, by halving the one list until a table is small: memory grows with the lists, not with their product."""
        w, i, j = self._weights(p, q)
        todo = [(0, len(i), 0, len(j))]
        while todo:
            lo, hi, left, right = todo.pop()
            if lo == hi or left == right:
                continue
            if hi - lo == 1 or (hi - lo) * (right - left) <= 1 << 18:
                table = np.stack(list(self._rows(w, i[lo:hi], j[left:right])))
                k, m = hi - lo, right - left
                while k and m:
                    if table[k, m] == table[k - 1, m]:
                        k -= 1
                    elif table[k, m] == table[k, m - 1]:
                        m -= 1
                    else:
                        k, m = k - 1, m - 1
                        yield lo + k, left + m
                continue
            mid = (lo + hi) // 2
            *_, before = self._rows(w, i[lo:mid], j[left:right])
            *_, after = self._rows(w, i[mid:hi][::-1], j[left:right][::-1])
            at = left + int(np.argmax(before + after[::-1]))
            todo += [(lo, mid, left, at), (mid, hi, at, right)]

    def pairs(self) -> list[tuple[Node, Node]]:
        out, todo = [], [self.roots]
        if not self.score(*(self.of[id(n)] for n in self.roots)):
            return []
        while todo:
            a, b = todo.pop()
            out.append((a, b))
            x, y = self.of[id(a)], self.of[id(b)]
            if x == y:
                todo += zip(a.kids, b.kids, strict=True)
            elif a.kids and b.kids:
                p, q, head, _ = self._middle(x, y)
                todo += zip(a.kids[:head], b.kids[:head], strict=True)
                todo += zip(a.kids[head + len(p) :], b.kids[head + len(q) :], strict=True)
                if len(p) and len(q):
                    for c in set(p.tolist()):
                        for d in set(q.tolist()):
                            self.score(c, d)
                    todo += [(a.kids[head + k], b.kids[head + m]) for k, m in self._chosen(p, q)]
        return out


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Score and pairs of the simple tree matching of two trees."""
    m = Matching(a, b)
    return m.score(m.of[id(a)], m.of[id(b)]), m.pairs()


@functools.lru_cache(maxsize=2000)
def places(bones: str, reference: str) -> list[int]:
    """For each node of a skeleton in preorder the number of the reference's node that it is matched with, or -1."""
    a, b = from_skeleton(bones), from_skeleton(reference)
    number = {id(n): k for k, n in enumerate(preorder(b))}
    to = {id(x): number[id(y)] for x, y in match(a, b)[1]}
    return [to.get(id(n), -1) for n in preorder(a)]


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(errors="replace"), digest_size=8).digest(), "little", signed=True)


def extract(page: str | None, references: Iterable[dict] | None = None, names: bool = True) -> str:
    """Main text of a page, given its host's wrapper: layout, reference (a skeleton) and template (its template nodes and menus) of each layout, the most frequent first."""
    root, blocks = parse(page or "", names)
    gone: set[int] = set()
    if references := list(references or ()):
        own = layout(root)
        wrapper = next((r for r in references if r["layout"] == own), references[0])
        if template := set(wrapper["template"] or ()):
            gone = {id(n) for n, k in zip(preorder(root), places(skeleton(root), wrapper["reference"]), strict=True) if k in template}
    left = [(n, t) for n, t in blocks if not n.skip and id(n) not in gone]
    has_main = any(n.main for n, _ in left)
    return "\n".join(t for n, t in left if n.main or not has_main)


def beside(blocks: list[tuple[Node, str]]) -> dict[int, int]:
    """For the nodes of an article, by id: digest of the longest block of the article beside the node; 0 if there is none."""
    inner = sorted(((len(t), t, id(n)) for n, t in blocks if n.main and not n.skip), reverse=True)
    if not inner:
        return {}
    first = inner[0]
    other = next((x for x in inner if x[2] != first[2]), None)
    one, two = _digest(first[1]), _digest(other[1]) if other else 0
    return {id(n): two if id(n) == first[2] else one for n, _ in blocks if n.main}


def beside_content(reference: Node, chars: dict[int, int]) -> set[int]:
    """Slots beside the content, given the characters that vary in each slot over a host's pages, by the node's number.

    The content is the deepest node with CONTENT of those characters below it. A slot
    outside of it with BESIDE of them at most is none of the article; headings are.
    """
    order = preorder(reference)
    below = {id(n): chars.get(k, 0) for k, n in enumerate(order)}
    for n in reversed(order):
        below[id(n)] += sum(below[id(c)] for c in n.kids)
    total = below[id(reference)]
    at = reference
    while step := next((c for c in at.kids if below[id(c)] >= CONTENT * total), None) if total else None:
        at = step
    inside = {id(n) for n in preorder(at)}
    return {k for k, n in enumerate(order) if k in chars and id(n) not in inside and chars[k] <= BESIDE * total and not _HEADING.match(n.label)}


def host_of(url):
    """Lower-case host of a URL column, without port; null or odd URLs share the empty host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def induce(pages: DataFrame, names: bool = True) -> DataFrame:
    """Wrapper of each host of pages (host, html): host and references, the most frequent layout first."""
    by_name = names

    def outline(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.int64()), ("page", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())]))
        for batch in it:
            tops, bones, slots, whole = [], [], [], []
            for page in batch.column("html").to_pylist():
                root, blocks = parse(page or "", by_name)
                tops.append(layout(root))
                bones.append(skeleton(root))
                nodes = preorder(root)
                of = _digest("\n".join(t for n in nodes for t in n.texts))
                rest = beside(blocks)
                # what is left out by name needs no count; links in an article are its own
                slots.append([{"node": k, "text": _digest("\n".join(n.texts)), "page": rest.get(id(n), of), "chars": sum(map(len, n.texts)), "links": 0 if n.main else n.links} for k, n in enumerate(nodes) if n.texts and not (n.main and n.skip)])
                whole.append(of if blocks else None)
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(tops, pa.string()), pa.array(bones, pa.string()), pa.array(slots, kind), pa.array(whole, pa.int64())], names=["host", "layout", "bones", "slots", "whole"])

    slot = "array<struct<node:int,text:bigint,page:bigint,chars:bigint,links:bigint>>"
    # pages without text say nothing of a layout
    outlined = written(pages.mapInArrow(outline, f"host string, layout string, bones string, slots {slot}, whole long").where("whole is not null"), "outlines")
    layouts = outlined.groupBy("host", "layout").agg(F.count("*").alias("n"), F.min(F.struct("whole", "bones")).alias("least"))
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "layout"))
    references = written(layouts.withColumn("rank", place).where(F.col("rank") <= LAYOUTS).select("host", "layout", "rank", F.col("least.bones").alias("reference")), "references")

    def align(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "rank", "node", "text", "page", "chars", "links"]
        for batch in it:
            rows: list[tuple] = []
            for host, rank, bones, slots, reference in zip(*(batch.column(c).to_pylist() for c in ("host", "rank", "bones", "slots", "reference")), strict=True):
                place = places(bones, reference)
                rows += [(host, rank, place[s["node"]], s["text"], s["page"], s["chars"], s["links"]) for s in slots if place[s["node"]] >= 0]
            types = (pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, types, strict=True)], names=names)

    own = references.select("host", "layout", "rank", "reference")
    first = references.where("rank = 1").select("host", F.col("reference").alias("first"))
    joined = outlined.join(own, ["host", "layout"], "left").join(first, "host").select("host", F.coalesce("rank", F.lit(1)).alias("rank"), "bones", "slots", F.coalesce("reference", "first").alias("reference"))
    aligned = joined.mapInArrow(align, "host string, rank int, node int, text long, page long, chars long, links long").distinct()  # copies of a page count once
    counts = aligned.groupBy("host", "rank", "node", "text").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    nodes = counts.groupBy("host", "rank", "node").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    decided = (F.col("most") >= SHARE * F.col("n")) | (F.col("links") >= LINKS * F.col("chars"))
    known = nodes.where(F.col("n") >= MIN_PAGES).groupBy("host", "rank").agg(F.collect_list(F.struct("node", "chars", decided.alias("decided"))).alias("nodes"))  # as many as the reference has

    def judge(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "rank", "layout", "reference"]
        for batch in it:
            found = []
            for reference, nodes in zip(batch.column("reference").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
                gone = {x["node"] for x in nodes or () if x["decided"]}
                found.append(sorted(gone | beside_content(from_skeleton(reference), {x["node"]: x["chars"] for x in nodes or () if not x["decided"]})) or None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.list_(pa.int32()))], names=[*names, "template"])

    each = references.join(known, ["host", "rank"], "left").select("host", "rank", "layout", "reference", "nodes").mapInArrow(judge, "host string, rank int, layout string, reference string, template array<int>")
    wrappers = each.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("rank", "layout", "reference", "template"))).alias("references"))
    # only wrappers with template nodes change anything
    return wrappers.where(F.exists("references", lambda r: r["template"].isNotNull()))


def extract_pages(pages: DataFrame, url: str = "url", page: str = "html", by_name: bool = True) -> DataFrame:
    """Every row of pages with text and n_chars (code points) in place of its html.

    Without by_name wrappers alone decide: names of elements and classes, article and main
    elements too, mean nothing. Null or empty html gives an empty text. Pages whose URL has no host share a wrapper.
    Repeated rows each get a row and count once for their wrapper; empty pages give an empty
    table. Columns named like a result are replaced, others pass through.
    """
    results = ("text", "n_chars")
    keep = [c for c in pages.columns if c not in (page, *results)]
    names = [f"k{i}" for i in range(len(keep))]
    plain = bounded(pages).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{page}`").cast("string").alias("html"))
    wrappers = written(induce(plain.select("host", "html"), by_name), "wrappers")
    kinds = "".join(f"{n} {plain.schema[n].dataType.simpleString()}, " for n in names)

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = [extract(p, r, by_name) for p, r in zip(*(batch.column(c).to_pylist() for c in ("html", "references")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, *results])

    out = plain.join(wrappers, "host", "left").select(*names, "html", "references").mapInArrow(run, f"{kinds}text string, n_chars long")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], *results)
