"""Main text of web pages by wrapper induction.

Pages of one host and one shape (the kinds of element at the top of the body) share a template.
Of each such group the page of median size is the base; every page is aligned with it by simple
tree matching, and per base node the different pages are counted that say the same there. Nodes
that nearly all pages agree on are template, the others are slots, and the smallest container of
most of the varying text is the content slot. A page's text is what falls on that slot, without
template nodes. Inside an article nothing is template, as articles of a host may well share
lines. What a page itself marks as menu, advert, form and so on goes in any case.
"""

import html as html_lib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import stored

LEAST_PAGES = 3
SHARE = 0.8
FRAME_LETTERS = 200
TABLE_CELLS = 4_000_000  # larger alignment tables are halved instead of kept; the weight is the same
IN_ARTICLE, IN_MAIN, ALONE = 1, 2, 4

# Elements and names that mark what is not main text, and how elements nest.
DROPPED_TAGS = frozenset("script style noscript template title head nav footer aside form button select textarea "
                         "input iframe svg canvas object embed audio video map dialog datalist menu".split())  # fmt: skip
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription "
    "signup social share sharing related recommended recommendations sidebar aside menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead pagination pager widget toolbar skip login search hidden "
    "copyright disclaimer tracking".split()
)
READERS = frozenset("comment comments disqus reactions replies responses".split())
STATES = frozenset("no not non with without has enabled disabled open closed results of".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
CONTAINERS = frozenset("html body div section table tbody tr td center form".split())
PROSE = frozenset("h1 h2 h3 h4 h5 h6 hgroup p blockquote figure pre".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())  # fmt: skip
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())  # fmt: skip
SIBLINGS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
}
SCOPES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
DIGITS = re.compile(r"[0-9]+")
NAME_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


class Node:
    """An element: its tag, a key for matching, children (elements and strings), and what its names mark it as."""

    __slots__ = ("tag", "key", "kind", "kids", "elements", "marked", "readers", "hidden", "role", "digest", "dropped", "letters")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.kids, self.role, names, classes = tag, [], "", "", ""
        self.marked = self.readers = self.hidden = False
        if attributes and "=" in attributes or "hidden" in attributes:
            for m in ATTRIBUTE.finditer(attributes):
                name = m[1].lower()
                value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
                if name in ("class", "id"):
                    names += " " + value
                    classes += " " + value if name == "class" else ""
                elif name == "role":
                    self.role = value.strip().lower()
                elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                    self.hidden = True
            for name in names.split():
                parts = {p.lower() for p in NAME_PARTS.findall(name)}
                # "with-sidebar" or "no-comments" tells a state of the page, not what the element is
                if STATES.isdisjoint(parts):
                    self.marked = self.marked or not DROPPED_NAMES.isdisjoint(parts)
                    self.readers = self.readers or not READERS.isdisjoint(parts)
        self.key = f"{tag}.{DIGITS.sub('', ' '.join(sorted(names.split())))}" if names else tag
        self.kind = f"{tag}.{DIGITS.sub('', ' '.join(sorted(classes.split())))}" if classes else tag

    @property
    def main(self) -> bool:
        return self.tag == "main" or self.role == "main"


def parse(source: str) -> Node:
    """Element tree of a page, however broken; nothing is cut off."""
    root = Node("#root", "")
    stack, at, n = [root], 0, len(source)
    while at < n:
        m = TOKEN.search(source, at)
        if m is None:
            stack[-1].kids.append(source[at:])
            break
        if m.start() > at:
            stack[-1].kids.append(source[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in ENDS_P:
            _close(stack, frozenset(["p"]), ("table", "article", "section", "div", "main", "body", "td", "li", "button"))
        elif tag in SIBLINGS:
            _close(stack, SIBLINGS[tag], SCOPES[tag])
        elif tag == "body" and stack[-1].tag == "head":
            stack.pop()
        attributes = m[3] or m[6] or ""
        node = Node(tag, attributes)
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(source, at)
            at = end.start() if end else n
            stack.append(node)
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
    return root


def _close(stack: list[Node], tags: frozenset, scopes: tuple) -> None:
    """End the innermost open element of these tags, unless a scope lies in between."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in scopes:
            return


def _post_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(k for k in node.kids if type(k) is Node)
    order.reverse()
    return order


def _post_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        node.elements = [k for k in node.kids if type(k) is Node]
        stack.extend(node.elements)
    order.reverse()
    return order


def measure(root: Node) -> None:
    """Per node: digest of its text, letters outside links and dropped elements, and whether it is dropped.

    Hidden elements, readers' comments, and those with a tag or role for other things are dropped. Forms and
    elements with a name for other things are too, unless they hold an article, or more than half
    of the letters of a page that has no article: then the name speaks of the whole page, and the form is
    the page's frame (if it has ``FRAME_LETTERS``, as those of a login have not).
    """
    holds, doubtful, stated = set(), [], 0
    for node in _post_order(root):
        text, letters = blake2b(node.tag.encode("utf-8", "replace"), digest_size=8), 0
        for k in node.kids:
            if type(k) is Node:
                text.update(k.digest)
                letters += 0 if k.dropped or k.tag == "a" else k.letters
            else:
                words = " ".join(k.split())
                text.update(words.encode("utf-8", "replace"))
                letters += len(words)
        node.digest, node.letters = text.digest(), letters
        own = node.tag == "article" or node.main
        named = node.marked or node.tag == "form"
        stated += own and not (node.marked or node.readers or node.hidden)
        inner = any(id(k) in holds for k in node.elements)
        if own or inner:
            holds.add(id(node))
        free = node.main or (inner and node.tag != "article") or node.tag in ("html", "body")
        node.dropped = not free and (
            node.hidden or node.readers or (node.tag in DROPPED_TAGS and node.tag != "form")
            or (not own and (node.role in DROPPED_ROLES or node.tag == "header"))
        )
        if named and not free and not node.dropped:
            doubtful.append(node)
    for node in doubtful:
        least = FRAME_LETTERS if node.tag == "form" else 0
        node.dropped = bool(stated) or 2 * node.letters <= root.letters or node.letters < least
    # a header inside an article holds its title and stays
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag == "article" or node.main
        if node.tag == "header" and inside and not (node.marked or node.readers or node.hidden) and node.role not in DROPPED_ROLES:
            node.dropped = False
        stack.extend((k, inside) for k in node.elements)


def shape(root: Node) -> str:
    """The kinds of container at the top of the body, below elements that hold all the others."""
    node = root
    while True:
        found = [k for k in node.elements if k.tag in CONTAINERS or k.tag in DROPPED_TAGS or k.tag in ("header", "article", "main")]
        inner = [k for k in found if k.tag != "head"]
        if len(inner) != 1 or inner[0].tag not in CONTAINERS:
            return "|".join(sorted({k.kind for k in found}))
        node = inner[0]


def outline(source: str) -> tuple[str, list, list]:
    """Shape, blocks and texts of a page.

    A block is ``[parent, key, digest]``; dropped elements and articles are blocks without blocks
    inside, and inline elements are part of the block around them. A text is ``[block, flags,
    letters outside links, text]``, in page order; every break between blocks is a blank.
    """
    root = parse(source)
    measure(root)
    blocks, texts = [[-1, root.key, root.digest.hex()]], []
    beside, mains, walk = set(), False, [root]
    while walk:
        node = walk.pop()
        for k in node.elements:
            if k.tag == "article" and not k.dropped:
                beside.add(id(node))
            elif not k.dropped:
                walk.append(k)
    # item, its block, flags, whether in a link, and whether it belongs to what the page offers as prose
    stack: list = [(k, 0, 0, False, False) for k in reversed(root.kids)]
    parent = {id(k): id(root) for k in root.elements}

    def add(block: int, flags: int, letters: int, text: str) -> None:
        if texts and texts[-1][0] == block and texts[-1][1] == flags:
            texts[-1][2] += letters
            texts[-1][3].append(text)
        else:
            texts.append([block, flags, letters, [text]])

    while stack:
        item, block, flags, link, prose = stack.pop()
        if type(item) is str:
            words = " ".join(item.split())
            add(block, flags | ALONE * prose, 0 if link else len(words), html_lib.unescape(item))
            continue
        inside = flags & IN_ARTICLE
        if item.dropped or (item.tag not in INLINE and not inside):
            if not inside:
                blocks.append([block, item.key, item.digest.hex()])
            if item.dropped:
                add(block, flags | ALONE * prose, 0, " ")
                continue
            block = len(blocks) - 1
        if item.tag == "article":
            flags |= IN_ARTICLE
        if item.main:
            flags |= IN_MAIN
            mains = True
        prose = prose or item.tag == "article" or (item.tag in PROSE and parent[id(item)] in beside)
        link = link or item.tag == "a"
        broken = item.tag not in INLINE
        if broken:
            add(block, flags | ALONE * prose, 0, " ")
            stack.append((" ", block, flags, link, prose))
        for k in reversed(item.kids):
            if type(k) is Node:
                parent[id(k)] = id(item)
            stack.append((k, block, flags, link, prose))
    # without a wrapper: what lies in main; else articles that hold half of the letters, and the
    # headings and paragraphs beside them; else everything
    articles = 2 * sum(t[2] for t in texts if t[1] & IN_ARTICLE) >= sum(t[2] for t in texts) and bool(beside)
    for t in texts:
        alone = t[1] & IN_MAIN if mains else t[1] & ALONE if articles else True
        t[1] = t[1] & (IN_ARTICLE | IN_MAIN) | (ALONE if alone else 0)
        t[3] = f" {' '.join(''.join(t[3]).split())} "
    return shape(root), blocks, [t for t in texts if t[3] != "  "]


class Block:
    """A block of an outline as a tree node."""

    __slots__ = ("key", "digest", "index", "elements", "size", "sig")


def tree(blocks: list) -> list[Block]:
    """Blocks as a tree, in page order; the first is the root."""
    made = []
    for i, (parent, key, digest) in enumerate(blocks):
        node = Block()
        node.key, node.digest, node.index, node.elements = key, digest, i, []
        made.append(node)
        if parent >= 0:
            made[parent].elements.append(node)
    for node in reversed(made):
        node.size = 1 + sum(k.size for k in node.elements)
        node.sig = hash((node.key, tuple([k.sig for k in node.elements])))
    return made


def _ends(a: list[Block], b: list[Block]) -> tuple[int, int]:
    """How many children are alike in structure at the start, and then at the end."""
    n = min(len(a), len(b))
    lo = 0
    while lo < n and a[lo].sig == b[lo].sig:
        lo += 1
    hi = 0
    while hi < n - lo and a[-1 - hi].sig == b[-1 - hi].sig:
        hi += 1
    return lo, hi


def _middles(a: Block, b: Block) -> tuple[list[Block], list[Block]]:
    lo, hi = _ends(a.elements, b.elements)
    return a.elements[lo : len(a.elements) - hi], b.elements[lo : len(b.elements) - hi]


def _pair(x: Block, y: Block, memo: dict) -> int:
    return 0 if x.key != y.key else x.size if x.sig == y.sig else memo[x.sig, y.sig]


def _matched(a: list[Block], b: list[Block], memo: dict, pairs: list | None) -> int:
    """Weight of the best ordered matching of two child lists, whose pairs' weights are known; adds the pairs."""
    kinds = list({y.sig: y for y in b}.values())
    place = {y.sig: i for i, y in enumerate(kinds)}
    at = np.array([place[y.sig] for y in b])
    known: dict = {}

    def weights(x: Block) -> np.ndarray:
        if x.sig not in known:
            known[x.sig] = np.array([_pair(x, y, memo) for y in kinds], np.int64)
        return known[x.sig]

    def table(xs: list[Block], columns: np.ndarray, keep: bool) -> list[np.ndarray]:
        rows = [np.zeros(len(columns) + 1, np.int64)]
        for x in xs:
            row = np.zeros(len(columns) + 1, np.int64)
            np.maximum(rows[-1][1:], rows[-1][:-1] + weights(x)[columns], out=row[1:])
            np.maximum.accumulate(row, out=row)
            if not keep:
                rows.pop()
            rows.append(row)
        return rows

    if pairs is None:
        return int(table(a, at, False)[-1][-1])
    total, work = None, [(0, len(a), 0, len(b))]
    while work:
        i0, i1, j0, j1 = work.pop()
        if i0 == i1 or j0 == j1:
            total = total or 0
            continue
        if (i1 - i0) * (j1 - j0) > TABLE_CELLS and i1 - i0 > 1:
            # too large to keep: find where the best matching crosses the middle row
            mid = (i0 + i1) // 2
            above = table(a[i0:mid], at[j0:j1], False)[-1]
            below = table(a[mid:i1][::-1], at[j0:j1][::-1], False)[-1][::-1]
            cut = j0 + int(np.argmax(above + below))
            total = int((above + below).max()) if total is None else total
            work += [(i0, mid, j0, cut), (mid, i1, cut, j1)]
            continue
        rows = table(a[i0:i1], at[j0:j1], True)
        total = int(rows[-1][-1]) if total is None else total
        i, j = i1 - i0, j1 - j0
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((a[i0 + i], b[j0 + j]))
    return total or 0


def matching(a: Block, b: Block, memo: dict) -> int:
    """Simple tree matching: most node pairs of two trees that keep parents and order."""
    if a.key != b.key or a.sig == b.sig:
        return a.size if a.key == b.key else 0
    stack = [(a, b)]
    while stack:
        x, y = stack[-1]
        if (x.sig, y.sig) in memo:
            stack.pop()
            continue
        xs, ys = _middles(x, y)
        first: dict = {}
        for q in ys:
            first.setdefault(q.key, {}).setdefault(q.sig, q)
        open_pairs = [
            (p, q) for p in {p.sig: p for p in xs}.values() for q in first.get(p.key, {}).values()
            if p.sig != q.sig and (p.sig, q.sig) not in memo
        ]
        if open_pairs:
            stack.extend(open_pairs)
            continue
        lo, hi = _ends(x.elements, y.elements)
        ends = sum(k.size for k in x.elements[:lo]) + sum(k.size for k in x.elements[len(x.elements) - hi :])
        memo[x.sig, y.sig] = 1 + ends + (_matched(xs, ys, memo, None) if xs and ys else 0)
        stack.pop()
    return memo[a.sig, b.sig]


def aligned(a: Block, b: Block) -> Iterator[tuple[Block, Block]]:
    """Pairs of the matching, from the roots down."""
    memo: dict = {}
    stack = [(a, b)] if a.key == b.key else []
    while stack:
        x, y = stack.pop()
        yield x, y
        matching(x, y, memo)
        lo, hi = _ends(x.elements, y.elements)
        stack.extend(zip(x.elements[:lo], y.elements[:lo], strict=True))
        stack.extend(zip(x.elements[len(x.elements) - hi :], y.elements[len(y.elements) - hi :], strict=True))
        xs, ys = _middles(x, y)
        if xs and ys:
            pairs: list = []
            _matched(xs, ys, memo, pairs)
            stack.extend(pairs)


def agreeing(base: list[Block], page: list[Block]) -> list[int]:
    """Base blocks whose whole text the page repeats."""
    return [x.index for x, y in aligned(base[0], page[0]) if x.digest == y.digest]


def learn(blocks: list, texts: list, counts: dict[int, int], pages: int) -> dict | None:
    """Wrapper from a base page: its blocks, which are template (``constant``), and the content ``slot``.

    Template is what the share ``SHARE`` of all pages says there; ``counts`` has the pages per
    base block. Fewer than ``LEAST_PAGES`` pages can't tell a template from a shared line.
    """
    if pages < LEAST_PAGES:
        return None
    constant = [i for i, n in counts.items() if n >= SHARE * pages]
    gone, varying = set(constant), [0] * len(blocks)
    under = [False] * len(blocks)
    for i, (parent, _, _) in enumerate(blocks):
        under[i] = i in gone or (parent >= 0 and under[parent])
    for block, flags, letters, _ in texts:
        varying[block] += letters if flags & IN_ARTICLE or not under[block] else 0
    for i in range(len(blocks) - 1, 0, -1):
        varying[blocks[i][0]] += varying[i]
    children: dict = {}
    for i, (parent, _, _) in enumerate(blocks):
        children.setdefault(parent, []).append(i)
    slot = 0
    while True:
        best = max(children.get(slot, []), key=lambda i: varying[i], default=None)
        if best is None or varying[best] <= 0.9 * varying[slot] or blocks[best][1].split(".", 1)[0] not in CONTAINERS:
            return {"blocks": blocks, "constant": sorted(constant), "slot": slot}
        slot = best


class Wrapper:
    """A wrapper read back: a tree that pages can be aligned with."""

    def __init__(self, text: str):
        made = json.loads(text)
        self.blocks, self.constant, self.slot = tree(made["blocks"]), set(made["constant"]), made["slot"]


def page_text(blocks: list, texts: list, wrapper: Wrapper | None = None) -> str:
    """Main text of an outlined page; without a wrapper from what the page itself marks."""
    gone, within = [False] * len(blocks), [False] * len(blocks)
    if wrapper is not None:
        for x, y in aligned(wrapper.blocks[0], tree(blocks)[0]):
            gone[y.index] = x.index in wrapper.constant and x.digest == y.digest
            within[y.index] = x.index == wrapper.slot
        for i in range(1, len(blocks)):
            gone[i] = gone[i] or gone[blocks[i][0]]
            within[i] = within[i] or within[blocks[i][0]]
    kept = [t for t in texts if within[t[0]]]
    if not any(t[2] for t in kept):
        kept = [t for t in texts if t[1] & ALONE]
    elif any(t[1] & IN_MAIN for t in kept):
        kept = [t for t in kept if t[1] & IN_MAIN]
    chosen = {id(t) for t in kept if t[1] & IN_ARTICLE or not gone[t[0]]}
    return " ".join("".join(t[3] if id(t) in chosen else " " for t in texts).split())


def main_text(source: str | None, wrapper: Wrapper | None = None) -> str:
    """Main text of one page."""
    return page_text(*outline(source)[1:], wrapper) if source else ""


def _host(url):
    """Host of an address, lower case; none: empty."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with their shape, size and outline in place of the HTML."""
    for batch in batches:
        shapes, sizes, outlines = [], [], []
        for source in batch.column(batch.num_columns - 1).to_pylist():
            kind, blocks, texts = outline(source) if source else (None, None, None)
            shapes.append(kind)
            sizes.append(len(blocks) if source else None)
            outlines.append(json.dumps([blocks, texts], ensure_ascii=False) if source else None)
        added = [pa.array(shapes, pa.string()), pa.array(sizes, pa.int32()), pa.array(outlines, pa.string())]
        names = [*batch.schema.names[:-1], "_shape", "_size", "_outline"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=names)


def _agreements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read = lru_cache(16)(lambda base: tree(json.loads(base)[0]))
    for batch in batches:
        bases, pages = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        agree = [agreeing(read(b), tree(json.loads(p)[0])) for b, p in zip(bases, pages, strict=True)]
        columns = [*batch.columns[:3], pa.array(agree, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["_host", "_group", "_content", "_agree"])


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for pages, base, counts in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            found = learn(*json.loads(base), {c["block"]: c["n"] for c in counts}, pages)
            made.append(None if found is None else json.dumps(found))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(made, pa.string())], names=["_host", "_group", "_wrapper"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text`` per page.

    The pages of a host are grouped by shape; shapes of fewer than three different pages make one
    group, and if that has fewer than three as well, they go with the host's most frequent shape. Each
    group gets a wrapper from all its different pages (repeated rows count once); a group of fewer
    than three has none, and its pages speak for themselves.

    An outline of each page is stored once. Bases and wrappers, one a group, are stored too, so Spark
    knows their size when it plans the joins: small ones travel to the pages, others are joined by host
    and shape, where adaptive execution splits a large host.

    Null and empty pages have the empty text. Pages without a host share one. Repeated rows come out as
    often as they came in. No pages: no rows.
    """
    rows = pages.select(
        F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), _host(F.col(url_col)).alias("_host"),
        F.xxhash64(html_col).alias("_content"), F.col(html_col).alias("_html"),
    )
    kind = pages.schema[id_col].dataType.simpleString()
    seen = stored(
        rows.mapInArrow(
            _outlines, f"_id {kind}, _url string, _host string, _content long, _shape string, _size int, _outline string"
        ),
        "page_outlines",
    )
    keys = ["_host", "_group"]
    distinct = seen.where(F.col("_shape").isNotNull()).groupBy("_host", "_shape", "_content").agg(F.max("_size").alias("_size"))
    shapes = distinct.groupBy("_host", "_shape").agg(F.count(F.lit(1)).alias("_n"))
    few = F.col("_n") < LEAST_PAGES
    hosts = shapes.groupBy("_host").agg(
        F.sum(F.when(few, F.col("_n")).otherwise(0)).alias("_rest"), F.max(F.struct("_n", "_shape")).alias("_top")
    )
    groups = stored(
        shapes.join(hosts, "_host").select(
            "_host", "_shape",
            F.when(~few, F.col("_shape")).when(F.col("_rest") >= LEAST_PAGES, F.lit("*")).otherwise(F.col("_top._shape")).alias("_group"),
        ),
        "page_groups",
    )
    members = distinct.join(groups, ["_host", "_shape"])
    middle = members.groupBy(keys).agg(F.count(F.lit(1)).alias("_pages"), F.percentile_approx("_size", 0.5).alias("_size"))
    chosen = (
        members.join(middle.where(F.col("_pages") >= LEAST_PAGES), [*keys, "_size"])
        .groupBy(*keys, "_pages").agg(F.min("_content").alias("_content"))
    )
    # rows of one content have one outline
    bases = stored(
        seen.where(F.col("_shape").isNotNull()).select("_host", "_content", "_outline").join(stored(chosen, "page_bases"), ["_host", "_content"])
        .groupBy(*keys, "_pages").agg(F.min("_outline").alias("_base")),
        "base_outlines",
    )
    agreed = (
        seen.select("_host", "_shape", "_content", "_outline").join(stored(groups.join(bases, keys), "shape_bases"), ["_host", "_shape"])
        .select("_host", "_group", "_content", "_base", "_outline")
        .mapInArrow(_agreements, "_host string, _group string, _content long, _agree array<int>")
    )
    counts = (
        agreed.dropDuplicates([*keys, "_content"]).select(*keys, F.explode("_agree").alias("block"))
        .groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*keys).agg(F.collect_list(F.struct("block", "n")).alias("_counts"))  # as many as the base has blocks
    )
    learned = (
        bases.join(counts, keys).select(*keys, "_pages", "_base", "_counts")
        .mapInArrow(_learned, "_host string, _group string, _wrapper string")
    )
    wrappers = stored(groups.join(learned, keys).select("_host", "_shape", "_wrapper"), "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lru_cache(16)(lambda text: Wrapper(text) if text else None)
        for batch in batches:
            texts = [
                page_text(*json.loads(page), read(made)) if page else ""
                for page, made in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=[id_col, url_col, "text"])

    work = seen.join(wrappers, ["_host", "_shape"], "left").select("_id", "_url", "_outline", "_wrapper")
    return work.mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` string, text string")
