"""Main text of web pages by wrapper induction over the pages of a host.

Every page is parsed to a small tree and aligned with the reference tree of its host by simple tree
matching (the largest set of node pairs that keeps labels, parents and order). What all pages of a
host show at a matched node is counted: a node whose text keeps coming back is constant and belongs to
the template, a node whose text varies is a slot. The counts are taken over all distinct pages (copies,
repeated rows and mirrors, which agree in their text outside furniture, are one page) and are one
small row per host and node. The wrapper of a host is its reference tree with these counts; a page is
then read by aligning it once more and keeping the slots.

Markup that names its own purpose (menus, headers, footers, forms, notices, adverts, comments) by its
element, its role or a whole name of a fixed list is never content, unless it is or holds an ``article``
or ``main`` or, on a page without these, holds most of the text that varies. Elsewhere the wrapper decides: constant nodes go, also inside an ``article`` or ``main``
element, and slots stay, also outside of one where they hold more text than these elements do (teasers
marked as articles beside a body that is not); where the article is the longer, slots outside of it are
counters, dates and links to other pages, and go. What it leaves open (hosts with few distinct pages, nodes
that few pages reach or that are neither constant nor varying) is kept inside these elements, where a
page has one, and dropped outside.

A host may hold any share of the pages: references and counts are pre-aggregated minima and sums,
and pages meet their host's wrapper by a join on host and salt, the wrappers repeated per salt.

Defined results: a null or empty page, and one without content, has the empty text; a null address is
a host of its own; pages of equal size tie by their bytes for the reference; repeated rows are read
alike; an empty table gives no rows; columns with clashing names are not read.
"""

from __future__ import annotations

import html as html_codec
import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.batches import pieces
from folioscope.session import stable

SALTS = 32
BROADCAST_BYTES = 16 << 20
LEAST_PAGES = 4
# a node is template where its recurring texts, each on CONSTANT_SHARE of the distinct pages that reach
# it, stand on NODE_SHARE of them together, and REACHED_SHARE of the distinct pages of the host reach it
CONSTANT_SHARE = 0.3
NODE_SHARE = 0.9
REACHED_SHARE = 0.5
# a slot shows at least so many different texts a page that reaches it
VARYING_SHARE = 0.5
# tables of more cells are not held: the child lists are halved until they fit
CELLS_AT_ONCE = 4_000_000
WRAPPER_NODES = 200_000

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template head title".split())
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
FURNITURE = set("nav header footer aside form menu dialog search".split())
CONTENT = set("article main".split())
FURNITURE_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split()
)
# Class and id names that mark furniture, compared with whole tokens.
FURNITURE_NAMES = set(
    "ad ads ad-box ad-slot ad-banner ad-container adv advert adverts advertisement advertising banner "
    "sponsor sponsored promo promoted promotion cookie cookies cookie-notice cookie-banner cookie-bar "
    "cookie-consent consent gdpr notice notices alert popup modal overlay newsletter newsletter-signup "
    "subscribe subscription signup login comment comments comment-list comments-area respond "
    "disqus disqus_thread reply replies sidebar side-bar aside nav navbar navigation site-nav main-nav "
    "nav-menu main-menu menu menus breadcrumb breadcrumbs pagination pager footer site-footer "
    "page-footer header site-header page-header masthead topbar top-bar toolbar share sharing "
    "share-buttons social social-links social-share related related-posts related-articles recommended "
    "recommendations widget widgets widget-area search search-form searchform copyright legal "
    "disclaimer skip skip-link".split()
)
# Elements that stay furniture whatever they hold; others are none if they hold the content.
ALWAYS_FURNITURE = set("nav footer aside".split())
# The end of a paragraph is implied by the start of any of these.
ENDS_PARAGRAPH = BLOCKS - {"br"}
IMPLIED_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table article section div body html main aside nav form blockquote".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I
)
RAW_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in ("script", "style", "textarea", "title")}
SPACE = re.compile(r"[^\S\x1c-\x1f]+")


class Node:
    """An element with its own text pieces and children in page order."""

    __slots__ = ("tag", "marks", "items", "number", "holds_content")

    def __init__(self, tag: str, marks: str = ""):
        self.tag, self.marks, self.items, self.number = tag, marks, [], -1
        self.holds_content = tag in ("html", "body")

    @property
    def children(self) -> list[Node]:
        return [i for i in self.items if isinstance(i, Node)]


def _marks(attributes: str) -> str:
    """``furniture``, ``hidden``, ``content`` or nothing, from the attributes of a tag."""
    found = ""
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "hidden"
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return "hidden"
        if name == "role" and value in FURNITURE_ROLES:
            return "furniture"
        if name == "role" and value in ("main", "article"):
            return "content"
        if name in ("class", "id") and FURNITURE_NAMES.intersection(value.split()):
            found = "furniture"
    return found


def parse(page: str) -> Node:
    """The tree of a page; unclosed and stray tags are tolerated."""
    root = Node("#root")
    stack = [root]
    at = 0
    while at < len(page):
        token = TOKEN.search(page, at)
        if token is None:
            stack[-1].items.append(page[at:])
            break
        if token.start() > at:
            stack[-1].items.append(page[at : token.start()])
        at = token.end()
        closing, tag, attributes = token.group(1), token.group(2), token.group(3)
        if tag is None:
            if token.group().startswith("<![CDATA["):
                stack[-1].items.append(html_codec.escape(token.group()[9:-3]))
            continue
        tag = tag.lower()
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            # an inline end tag does not close the block around it
            crossed = {n.tag for n in stack[depth + 1 :]}
            if depth and (tag in BLOCKS or not crossed & BLOCKS):
                del stack[depth:]
            continue
        if tag in ENDS_PARAGRAPH:
            depth = next(
                (i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in SCOPES | {"p"}), 0
            )
            if stack[depth].tag == "p":
                del stack[depth:]
        if tag in IMPLIED_ENDS:
            depth = len(stack) - 1
            while depth and stack[depth].tag not in IMPLIED_ENDS[tag] | SCOPES:
                depth -= 1
            if stack[depth].tag in IMPLIED_ENDS[tag]:
                del stack[depth:]
        node = Node(tag, _marks(attributes) if attributes else "")
        stack[-1].items.append(node)
        if tag in RAW_END:
            end = RAW_END[tag].search(page, at)
            stop = end.start() if end else len(page)
            if tag == "textarea" and stop > at:
                node.items.append(page[at:stop])
            at = end.end() if end else len(page)
        elif tag not in VOID and not (attributes or "").endswith("/"):
            stack.append(node)
    return root


def text_of(node: Node) -> str:
    """All visible text of a subtree on one line, to compare matched nodes."""
    parts: list[str] = []
    todo = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item.tag not in HIDDEN:
            todo.extend(reversed(item.items))
    return SPACE.sub(" ", html_codec.unescape(" ".join(parts))).strip()


def _is_region(node: Node) -> bool:
    return node.tag in CONTENT or node.marks == "content"


def _is_furniture(node: Node) -> bool:
    if node.tag in HIDDEN or node.tag in ALWAYS_FURNITURE or node.marks == "hidden":
        return True
    return (node.tag in FURNITURE or node.marks == "furniture") and not node.holds_content


def find_content(root: Node, constant: set[int] = frozenset()) -> None:
    """Mark nodes that are no furniture whatever they are called.

    These hold an ``article`` or ``main``, or are one; on a page without, they hold most of its text
    that is neither constant nor in links nor in elements that are always furniture.
    """
    order: list[tuple] = []  # (node, place of its parent)
    todo = [(root, -1)]
    while todo:
        node, parent = todo.pop()
        if node.tag in HIDDEN or node.tag in ALWAYS_FURNITURE or node.marks == "hidden":
            continue
        order.append((node, parent))
        todo.extend((c, len(order) - 1) for c in node.children)
    regions = [_is_region(node) for node, _ in order]
    if any(regions):
        for at in range(len(order) - 1, -1, -1):
            node, parent = order[at]
            node.holds_content = node.holds_content or regions[at]
            if parent >= 0 and regions[at]:
                regions[parent] = True
        return
    if not any(n.tag in FURNITURE or n.marks == "furniture" for n, _ in order):
        return
    sizes = [0] * len(order)
    for at in range(len(order) - 1, -1, -1):
        node, parent = order[at]
        if node.tag == "a" or node.number in constant:
            sizes[at] = 0
        else:
            sizes[at] += sum(len(i.strip()) for i in node.items if isinstance(i, str))
        if parent >= 0:
            sizes[parent] += sizes[at]
    for (node, _), size in zip(order, sizes):
        node.holds_content = node.holds_content or 2 * size > sizes[0]


def skeleton(root: Node) -> list[tuple]:
    """Block-level nodes of a page as rows ``(number, parent, label, text)`` in page order.

    Inline elements belong to the block around them. Nodes get their number here.
    """
    rows: list[tuple] = []
    todo = [(root, -1)]
    while todo:
        node, parent = todo.pop()
        node.number = len(rows)
        label = node.tag + (":" + node.marks if node.marks else "")
        leaf = node.tag in HIDDEN or not any(c.tag in BLOCKS for c in node.children)
        rows.append((node.number, parent, label, text_of(node) if leaf else None))
        if not leaf:
            own = node.number
            todo.extend((c, own) for c in reversed(node.children) if c.tag in BLOCKS)
    return rows


class Shapes:
    """Skeleton rows with the shape of every node: a number for its label and its children's shapes."""

    def __init__(self, rows: list[tuple], base: Shapes | None = None):
        self.rows = rows
        self.kids: list[list[int]] = [[] for _ in rows]
        for number, parent, *_ in rows:
            if parent >= 0:
                self.kids[parent].append(number)
        known = base.known if base else {}
        self.known: dict[tuple, int] = {}
        self.below: dict[int, tuple[int, ...]] = {}
        self.size: dict[int, int] = {}
        self.label: dict[int, str] = {}
        self.shape = [0] * len(rows)
        for number in range(len(rows) - 1, -1, -1):
            below = tuple([self.shape[k] for k in self.kids[number]])
            key = (rows[number][2], below)
            shape = known.get(key)
            if shape is None:
                shape = self.known.setdefault(key, len(known) + len(self.known))
            if shape not in self.below:
                self.below[shape], self.label[shape] = below, rows[number][2]
                self.size[shape] = 1 + sum(self.size[k] for k in below)
            self.shape[number] = shape


def _last_row(left, right, weights):
    """Weight of a best alignment of all of ``left`` with every prefix of ``right``."""
    import numpy as np

    row = np.zeros(len(right) + 1, dtype=np.int64)
    for i in left:
        best = np.maximum(row[1:], row[:-1] + weights[i, right])
        row[1:] = np.maximum.accumulate(best)
    return row


def align(left, right, weights, cells: int = CELLS_AT_ONCE) -> list[tuple[int, int]]:
    """Places of a heaviest common subsequence; memory stays linear beyond ``cells`` cells.

    ``left`` and ``right`` hold rows and columns of ``weights``; weight 0 is no pair.
    """
    import numpy as np

    n, m = len(left), len(right)
    if not n or not m:
        return []
    if n == 1:
        best = int(np.argmax(weights[left[0], right]))
        return [(0, best)] if weights[left[0], right[best]] else []
    if n * m > cells:
        half = n // 2
        ahead = _last_row(left[:half], right, weights)
        behind = _last_row(left[half:][::-1], right[::-1], weights)[::-1]
        cut = int(np.argmax(ahead + behind))
        first = align(left[:half], right[:cut], weights, cells)
        second = align(left[half:], right[cut:], weights, cells)
        return first + [(i + half, j + cut) for i, j in second]
    table = np.zeros((n + 1, m + 1), dtype=np.int32)
    for i in range(n - 1, -1, -1):
        best = np.maximum(table[i + 1, :-1], table[i + 1, 1:] + weights[left[i], right])
        table[i, :-1] = np.maximum.accumulate(best[::-1])[::-1]
    pairs = []
    i = j = 0
    while i < n and j < m:
        weight = weights[left[i], right[j]]
        if weight and table[i, j] == table[i + 1, j + 1] + weight:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif table[i, j] == table[i + 1, j]:
            i += 1
        else:
            j += 1
    return pairs


def match(a: list[tuple], b: list[tuple] | Shapes) -> dict[int, int]:
    """Simple tree matching of two skeletons: ``{node of a: node of b}`` of a largest matching.

    Runs of equal shape at both ends of two child lists are paired first, which keeps the matching
    largest and leaves small tables; what is left is a longest common subsequence weighted by the
    matches of the subtrees. Equal pairs of shapes are solved once.
    """
    import numpy as np

    two = b if isinstance(b, Shapes) else Shapes(b)
    one = Shapes(a, two)
    if not one.rows or not two.rows or one.rows[0][2] != two.rows[0][2]:
        return {}
    # per pair of different shapes of one label the nodes matched, and the places of paired children
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def weight(x: int, y: int) -> int:
        if x == y:
            return one.size[x]
        return memo[x, y][0] if one.label[x] == two.label[y] else 0

    todo = [(one.shape[0], two.shape[0])]
    while todo:
        x, y = todo[-1]
        if x == y or (x, y) in memo:
            todo.pop()
            continue
        left, right = one.below[x], two.below[y]
        shorter, front, back = min(len(left), len(right)), 0, 0
        while front < shorter and left[front] == right[front]:
            front += 1
        while back < shorter - front and left[-1 - back] == right[-1 - back]:
            back += 1
        inner_left, inner_right = left[front : len(left) - back], right[front : len(right) - back]
        rows = {v: i for i, v in enumerate(dict.fromkeys(inner_left))}
        columns = {v: i for i, v in enumerate(dict.fromkeys(inner_right))}
        open_pairs = [
            (v, w)
            for v in rows
            for w in columns
            if v != w and one.label[v] == two.label[w] and (v, w) not in memo
        ]
        if open_pairs:
            todo.extend(open_pairs)
            continue
        todo.pop()
        pairs = [(i, i) for i in range(front)]
        if rows and columns:
            weights = np.array([[weight(v, w) for w in columns] for v in rows], dtype=np.int64)
            inner = align(
                np.array([rows[v] for v in inner_left]), np.array([columns[v] for v in inner_right]), weights
            )
            pairs += [(i + front, j + front) for i, j in inner]
        pairs += [(len(left) - i, len(right) - i) for i in range(back, 0, -1)]
        memo[x, y] = 1 + sum(weight(left[i], right[j]) for i, j in pairs), pairs

    found: dict[int, int] = {}
    nodes = [(0, 0)]
    while nodes:
        x, y = nodes.pop()
        found[x] = y
        left, right = one.kids[x], two.kids[y]
        if one.shape[x] == two.shape[y]:
            nodes.extend(zip(left, right))
        else:
            nodes.extend((left[i], right[j]) for i, j in memo[one.shape[x], two.shape[y]][1])
    return found


def blocks(root: Node, constant: set[int], varying: set[int] = frozenset()) -> list[str]:
    """Text blocks of the content in page order.

    ``constant`` holds numbers of template nodes, which go wherever they are, and ``varying`` those of
    slots. Slots outside of regions stay where they hold more text, links apart, than the regions.
    Regions, where a page has one, decide on the text that is neither.
    """
    find_content(root, constant)
    has_region = False
    todo = [root]
    while todo and not has_region:
        node = todo.pop()
        if not _is_furniture(node):
            has_region = has_region or _is_region(node)
            todo.extend(node.children)
    out: list[tuple[str, bool]] = []  # with whether all of it comes from slots outside of regions
    line: list[str] = []
    inner = False  # whether the block has text that stays in any case
    weights = [0, 0]  # characters outside and inside

    def flush() -> None:
        nonlocal inner
        text = SPACE.sub(" ", "".join(line)).strip()
        if text:
            out.append((text, not inner))
        line.clear()
        inner = False

    # (item, whether inside a region, whether inside a slot, whether inside a link); None marks the end
    # of a block
    stack: list[tuple] = [(root, False, False, False)]
    while stack:
        item, inside, slot, link = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if inside or slot or not has_region:
                line.append(html_codec.unescape(item))
                stays = inside or not has_region
                inner = inner or (stays and not item.isspace())
                if stays or not link:
                    weights[stays] += len(item.strip())
        else:
            # a page header is furniture, the header of an article is part of it
            own_header = inside and item.tag == "header" and not item.marks
            if (_is_furniture(item) and not own_header) or item.number in constant:
                if item.tag in BLOCKS:
                    flush()
                continue
            inside = inside or _is_region(item)
            slot = slot or item.number in varying
            link = link or item.tag == "a"
            if item.tag in BLOCKS:
                flush()
                stack.append((None, inside, slot, link))
            stack.extend((child, inside, slot, link) for child in reversed(item.items))
    flush()
    kept_outside = weights[False] > weights[True]
    return [text for text, outside in out if kept_outside or not outside]


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _text_sum(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


class Wrapper:
    """A reference tree and, for each of its nodes, the sums of the texts that are constant there."""

    def __init__(self, written: str | None):
        stored = json.loads(written) if written else {"nodes": [], "varying": [], "constant": {}}
        nodes = [(p, label) for p, label, n in stored["nodes"] for _ in range(n)]
        self.rows = [(i, p, label, None) for i, (p, label) in enumerate(nodes)]
        self.shapes = Shapes(self.rows)
        self.varying = set(stored["varying"])
        self.constant = {int(n): set(sums) for n, sums in stored["constant"].items()}


class Wrappers(dict):
    """Wrappers by their written form; starts anew when their nodes have grown to a fixed number."""

    nodes = 0

    def __missing__(self, written: str | None) -> Wrapper:
        if self.nodes >= WRAPPER_NODES or len(self) >= 2000:
            self.clear()
            self.nodes = 0
        self[written] = Wrapper(written)
        self.nodes += len(self[written].rows)
        return self[written]


def reference(page: str) -> str:
    """The whole tree of a page; siblings of one label in a row are written once with their number."""
    nodes: list[list] = []
    for _, parent, label, _ in skeleton(parse(page)):
        if nodes and nodes[-1][:2] == [parent, label]:
            nodes[-1][2] += 1
        else:
            nodes.append([parent, label, 1])
    return json.dumps({"nodes": nodes, "varying": [], "constant": {}})


def shown_texts(root: Node, wrapper: Wrapper) -> Iterator[tuple[int, int]]:
    """Node of the reference and sum of the text, for every matched leaf of a page."""
    rows = skeleton(root)
    for own, at in match(rows, wrapper.shapes).items():
        if rows[own][3]:
            yield at, _text_sum(rows[own][3])


def slot_text(root: Node) -> str:
    """All text outside furniture: pages that agree in it count as one page."""
    parts: list[str] = []
    todo: list = [root]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
        elif not _is_furniture(item):
            todo.extend(reversed(item.items))
    return " ".join(html_codec.unescape(" ".join(parts)).split())


def main_text(page: str | None, wrapper: Wrapper) -> str:
    root = parse(page or "")
    constant: set[int] = set()
    varying: set[int] = set()
    rows = skeleton(root)
    if wrapper.constant or wrapper.varying:
        for own, at in match(rows, wrapper.shapes).items():
            sums = wrapper.constant.get(at)
            if at in wrapper.varying:
                varying.add(own)
            elif sums and rows[own][3] and _text_sum(rows[own][3]) in sums:
                constant.add(own)
    return "\n".join(blocks(root, constant, varying))


def _references(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        written = [reference(h) for h in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(written, pa.string())], names=["host", "wrapper"]
        )


def _shown(batches: Iterator) -> Iterator:
    """Rows ``(host, html, wrapper)`` to ``(host, slots, shown)``: a sum of the page's text outside
    furniture, and the texts of matched nodes."""
    import pyarrow as pa

    known = Wrappers()
    pairs = pa.list_(pa.struct([("node", pa.int32()), ("shown", pa.int64())]))
    for batch in pieces(batches):
        slots, shown = [], []
        for page, written in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            root = parse(page or "")
            find_content(root)
            slots.append(_text_sum(slot_text(root)))
            texts = sorted(shown_texts(root, known[written]))
            shown.append([{"node": n, "shown": t} for n, t in texts])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(slots, pa.int64()), pa.array(shown, pairs)],
            names=["host", "slots", "shown"],
        )


def _beside(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Pages with the wrapper of their host.

    Wrappers of counted bytes are broadcast up to ``BROADCAST_BYTES``; beyond it both sides are dealt
    by host and salt, so a host with any share of the pages is read by many tasks.
    """
    size = wrappers.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return pages.join(F.broadcast(wrappers), "host", "left")
    salted = wrappers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int")
    return pages.withColumn("salt", salt).join(salted, ["host", "salt"], "left").drop("salt")


def induce(pages: DataFrame) -> DataFrame:
    """``(host, wrapper)`` of every host, from ``(host, page_id, html)``."""
    sized = pages.filter(F.length("html") > 0)
    # the page of smallest hash is the reference of its host
    chosen = stable(sized.groupBy("host").agg(F.min(F.xxhash64("html")).alias("h")))
    picked = (
        sized.withColumn("h", F.xxhash64("html"))
        .join(chosen, ["host", "h"], "left_semi")
        .groupBy("host")
        .agg(F.min("html").alias("html"))
    )
    references = stable(picked.mapInArrow(_references, "host string, wrapper string"))
    # copies, repeated rows and mirrors count as one page
    distinct = stable(
        _beside(pages.filter(F.length("html") > 0), references)
        .select("host", "html", "wrapper")
        .mapInArrow(_shown, "host string, slots bigint, shown array<struct<node: int, shown: bigint>>")
        .groupBy("host", "slots")
        .agg(F.min("shown").alias("shown"))
    )
    shown = (
        distinct.select("host", F.explode("shown").alias("s"))
        .groupBy("host", "s.node", "s.shown")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    shown = stable(shown)
    total = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    reached = shown.groupBy("host", "node").agg(
        F.sum("n").alias("reached"), F.count(F.lit(1)).alias("texts")
    )
    nodes = (
        reached.join(total, "host")
        .filter(F.col("reached") >= LEAST_PAGES)
        .filter(F.col("reached") >= REACHED_SHARE * F.col("pages"))
        .select("host", "node", "reached", "texts")
    )
    # at most 1 / CONSTANT_SHARE texts of a node pass, so the collected lists are bounded
    constant = (
        shown.filter(F.col("n") >= 3)
        .join(nodes, ["host", "node"])
        .filter(F.col("n") >= CONSTANT_SHARE * F.col("reached"))
        .groupBy("host", "node")
        .agg(
            F.collect_list("shown").alias("sums"),
            F.sum("n").alias("covered"),
            F.first("reached").alias("reached"),
        )
        .filter(F.col("covered") >= NODE_SHARE * F.col("reached"))
        .groupBy("host")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col("node").cast("string"), "sums"))).alias("c"))
    )
    varying = (
        nodes.filter(F.col("texts") >= VARYING_SHARE * F.col("reached"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("node")).alias("v"))
    )
    found = F.concat(
        F.lit('"varying": '), F.coalesce(F.to_json("v"), F.lit("[]")),
        F.lit(', "constant": '), F.coalesce(F.to_json("c"), F.lit("{}")), F.lit("}"),
    )
    kept = F.expr("substring_index(wrapper, '\"varying\": ', 1)")
    return (
        references.join(varying, "host", "left")
        .join(constant, "host", "left")
        .select("host", F.concat(kept, found).alias("wrapper"))
    )


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``(page_id, url, text)`` of every page."""
    named = pages.select(
        host_of(F.col(url)).alias("host"),
        F.col(key).alias("page_id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
    )
    wrappers = stable(induce(named.select("host", "page_id", "html")))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = Wrappers()
        for batch in pieces(batches):
            texts = [
                main_text(page, known[written])
                for page, written in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    kind = pages.schema[key].dataType.simpleString()
    return (
        _beside(named, wrappers)
        .select("page_id", "url", "html", "wrapper")
        .mapInArrow(run, f"page_id {kind}, url string, text string")
    )
