"""Main text of web pages by wrapper induction.

Pages of a host are made by a few templates. A page's layout is its set of tag paths. A reference page
is chosen for all pages of a host, for those with the same upper paths, and for each layout, if there
are enough pages; the tree of every page is aligned with its references' by simple tree matching, which
finds the largest order-preserving match of equal tags, top down. A reference node whose text is the same in
nearly all pages it was matched in is template, and so is that text in the nodes matched to it, nowhere else;
nodes whose text varies are slots that hold content. Markup is read once; trees and blocks are stored.
Menus, adverts and footers vary too, so what an element calls itself (its tag, role, class and id)
closes the slots inside it.
"""

from __future__ import annotations

import hashlib
import html as entities
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkmart.llm.common import stored, whole
from sparkmart.llm.scan import by_bytes

#: A node is template if it has its text in this share of at least LEAST_PAGES matched, different pages.
CONSTANT, LEAST_PAGES = 0.9, 4
#: A group of n different pages with more than 1 - 2 / n, or COPIES, of their content text constant holds copies of one page; nothing is template there.
COPIES = 0.8
#: Parts into which the pages of a group are dealt to meet their reference.
SALTS = 16
#: Levels of a tag path that pages of similar layouts share.
UPPER = 4
#: Outside of an article, a block with this share of its characters in links is a menu.
LINKS = 0.6

# HTML's block elements, void elements and elements without readable text.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math select button canvas audio video".split())
SPACED = frozenset("br td th img wbr option".split())
ENDS = {"li": {"li": "ul ol menu dir"}, "dt": {"dt": "dl", "dd": "dl"}, "dd": {"dt": "dl", "dd": "dl"}, "tr": {"tr": "table"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Tags, roles and name parts of what is not the article.
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
ASIDE_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer sidebar aside ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond reply replies share sharing social related recommended pagination pager search widget widgets toolbar copyright".split()
)
REPLIES = frozenset("comment comments disqus respond reply replies".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)>|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[a-z0-9]+")
#: Elements whose content is text up to their own closing tag, whatever stands in it.
UNPARSED = frozenset("script style textarea title iframe".split())
CLOSING = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in UNPARSED}
BODY = re.compile(r"<body(?=[\s/>])", re.I)


def tokens(source: str) -> Iterator[re.Match]:
    """Matches of TOKEN, without the content of unparsed elements; one that is never closed ends at the body, or at the end."""
    at = 0
    while m := TOKEN.match(source, at):
        yield m
        at = m.end()
        tag = (m[2] or "").lower()
        if tag in UNPARSED and not m[1] and not m[3].endswith("/"):
            end = CLOSING[tag].search(source, at) or BODY.search(source, at)
            at = end.start() if end else len(source)


class Node:
    """An element: its tag, block children, the numbers of its blocks of text, and whether it is closed to content."""

    __slots__ = ("tag", "children", "blocks", "closed", "inside", "heads")

    def __init__(self, tag: str, closed: bool, inside: bool, heads: bool):
        self.tag, self.children, self.blocks = tag, [], []
        self.closed, self.inside, self.heads = closed, inside, heads


class Page:
    """The tree of a page and its blocks: (text, node, characters in links)."""

    def __init__(self, source: str | None):
        self.root = Node("#", False, False, False)
        self.blocks: list[tuple[str, Node, int]] = []
        self.has: set[str] = set()
        stack: list[tuple[str, Node]] = [("#", self.root)]
        text: list[str] = []
        linked = link = 0
        skip = ""

        def flush() -> None:
            nonlocal text, linked
            said = " ".join("".join(text).split())
            if said:
                node = stack[-1][1]
                node.blocks.append(len(self.blocks))
                self.blocks.append((said, node, linked))
            text, linked = [], 0

        for m in tokens(source or ""):
            tag = m[2]
            if tag is None:
                piece = m[0]
                if not skip and not piece.startswith("<!") and not piece.startswith("<?"):
                    piece = entities.unescape(piece) if "&" in piece else piece
                    text.append(piece)
                    if link:
                        linked += len(piece)
                continue
            tag = tag.lower()
            if skip:
                if m[1] and tag == skip:
                    skip = ""
                elif m[1] or tag != "body" or skip not in UNPARSED:
                    continue
                else:
                    skip = ""
                if m[1]:
                    continue
            if m[1]:
                if tag == "a":
                    link = max(0, link - 1)
                if tag in BLOCKS and any(t == tag for t, _ in stack):
                    flush()
                    while stack.pop()[0] != tag:
                        pass
                    link = 0
                elif tag in SPACED:
                    text.append(" ")
                continue
            if tag in RAW and not m[3].endswith("/"):
                skip = tag
                text.append(" ")
                continue
            if tag in SPACED:
                text.append(" ")
            if tag == "a":
                link = 1
            if tag not in BLOCKS:
                continue
            flush()
            link = 0
            self._imply(stack, tag)
            node = self._open(stack[-1][1], tag, m[3])
            stack[-1][1].children.append(node)
            if tag not in VOID:
                stack.append((tag, node))
        flush()

    def _imply(self, stack: list, tag: str) -> None:
        """Close what the new element closes by HTML's rules: an open paragraph, an open item of the same list."""
        ends, over = ENDS.get(tag, {}), None
        for i in range(len(stack) - 1, 0, -1):
            name = stack[i][0]
            if name == "p" and tag != "p" or name == "p":
                over = i
            elif name in HEADINGS and tag in HEADINGS:
                over = i
            elif name in ends:
                over = i
            elif any(name in parents.split() for parents in ends.values()) or not ends:
                break
        if over:
            del stack[over:]

    def _open(self, parent: Node, tag: str, attributes: str) -> Node:
        closed, inside, heads = parent.closed, parent.inside, parent.heads
        names: set[str] = set()
        if attributes and attributes.strip(" /"):
            given = {k.lower(): a or b or c or "" for k, a, b, c in ATTRIBUTE.findall(attributes)}
            names = set(NAME.findall(f"{given.get('class', '')} {given.get('id', '')}".lower()))
            hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "")
            closed |= hidden or given.get("role", "").lower() in ASIDE_ROLES
        if tag in ("article", "main"):
            closed |= bool(names & REPLIES)
            if not closed:
                self.has.add(tag)
                inside = True
        elif tag not in ("html", "body"):
            head = tag == "header" or "header" in names
            if head and inside and not closed and not (names - {"header"}) & ASIDE_NAMES:
                heads = True  # a header of the article itself gives its headings
            elif tag in ASIDE_TAGS or names & ASIDE_NAMES:
                closed = True
        return Node(tag, closed or (heads and tag not in HEADINGS and not tag == "header" and tag != "div"), inside, heads)

    def content(self) -> list[int]:
        """Numbers of the blocks that may be content."""
        article = bool(self.has)
        out = []
        for i, (said, node, linked) in enumerate(self.blocks):
            if node.closed or (article and not node.inside) or (node.heads and node.tag not in HEADINGS):
                continue
            if not article and linked >= LINKS * len(said):
                continue
            out.append(i)
        return out


class Shapes:
    """Numbers of subtrees, equal for equal tags all the way down, and the sizes of the largest matches of two of them."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.tags: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.nodes: list[int] = []
        self.of: dict[int, int] = {}
        self.best: dict[tuple[int, int], int] = {}

    def add(self, root: Node) -> None:
        order, todo = [], [root]
        while todo:
            order.append(todo.pop())
            todo += order[-1].children
        for node in reversed(order):
            form = (node.tag, *(self.of[id(c)] for c in node.children))
            if form not in self.numbers:
                self.numbers[form] = len(self.tags)
                self.tags.append(node.tag)
                self.kids.append(form[1:])
                self.nodes.append(1 + sum(self.nodes[k] for k in form[1:]))
            self.of[id(node)] = self.numbers[form]

    def known(self, x: int, y: int) -> int | None:
        """The size of the largest match of x and y, None if it is still to be computed."""
        if x == y:
            return self.nodes[x]
        if self.tags[x] != self.tags[y]:
            return 0
        return self.best.get((x, y)) if self.kids[x] and self.kids[y] else 1

    def solve(self, x: int, y: int) -> None:
        todo = [(x, y)]
        while todo:
            x, y = todo[-1]
            if self.known(x, y) is None:
                missing = [(u, v) for u in set(self.kids[x]) for v in set(self.kids[y]) if self.known(u, v) is None]
                if missing:
                    todo += missing
                    continue
                *_, last = self.rows(x, y)
                self.best[x, y] = 1 + int(last[-1])
            todo.pop()

    def rows(self, x: int, y: int, first: Sequence[int] | None = None, start: int = 0, stop: int | None = None) -> Iterator[Sequence[int]]:
        """Row i holds the sizes of the largest matches of the first i children of x with the first 0, 1, ... children of y."""
        if len(self.kids[x]) * len(self.kids[y]) <= 1024:  # the same rows, faster without arrays
            row = [0] * (len(self.kids[y]) + 1) if first is None else first
            yield row
            for u in self.kids[x][start:stop]:
                after = [0]
                for j, v in enumerate(self.kids[y]):
                    after.append(max(row[j + 1], after[j], row[j] + self.known(u, v)))
                row = after
                yield row
            return
        others, place = np.unique(np.array(self.kids[y]), return_inverse=True)
        others, gains = others.tolist(), {}
        row = np.zeros(len(place) + 1, np.int32) if first is None else first
        yield row
        for u in self.kids[x][start:stop]:
            if u not in gains:
                gains[u] = np.array([self.known(u, v) for v in others], np.int32)
            after = row.copy()
            np.maximum(row[1:], row[:-1] + gains[u][place], out=after[1:])
            row = np.maximum.accumulate(after)
            yield row

    def used(self, x: int, y: int) -> list[tuple[int, int]]:
        """The child pairs of the largest match. Only every step-th row is kept, the rows between are computed again."""
        if not self.kids[x] or not self.kids[y]:
            return []
        i, j = len(self.kids[x]), len(self.kids[y])
        if x == y:
            return [(k, k) for k in range(i)]
        step = math.isqrt(i) + 1
        marks = [row for k, row in enumerate(self.rows(x, y)) if k % step == 0]
        out = []
        while i and j:
            low = (i - 1) // step * step
            size = list(self.rows(x, y, marks[low // step], low, i))
            while i > low and j:
                if size[i - low][j] == size[i - low - 1][j]:
                    i -= 1
                elif size[i - low][j] == size[i - low][j - 1]:
                    j -= 1
                else:
                    out.append((i - 1, j - 1))
                    i, j = i - 1, j - 1
        return out[::-1]


def matched(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of nodes of the largest match of the two trees (simple tree matching), exact for sibling lists of any length."""
    shapes = Shapes()
    shapes.add(a)
    shapes.add(b)
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        p, q = shapes.of[id(x)], shapes.of[id(y)]
        shapes.solve(p, q)
        todo += [(x.children[i], y.children[j]) for i, j in shapes.used(p, q)]
    return out


def said_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host_of(url: str | Column) -> Column:
    """Host of a URL in lower case, without user and port; '' for NULL and for what is no URL."""
    return F.lower(F.regexp_extract(whole(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def layout(page: Page) -> tuple[int, int]:
    """Hashes of the page's tag paths, cut to UPPER levels and whole."""
    numbers: dict[tuple, int] = {}
    paths, upper, at = set(), set(), 0
    todo = [(-1, 0, c) for c in page.root.children]
    while at < len(todo):
        above, depth, node = todo[at]
        at += 1
        key = (above, node.tag)
        if key not in numbers:
            numbers[key] = said_hash(f"{above} {node.tag}")
            paths.add(numbers[key])
            if depth < UPPER:
                upper.add(numbers[key])
        todo += [(numbers[key], depth + 1, c) for c in node.children]
    return tuple(said_hash(" ".join(map(str, sorted(x)))) for x in (upper, paths))


def preorder(root: Node) -> tuple[list[Node], list[int]]:
    """Nodes, each behind its parent, and the places of their parents; -1 for the root."""
    nodes, up, todo = [], [], [(root, -1)]
    while todo:
        node, above = todo.pop()
        here = len(nodes)
        nodes.append(node)
        up.append(above)
        todo += [(c, here) for c in reversed(node.children)]
    return nodes, up


def tree(tags: str, up: Sequence[int]) -> list[Node]:
    """The nodes that `preorder` wrote down."""
    nodes = [Node(t, False, False, False) for t in tags.split(" ")]
    for node, above in zip(nodes, up):
        if above >= 0:
            nodes[above].children.append(node)
    return nodes


INT, LONG, TEXT = pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string())
#: What is kept of a page: its layout, its tree, and per block of content its text, node, place among the node's blocks, hash and length.
PARSED = {
    "id": ("long", pa.int64()), "upper": ("long", pa.int64()), "full": ("long", pa.int64()), "body": ("long", pa.int64()), "tags": ("string", pa.string()), "up": ("array<int>", INT),
    "texts": ("array<string>", TEXT), "node": ("array<int>", INT), "nth": ("array<int>", INT), "said": ("array<long>", LONG), "size": ("array<int>", INT),
}


def parsed(pages: DataFrame) -> DataFrame:
    """The one time that markup is read: `row`, `host`, `pick` and PARSED of every page, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in by_bytes(batches, "html"):
            found: dict[str, list] = {c: [] for c in PARSED}
            for source in batch.column("html").to_pylist():
                page = Page(source)
                nodes, up = preorder(page.root)
                place = {id(n): i for i, n in enumerate(nodes)}
                some = page.content()
                texts = [page.blocks[i][0] for i in some]
                upper, full = layout(page)
                node = [place[id(page.blocks[i][1])] for i in some]
                nth = [page.blocks[i][1].blocks.index(i) for i in some]
                values = (number, upper, full, said_hash("\n".join(texts)), " ".join(n.tag for n in nodes), up, texts, node, nth, list(map(said_hash, texts)), list(map(len, texts)))
                for c, v in zip(found, values):
                    found[c].append(v)
                number += 1
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("host"), batch.column("pick"), *(pa.array(found[c], kind) for c, (_, kind) in PARSED.items())], ["row", "host", "pick", *found])

    out = T.StructType().add("row", pages.schema["row"].dataType).add("host", "string").add("pick", "long")
    kinds = {"long": T.LongType(), "string": T.StringType(), "array<int>": T.ArrayType(T.IntegerType()), "array<long>": T.ArrayType(T.LongType()), "array<string>": T.ArrayType(T.StringType())}
    for name, (kind, _) in PARSED.items():
        out = out.add(name, kinds[kind])
    return stored(pages.select("row", "host", "pick", "html").mapInArrow(run, out), "zstd")


def grouped(pages: DataFrame) -> DataFrame:
    """(host, upper, full, pick): the groups of at least LEAST_PAGES pages and the page each is judged by.

    NULL stands for any layout. A group that is all of a wider one is left out. The reference is of the
    group's most frequent layout. Pages without content are in no group.
    """
    layouts = stored(pages.filter(F.size("node") > 0).groupBy("host", "upper", "full").agg(F.count(F.lit(1)).alias("n"), F.min("pick").alias("pick")))
    first = F.min(F.struct((-F.col("n")).alias("n"), "full", "pick")).alias("first")
    uppers = layouts.groupBy("host", "upper").agg(F.sum("n").alias("m"), first)
    hosts = layouts.groupBy("host").agg(F.sum("n").alias("all"), first)
    none = F.lit(None).cast("long")
    whole_hosts = hosts.filter(F.col("all") >= LEAST_PAGES).select("host", none.alias("upper"), none.alias("full"), "first.pick")
    parts = uppers.join(hosts.select("host", "all"), "host").filter((F.col("m") >= LEAST_PAGES) & (F.col("m") < F.col("all"))).select("host", "upper", none.alias("full"), "first.pick")
    single = layouts.join(uppers.select("host", "upper", "m"), ["host", "upper"]).filter((F.col("n") >= LEAST_PAGES) & (F.col("n") < F.col("m"))).select("host", "upper", "full", "pick")
    return stored(whole_hosts.union(parts).union(single))


SHAPE = ("tags", "up", "node", "nth", "said", "size")


def aligned(pages: DataFrame) -> DataFrame:
    """(id, host, group, body, slot, mine, said, same, weight): per page and reference, the reference's blocks of content whose node was matched.

    `mine` is the page's block in the same place of the matched node, -1 without one, `same` whether it
    says the same. A row of slot -1 gives the length of the page's own content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple] = {}
        names = ["id", "host", "group", "body", "slot", "mine", "said", "same", "weight"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64()]
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                key = r["host"], r["group"]
                if key not in known:
                    if len(known) > 200:
                        known.clear()
                    known[key] = tree(r["ref_tags"], r["ref_up"])
                ref, page = known[key], tree(r["tags"], r["up"])
                head = r["id"], *key, r["body"]
                rows.append((*head, -1, -1, 0, False, sum(r["size"])))
                place = {id(n): i for i, n in enumerate(page)}
                partner = {id(x): place[id(y)] for x, y in matched(ref[0], page[0])}
                blocks = {(n, k): i for i, (n, k) in enumerate(zip(r["node"], r["nth"]))}
                holds = set(r["node"])
                for slot, (n, k, said, size) in enumerate(zip(r["ref_node"], r["ref_nth"], r["ref_said"], r["ref_size"])):
                    mate = partner.get(id(ref[n]))
                    if mate in holds:
                        mine = blocks.get((mate, k), -1)
                        rows.append((*head, slot, mine, said, mine >= 0 and r["said"][mine] == said, size))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names)

    return pages.mapInArrow(run, "id long, host string, group string, body long, slot int, mine int, said long, same boolean, weight long")


def template(pages: DataFrame) -> DataFrame:
    """(id, fixed): the numbers of a page's blocks that stand in a node matched to a constant one, and say what that says."""
    groups = grouped(pages)
    name = lambda upper, full: F.concat_ws(" ", F.coalesce(F.col(upper).cast("string"), F.lit("-")), F.coalesce(F.col(full).cast("string"), F.lit("-")))
    shapes = pages.select("host", "pick", *[F.col(c).alias(f"ref_{c}") for c in SHAPE])
    references = stored(groups.withColumn("group", name("upper", "full")).join(shapes, ["host", "pick"]).dropDuplicates(["host", "group"]).select("host", "group", *[f"ref_{c}" for c in SHAPE]))
    mine = F.array(F.lit("- -"), F.concat(F.col("upper").cast("string"), F.lit(" -")), name("upper", "full"))
    # A page goes on once for each of its groups that has a reference; on a host of one layout that is one.
    # References are few: each stands SALTS times, so that a host with very many pages is spread.
    held = references.groupBy("host").agg(F.collect_set("group").alias("held"))
    sided = pages.filter(F.size("node") > 0).select("id", "host", "body", *SHAPE, mine.alias("mine")).join(held, "host")
    sided = sided.select("id", "host", "body", *SHAPE, F.explode(F.array_intersect("mine", "held")).alias("group"), F.pmod("id", F.lit(SALTS)).alias("salt"))
    spread = references.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    nodes = stored(aligned(sided.join(spread, ["host", "group", "salt"]).drop("salt")))
    # Pages with equal content count once, so that copies of a page do not look like a template.
    once = nodes.groupBy("host", "group", "slot", "said", "weight", "body").agg(F.max("same").alias("same"))
    slots = once.groupBy("host", "group", "slot", "weight").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("same").cast("int")).alias("same"))
    constant = (F.col("slot") >= 0) & (F.col("n") >= LEAST_PAGES) & (F.col("same") >= F.col("n") * CONSTANT)
    by_group = slots.groupBy("host", "group").agg(
        F.collect_set(F.when(constant, F.col("slot"))).alias("slots"),
        F.sum(F.when(constant, F.col("weight") * F.col("same")).otherwise(0)).alias("fixed"),
        F.sum(F.when(F.col("slot") < 0, F.col("weight") * F.col("n")).otherwise(0)).alias("all"),
        F.sum(F.when(F.col("slot") < 0, F.col("n")).otherwise(0)).alias("bodies"),
    )
    most = F.least(F.lit(COPIES), 1 - F.lit(2.0) / F.col("bodies"))
    kept = by_group.filter((F.size("slots") > 0) & (F.col("fixed") <= F.col("all") * most)).select("host", "group", F.explode("slots").alias("slot"))
    return nodes.filter("same").join(kept, ["host", "group", "slot"]).groupBy("id").agg(F.collect_set("mine").alias("fixed"))


def main_text(pages: DataFrame, html: str = "html", url: str = "url", text: str = "text", induce: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Add the main text of every page; all other columns stay (or those in `keep`), an existing column of that name is replaced.

    Character references are decoded, white space inside a block becomes one blank, blocks are joined
    in page order by a line feed. A NULL, empty or textless page gives ''. Pages with a NULL url share
    the host ''. Repeated rows count each, equal contents of a group as one page; of references that
    tie, the smallest hash is taken. An empty table stays empty, and columns may have any names.
    Without `induce` only what the elements call themselves decides.
    """
    carried = [c for c in (keep or pages.columns) if c != text]
    slim = pages.select(F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row"), host_of(F.col(f"`{url}`")).alias("host"), whole(F.col(f"`{html}`")).alias("html"), F.xxhash64(whole(F.col(f"`{url}`")), whole(F.col(f"`{html}`"))).alias("pick"))
    read = parsed(slim)
    fixed = stored(template(read)) if induce else None
    if fixed is not None and not fixed.isEmpty():  # texts only meet what is taken out of them where there is any
        read = read.select("id", "row", "texts").join(fixed, "id", "left")
        said = F.filter("texts", lambda x, i: ~F.array_contains(F.coalesce("fixed", F.array().cast("array<int>")), i))
    else:
        said = F.col("texts")
    return read.select(*(F.col(f"row.`{c}`").alias(c) for c in carried), F.array_join(said, "\n").alias(text))


def digest(pages: DataFrame) -> DataFrame:
    out = main_text(pages, keep=["page_id", "url"])
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
