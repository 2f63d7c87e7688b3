"""Main text of web pages through wrappers: union-free regular expressions inferred for each host.

A page is read as a stream of structural tags and texts. Streams of one host are aligned one after the other: a group
that follows itself becomes a repeated group, a group that only one side has an optional one, and text a slot. Each
slot of the finished wrapper is main text or not by what encloses it, and a page's texts are read off at the slots.

An <article> says what the main text is. Where a page has none, the wrapper tells what belongs to the template of its
host: a text that stands in the same slot on most of the host's different pages is not this page's main text.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartspark.llm.common import CHUNK_BYTES, split_batches, stored
from cartspark.llm.url_filter import host_of

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset(
    "html head body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
# What is never main text, by element, by role, and by a word of class or id.
DROPPED = frozenset(
    "head nav header footer aside form menu dialog select button svg math canvas object audio video".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form toolbar".split()
)
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside header masthead footer notice notices cookie cookies consent "
    "alert popup modal overlay comment comments reply replies disqus respond share sharing social related recommended "
    "newsletter subscribe subscription signup login toolbar widget skip hidden".split()
)
# Words that may stand beside those in one name without changing what it is: post-comments, top-ad-2, cookie-bar.
NEUTRAL_WORDS = frozenset(
    "area article bar block bottom box container content global group holder inner item left links list main page panel "
    "post primary right secondary section site top wrap wrapper".split()
)
# Elements inside a line of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output picture progress q "
    "ruby s samp small span strike strong sub sup time tt u var".split()
)
# Elements that an open <p> ends at, and those that end an open one of their own kind.
CLOSES_P = BLOCKS - {"html", "head", "body", "option", "optgroup"}
SAME = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tr": ("td", "th", "tr"),
    "option": ("option",),
}
SCOPES = frozenset("ul ol dl table tr tbody thead tfoot select article section div body html".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
WORDS = re.compile(r"[a-z]+|\d+")
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}


def says_dropped(token: str) -> bool:
    """Whether a class or id names something that is no main text: all its words do, or are neutral (no-comments: no)."""
    words = WORDS.findall(token)
    return any(w in DROPPED_WORDS for w in words) and all(w in DROPPED_WORDS or w in NEUTRAL_WORDS or w.isdigit() for w in words)


@lru_cache(maxsize=4096)
def label_of(name: str, attrs: str) -> str:
    """The element's name; * for role=main. With ! before it, it holds no main text; with ~, its class or id says so."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attrs)} if attrs else {}
    if name in ("html", "body"):
        return name
    if name != "main" and (name in DROPPED or found.get("role") in DROPPED_ROLES or (attrs and HIDDEN.search(attrs))):
        return "!" + name
    main = name == "main" or found.get("role") == "main"
    if any(says_dropped(token) for token in f"{found.get('class', '')} {found.get('id', '')}".split()) and name != "main":
        return "~" + ("main" if main else name)
    return "main" if main else name


@dataclass
class Node:
    """An element of a page or wrapper. A child "#" is text; ``once`` and ``always`` make up the group's ?, + or *."""

    label: str
    children: list[Node] = field(default_factory=list)
    once: bool = True
    always: bool = True
    text: str = ""
    main: bool = False
    groups: dict[str, Node] = field(default_factory=dict)

    @property
    def sign(self) -> str:
        return {(True, True): "", (True, False): "?", (False, True): "+", (False, False): "*"}[self.once, self.always]

    def expression(self) -> str:
        """The wrapper as a regular expression over tags."""
        if self.label == "#":
            return "#" + self.sign
        if self.label[0] == "(":
            return f"({''.join(c.expression() for c in self.children)}){self.sign}"
        return f"(<{self.label}>{''.join(c.expression() for c in self.children)}</{self.label}>){self.sign}"

    def pack(self) -> list:
        return [self.label, int(self.once), int(self.always), [c.pack() for c in self.children]]

    @classmethod
    def unpack(cls, data: list) -> Node:
        return cls(data[0], [cls.unpack(c) for c in data[3]], bool(data[1]), bool(data[2]))


# Elements nested deeper than this are no nodes of their own: their texts are blocks of the node at this depth, and what
# is dropped among them is dropped. What class or id mark is a node down to one and a half times this depth, and an
# article or main element down to twice.
DEPTH = 200
REGIONS = ("article", "main")


def read_page(page: str) -> Node:
    """Blocks and their texts. Inline elements belong to the text; comments, scripts and styles vanish.

    What class or id mark as no main text is that, unless an article or main element stands in it. An article so marked
    counts only where a page has no other.
    """
    root = Node("page")
    # Name, node that takes the texts, and depth of that node.
    stack: list[tuple[str, Node, int]] = [("page", root, 0)]
    at, end, apart = 0, len(page), False

    def text(run: str) -> None:
        nonlocal apart
        if not run:
            return
        siblings = stack[-1][1].children
        if siblings and siblings[-1].label == "#" and not apart:
            siblings[-1].text += run
        elif not run.isspace():
            siblings.append(Node("#", text=run))
            apart = False

    def close(names: tuple[str, ...], scopes: frozenset = frozenset()) -> None:
        nonlocal apart
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                # Blocks that share a node are blocks all the same.
                deeper = zip(stack[i - 1 :], stack[i:])
                apart = apart or any(outer[2] == inner[2] and inner[0] in BLOCKS for outer, inner in deeper)
                del stack[i:]
                return
            if stack[i][0] in scopes:
                return

    while at < end:
        match = TOKEN.search(page, at)
        if not match:
            text(page[at:])
            break
        text(page[at : match.start()])
        at = match.end()
        name = (match["name"] or match["name2"] or "").lower()
        if not name:
            continue
        if match["close"] or match["close2"]:
            if name in BLOCKS or any(name == entry[0] for entry in stack[-8:]):
                close((name,))
            continue
        if name in RAW:
            stop = RAW_ENDS[name].search(page, at)
            at = stop.end() if stop else end
            continue
        if name == "br":
            text(" ")
            continue
        label = label_of(name, match["attrs"] or "")
        block = name in BLOCKS or label == "main"
        if not block and (label[0] not in "!~" or (label[0] == "~" and name not in INLINE)):
            continue
        if name in CLOSES_P:
            close(("p",), SCOPES)
        if name in SAME:
            close(SAME[name], SCOPES - set(SAME[name]))
        _, parent, depth = stack[-1]
        deepest = 2 * DEPTH if label in REGIONS else 3 * DEPTH // 2 if label[0] == "~" else DEPTH
        if not block or (depth >= DEPTH and label[0] == "!"):
            # Dropped inside a block's text, which goes on behind it, or too deep for a node.
            entry = (name, Node("!" + name), depth)
        elif depth >= deepest:
            apart = True
            entry = (name, parent, depth)
        else:
            node = Node(label)
            parent.children.append(node)
            entry = (name, node, depth + 1)
        if name not in VOID:
            stack.append(entry)
    settle(root)
    return root


def settle(root: Node) -> None:
    """Decide what class or id mark as no main text: it is that, unless what says main text stands in it."""
    found: set[str] = set()

    def collect(node: Node) -> None:
        found.add(node.label)
        for child in node.children:
            if child.label[0] != "!":
                collect(child)

    collect(root)
    wanted = {r for r in REGIONS if r in found} or {f"~{r}" for r in REGIONS}

    def decide(node: Node) -> bool:
        holds = node.label in wanted
        for child in node.children:
            holds = (child.label[0] != "!" and decide(child)) or holds
        if node.label[0] == "~":
            node.label = node.label[1:] if holds else "!" + node.label[1:]
        return holds

    decide(root)


def fold(children: list[Node]) -> list[Node]:
    """Neighbours of one label become one repeated group."""
    out: list[Node] = []
    for child in children:
        if out and out[-1].label == child.label:
            merged = align(out[-1], child)
            merged.once = False
            out[-1] = merged
        else:
            out.append(child)
    return out


# Longest group of neighbours, (h2 p), that is looked for as a repeated one.
TANDEM = 6


def fold_groups(children: list[Node]) -> list[Node]:
    """Neighbours that come again in the same order become one repeated group, whose label lists theirs."""
    out: list[Node] = []
    i = 0
    labels = [c.label for c in children]
    while i < len(children):
        for width in range(2, TANDEM + 1):
            unit, times = labels[i : i + width], 1
            while len(unit) == width and labels[i + times * width : i + (times + 1) * width] == unit:
                times += 1
            if times > 1:
                parts = [children[i + k * width : i + (k + 1) * width] for k in range(times)]
                joined = [reduce(align, same) for same in zip(*parts, strict=True)]
                out.append(Node(f"({' '.join(unit)})", joined, False))
                i += times * width
                break
        else:
            out.append(children[i])
            i += 1
    return out


def structure(node: Node) -> Node:
    """A page's stream as a first wrapper: groups folded, texts as slots, nothing below what holds no main text."""
    if node.label == "#" or node.label[0] == "!":
        return Node(node.label)
    return Node(node.label, fold_groups(fold([structure(c) for c in node.children])))


def align(a: Node, b: Node) -> Node:
    """The wrapper that fits what either of two wrappers of one label fits."""
    once, always = a.once and b.once, a.always and b.always
    return Node(a.label, align_all(a.children, b.children), once, always)


def optional(node: Node) -> Node:
    return Node(node.label, node.children, node.once, False)


def align_all(a: list[Node], b: list[Node]) -> list[Node]:
    """Align two streams on their longest common run of labels; what is between becomes optional."""
    if [x.label for x in a] == [x.label for x in b]:
        return [align(x, y) for x, y in zip(a, b, strict=True)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            same = a[i].label == b[j].label
            best[i][j] = best[i + 1][j + 1] + 1 if same else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i].label == b[j].label:
            out.append(align(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append(optional(a[i]))
            i += 1
        else:
            out.append(optional(b[j]))
            j += 1
    return fold_optional(out + [optional(x) for x in [*a[i:], *b[j:]]])


def fold_optional(children: list[Node]) -> list[Node]:
    """As fold; two optional groups of one label side by side are a repeated optional one."""
    out: list[Node] = []
    for child in children:
        if out and out[-1].label == child.label:
            always = out[-1].always or child.always
            out[-1] = align(out[-1], child)
            out[-1].once, out[-1].always = False, always
        else:
            out.append(child)
    return out


def region_of(node: Node) -> str:
    """What encloses main text in this wrapper or page: article, else main, else body, else the whole page."""
    labels = set()

    def walk(n: Node) -> None:
        labels.add(n.label)
        for child in n.children:
            walk(child)

    walk(node)
    return next((x for x in ("article", "main", "body") if x in labels), "page")


def mark(wrapper: Node) -> Node:
    """Say of every slot of a wrapper whether it is main text, and join a node's groups of one label for main_text."""
    region = region_of(wrapper)

    def walk(node: Node, inside: bool) -> None:
        inside = inside or node.label == region
        node.main = inside
        for child in node.children:
            if child.label[0] != "!":
                walk(child, inside)

    def members(part: Node) -> Iterator[Node]:
        for child in part.children:
            if child.label[0] == "(":
                yield from members(child)
            else:
                yield child

    def join(node: Node, parts: list[Node]) -> Node:
        together: dict[str, list[Node]] = {}
        for part in parts:
            for child in members(part):
                together.setdefault(child.label, []).append(child)
        node.groups = {label: join(Node(label, main=same[0].main), same) for label, same in together.items()}
        return node

    walk(wrapper, region == "page")
    return join(wrapper, [wrapper])


def fits(node: Node, pattern: Node) -> bool:
    """Whether a marked wrapper has a group for every element and text of a page outside of what is dropped."""
    return all(
        child.label in pattern.groups and (child.label[0] == "!" or fits(child, pattern.groups[child.label]))
        for child in node.children
    )


def slot_of(path: str, line: str) -> str:
    """A text in its place, as a key."""
    return hashlib.sha256(f"{path}\n{line}".encode("utf-8", "surrogatepass")).hexdigest()[:32]


def main_blocks(page: str, wrapper: Node | None = None) -> tuple[str, list[tuple[str, str]]]:
    """What encloses the main text, and the texts at the main slots: path of labels, and text.

    A page without the region that its host's wrapper has (an article, say) is a wrapper of its own, and so is one with
    an element that the wrapper does not have there. Groups of one label that others stand between are read as one: what
    is main text is the same in all of them.
    """
    root = read_page(page)
    own = region_of(root)
    if wrapper is None or region_of(wrapper) != own or not fits(root, wrapper):
        wrapper = mark(structure(root))
    blocks: list[tuple[str, str]] = []

    def walk(node: Node, pattern: Node, path: str) -> None:
        for child in node.children:
            group = pattern.groups[child.label]
            if child.label[0] == "!":
                continue
            if child.label != "#":
                walk(child, group, f"{path}/{child.label}")
            elif group.main and (line := " ".join(html.unescape(child.text).split())):
                blocks.append((path, line))

    walk(root, wrapper, "")
    return own, blocks


def main_text(page: str, wrapper: Node | None = None, template: frozenset[str] = frozenset()) -> str:
    """A page's texts at the main slots of its host's wrapper, blocks joined by line ends.

    In a page without an article, texts of the host's template are left out; if nothing else is there, they stay.
    """
    region, blocks = main_blocks(page, wrapper)
    if template and region != "article":
        blocks = [b for b in blocks if slot_of(*b) not in template] or blocks
    return "\n".join(line for _, line in blocks)


# A text belongs to a template if so many different pages of its host have it in one place, and more than half of them.
TEMPLATE_PAGES = 3


def find_templates(pages: DataFrame) -> DataFrame:
    """host and template: the texts, in their places, that most different pages of a host without an article share.

    A host has at most twice as many of them as a page has blocks. Equal pages count as one.
    """

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_batches(batches, "html", 4 * CHUNK_BYTES):
            out: set[tuple[str, str, str]] = set()
            for host, page in zip(batch.column("host"), batch.column("html"), strict=True):
                region, blocks = main_blocks(page.as_py() or "")
                if region == "article" or not blocks:
                    continue
                keys = [slot_of(*b) for b in blocks]
                digest = slot_of("", " ".join(keys))
                # The empty slot counts the pages themselves.
                out |= {(host.as_py(), digest, key) for key in ["", *keys]}
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["host", "page", "slot"])

    # Most pages say what their article is; they are not parsed here.
    others = pages.where(~F.coalesce(F.col("html").rlike("(?i)<article"), F.lit(False))).select("host", "html")
    found = others.mapInArrow(slots, "host string, page string, slot string").distinct()
    counted = found.groupBy("host", "slot").agg(F.count(F.lit(1)).alias("n"))
    hosts = counted.where("slot = ''").select("host", F.col("n").alias("pages")).where(F.col("pages") >= TEMPLATE_PAGES)
    shared = counted.where((F.col("slot") != "") & (F.col("n") >= TEMPLATE_PAGES)).join(hosts, "host")
    return shared.where(F.col("n") * 2 > F.col("pages")).groupBy("host").agg(F.collect_list("slot").alias("template"))


@lru_cache(maxsize=1000)
def wrapper_of(data: str) -> Node:
    return mark(Node.unpack(json.loads(data)))


# Hosts whose wrappers a task holds before it hands them on.
OPEN_HOSTS = 500


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """One row per host of ``pages`` (host, html): host, wrapper (JSON) and expression, from all of its pages.

    Every task aligns what it reads of a host to one wrapper, so that a host of a third of all pages sends one small row
    a task; these are then aligned with each other.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Node] = {}
        seen: set[tuple[str, str]] = set()
        for batch in split_batches(batches, "html", 4 * CHUNK_BYTES):
            for host, page in zip(batch.column("host"), batch.column("html"), strict=True):
                host, own = host.as_py(), structure(read_page(page.as_py() or ""))
                key = (host, json.dumps(own.pack()))
                if key in seen:
                    continue
                seen.add(key)
                found[host] = align(found[host], own) if host in found else own
                if len(found) > OPEN_HOSTS or len(seen) > 20 * OPEN_HOSTS:
                    yield packed(found)
                    found, seen = {}, set()
        if found:
            yield packed(found)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, wrapper = None, None
        for batch in batches:
            for host, data in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                own = Node.unpack(json.loads(data))
                if host == current and wrapper is not None:
                    wrapper = align(wrapper, own)
                    continue
                if wrapper is not None:
                    yield packed({current: wrapper})
                current, wrapper = host, own
        if wrapper is not None:
            yield packed({current: wrapper})

    def packed(found: dict[str, Node]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(found), pa.string()),
                pa.array([json.dumps(n.pack()) for n in found.values()], pa.string()),
                pa.array([n.expression() for n in found.values()], pa.string()),
            ],
            names=["host", "wrapper", "expression"],
        )

    schema = "host string, wrapper string, expression string"
    partial = pages.select("host", "html").mapInArrow(first, schema)
    return (
        partial.select("host", "wrapper").distinct().repartition("host").sortWithinPartitions("host", "wrapper")
        .mapInArrow(second, schema)
    )


def extract_text(pages: DataFrame, wrappers: DataFrame | None = None) -> DataFrame:
    """Adds ``text`` (main text, empty if none) to page_id, url and html of every row.

    Without ``wrappers`` they and the templates of hosts (at least three different pages) are inferred from these pages. A null html is an empty page; a null url, or one without
    ://, belongs to the host named by the empty string; a page of a host without wrapper is judged by itself. White space
    inside a block is one space; blocks are joined by one line end. Repeated rows stay. Extra columns are not read.
    """
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    if wrappers is None:
        inferred = stored(infer_wrappers(rows), "wrappers")
        # One small row a host; from a table of known size Spark joins it without moving pages, if it is small enough.
        wrappers = stored(inferred.join(find_templates(rows), "host", "left"), "wrappers")
    if "template" not in wrappers.columns:
        wrappers = wrappers.withColumn("template", F.lit(None).cast("array<string>"))
    joined = rows.join(wrappers.select("host", "wrapper", "template"), "host", "left").select(
        "page_id", "url", "html", "wrapper", "template"
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_batches(batches, "html", 4 * CHUNK_BYTES):
            texts = []
            for page, data, template in zip(*(batch.column(c) for c in ("html", "wrapper", "template")), strict=True):
                wrapper = wrapper_of(data.as_py()) if data.is_valid else None
                texts.append(main_text(page.as_py() or "", wrapper, frozenset(template.as_py() or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    id_type = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(extract, f"page_id {id_type}, url string, text string")
