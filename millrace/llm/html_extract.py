"""Main text of web pages by tag-path ratios.

A page is read once into text leaves, each with its path of tags from the root, the element that holds it and the block
it belongs to. For every path the text length outside links and the punctuation are summed and divided by the number
of its leaves; the two ratios are smoothed over the page's sequence of leaves with a Gaussian, fused by their product
and the path's share of text outside links, and paths whose mean reaches `spread` times the mean of all leaves are
content paths. The smallest container that holds at least `share` of the content paths' text is the article, or the
`article` or `main` element around it; without such an element, blocks around it stay only on paths that reach the mean
without their neighbours' help. In it stay the blocks on content paths; headings that a block stays under; blocks
that aren't mostly links, if a content block shares their container or the article is marked; and a block of nothing but
a link between two content blocks. In a marked article also headings without anything under them and single blocks of
links stay; lists of links and their headings go. Boilerplate by tag or attributes is vetoed and never counts, nor does
a line of copyright outside a marked article.

Tags are kept as numbered paths and elements with links to their parents, so time and memory are linear in the page,
however deeply it is nested.

Defined results: a null or empty page, and one without text, gives an empty text with n_chars 0; unclosed and
misnested tags are closed as browsers close them as far as blocks go; a tag cut off at the end of the page is
no text; a quote in a tag counts only behind "=" and if it is closed; a button, svg or the like without its end tag ends
at the next block or where an element around it ends; repeated rows are extracted one by one; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_batches

#: Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("head title script style noscript template iframe object svg math canvas audio video select button textarea".split())
BOILER = frozenset("nav header footer aside form dialog menu".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset(["", *"article aside body center details div fieldset figure form html main section td".split()])
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot html body legend summary".split())
#: Words in class, id or role attributes of boilerplate, whatever stands beside them, and words that are so unless the element names itself content.
NOISE = re.compile(r"(?:^|[_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|popup|modal|overlay|comments?|disqus|replies|respond|feedback|(?:user|reader|visitor|guest|community)s?[_-](?:discussions?|responses?|opinions?|reviews?)|discussion-?(?:board|thread|list)|sidebar|side-bar|widgets?|menus?|nav\w*|breadcrumbs?|footer|masthead|site-header|page-header|toolbar|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search|pagination|pager|complementary|contentinfo|dialog)(?=$|[_-]|\d)", re.I)
WEAK = re.compile(r"(?:^|[_-])(?:header|tags?|alerts?)(?=$|[_-]|\d)", re.I)
OWN = re.compile(r"(?:^|[_-])(?:article|content|main|post|story|entry|body)(?=$|[_-])", re.I)
#: A line that says whose rights a page is under.
COPYRIGHT = re.compile(r"\s*(?:©|&copy;|\(c\)\s|copyright\b)[^\n]{0,200}\Z", re.I)
#: Words that say how a container is laid out, not what it is.
LAYOUT = re.compile(r"(?:^|[_-])(?:has|no|with|without)[_-]", re.I)
TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)|[^>])*+)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none""", re.I)
ITEMS = frozenset(("li", "dt", "dd", "td", "th"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
HEAD_END = re.compile(r"</head\s*>|<body[\s>]", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…、。¿¡，？！]")
#: What an opening tag ends (the nearest such element), and where the search for it stops.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",))}
#: The tags that end a raw element.
RAW_END = {tag: re.compile(rf"</{tag}\s*>|\Z", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
#: Other elements whose content is skipped.
PAIRED = SKIP - frozenset(RAW_END) - {"head"}
ANY_PAIRED = re.compile(rf"<(?:{'|'.join(sorted(PAIRED))})(?=[\s/>])", re.I)


class Leaf:
    """A piece of text: the element it lies in, its path, its block."""

    __slots__ = ("block", "node", "path", "text")

    def __init__(self, text: str, node: int, path: int, block: int):
        self.text, self.node, self.path, self.block = text, node, path, block


class Page:
    """Elements by number, each with its parent; element 0 is the page itself."""

    def __init__(self) -> None:
        self.tag, self.parent, self.boiler, self.path, self.link, self.heading, self.inside, self.item = [""], [0], [False], [0], [False], [0], [False], [False]
        self.paths: dict[tuple[int, str], int] = {(0, ""): 0}
        self.leaves: list[Leaf] = []

    def add(self, tag: str, parent: int, boiler: bool) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.boiler.append(boiler or self.boiler[parent])
        self.path.append(self.paths.setdefault((self.path[parent], tag), len(self.paths)))
        self.link.append(tag == "a" or self.link[parent])
        self.heading.append(int(tag[1]) if tag in HEADINGS else self.heading[parent])
        self.inside.append(tag in ("article", "main") or self.inside[parent])
        self.item.append(tag in ITEMS or self.item[parent])
        return len(self.tag) - 1


def is_boiler(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in BOILER and not (tag == "header" and inside_article):
        return True
    if not attributes:
        return False
    if HIDDEN.search(attributes):
        return True
    if tag in ("article", "main", "body", "html"):
        return False
    names = [x for value in ATTRIBUTE.findall(attributes) for x in value.strip("\"'").split() if not LAYOUT.search(x)]
    return any(NOISE.search(x) for x in names) or (any(WEAK.search(x) for x in names) and not any(OWN.search(x) for x in names))


class Open:
    """The open elements, with the places of each tag, so that looking one up doesn't walk the stack."""

    def __init__(self) -> None:
        self.items: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str, value: int) -> None:
        self.places.setdefault(tag, []).append(len(self.items))
        self.items.append((tag, value))

    def last(self, *tags: str) -> int:
        """Where the innermost open element with one of these tags is, or -1."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def first(self, tags: Iterable[str]) -> int:
        return min((p[0] for t in tags if (p := self.places.get(t))), default=-1)

    def cut(self, to: int) -> list[str]:
        """Close all from `to` on."""
        tags = [x[0] for x in self.items[to:]]
        for t in tags:
            self.places[t].pop()
        del self.items[to:]
        return tags


def paired_ends(page: str) -> dict[int, int]:
    """Where the outermost skipped elements end, by the place behind their opening tag; those without an end tag of their own are left out."""
    ends: dict[int, int] = {}
    at, stack = 0, Open()
    if not ANY_PAIRED.search(page):
        return ends
    while (start := page.find("<", at)) >= 0:
        m = TOKEN.match(page, start)
        at = m.end() if m else start + 1
        tag = m[2].lower() if m and m[2] else None
        if tag is None or tag in VOID:
            continue
        if m[1]:
            to = stack.last(tag)
            if to >= 0:
                if tag in PAIRED:
                    ends[stack.items[to][1]] = at
                stack.cut(to)
        elif tag in RAW_END:
            at = RAW_END[tag].search(page, at).end()
        elif tag in PAIRED or tag in BLOCKS:
            if not (m[3].endswith("/") and tag in ("svg", "math")):
                stack.push(tag, at)
    return ends


def parsed(text: str) -> Page:
    """The page's elements and its text leaves in order."""
    page, stack, at, block, head = Page(), Open(), 0, 0, False

    def top() -> int:
        return stack.items[-1][1] if stack.items else 0

    def close(to: int) -> None:
        nonlocal block
        if any(t in BLOCKS for t in stack.cut(to)):
            block += 1

    def leaf(piece: str) -> None:
        if piece:
            page.leaves.append(Leaf(piece, top(), page.path[top()], block))

    ends = paired_ends(text)
    while at < len(text):
        start = text.find("<", at)
        if start < 0:
            leaf(text[at:])
            break
        m = TOKEN.match(text, start)
        if m is None:  # a bare "<"
            leaf(text[at : start + 1])
            at = start + 1
            continue
        leaf(text[at:start])
        at = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            continue
        if m[4] != ">":  # cut off
            break
        if m[1]:
            to = stack.last(tag)
            if to >= 0:
                close(to)
            elif tag == "p":
                block += 1
            continue
        if tag == "br":
            leaf("\n")
            continue
        if tag in BLOCKS and (to := stack.first(PAIRED)) >= 0:
            close(to)
        if tag in CLOSES_P and (to := stack.last("p")) >= 0:
            close(to)
        if tag in ENDS:
            closed, bounds = ENDS[tag]
            if (to := stack.last(*closed)) > stack.last(*bounds):
                close(to)
        if tag in BLOCKS:
            block += 1
        if tag in VOID or m[3].endswith("/") and tag in ("svg", "math", "path"):
            continue
        if tag in RAW_END:
            at = RAW_END[tag].search(text, at).end()
            continue
        if tag == "head":
            if not head and (m := HEAD_END.search(text, at)):
                at = m.start() if m[0].lower().startswith("<body") else m.end()
            head = True
            continue
        if at in ends:
            at = ends[at]
            continue
        stack.push(tag, page.add(tag, top(), tag in PAIRED or is_boiler(tag, m[3], page.inside[top()])))
    return page


def smoothed(values: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over the sequence, window two standard deviations to each side."""
    if len(values) < 3:
        return values
    kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    return np.convolve(np.concatenate((values[[0, 0]], values, values[[-1, -1]])), kernel / kernel.sum(), mode="valid")


def fused_ratios(leaves: list[Leaf], in_link: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each leaf's path, and each path's fused ratio, smoothed and not: length and punctuation a leaf, times the share outside links."""
    names: dict[int, int] = {}
    path = np.array([names.setdefault(x.path, len(names)) for x in leaves])
    count = np.bincount(path)
    sizes = np.array([len(x.text.strip()) for x in leaves], float)
    plain = np.bincount(path, weights=sizes * ~in_link)
    marks = np.bincount(path, weights=[len(PUNCTUATION.findall(x.text)) for x in leaves]) / count
    fused = smoothed((plain / count)[path]) * (1 + smoothed(marks[path]))
    outside = plain / np.maximum(np.bincount(path, weights=sizes), 1)
    return path, np.bincount(path, weights=fused) / count * outside, plain / count * (1 + marks) * outside


def content_paths(leaves: list[Leaf], in_link: np.ndarray, usable: np.ndarray, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether each leaf lies on a content path, and whether it would without its neighbours; a path with the highest ratio always is one."""
    path, ratio, own = fused_ratios(leaves, in_link)
    threshold = min(ratio[path].mean() * spread, ratio[path[usable]].max())
    content = usable & (ratio[path] >= threshold)
    return content, content & (own[path] >= threshold)


def extract(html: str | None, share: float = 0.9, spread: float = 0.1) -> str:
    """The main text of one page: blocks joined by two line feeds."""
    page = parsed(html or "")
    leaves = [x for x in page.leaves if x.text.strip()]
    usable = np.array([not page.boiler[x.node] and not (not page.inside[x.node] and COPYRIGHT.match(x.text)) for x in leaves], bool)
    if not usable.any():
        return ""
    in_link = np.array([page.link[x.node] for x in leaves], bool)
    content, alone = content_paths(leaves, in_link, usable, spread)
    # Text on content paths below every element; parents have smaller numbers than what they hold.
    weight, holder = [0] * len(page.tag), [0] * len(page.tag)
    for x, c in zip(leaves, content, strict=True):
        weight[x.node] += len(x.text) if c else 0
    for n in range(len(page.tag) - 1, 0, -1):
        weight[page.parent[n]] += weight[n]
    for n in range(1, len(page.tag)):
        holder[n] = n if page.tag[n] in CONTAINERS else holder[page.parent[n]]
    deepest = max(n for n in range(len(page.tag)) if page.tag[n] in CONTAINERS and weight[n] >= share * weight[0])
    # From there up to the article, else as far as below the body.
    above = [deepest]
    while above[-1]:
        above.append(page.parent[above[-1]])
    marked = [n for n in above if page.tag[n] in ("article", "main")]
    inner = [n for n in above if n and page.tag[n] not in ("html", "body")]
    root = marked[-1] if marked else inner[-1] if inner else deepest
    below, within = ([n == top for n in range(len(page.tag))] for top in (root, root if marked else deepest))
    for n in range(1, len(page.tag)):
        below[n] = below[n] or below[page.parent[n]]
        within[n] = within[n] or within[page.parent[n]]
    blocks: dict[int, list[int]] = {}
    for k, x in enumerate(leaves):
        if usable[k] and below[x.node]:
            blocks.setdefault(x.block, []).append(k)
    order = list(blocks.values())
    chosen = [bool((content if within[leaves[ks[0]].node] else alone)[ks].any()) for ks in order]
    homes = {holder[leaves[k].node] for ks, c in zip(order, chosen, strict=True) if c for k in ks if content[k]}
    level = [page.heading[leaves[ks[0]].node] for ks in order]
    size = lambda ks: sum(len(leaves[k].text.strip()) for k in ks)
    linked = [2 * size([k for k in ks if in_link[k]]) > size(ks) for ks in order]
    stays = [c and not h or not c and not h and not n and (bool(marked) or holder[leaves[ks[0]].node] in homes) for ks, c, h, n in zip(order, chosen, level, linked, strict=True)]
    for i in range(1, len(order) - 1):
        stays[i] = stays[i] or linked[i] and not level[i] and chosen[i - 1] and chosen[i + 1]
    if marked:  # a link by itself is text; links beside each other or in a list are a list of links
        for i, ks in enumerate(order):
            alone_ = not any(linked[max(0, i - 1) : i] + linked[i + 1 : i + 2])
            stays[i] = stays[i] or linked[i] and not level[i] and alone_ and not page.item[leaves[ks[0]].node]
    if not any(stays):
        stays = chosen
    # What a heading of each level has under it, up to the next of its level or above: anything, and anything that stays.
    held, kept_under = [False] * 7, [False] * 7
    for i in range(len(order) - 1, -1, -1):
        own_level = level[i]
        if own_level:
            stays[i] = stays[i] or kept_under[own_level] or bool(marked) and not held[own_level]
            held[own_level:], kept_under[own_level:] = [False] * (7 - own_level), [False] * (7 - own_level)
        for above_ in range(1, own_level or 7):
            held[above_], kept_under[above_] = True, kept_under[above_] or stays[i]
    kept = {leaves[ks[0]].block for ks, s in zip(order, stays, strict=True) if s}
    texts: dict[int, list[str]] = {b: [] for b in sorted(kept)}
    for x in page.leaves:
        if x.block in kept and below[x.node] and not page.boiler[x.node]:
            texts[x.block].append(x.text)
    return "\n\n".join(t for parts in texts.values() if (t := " ".join(unescape("".join(parts)).split())))


def extract_pages(pages: DataFrame, html_col: str = "html", id_cols: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(id columns, text, n_chars), one row per page."""
    text_batches(pages.sparkSession)
    slim = pages.select(*id_cols, F.col(html_col).alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*id_cols).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(len(id_cols))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=[*id_cols, "text", "n_chars"])

    return slim.mapInArrow(run, f"{schema}, text string, n_chars bigint")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
