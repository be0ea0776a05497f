"""Main text of pages by wrapper induction.

* *Trees.* Each page is parsed to a tree of its block elements, with a leaf for every run
  of text.  A node's label is its tag with its classes and id.  Neighbouring siblings of
  one label are merged, so lists and paragraphs of any number have one shape.
  So are the children of one label of a node with more than ``WIDEST`` groups of them.
* *Alignment.* The shapes of a host's pages are aligned by simple tree matching (the
  largest order-preserving match of nodes with equal labels below equal labels) and
  folded into a wrapper that has every node of every shape once.  Shapes are counted
  first, so a host's pages meet as a few shapes; these are folded in groups of about
  ``FOLD_SHAPES``, then the groups' wrappers likewise, until a host has one.
* *Template and slots.* Texts are counted for each wrapper node over all pages of the
  host.  A node where most pages have the same text is template; a node whose texts vary
  is a slot, and its texts are content.
  Of two to four different pages all must have it, and if such texts are the larger part
  of these pages, they are versions of one page rather than pages of one template.  A
  single page has no template.
* *Regions.* Varying text is still no content in menus, adverts and the like, which vary
  from page to page too.  The wrapper's nodes tell by what all pages have in them, summed
  along the alignment: an element on half the pages with more text in links than beside is
  a menu; one with bare text, a tenth of what the main block beside it has, is a slot for
  adverts; one with a good share of the text is content, whatever its name.  Elements,
  roles, and classes and ids that name a region as a whole (``related-posts``) are regions
  on all hosts; other names with such a word (``social-sciences``) are up to the wrapper.
  On hosts of fewer than ``FEW_PAGES`` pages the page's own sums decide of these.
* *Articles.* Inside an article only a name as a whole counts; inline elements of an article
  and of code stay unless they name an advert.  If a page has an article or main element with text
  outside regions, its content lies there, unless it is a teaser beside a far longer text.

The second scan needs only the constant texts and judged paths of each host (hashes, at
most a few for every leaf of a usual page), which Spark joins as their size demands.

Rows: a null page or one without content has an empty text; a null or unreadable url has
no host, and such pages share no template; repeated rows and ids are extracted each, but
pages of a host with the same texts outside the regions above count as one for its
template; an empty table gives no rows; other columns are not read.  Below ``DEEPEST`` elements are followed, but their texts have the place of texts of
the element at that depth.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from html.parser import HTMLParser
from itertools import accumulate
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import small_batches, text_slices
from mailspark.sources.scratch import written

#: A text is template where this share of a host's pages have it at the same node; within
#: an article the second share.
TEMPLATE_SHARE = 0.5
ARTICLE_SHARE = 0.9
#: On hosts with fewer different pages a template text is on all of them.
FEW_PAGES = 5
#: A doubtful name's element is content with so many letters on a page outside links, and
#: such a share of the page's.
CONTENT_CHARS = 200
CONTENT_SHARE = 0.2
#: The main block of a page has this share of its text, a slot beside it at most the other.
MAIN_SHARE = 0.7
SLOT_SHARE = 0.1
#: An article is a teaser if the text outside is so many times as long.
TEASER = 4
DEEPEST = 60
#: A node with more groups of children is a flow, as the body of a long article: its
#: children of one label are one node of the shape.
WIDEST = 256
FOLD_SHAPES = 64

# Elements by what they are for.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li "
    "legend main menu nav ol p pre search section summary table tbody td tfoot th thead "
    "tr ul".split()
)
SILENT = frozenset(
    "annotation annotation-xml audio button canvas datalist embed head iframe input link map meta meter "
    "noembed noframes noscript object option optgroup output progress script select style "
    "svg template textarea title video".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
ASIDE = frozenset("aside dialog footer form header menu nav search".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar "
    "navigation search tablist toolbar".split()
)
NAMES = frozenset(
    "ad ads adbox adsense advert advertisement advertising adverts alert banner breadcrumb "
    "breadcrumbs comment comments commentlist consent cookie cookies copyright "
    "disclaimer disqus footer form gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promoted promotion recommended related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split()
)
#: Words that go with these in a name of such a region.
BOXES = frozenset(
    "area bar block box button buttons container form icons inner item items links list "
    "content module panel policy posts reader readers section slot thread unit user users wrap "
    "wrapper".split()
)
#: Words that tell whose region it is, outside an article.
PLACES = frozenset(
    "article blog bottom global left local main page post primary right secondary site top".split()
)
ADVERTS = frozenset("ad ads adbox adsense advert advertisement advertising adverts sponsored".split())
#: Blocks of running text; others hold them.
FLOWS = frozenset("address blockquote dd dt figure h1 h2 h3 h4 h5 h6 hgroup li p pre".split())
#: Words by which a name tells a title, or a state of what it stands at.
TITLES = frozenset("article entry post section story title".split())
STATES = frozenset(
    "accepted active closed disabled enabled has is no off on open ready with without".split()
)
#: Opening one of these closes an open element of the second set.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tfoot", "tr", "td", "th"},
    "thead": {"thead", "tbody", "tfoot", "tr", "td", "th"},
}
#: What an implied end tag doesn't reach beyond.
WALLS = frozenset("article aside body div html main nav ol section table ul dl".split())
TEXT = "#text"
PARTS = re.compile(r"[a-z]+")
UNENDED = re.compile(r"<[a-zA-Z/!?]")


class Node:
    """An element or a run of text; ``links`` of its letters are in links, and ``doubt`` has
    the depths of the elements above whose names leave open what they are."""

    __slots__ = ("tag", "label", "children", "text", "dropped", "article", "links", "doubt")

    def __init__(
        self,
        tag: str,
        label: str,
        dropped: bool,
        article: bool,
        text: str = "",
        links: int = 0,
        doubt: tuple[int, ...] = (),
    ):
        self.tag, self.label, self.text = tag, label, text
        self.children: list[Node] = []
        self.dropped, self.article = dropped, article
        self.links, self.doubt = links, doubt


def _names(attrs: dict) -> list[str]:
    return sorted({*(attrs.get("class") or "").lower().split(), (attrs.get("id") or "").lower()})


def _aside(tag: str, attrs: dict, names: list[str], in_article: bool) -> bool:
    """An element that is a region wherever it stands."""
    if tag in ASIDE and not (tag == "header" and in_article):
        return True
    if "hidden" in attrs or (attrs.get("role") or "").lower() in ROLES:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    if in_article and tag not in BLOCKS:
        return False
    places = tag in BLOCKS and not in_article
    return any(_is_region(n, places) for n in names)


def _doubtful(tag: str, names: list[str], in_article: bool) -> bool:
    """A block whose name has the word of a region, but tells something else too."""
    if in_article or tag in ("html", "body", "article", "main"):
        return False
    return any(map(_names_region, names))


@lru_cache(maxsize=1 << 14)
def _names_region(name: str) -> bool:
    """A class or id with the word of a region."""
    words = set(PARTS.findall(name))
    if not STATES.isdisjoint(words):
        return False
    return not (words & NAMES).issubset({"header"} if words & TITLES else ())


@lru_cache(maxsize=1 << 14)
def _is_region(name: str, places: bool = False) -> bool:
    """A class or id that names a region as a whole; a header has to be one outside."""
    words = set(PARTS.findall(name))
    if "header" in words or words.isdisjoint(NAMES) or not STATES.isdisjoint(words):
        return False
    return words <= (NAMES | BOXES | PLACES if places else NAMES | BOXES)


def _is_advert(name: str) -> bool:
    words = set(PARTS.findall(name))
    return not words.isdisjoint(ADVERTS) and words <= ADVERTS | BOXES


class TreeBuilder(HTMLParser):
    """Block elements and runs of text of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", "#page", False, False)
        self.open: list[Node] = [self.root]
        # Where in ``open`` the elements of each tag are, and the walls.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.walls: list[int] = []
        self.silent: list[str] = []
        self.run: list[str] = []
        self.hushed: list[str] = []
        self.code = 0
        # How many elements were open where the open link began, and its letters.
        self.link = self.linked = 0

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        links, self.linked, self.run = min(self.linked, len(text)), 0, []
        if text:
            at = self.open[-1]
            parent = self.open[min(len(self.open), DEEPEST) - 1]
            parent.children.append(Node(TEXT, TEXT, at.dropped, at.article, text, links, at.doubt))

    def handle_starttag(self, tag, attrs):
        if self.silent:
            if tag not in VOID:
                self.silent.append(tag)
            return
        if tag in SILENT:
            if tag not in VOID:
                self.silent.append(tag)
            return
        found = dict(attrs)
        names = _names(found) if found else []
        at = self.open[-1]
        if tag not in BLOCKS:
            if tag == "br":
                self.run.append(" ")
            elif tag not in VOID:
                in_code = self.code or self.places["pre"]
                aside = found and _aside(tag, found, names, at.article or in_code)
                if self.hushed or aside or not in_code and any(map(_is_advert, names)):
                    self.hushed.append(tag)
                elif tag == "a":
                    self.link = len(self.open) if found.get("href") is not None else 0
                elif tag == "code":
                    self.code += 1
            return
        self.hushed.clear()
        self.flush()
        if tag != "p" and tag in CLOSES:
            self.imply(CLOSES[tag])
        elif self.open[-1].tag == "p":
            self.shut(len(self.open) - 1)
        at = self.open[-1]
        label = ".".join([tag, *(re.sub(r"\d+", "", n) for n in names if n)])
        article = at.article or tag in ("article", "main") or found.get("role") == "main"
        dropped = at.dropped or _aside(tag, found, names, at.article)
        doubt = at.doubt
        if not dropped and _doubtful(tag, names, at.article):
            # What is deeper than the tree has no place of its own to be judged at.
            dropped = len(self.open) >= DEEPEST
            doubt = (*doubt, len(self.open))
        node = Node(tag, label, dropped, article, doubt=doubt)
        if len(self.open) < DEEPEST:
            at.children.append(node)
        if tag not in VOID:
            self.places[tag].append(len(self.open))
            if tag in WALLS:
                self.walls.append(len(self.open))
            self.open.append(node)

    def imply(self, tags: set[str]) -> None:
        at = max((self.places[t][-1] for t in tags if self.places[t]), default=0)
        if at > (self.walls[-1] if self.walls else 0):
            self.shut(at)

    def shut(self, at: int) -> None:
        """Close the open elements from that place on."""
        for node in reversed(self.open[at:]):
            self.places[node.tag].pop()
            if node.tag in WALLS:
                self.walls.pop()
        del self.open[at:]
        if self.link > at:
            self.link = 0

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.silent:
            if tag in self.silent:
                del self.silent[len(self.silent) - 1 - self.silent[::-1].index(tag) :]
            return
        if tag not in BLOCKS:
            if tag in self.hushed:
                del self.hushed[len(self.hushed) - 1 - self.hushed[::-1].index(tag) :]
            elif tag == "code" and self.code:
                self.code -= 1
            elif tag == "a":
                self.link = 0
            return
        self.hushed.clear()
        self.flush()
        if self.places[tag]:
            self.shut(self.places[tag][-1])

    def handle_data(self, data):
        if not self.silent and not self.hushed:
            self.run.append(data)
            if self.link:
                self.linked += len(data.strip())


def parse(html: str) -> Node:
    """The tree of a page; a comment or tag that never ends is no text."""
    builder = TreeBuilder()
    builder.feed(html)
    if not builder.silent and UNENDED.match(builder.rawdata):
        builder.rawdata = ""
    builder.close()
    builder.flush()
    return builder.root


# A shape is (label, shapes of the children).


@lru_cache(maxsize=1 << 14)
def matched(a: tuple, b: tuple) -> int:
    """Simple tree matching: nodes in the largest order-preserving match of two shapes."""
    if a[0] != b[0]:
        return 0
    if a == b:
        return size_of(a)
    return 1 + sum(matched(a[1][i], b[1][j]) for i, j in pairs(a[1], b[1]))


@lru_cache(maxsize=1 << 14)
def size_of(shape: tuple) -> int:
    return 1 + sum(map(size_of, shape[1]))


@lru_cache(maxsize=1 << 8)
def pairs(a: tuple, b: tuple) -> tuple[tuple[int, int], ...]:
    """Places of the children that are matched: the heaviest common subsequence.

    Equal heads and tails match.  Between them only children of one label are looked at,
    and a tree of maxima over the places in ``b`` gives the best chain before each.
    """
    head, least = 0, min(len(a), len(b))
    while head < least and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < least - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    places: dict[str, list[int]] = defaultdict(list)
    for j in range(head, len(b) - tail):
        places[b[j][0]].append(j)
    width = len(b) - tail - head
    best: list[tuple[int, int]] = [(0, -1)] * (width + 1)
    links: list[tuple[int, int, int]] = []
    for i in range(head, len(a) - tail):
        # From the right, so that a child is matched once.
        for j in reversed(places.get(a[i][0], ())):
            k, top = j - head, (0, -1)
            while k:
                top = max(top, best[k])
                k &= k - 1
            weight = top[0] + matched(a[i], b[j])
            links.append((i, j, top[1]))
            k = j - head + 1
            while k <= width:
                if best[k][0] < weight:
                    best[k] = (weight, len(links) - 1)
                k += k & -k
    k, last = width, (0, -1)
    while k:
        last = max(last, best[k])
        k &= k - 1
    middle, at = [], last[1]
    while at >= 0:
        i, j, at = links[at]
        middle.append((i, j))
    ends = [(len(a) - t, len(b) - t) for t in range(tail, 0, -1)]
    return (*((i, i) for i in range(head)), *middle[::-1], *ends)


def merged(a: tuple, b: tuple) -> tuple:
    """A shape with the nodes of both, matched ones once."""
    if a == b:
        return a
    children: list[tuple] = []
    done_a = done_b = 0
    for i, j in (*pairs(a[1], b[1]), (len(a[1]), len(b[1]))):
        children += b[1][done_b:j]
        children += a[1][done_a:i]
        if i < len(a[1]):
            children.append(merged(a[1][i], b[1][j]))
        done_a, done_b = i + 1, j + 1
    return a[0], tuple(_joined(children))


def _joined(children: list[tuple]) -> list[tuple]:
    """Neighbours of one label merged; of a flow, all children of one label."""
    groups: list[dict[tuple, None]] = []
    labels: list[str] = []
    for child in children:
        if not labels or labels[-1] != child[0]:
            labels.append(child[0])
            groups.append({})
        groups[-1][child] = None
    if len(groups) > WIDEST:
        flow: dict[str, dict[tuple, None]] = {}
        for label, group in zip(labels, groups):
            flow.setdefault(label, {}).update(group)
        groups = list(flow.values())
    return [reduce(merged, group) for group in groups]


def shape_of(node: Node, known: dict[int, tuple] | None = None) -> tuple:
    """The shape of a tree; ``known`` takes that of every node by its identity."""
    shape = node.label, tuple(_joined([shape_of(c, known) for c in node.children]))
    if known is not None:
        known[id(node)] = shape
    return shape


def _starts(shape: tuple, number: int) -> list[int]:
    """The preorder numbers of a shape's children."""
    return list(accumulate(map(size_of, shape[1]), initial=number + 1))[:-1]


def _places(own: tuple, shapes: tuple) -> dict[int, int]:
    """Where children stand in a wider shape: where matched, or the one of their label."""
    found = dict(pairs(own, shapes))
    if len(found) < len(own):
        only: dict[str, int] = {}
        for j, child in enumerate(shapes):
            only[child[0]] = -1 if child[0] in only else j
        for i, child in enumerate(own):
            if i not in found and only.get(child[0], -1) >= 0:
                found[i] = only[child[0]]
    return found


def numbered(node: Node, shape: tuple, known: dict[int, tuple]) -> Iterator[tuple[Node, int]]:
    """Texts of a page with the preorder number of their node in the page's shape."""

    def walk(nodes: list[Node], s: tuple, first: int) -> Iterator[tuple[Node, int]]:
        # All nodes of one place in the shape share its number; walk child by child.
        starts = _starts(s, first)
        for node in nodes:
            own = known[id(node)][1]
            at = _places(own, s[1])
            # A node's children are in the group of the next neighbours of their label,
            # or in that of their label, if the children are a flow.
            groups: list[list[Node]] = []
            for c in node.children:
                if groups and groups[-1][0].label == c.label:
                    groups[-1].append(c)
                else:
                    groups.append([c])
            if len(groups) != len(own):
                flow: dict[str, list[Node]] = {}
                for group in groups:
                    flow.setdefault(group[0].label, []).extend(group)
                groups = list(flow.values())
            for i, group in enumerate(groups):
                if i not in at:
                    continue
                j = at[i]
                if s[1][j][0] == TEXT:
                    yield from ((n, starts[j]) for n in group)
                else:
                    yield from walk(group, s[1][j], starts[j])

    yield from walk([node], shape, 0)


def aligned(shape: tuple, wrapper: tuple) -> list[int]:
    """For each node of a shape in preorder, its preorder number in the wrapper, or -1."""
    found: list[int] = []

    def walk(s: tuple, w: tuple | None, number: int) -> None:
        found.append(number)
        if w is None:
            for child in s[1]:
                walk(child, None, -1)
            return
        places, starts = _places(s[1], w[1]), _starts(w, number)
        for i, child in enumerate(s[1]):
            j = places.get(i)
            walk(child, None if j is None else w[1][j], -1 if j is None else starts[j])

    walk(shape, wrapper, 0)
    return found


def packed(shape: tuple) -> str:
    return json.dumps(shape, ensure_ascii=False, separators=(",", ":"))


def unpacked(text: str) -> tuple:
    def frozen(x):
        return x[0], tuple(map(frozen, x[1]))

    return frozen(json.loads(text))


def hash64(*parts: str) -> int:
    digest = hashlib.blake2b("\0".join(parts).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def leaves(node: Node, path: str = "") -> Iterator[tuple[Node, str]]:
    """Texts of a page in order, with the labels above them."""
    for child in node.children:
        if child.tag == TEXT:
            yield child, path
        else:
            yield from leaves(child, f"{path}/{child.label}")


TEXTS = pa.list_(
    pa.struct([("node", pa.int32()), ("hash", pa.int64()), ("article", pa.bool_()), ("size", pa.int64())])
)
SLOTS = pa.list_(
    pa.struct(
        [
            ("node", pa.int32()),
            ("dropped", pa.bool_()),
            ("article", pa.bool_()),
            ("chars", pa.int64()),
            ("links", pa.int64()),
        ]
    )
)


def page_shapes(pages: DataFrame) -> DataFrame:
    """Of each page: host, its shape, a hash of its texts outside regions that are dropped
    anyway, these as (node in the shape, hash with the path, in an article, size), and for
    each node, also in such regions, the sizes of its texts and of what is in links."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, htmls in text_slices(batches, "html"):
            found: dict[str, list] = {"host": [], "content": [], "shape": [], "texts": [], "slots": []}
            for url, html in zip(rows.column("url").to_pylist(), htmls):
                root = parse(html)
                known: dict[int, tuple] = {}
                shape = shape_of(root, known)
                kept = [(n, p) for n, p in leaves(root) if not n.dropped]
                paths = {id(n): p for n, p in kept}
                texts: set[tuple] = set()
                slots: dict[int, list] = {}
                for n, number in numbered(root, shape, known):
                    if id(n) in paths:
                        texts.add((number, hash64(paths[id(n)], n.text), n.article, len(n.text)))
                    slot = slots.setdefault(number, [number, n.dropped, n.article, 0, 0])
                    slot[3] += len(n.text)
                    slot[4] += n.links
                found["host"].append(host_of(url))
                found["content"].append(hash64(*(n.text for n, _ in kept)))
                found["shape"].append(packed(shape))
                names = ("node", "hash", "article", "size")
                found["texts"].append([dict(zip(names, t)) for t in sorted(texts)])
                names = ("node", "dropped", "article", "chars", "links")
                found["slots"].append([dict(zip(names, t)) for t in slots.values()])
            types = (pa.string(), pa.int64(), pa.string(), TEXTS, SLOTS)
            yield pa.RecordBatch.from_pydict(
                {k: pa.array(v, t) for (k, v), t in zip(found.items(), types)}
            )

    return pages.select("url", "html").mapInArrow(
        run,
        "host string, content long, shape string, "
        "texts array<struct<node: int, hash: long, article: boolean, size: long>>, "
        "slots array<struct<node: int, dropped: boolean, article: boolean, chars: long, links: long>>",
    )


def folded(shapes: DataFrame, *by) -> DataFrame:
    """The wrapper of the shapes of each group."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        wrapper = None
        for text in sorted(set(group.column("shape").to_pylist())):
            wrapper = unpacked(text) if wrapper is None else merged(wrapper, unpacked(text))
        return pa.table({"host": [key[0].as_py()], "shape": [packed(wrapper)]})

    return shapes.groupBy("host", *by).applyInArrow(run, "host string, shape string")


def fold_group(shapes: DataFrame) -> tuple[int, Column]:
    """How many groups leave about ``FOLD_SHAPES`` of a host in one, and a row's group."""
    counts = shapes.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    groups = max(1, -(-most // FOLD_SHAPES))
    return groups, F.pmod(F.xxhash64("shape"), F.lit(groups)).alias("group")


def wrappers(shapes: DataFrame) -> DataFrame:
    """host, wrapper: from (host, shape), folded in groups of a host round by round."""
    left = shapes.select("host", "shape")
    groups, group = fold_group(left)
    while groups > 1:
        left = written(folded(left.select("host", "shape", group), "group"), "folded-shapes")
        groups, group = fold_group(left)
    return folded(left).withColumnRenamed("shape", "wrapper")


def wrapper_nodes(shapes: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """For each (host, shape) the wrapper's node of each node of the shape."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table, wrapper: pa.Table) -> pa.Table:
        found = unpacked(wrapper.column("wrapper")[0].as_py())
        nodes = [aligned(unpacked(s), found) for s in group.column("shape").to_pylist()]
        return pa.table(
            {
                "host": group.column("host"),
                "shape": group.column("shape"),
                "nodes": pa.array(nodes, pa.list_(pa.int32())),
            }
        )

    # A group of shapes gets the wrapper once.
    grouped = shapes.select("host", "shape", fold_group(shapes)[1])
    sent = grouped.select("host", "group").distinct()
    sent = sent.join(wrappers(shapes) if known is None else known, "host")
    sent = sent.toDF("of_host", "of_group", "wrapper")
    return (
        grouped.groupBy("host", "group")
        .cogroup(sent.groupBy("of_host", "of_group"))
        .applyInArrow(run, "host string, shape string, nodes array<int>")
    )


ARTICLE = hash64("an article has the content")


def judged(wrapper: tuple, pages: int, nodes: dict[int, list]) -> tuple[set[int], set[int]]:
    """Paths of a host's regions and of its content elements, as hashes.

    ``nodes``: of each text node of the wrapper its pages, in an article, chars, links,
    and if it lies in a region anyway.
    """
    regions: set[int] = set()
    contents: set[int] = set()
    total = sum(n[2] - n[3] for n in nodes.values() if not n[4])
    inside = sum(n[2] - n[3] for n in nodes.values() if n[1] and not n[4])
    if inside and inside * TEASER >= total - inside:
        contents.add(ARTICLE)

    def walk(shape: tuple, number: int, path: str) -> tuple[list, list]:
        """pages, in an article, chars, links of a node; and of its elements, with paths."""
        own = [0, False, 0, 0]
        elements = []
        for child, at in zip(shape[1], _starts(shape, number)):
            if child[0] == TEXT:
                found, bare = nodes.get(at, [0, False, 0, 0]), True
            else:
                below = f"{path}/{child[0]}"
                found, inner = walk(child, at, below)
                bare = not inner and child[0].split(".")[0] not in FLOWS
                elements.append((below, child, at, found, bare))
                plain = found[2] - found[3]
                often = max(found[0], 1)
                if 2 * found[0] >= pages and not found[1] and found[2] < 2 * found[3]:
                    regions.add(hash64(below))
                elif plain >= CONTENT_CHARS * often and plain * pages >= CONTENT_SHARE * total * often:
                    if found[2] >= 2 * found[3]:
                        contents.add(hash64(below))
            own = [max(own[0], found[0]), own[1] or found[1], own[2] + found[2], own[3] + found[3]]
        return own, elements

    _, elements = walk(wrapper, 0, "")
    # The first elements that share the page's text among them.
    found = [e for e in elements if e[3][2] > e[3][3]]
    while len(found) == 1:
        _, elements = walk(found[0][1], found[0][2], found[0][0])
        found = [e for e in elements if e[3][2] > e[3][3]]
    if any(e[3][2] - e[3][3] >= MAIN_SHARE * total for e in found):
        for path, _, _, (often, article, chars, links), bare in found:
            short = (chars - links) * pages <= SLOT_SHARE * total * often
            if bare and short and not article and 2 * often >= pages:
                regions.add(hash64(path))
    return regions, contents


def host_regions(slots: DataFrame, known: DataFrame) -> DataFrame:
    """host, regions, contents: from the sums at each wrapper node of a host."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table, wrapper: pa.Table) -> pa.Table:
        if not (group.num_rows and wrapper.num_rows):
            return pa.table({"host": [], "regions": [], "contents": []}, schema=schema)
        rows = group.to_pylist()
        nodes = {
            r["node"]: [r["n"], r["article"], r["chars"], r["links"], r["dropped"]] for r in rows
        }
        shape = unpacked(wrapper.column("wrapper")[0].as_py())
        regions, contents = judged(shape, rows[0]["pages"], nodes)
        return pa.table(
            {"host": [rows[0]["host"]], "regions": [sorted(regions)], "contents": [sorted(contents)]},
            schema=schema,
        )

    many = pa.list_(pa.int64())
    schema = pa.schema([("host", pa.string()), ("regions", many), ("contents", many)])
    return (
        slots.groupBy("host")
        .cogroup(known.toDF("of_host", "wrapper").groupBy("of_host"))
        .applyInArrow(run, "host string, regions array<long>, contents array<long>")
    )


def templates(pages: DataFrame) -> DataFrame:
    """host, constants (hashes of the texts that are template on a host), regions, contents."""
    # Copies of a page say nothing about what is constant; one of them is counted.
    one = F.min(F.struct("shape", "texts", "slots")).alias("page")
    found = written(
        page_shapes(pages)
        .where((F.col("host") != "") & (F.size("texts") > 0))
        .groupBy("host", "content")
        .agg(one)
        .select("host", "page.*"),
        "page-shapes",
    )
    size = F.aggregate("texts", F.lit(0).cast("long"), lambda n, t: n + t["size"])
    shapes = written(
        found.groupBy("host", "shape").agg(
            F.count(F.lit(1)).alias("pages"), F.sum(size).alias("all_size")
        ),
        "shapes",
    )
    known = written(wrappers(shapes), "wrappers")
    nodes = written(wrapper_nodes(shapes.select("host", "shape"), known), "wrapper-nodes")
    texts = (
        found.select("host", "shape", F.explode("texts").alias("t"))
        .groupBy("host", "shape", "t.node", "t.hash", "t.article", "t.size")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = shapes.groupBy("host").agg(
        F.sum("pages").alias("pages"), F.sum("all_size").alias("all_size")
    )
    few = F.col("pages") < FEW_PAGES
    share = F.when(few, 1.0).when(F.col("article"), ARTICLE_SHARE).otherwise(TEMPLATE_SHARE)
    constant = (
        texts.join(nodes, ["host", "shape"])
        .select(
            "host", "hash", "article", "size", F.col("nodes")[F.col("node")].alias("node"), "n"
        )
        .groupBy("host", "node", "hash", "article", "size")
        .agg(F.sum("n").alias("n"))
        .join(total.where("pages > 1"), "host")
        .where(F.col("n") >= F.col("pages") * share)
        .groupBy("host", "pages", "all_size")
        .agg(F.collect_set("hash").alias("constants"), F.sum(F.col("n") * F.col("size")).alias("same"))
        .where(~few | (F.col("same") * 2 <= F.col("all_size")))
    )
    sums = [F.sum("n").alias("n"), F.max("article").alias("article")]
    sums += [F.min("dropped").alias("dropped"), *(F.sum(c).alias(c) for c in ("chars", "links"))]
    slots = (
        found.select("host", "shape", F.inline("slots"))
        .groupBy("host", "shape", "node")
        .agg(F.count(F.lit(1)).alias("n"), *sums[1:])
        .join(nodes, ["host", "shape"])
        .withColumn("node", F.col("nodes")[F.col("node")])
        .groupBy("host", "node")
        .agg(*sums)
        .join(total.where(~few), "host")
        .select("host", "node", "n", "article", "dropped", "chars", "links", "pages")
    )
    return written(
        constant.select("host", "constants").join(host_regions(slots, known), "host", "full"),
        "templates",
    )


def content(
    root: Node, constants: set[int], regions: set[int] | None = None, contents: set[int] = frozenset()
) -> list[Node]:
    """The texts of a page that are content.  Without ``regions`` the host wasn't judged."""
    found = [(n, path) for n, path in leaves(root) if not n.dropped]
    total = sum(len(n.text) - n.links for n, _ in found)
    sums: dict[str, list[int]] = defaultdict(lambda: [0, 0])

    def above(path: str, depth: int) -> str:
        return "/".join(path.split("/")[: depth + 1])

    for n, path in found:
        for depth in n.doubt:
            own = sums[above(path, depth)]
            own[0] += len(n.text)
            own[1] += len(n.text) - n.links
    known: dict[str, bool] = {}

    def stays(path: str) -> bool:
        """No element of the path is a region of the host."""
        if path not in known:
            upper = path.rpartition("/")[0]
            known[path] = not path or hash64(path) not in regions and stays(upper)
        return known[path]

    def trusted(path: str) -> bool:
        if regions is not None:
            return hash64(path) in contents
        chars, plain = sums[path]
        return plain >= CONTENT_CHARS and plain >= CONTENT_SHARE * total and 2 * plain > chars

    trust = {path: trusted(path) for path in sums}
    kept = [
        n
        for n, path in found
        if (not n.doubt or all(trust[above(path, d)] for d in n.doubt))
        and (not regions or n.article or stays(path))
        and not (constants and hash64(path, n.text) in constants)
    ]
    inside = [n for n in kept if n.article]
    if not inside or ARTICLE in contents:
        return inside or kept
    size = sum(len(n.text) for n in inside)
    rest = sum(len(n.text) - n.links for n in kept if not n.article)
    return inside if size * TEASER >= rest else [n for n in kept if not n.article]


def main_text(html: str, constants: set[int], *host: set[int]) -> str:
    """Blocks of the content, joined by an empty line."""
    return "\n\n".join(n.text for n in content(parse(html), constants, *host))


def extract(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """page_id, url and text of every page."""
    pages = small_batches(pages).select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.col(html_column).cast("string").alias("html"),
    )
    known = templates(pages)

    def hosts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = pa.array([host_of(u) for u in batch.column("url").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, names], [*batch.schema.names, "host"]
            )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, htmls in text_slices(batches, "html"):
            hosts = zip(*(rows.column(c).to_pylist() for c in ("constants", "regions", "contents")))
            found = [
                main_text(
                    html,
                    set(constants or ()),
                    *(() if regions is None else (set(regions), set(contents))),
                )
                for html, (constants, regions, contents) in zip(htmls, hosts)
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column("page_id"), rows.column("url"), pa.array(found, pa.string())],
                ["page_id", "url", "text"],
            )

    return (
        pages.mapInArrow(hosts, "page_id long, url string, html string, host string")
        .join(known, "host", "left")
        .select("page_id", "url", "html", "constants", "regions", "contents")
        .mapInArrow(run, "page_id long, url string, text string")
    )
