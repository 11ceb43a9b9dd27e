"""Main text of web pages by wrapper induction over the pages of each host.

Each page is parsed to a tree whose runs of like siblings are one repeated node. Pages of a host are dealt to small
groups, of which near copies of a page before are left out, as they tell nothing. Neighbours among the rest are
aligned by simple tree matching: the largest set of nodes with equal tag and classes that keeps order and ancestry.
Nodes aligned from page to page are a slot. Each page of a slot after the first votes: for "content" as often as the
slot has further distinct texts, else for "template"; Spark adds up the votes by host and place in the tree. Places that are constant
become the host's template, and extraction leaves them out, together with elements whose tag or role says what they
are: navigation, forms, scripts and the like. A class or id is a hint that an element is an advertisement, a list of
comments or such, and counts only if the rest of the page bears it out (:func:`_hinted`): what holds most of a page's
text is never dropped for a word in its class. An article tag counts only on hosts with too few pages to compare.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.tables import stored
from tidewheel.llm.urls import host

#: Pages of a group, and votes and share of them that make a place template: outside, and inside an article.
GROUP, OUTSIDE, INSIDE = 64, (2, 0.5), (8, 0.9)
#: Share of a page's text besides what its whole group has, up to which it is a copy of the others.
BARE = 0.1
#: At most so many template places are broadcast (240 bytes each at most); more go to the parts of their hosts.
BROADCAST_PLACES = 200_000
#: Pages of a part of a host, and rows taken at once.
PART, ROWS = 4096, 256
#: Children to align beyond which (as a product) like ones are matched in order of appearance.
DENSE = 1_000_000

# Fixed names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset("head nav aside form footer button select datalist dialog menu object svg canvas audio video map".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSED_WITHIN = frozenset("ul ol dl table select article section div body".split())
#: Values of role that say that an element is no content.
ROLE_VALUES = frozenset("navigation banner search complementary contentinfo form dialog alertdialog alert menu menubar toolbar status".split())
#: Words in a class or id that hint at what an element is for.
ROLES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar footer masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup login search "
    "share sharing social related recommended comment comments disqus replies reply pagination pager widget".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|title|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/><\"']*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\"<>])*+)>|<[!?][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s")
_DIGITS, _NAMES = re.compile(r"\d+"), re.compile(r"[a-z]+")
#: Characters of a place beyond which its beginning is a check sum, so places and trees stay small however deep a page is.
LONG_PLACE = 240
_HEADS = frozenset(("article", "main", "h1"))


class Element:
    __slots__ = ("article", "dropped", "hint", "place", "tag")

    def __init__(self, tag: str, place: str, dropped: bool, article: bool, hint: int):
        self.tag, self.place, self.dropped, self.article, self.hint = tag, place, dropped, article, hint


class Hint:
    """An element whose class or id hints that it is no content: ``sure`` if a whole name says so and not a part of one."""

    __slots__ = ("around", "head", "size", "sure")

    def __init__(self, around: int, sure: bool):
        self.around, self.sure, self.size, self.head = around, sure, 0, False


def _hinted(hints: list[Hint], total: int) -> list[bool]:
    """Which of the hints hold, ``total`` being the characters of the page's text without what its tags drop.

    A part of a name holds for an element without a heading or article that has less than half of the text; a whole
    name also for one that has more, or has a heading, but not both. What is in an element that goes goes, too.
    """
    out: list[bool] = []
    for hint in hints:  # an element comes after those around it
        most = 2 * hint.size >= total
        holds = not (most and hint.head) if hint.sure else not (most or hint.head)
        out.append(holds or (hint.around >= 0 and out[hint.around]))
    return out


def blocks(page: str) -> list[tuple[str, str, bool, bool]]:
    """(text, place, in an article, dropped by its own saying) of every block with text, in page order.

    ``place`` is the path of tags and classes. Character references are decoded, white space is one space.
    """
    out: list[tuple[str, str, bool, bool, int]] = []
    stack = [Element("", "", False, False, -1)]
    opened: dict[str, int] = {}  # open elements by tag
    hints: list[Hint] = []
    parts: list[str] = []
    at = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            top = next(e for e in reversed(stack) if e.tag in BLOCK or e.dropped or not e.tag)
            out.append((text, top.place, top.article, stack[-1].dropped, stack[-1].hint))

    def close(depth: int) -> None:
        for e in stack[depth:]:
            opened[e.tag] -= 1
        del stack[depth:]

    for found in _TOKEN.finditer(page):
        if found.start() > at:
            parts.append(page[at : found.start()])
        at = found.end()
        tag = found.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        block = tag in BLOCK or tag in DROPPED
        if found.group(2):
            if opened.get(tag):
                depth = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag)
                if any(e.tag in BLOCK or e.dropped or e.hint >= 0 for e in stack[depth:]):
                    flush()
                close(depth)
            continue
        if block:
            flush()
            if tag in BLOCK and opened.get("p") and (p := next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p" or stack[i].tag in CLOSED_WITHIN), 0)) and stack[p].tag == "p":
                close(p)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES.get(tag, ()):
                    close(i)
                elif stack[i].tag in CLOSED_WITHIN:
                    break
        if tag in VOID:
            continue
        names, dropped, parent = "", tag in DROPPED, stack[-1]
        hint = parent.hint
        if found.group(4):
            said = sure = False
            for name, value in _ATTRIBUTE.findall(found.group(4)):
                value = value.strip("\"'").lower()
                name = name.lower()
                if name == "role":
                    dropped = dropped or (tag not in ("html", "body", "article", "main") and value in ROLE_VALUES)
                    continue
                if name == "class":
                    names = "." + ".".join(sorted(_DIGITS.sub("9", value).split()))
                said = said or not ROLES.isdisjoint(_NAMES.findall(value))
                sure = sure or not ROLES.isdisjoint(value.split())
            if said and tag not in ("html", "body"):
                if not block:
                    flush()
                hint = len(hints)
                hints.append(Hint(parent.hint, sure))
        if tag in _HEADS:
            around = parent.hint
            while around >= 0 and not hints[around].head:
                hints[around].head = True
                around = hints[around].around
        if not block and not dropped and hint == parent.hint:
            continue  # an element within a line, which says nothing
        main = tag in ("article", "main")
        dropped = dropped or (tag == "header" and not parent.article)
        # an article in a form or in navigation that was never closed is an article still
        inherited = parent.dropped and not (main and all(e.tag in ("form", "header", "nav") for e in stack if e.dropped and e.tag in DROPPED | {"header"}) and not any(e.dropped and e.tag not in DROPPED | {"header"} for e in stack))
        place = f"{parent.place}/{tag}{names}"
        if len(place) > LONG_PLACE:
            place = f"/#{zlib.crc32(place.encode('utf-8', 'replace')):08x}{zlib.adler32(place.encode('utf-8', 'replace')):08x}"
        opened[tag] = opened.get(tag, 0) + 1
        stack.append(Element(tag, place, dropped or inherited, parent.article or main, hint))
    if at < len(page):
        parts.append(page[at:])
    flush()
    for text, _, _, dropped, hint in out:
        if not dropped and hint >= 0:
            hints[hint].size += len(text)
    for hint in reversed(hints):
        if hint.around >= 0:
            hints[hint.around].size += hint.size
    gone = _hinted(hints, sum(len(text) for text, _, _, dropped, _ in out if not dropped))
    return [(text, place, article, dropped or (hint >= 0 and gone[hint])) for text, place, article, dropped, hint in out]


Node = tuple  # (signature, place, check sum of texts, children)


def tree(found: list[tuple[str, str, bool, bool]]) -> Node:
    """The tree of the places of blocks, like siblings in a row being one node with all their texts."""
    root: list = ["", "", 0, []]
    for text, place, _, _ in found:
        node, path = root, ""
        for signature in place.split("/")[1:]:
            path += "/" + signature
            if not node[3] or node[3][-1][0] != signature:
                node[3].append([signature, path, 0, []])
            node = node[3][-1]
        node[2] = zlib.crc32(text.encode("utf-8", "replace"), node[2])
    return tuple(root)


def matching(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: how many nodes of two trees align, and which."""
    if a[0] != b[0]:
        return 0, []
    x, y = a[3], b[3]
    if len(x) * len(y) > DENSE:
        waiting: dict[str, list] = {}
        for node in reversed(y):
            waiting.setdefault(node[0], []).append(node)
        pairs = [(n, waiting[n[0]].pop()) for n in x if waiting.get(n[0])]
        inner = [matching(p, q) for p, q in pairs]
        return 1 + sum(n for n, _ in inner), [(a, b), *(z for _, zs in inner for z in zs)]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    inner = {}
    for i, p in enumerate(x):
        for j, q in enumerate(y):
            score = 0
            if p[0] == q[0]:
                inner[i, j] = matching(p, q)
                score = inner[i, j][0]
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + score)
    pairs, i, j = [(a, b)], len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs += inner[i - 1, j - 1][1]
            i, j = i - 1, j - 1
    return 1 + best[len(x)][len(y)], pairs


def pieces(found: list[tuple[str, str, bool, bool]]) -> dict[int, int]:
    """The sentences that a page is known by, as check sums with lengths: those of its articles, or of all of it if it has none."""
    kept = [text for text, _, article, dropped in found if article and not dropped] or [text for text, _, _, dropped in found if not dropped]
    return {zlib.crc32(p.encode("utf-8", "replace")): len(p) for text in kept for p in _SENTENCE.split(text)}


def distinct(known: list[dict[int, int]]) -> list[int]:
    """The numbers of the pages that are no near copy of one before, by their :func:`pieces`.

    What all pages have says nothing of any; of the rest, near copies share the larger part. Where there is next to
    no rest, pages are copies of each other.
    """
    common = set(known[0]).intersection(*known[1:]) if len(known) > 1 else set()
    firsts: list[int] = []
    rests: list[dict[int, int]] = []
    bare = False
    for i, page in enumerate(known):
        rest = {p: n for p, n in page.items() if p not in common}
        size = sum(rest.values())
        if size <= BARE * sum(page.values()):
            if bare:
                continue
            bare = True
        elif any(2 * sum(n for p, n in rest.items() if p in other) > min(size, sum(other.values())) for other in rests):
            continue
        firsts.append(i)
        rests.append(rest)
    return firsts


def slots(trees: list[Node]) -> list[tuple[str, list[int]]]:
    """(place, check sums of its texts) of the nodes that neighbours align, page by page; a node without match starts one."""
    out: list[tuple[str, list[int]]] = []
    before: dict[int, int] = {}

    def walk(node: Node) -> Iterator[Node]:
        yield node
        for child in node[3]:
            yield from walk(child)

    for i, now in enumerate(trees):
        slot = {id(q): before[id(p)] for p, q in matching(trees[i - 1], now)[1] if id(p) in before} if i else {}
        for node in walk(now):
            if not node[2]:
                continue
            if id(node) not in slot:
                slot[id(node)] = len(out)
                out.append((node[1], []))
            out[slot[id(node)]][1].append(node[2])
        before = slot
    return out


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for p in batch.column("html").to_pylist():
            found = blocks(p or "")
            packed.append(pickle.dumps((tree(found), pieces(found))))
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("turn"), pa.array(packed, pa.binary())], ["host", "turn", "tree"])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, group, votes = None, [], {}

    def told() -> pa.RecordBatch:
        keys = list(votes)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([votes[k][0] for k in keys], pa.int64()), pa.array([votes[k][1] for k in keys], pa.int64())]
        votes.clear()
        return pa.RecordBatch.from_arrays(columns, ["host", "place", "same", "n"])

    def close() -> None:
        if not group:
            return
        pages = [pickle.loads(packed) for packed in group]
        firsts = distinct([known for _, known in pages])
        for place, sums in slots([pages[i][0] for i in firsts]):
            if len(sums) > 1:
                vote = votes.setdefault((last[0], place), [0, 0])
                vote[0] += len(sums) - len(set(sums))
                vote[1] += len(sums) - 1
        group.clear()

    for batch in batches:
        for name, part, packed in zip(*(batch.column(c).to_pylist() for c in ("host", "part", "tree")), strict=True):
            if (name, part) != last:
                close()
                last = (name, part)
            if not group or packed != group[-1]:  # copies of a page tell nothing
                group.append(packed)
        if len(votes) > 100_000:
            yield told()
    close()
    if votes:
        yield told()


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, place, inside): the places of each host that are template, and whether even inside an article.

    A place that varies is a row without its name, so a host of which pages enough were compared has a row.
    """
    known = pages.where("html IS NOT NULL").select(host(F.col("url")).alias("host"), "html")
    known = known.where("host <> ''").select("host", "html", F.xxhash64("html").alias("turn"))
    trees = known.mapInArrow(_trees, "host string, turn long, tree binary")
    sizes = known.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"))
    dealt = trees.join(sizes, "host").select("host", F.pmod("turn", "parts").alias("part"), "turn", "tree")
    votes = dealt.repartition("host", "part").sortWithinPartitions("host", "part", "turn").mapInArrow(_votes, "host string, place string, same long, n long")
    total = votes.groupBy("host", "place").agg(F.sum("same").alias("same"), F.sum("n").alias("n"))
    inside = (F.col("n") >= INSIDE[0]) & (F.col("same") >= INSIDE[1] * F.col("n"))
    place = F.when(F.col("same") >= OUTSIDE[1] * F.col("n"), F.col("place"))
    return total.where(F.col("n") >= OUTSIDE[0]).select("host", place.alias("place"), inside.alias("inside")).distinct()


def main_text(page: str | None, template: dict[str, bool], compared: bool = False) -> str:
    """The blocks of a page without what is dropped or template.

    Where pages of the host were ``compared``, the template alone decides. Where not, blocks outside of articles go too
    if those inside hold the larger part of the text.
    """
    found = [(text, place, article) for text, place, article, dropped in blocks(page or "") if not dropped]
    if not compared and 2 * sum(len(text) for text, _, article in found if article) > sum(len(text) for text, _, _ in found):
        found = [block for block in found if block[2]]
    return "\n".join(text for text, place, article in found if not (template.get(place, False) if article else place in template))


def _extracted(names: list[str], shared) -> Callable:
    """The text of each page by its host's template: of ``shared``, or in front of the host's pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_host, own = None, None
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                texts, rows = [], []
                for i, (page, host, place, inside) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("__html", "__host", "__place", "__inside")), strict=True)):
                    if inside is not None:  # a place of the host whose pages follow
                        if own_host != host:
                            own_host, own = host, {}
                        if place is not None:
                            own[place] = inside
                        continue
                    template = shared.value.get(host) if shared is not None else own if own_host == host else None
                    texts.append(main_text(page, template or {}, template is not None))
                    rows.append(i)
                columns = [batch.column(i).take(pa.array(rows, pa.int64())) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, "text", "n_chars"])

    return run


def extracted(pages: DataFrame) -> DataFrame:
    """``pages`` without html, with ``text`` (its blocks joined by a newline, empty if there are none) and ``n_chars``.

    Null or empty html gives an empty text. A null URL or one without host belongs to no host: its page has no
    template. Rows may repeat and stay apart; columns named text and n_chars are replaced, others are carried.
    """
    spark = pages.sparkSession
    places = stored(wrappers(pages), "wrappers")
    names = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    whole = pages.select(*names, F.col("html").alias("__html"), host(F.col("url")).alias("__host"), F.lit(None).cast("string").alias("__place"), F.lit(None).cast("boolean").alias("__inside"))
    schema = T.StructType([*[pages.schema[c] for c in names], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    if places.count() <= BROADCAST_PLACES:
        templates: dict[str, dict] = {}
        for r in places.collect():
            own = templates.setdefault(r.host, {})
            if r.place is not None:
                own[r.place] = r.inside
        return whole.mapInArrow(_extracted(names, spark.sparkContext.broadcast(templates)), schema)
    # the pages of a host are dealt to parts, and its places go to each part in front of them
    sizes = pages.select(host(F.col("url")).alias("__host")).groupBy("__host").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("__parts"))
    parts = places.join(sizes, places["host"] == sizes["__host"]).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    front = parts.select(F.col("__host"), F.col("place").alias("__place"), F.coalesce("inside", F.lit(False)).alias("__inside"), "__part")
    dealt = whole.withColumn("__turn", F.xxhash64("__html", *names))
    large = sizes.where(F.col("__parts") > 1)  # few: a host has one for each so many pages
    dealt = dealt.join(F.broadcast(large), "__host", "left").withColumn("__part", F.pmod("__turn", F.coalesce("__parts", F.lit(1))).cast("int"))
    rows = dealt.select(*whole.columns, "__part").unionByName(front, allowMissingColumns=True)
    placed = rows.repartition("__host", "__part").sortWithinPartitions("__host", "__part", F.col("__inside").isNull())
    return placed.drop("__part").mapInArrow(_extracted(names, None), schema)
