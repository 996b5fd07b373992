"""Main text of web pages by site template removal (operator 1).

Every page is read into an element tree. Each element subtree is hashed (names, texts and child hashes, not
attributes), Spark counts beside how many different texts of a host each hash occurs, and subtrees that recur across many
pages of their host are deleted. A subtree's occurrences differ if the rest of the page does, by its least hash of
neighbouring words (in an article, by each of four such hashes): copies of a page have one rest, near copies mostly, so a page that stands at many
addresses isn't its own template. The host's pages count once for each text. Fixed rules on element names and class words take what differs from page to
page but is never article text (menus, adverts, notices, forms, reader comments, scripts). If a page marks its
article (``article``, ``main`` or the like), only text inside counts; a subtree there must recur on a larger share
of the pages (``ARTICLE_SHARE``), and headings, items and cells stay. So paragraphs that near copies share stay, unless nearly all pages of their host
are copies and less than two fifths of the pairs of words around are common to them.

Class words never take the element that holds the page's article: around ``main`` they don't count, around other
articles only if some article stands outside all such elements, if more text does, or if they mark reader comments and
lists of other articles; and not even then if nothing else would be left. In an article, words for headers don't count.

The tree is read twice, once for the counts and once for the text, rather than stored; both are narrow scans.
Subtrees meet their copies by host, hash and text, and the counts of what is left are combined before their shuffle, so a
host with a third of all pages is no hot spot. The recurring hashes
of all hosts are broadcast while they are few by count; else pages meet them in a join that Spark splits by size.

Null or empty html gives an empty text, a null address counts as one nameless host. Pages cut off anywhere are
read as far as they go. Equal rows give equal results. All columns of the input are kept whatever their names.
"""

from __future__ import annotations

import re
from html import unescape
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import shared

#: A subtree is template if it is in this many pages of its host that differ in text ...
MIN_PAGES = 5
#: ... and in this share of them, or in this one if it stands in an article.
MIN_SHARE, ARTICLE_SHARE = 0.2, 0.6
#: Rests of fewer words are compared as a whole outside of articles.
SHORT_REST = 20
#: Up to so many template hashes (8 bytes each) are sent to every executor; beyond, pages are shuffled by host.
BROADCAST_HASHES = 1 << 20

# Element names of HTML by their part in a page.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul caption option".split()
)
_DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select textarea input iframe object embed svg "
    "canvas audio video dialog menu title xmp noembed noframes math label datalist".split()
)
_REGION = frozenset(("article", "main"))
_WHOLE = frozenset(("#page", "html", "body"))
#: Elements that name or list parts of an article, and so may recur on many articles of a host.
_LABELS = frozenset("h1 h2 h3 h4 h5 h6 hgroup li dt dd td th tr thead tbody tfoot caption figcaption legend summary pre".split())
_CLOSES_P = _BLOCK - frozenset("body head html td th tr tbody thead tfoot li dd dt option caption summary legend".split())
#: An opening tag ends an open element of these names.
_ENDS = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tr": {"tr", "td", "th"}, "option": {"option"}, "body": {"head"},
}
#: ... but not beyond these.
_SCOPE = frozenset("ul ol dl table html body article section main div td th".split())
#: Words of class, id and role that mark what is no article text.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices notification alert popup modal overlay sidebar side aside rail widget widgets menu nav navbar "
    "navigation breadcrumb breadcrumbs topbar toolbar pagination pager header masthead footer colophon copyright "
    "comment comments reply replies respond discussion disqus share sharing social newsletter subscribe signup login "
    "search related recommended recommendations trending teaser teasers skip contentinfo complementary".split()
)
#: Of these, what may hold articles that are not the page's own.
_OTHERS = frozenset(
    "comment comments reply replies respond discussion disqus related recommended recommendations trending teaser teasers".split()
)
#: Of these, what an article may have for itself.
_HEADERS = frozenset(("header", "masthead"))
#: A word after one of these marks nothing: has-sidebar, no-sidebar, side-by-side.
_QUALIFIERS = frozenset("has no non not with without by".split())
#: A first word marks its token if the last only says what kind of box or part it is: sidebar-left, but not sidebar-layout.
_BOXES = frozenset(
    "container wrap wrapper box area item items list lists group block blocks section inner outer left right top bottom "
    "primary secondary main button buttons btn icon icons link links label form input field bar row slot unit zone panel pane "
    "column col posts post articles stories news content body text title heading author avatar meta date count counter "
    "toggle trigger message messages dialog policy settings logo image img holder bottombar header footer nav now tools".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s]+)))?")
_WORD = re.compile(r"[a-z]+")
_NAMED = re.compile(r"class|id|role|itemprop|hidden", re.I)
#: Turns the hash of a subtree into its name inside articles.
_INSIDE = 0x5555555555555555
#: Hashes in so many orders, each by its exclusive or with one of these.
_ORDERS = (0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class _Element:
    __slots__ = ("name", "dropped", "marks", "region", "within", "parts", "hash")

    def __init__(self, name: str, dropped: bool, marks: frozenset[str], region: str, within: bool = False):
        self.name, self.dropped, self.marks, self.region = name, dropped, marks, region
        self.within = within or bool(region)  # in a region, or one
        self.parts: list = []  # texts and elements, in page order


def _marks(token: str) -> set[str]:
    """The words that mark an element in one token of its class, id or role."""
    words = _WORD.findall(token)
    found = {w for w in words if w in _MARKS}
    if found and len(words) > 1:
        found = {words[-1]} & _MARKS if words[-2] not in _QUALIFIERS else set()
        if words[0] in _MARKS and words[-1] in _BOXES:
            found.add(words[0])
    return found


def _flags(name: str, attributes: str, in_region: bool) -> tuple[bool, frozenset[str], str]:
    """(dropped by its name, marks of its class words, kind of region or '') of an element."""
    dropped, region = name in _DROPPED or (name == "header" and not in_region), name if name in _REGION else ""
    marks: set[str] = set()
    if _NAMED.search(attributes):
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values).lower()
            if key in ("class", "id", "role"):
                for token in value.split():
                    marks |= _marks(token)
                if key == "role" and value == "main":
                    region = "main"
            elif key == "itemprop" and value == "articlebody":
                region = "main"
            elif key == "hidden":
                dropped = True
    if in_region or region:
        marks -= _HEADERS
    if name in ("html", "body"):
        return False, frozenset(), region
    return dropped, frozenset() if dropped else frozenset(marks), "" if dropped else region


def read_tree(html: str) -> _Element:
    """The element tree of a page, however broken."""
    root = _Element("#page", False, frozenset(), "")
    stack, at = [root], 0
    while m := _TOKEN.search(html, at):
        if m.start() > at:
            stack[-1].parts.append(html[at : m.start()])
        at, name = m.end(), m[2]
        if not name:
            continue
        name = name.lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
            continue
        if name in _CLOSES_P:
            _end(stack, {"p"})
        if name in _ENDS:
            _end(stack, _ENDS[name])
        within = stack[-1].within
        element = _Element(name, *_flags(name, m[3], within), within)
        stack[-1].parts.append(element)
        if name in _RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            element.parts.append(html[at : end.start() if end else len(html)])
            at = end.end() if end else len(html)
        elif name not in _VOID and not m[3].endswith("/"):
            stack.append(element)
        elif name not in _VOID and name in ("p", "div", "span", "b", "a"):  # the slash means nothing here
            stack.append(element)
    if at < len(html):
        stack[-1].parts.append(html[at:])
    return root


def _end(stack: list[_Element], names: set[str]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in names:
            del stack[k:]
            return
        if stack[k].name in _SCOPE:
            return


def _hash(root: _Element) -> None:
    """Set the hash of every subtree; no recursion, as pages may nest deeply."""
    order, todo = [], [root]
    while todo:
        order.append(e := todo.pop())
        todo.extend(p for p in e.parts if type(p) is not str)
    for e in reversed(order):
        inner = [str(p.hash) if type(p) is not str else " ".join(p.split()) for p in e.parts]
        text = "\x01".join((e.name, *filter(None, inner)))
        e.hash = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _settle(root: _Element, level: int) -> bool:
    """Drop the elements with marks, but not around ``main`` (from level 0), articles (1) and articles among comments or
    lists of other articles (2); whether all regions are dropped."""
    order, above = [root], [-1]
    at = 0
    while at < len(order):
        for p in order[at].parts:
            if type(p) is not str and (p.marks or not p.dropped):  # without marks, dropped by name
                order.append(p)
                above.append(at)
        at += 1
    others, holds = [False] * len(order), [False] * len(order)
    for i, e in enumerate(order):
        others[i] = (i > 0 and others[above[i]]) or not _OTHERS.isdisjoint(e.marks)
        holds[i] = e.region == "main" or (bool(e.region) and (level == 2 or (level == 1 and not others[i])))
    for i in range(len(order) - 1, 0, -1):
        holds[above[i]] |= holds[i]
    free = [True] * len(order)
    for i, e in enumerate(order):
        if e.marks:
            e.dropped = not holds[i]
        free[i] = not e.dropped and (i == 0 or free[above[i]])
    return any(e.region for e in order) and not any(f and e.region for f, e in zip(free, order))


def _walk(root: _Element) -> tuple[list[tuple[str, bool]], list[tuple[int, int, int, bool]]]:
    """(text, in an article) of each block; (hash, first block, end, in an article) of each subtree that may be template."""
    blocks: list[tuple[str, bool]] = []
    spans: list[tuple[int, int, int, bool]] = []
    pieces: list[str] = []
    inside = False

    def flush() -> None:
        if pieces and (text := " ".join(unescape("".join(pieces)).split())):
            blocks.append((text, inside))
        pieces.clear()

    todo: list = [(root, None, False, False)]
    while todo:
        part, begun, region, dropped = todo.pop()
        if part is None:  # the end of a block element
            flush()
            if begun is not None and len(blocks) > begun[1]:
                spans.append((begun[0].hash, begun[1], len(blocks), region))
        elif type(part) is str:
            if not dropped:
                if not pieces:
                    inside = region
                pieces.append(part)
        else:
            # Neither the article itself nor what holds the whole page is a candidate, nor are labels in an article.
            may = not (part.region or part.name in _WHOLE or (region and part.name in _LABELS))
            region, dropped = region or bool(part.region), dropped or part.dropped
            if part.name in _BLOCK:
                flush()
                todo.append((None, (part, len(blocks)) if may else None, region, dropped))
            elif part.name == "br":
                if not pieces:
                    inside = region
                pieces.append(" ")
            todo.extend((p, None, region, dropped) for p in reversed(part.parts))
    flush()
    return blocks, spans


def _article(root: _Element) -> tuple[list[str], list[tuple[int, int, int, bool]]]:
    """As _walk, with the blocks of the article alone if it has some, and the subtrees that hold a part of them."""
    blocks, spans = _walk(root)
    if any(own for _, own in blocks):
        at = [0, *accumulate(int(own) for _, own in blocks)]
        blocks, spans = [b for b in blocks if b[1]], [(h, at[i], at[j], own) for h, i, j, own in spans]
    return [text for text, _ in blocks], [s for s in spans if 0 < s[2] - s[1] < len(blocks)]


def _digest(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _sketch(text: str) -> list[int]:
    """The least hashes of a block's pairs of neighbouring words, in several orders of the hashes."""
    words = text.encode("utf-8", "surrogatepass").split()
    hashes = list(map(xxhash.xxh3_64_intdigest, map(b" ".join, zip(words, words[1:])))) or [xxhash.xxh3_64_intdigest(words[0])]
    return [min(map(order.__xor__, hashes)) for order in _ORDERS]


def _rests(texts: list[str], spans: list[tuple[int, int, int, bool]]) -> list[dict]:
    """Each subtree once, with the sketches of the text that stands outside of its first occurrence.

    Outside of articles one sketch is enough, and a short rest goes by all of its text, since a few words have too few pairs.
    """
    sketches = [_sketch(text) for text in texts] if spans else []
    words = [0, *accumulate(len(text.split()) for text in texts)]
    rows, known = [], set()
    before, after = [], []
    for k in range(len(_ORDERS)):
        least = [sketch[k] for sketch in sketches]
        before.append([1 << 64, *accumulate(least, min)])
        after.append([1 << 64, *accumulate(reversed(least), min)][::-1])
    for name, first, end, own in spans:
        if name in known:
            continue
        known.add(name)
        short = not own and words[-1] - words[end] + words[first] < SHORT_REST
        for k in range(len(_ORDERS) if own else 1):
            if short:
                rest = _digest("\n".join(texts[:first] + texts[end:]).encode("utf-8", "surrogatepass"))
            else:
                rest = min(before[k][first], after[k][end]) - (1 << 63)
            rows.append({"hash": name, "sketch": k, "rest": rest, "inside": own})
    return rows


def read_page(html: str | None, part: str = "blocks") -> dict:
    """blocks: the texts that the fixed rules leave; spans: the blocks that each subtree holds; if ``part`` is seen, seen: the
    subtrees with sketches of what is outside them, and a hash of all texts under no subtree's name."""
    if not html:
        return {"blocks": [], "spans": [], "seen": [{"hash": None, "sketch": 0, "rest": 0, "inside": False}]}
    root = read_tree(html)
    _hash(root)
    barred = _settle(root, 0)
    found = _article(root)
    if barred:
        _settle(root, 1)
        other = _article(root)
        if not found[0] and not other[0]:
            _settle(root, 2)
            other = _article(root)
        found = max(found, other, key=lambda read: sum(map(len, read[0])))
    texts, spans = found
    # What stands in articles is counted apart from what doesn't, so it has names of its own.
    spans = [(name ^ _INSIDE if own else name, first, end, own) for name, first, end, own in spans]
    page = {
        "blocks": [{"text": text} for text in texts],
        "spans": [{"hash": name, "first": first, "end": end} for name, first, end, _ in spans],
    }
    if part == "seen":
        content = _digest("\n".join(texts).encode("utf-8", "surrogatepass"))
        page["seen"] = [{"hash": None, "sketch": 0, "rest": content, "inside": False}, *_rests(texts, spans)]
    return page


def _read(html: Column, part: str) -> Column:
    number = pa.int64()
    kind, item = {
        "blocks": (
            "struct<blocks:array<struct<text:string>>,spans:array<struct<hash:long,first:int,end:int>>>",
            pa.struct(
                [
                    ("blocks", pa.list_(pa.struct([("text", pa.string())]))),
                    ("spans", pa.list_(pa.struct([("hash", number), ("first", pa.int32()), ("end", pa.int32())]))),
                ]
            ),
        ),
        "seen": (
            "struct<seen:array<struct<hash:long,sketch:int,rest:long,inside:boolean>>>",
            pa.struct(
                [("seen", pa.list_(pa.struct([("hash", number), ("sketch", pa.int32()), ("rest", number), ("inside", pa.bool_())])))]
            ),
        ),
    }[part]
    read = F.arrow_udf(lambda pages: pa.array([read_page(x, part) for x in pages.to_pylist()], item), kind)
    return read.asNondeterministic()(html)


def host(url: Column) -> Column:
    """The host of an address in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(
    pages: DataFrame,
    html: str = "html",
    url: str = "url",
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    article_share: float = ARTICLE_SHARE,
) -> DataFrame:
    """(__of, __templates): for each host (a hash of its name), the subtrees that recur on it.

    A page has a bounded number of subtrees, so those in a share of a host's pages are bounded as well.
    """
    address = F.xxhash64(host(F.col(url))).alias("__of")
    seen = pages.select(address, _read(F.col(html), "seen").alias("__page"))
    apart = seen.select("__of", F.explode("__page.seen").alias("__seen")).select("__of", "__seen.*").distinct()
    # Under no hash, the pages themselves are counted.
    rests = [F.count_if(F.col("sketch") == k) for k in range(len(_ORDERS))]
    rests = F.when(F.max("inside"), F.least(*rests)).otherwise(rests[0])
    counts = apart.groupBy("__of", "hash").agg(rests.alias("n"), F.max("inside").alias("inside"))
    counts = shared.stored(counts.filter((F.col("n") >= min_pages) | F.col("hash").isNull()))
    sizes = counts.filter("hash IS NULL").select("__of", F.col("n").alias("pages"))
    counts = counts.filter("hash IS NOT NULL")
    share = F.when(F.col("inside"), F.lit(article_share)).otherwise(F.lit(min_share))
    frequent = counts.join(sizes, "__of").filter(F.col("n") >= share * F.col("pages"))
    return shared.stored(frequent.groupBy("__of").agg(F.collect_set("hash").alias("__templates")))


def extract(pages: DataFrame, html: str = "html", url: str = "url", into: str = "text", **limits: float) -> DataFrame:
    """All rows and columns of pages and ``into``, the main text."""
    found = templates(pages, html, url, **limits)
    if (found.agg(F.sum(F.size("__templates"))).first()[0] or 0) <= BROADCAST_HASHES:
        found = F.broadcast(found)
    given, name = shared.masked(pages)
    own = [name[c] for c in pages.columns if c != into]
    read = given.select(
        *own, F.xxhash64(host(F.col(name[url]))).alias("__host"), _read(F.col(name[html]), "blocks").alias("__page")
    )
    none = F.array().cast("array<long>")
    joined = read.join(found, F.col("__host") == F.col("__of"), "left").withColumn(
        "__gone", F.filter("__page.spans", lambda s: F.array_contains(F.coalesce("__templates", none), s["hash"]))
    )
    kept = F.filter(
        "__page.blocks", lambda b, i: ~F.exists("__gone", lambda s: (s["first"] <= i) & (i < s["end"]))
    )
    back = [F.col(name[c]).alias(c) for c in pages.columns if c != into]
    return joined.select(*back, F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias(into))
