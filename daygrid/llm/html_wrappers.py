"""HTML extraction by union-free wrapper inference.

A page is a stream of tags and texts; block tags nest into a tree whose leaves
are text slots. The wrapper of a host is a union-free regular expression over
such streams, kept as the same kind of tree: every node is one group (a tag with
its class and id), once, optional (``?``) or repeated (``+``), and text is a slot.
Two wrappers are merged by aligning the children of equal groups: equal
neighbours fold into a repeated group, equal groups align (a longest common
subsequence) and merge inside, whatever one side lacks becomes optional. Merging
starts inside a page (its own repetitions) and goes on over all pages of a host:
within tasks, then within salted parts of the host, then once per host, so a
host with a third of all pages is never gathered in one task.

Slots carry counts (pages, characters, characters inside links) and whether all
pages had the same text there. A page is aligned with its host's wrapper, and the
groups of the wrapper that occur in it are its template. Its main group is chosen
among them from the wrapper's slots: text that is not link text, not constant over
the host and in no menu, header, footer, sidebar, notice, advert, form, script or
comment area. Such areas are known by tag or by a whole class, id or role; by name
only, never ``body``, ``main``, ``article``, headings, paragraphs or what holds the
main group. Inside a main group most names (``WEAK_WORDS``) need the wrapper's
evidence: half of the text is links or constant. ``article``, ``main`` and role=main are evidence: they are the main
group where they hold at least half of that text. Else it is the smallest area that
holds ``AREA_SHARE`` of its surroundings' text and has no text beside it. A page
left without text by the wrapper's evidence is judged by its own text.

Defined results: null or empty html gives an empty text; a url without a host
belongs to the host ``''``; markup is read leniently (unclosed and stray tags, a
page that ends early, tags nested deeper than ``DEPTH``); character references are decoded, white space inside a
block becomes one space, blocks are joined by one space; repeated rows get equal
results; extra columns play no role.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_by_size, spilled, table

# HTML element kinds.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup: skipped to the end tag or the end of the page.
RAW = frozenset("script style textarea title".split())
#: Elements a block tag ends if they were left open, and the elements in them that hold markup.
LEFT_OPEN = frozenset("svg math select".split())
_HOLDING = frozenset("foreignobject annotation-xml desc".split())
_BLOCKS = frozenset("article aside blockquote body div dl dd dt footer form h1 h2 h3 h4 h5 h6 header li main nav ol p pre section table ul".split())
CLOSED_BY = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
# Areas that are not main text, by tag, and by names in class, id or role.
ASIDE_TAGS = frozenset("head nav header footer aside form button menu script style noscript template textarea title svg iframe select".split())
#: Names of comment areas, of other areas that stand for themselves, and of areas that
#: inside a main group are dropped only if the wrapper shows them as links or constant.
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus".split())
SURE_WORDS = frozenset("ad ads advert adverts advertisement sponsored cookie cookies gdpr consent popup modal newsletter login breadcrumb breadcrumbs pagination pager".split())
WEAK_WORDS = frozenset(
    "nav navbar navigation menu menubar header masthead footer contentinfo sidebar aside complementary widget banner sponsor promo promotion notice alert search "
    "subscribe signup share sharing social related recommended discussion toolbar".split()
)
#: Words a name may be made of beside those ("comment-list", but not "no-sidebar").
_NAME_WORDS = frozenset("area article bar block bottom box button buttons container entry form group inner item items left link links list main outer page panel post posts primary right secondary section site top wrap wrapper".split())
#: Groups that are never an aside for their names.
NEVER_ASIDE = frozenset("page html body main article p h1 h2 h3 h4 h5 h6".split())
MAIN_TAGS = frozenset(["article", "main"])
#: Groups of text, as opposed to areas of a page.
_TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dd dt figure figcaption math".split())
#: Pages that must agree before a text counts as constant, and the share of its
#: surroundings' text that makes an area the main one.
CONSTANT_PAGES = 3
AREA_SHARE = 0.8

#: Nesting that is kept; deeper groups are read as parts of the one at this depth, as browsers do.
DEPTH = 200

_NAME = re.compile(r"[a-zA-Z][\w:-]*")
_QUOTE_OR_END = re.compile(r">|=\s*[\"']")
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PARTS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


class Node:
    """A group of a page or wrapper: label, quantifier, children; ``#`` is a text slot."""

    __slots__ = ("label", "many", "kids", "text", "links", "stats")

    def __init__(self, label: str, many: str = ""):
        self.label, self.many, self.kids = label, many, []
        self.text, self.links, self.stats = [], 0, None


def _label(tag: str, attributes: str) -> str:
    named = [("role=" if k.lower() == "role" else "") + html.unescape(v.strip("\"'")).strip() for k, v in _NAMED.findall(attributes)] if attributes else []
    return " ".join([tag, *(_DIGITS.sub("0", v.lower()) for v in named)])


@lru_cache(100_000)
def aside_kind(label: str) -> str:
    """``tag``, ``comment``, ``sure``, ``weak`` or '' for a group of this tag and names."""
    tag, _, named = label.partition(" ")
    if tag in ASIDE_TAGS:
        return "tag"
    if tag in NEVER_ASIDE:
        return ""
    words: set[str] = set()
    for name in named.split():
        parts = _PARTS.findall(name.removeprefix("role="))
        if all(p in COMMENT_WORDS or p in SURE_WORDS or p in WEAK_WORDS or p in _NAME_WORDS for p in parts):
            words.update(parts)
    if not COMMENT_WORDS.isdisjoint(words):
        return "comment"
    if not SURE_WORDS.isdisjoint(words):
        return "sure"
    return "weak" if tag == "dialog" or not WEAK_WORDS.isdisjoint(words) else ""


def _tokens(page: str):
    """(start, end, closing, tag, attributes) of the markup of a page, in one pass; comments and
    declarations have no tag. Quotes count only behind ``=``; once a tag finds no end
    that way, tags of this page end at the next ``>``. Without one, ``<`` is text."""
    at, last, plain = 0, page.rfind(">"), False
    while (start := page.find("<", at)) >= 0:
        at = start + 1
        sign = page[at : at + 1]
        if page.startswith("!--", at):
            end = page.find("-->", at + 3)
            end = len(page) if end < 0 else end + 3
            yield start, end, False, "", ""
            at = end
            continue
        if start >= last:
            continue
        if sign in ("!", "?"):
            end = page.find(">", at) + 1
            yield start, end, False, "", ""
            at = end
            continue
        name = _NAME.match(page, at + (sign == "/"))
        if not name:
            continue
        end = -1
        if sign != "/" and not plain:
            here = name.end()
            while m := _QUOTE_OR_END.search(page, here):
                if m[0] == ">":
                    end = m.start()
                    break
                close = page.find(m[0][-1], m.end())
                if close < 0:
                    break
                here = close + 1
            plain = end < 0
        if end < 0:
            end = page.find(">", name.end())
        if end < 0:
            continue
        tag, attributes, at = name[0].lower(), page[name.end() : end], end + 1
        if sign != "/" and tag in RAW:  # its content is part of the token
            gone = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = gone.end() if gone else len(page)
        yield start, at, sign == "/", tag, attributes


def parse(page: str | None) -> Node:
    """The tree of block tags of a page; text slots hold their text pieces."""
    root = Node("page")
    tags, nodes = ["page"], [root]
    opened = Counter()
    page = page or ""
    links, left_open = 0, False

    def put(piece: str) -> None:
        if piece:
            kids = nodes[-1].kids
            if not kids or kids[-1].label != "#":
                if not piece.strip():
                    return
                kids.append(Node("#"))
            kids[-1].text.append(piece)
            if links:
                kids[-1].links += len(piece)

    def shut(size: int) -> None:
        """Closes groups until ``size`` are open; text behind a deep one is a block of its own."""
        deep = len(tags) > DEPTH
        opened.subtract(tags[size:])
        del tags[size:], nodes[size:]
        if deep and nodes[-1].kids and nodes[-1].kids[-1].label == "#":
            nodes[-1].kids.append(Node("div"))

    def shut_by(tag: str) -> None:
        while len(tags) > 1 and tag in CLOSED_BY.get(tags[-1], ()):
            shut(len(tags) - 1)

    read = 0  # the page is read up to here
    for start, end, closing, tag, attributes in _tokens(page):
        put(html.unescape(page[read:start]))
        read = end
        if tag in INLINE:
            if not closing and tag == "br":
                put(" ")
            links = links if tag != "a" else 0 if closing else 1
        elif closing:
            links = 0
            if opened[tag] > 0:
                size = len(tags) - 1
                while tags[size] != tag:
                    size -= 1
                shut(size)
        elif tag:
            links = 0
            shut_by(tag)
            if left_open and tag in _BLOCKS:
                for i in range(len(tags) - 1, 0, -1):
                    if tags[i] in _HOLDING:
                        break
                    if tags[i] in LEFT_OPEN:
                        shut(i)
                        break
                shut_by(tag)
            if tag in RAW:
                nodes[-1].kids.append(Node(_label(tag, "")))
                continue
            node = Node(_label(tag, attributes))
            nodes[-1].kids.append(node)
            if tag not in VOID and not attributes.rstrip().endswith("/"):
                tags.append(tag)
                # beyond DEPTH a group's text goes on in the group around it, but for areas that are dropped
                nodes.append(node if len(tags) <= DEPTH or tag in ASIDE_TAGS else nodes[-1])
                opened[tag] += 1
                left_open = left_open or tag in LEFT_OPEN
    put(html.unescape(page[read:]))
    return root


def _words(slot: Node) -> str:
    return " ".join("".join(slot.text).split())


def _quantified(a: str, b: str) -> str:
    """Of two aligned groups: repeated if either is, optional if either is."""
    marks = set(a + b)
    return "*" if "*" in marks or {"?", "+"} <= marks else "+" if "+" in marks else "?" if "?" in marks else ""


def _optional(node: Node) -> Node:
    node.many = _quantified(node.many, "?")
    return node


def merge(a: Node, b: Node) -> Node:
    """The wrapper of two aligned groups of one label."""
    out = Node(a.label, _quantified(a.many, b.many))
    if a.label == "#":
        (p, c, k, t), (q, d, m, u) = a.stats, b.stats
        out.stats = (p + q, c + d, k + m, t if t == u else "")
        return out
    out.stats = (a.stats or 0) + (b.stats or 0)
    out.kids = align(a.kids, b.kids)
    return out


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """Aligned children: equal labels merge, the others become optional."""
    if [n.label for n in a] == [n.label for n in b]:
        return [merge(x, y) for x, y in zip(a, b)]
    out: list[Node] = []
    for op, i, j, k, m in SequenceMatcher(None, [n.label for n in a], [n.label for n in b], autojunk=False).get_opcodes():
        if op == "equal":
            out += [merge(x, y) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += [_optional(n) for n in [*a[i:j], *b[k:m]]]
    return fold(out)


def fold(kids: list[Node]) -> list[Node]:
    """Neighbours of one label become one repeated group."""
    out: list[Node] = []
    for n in kids:
        if out and out[-1].label == n.label:
            same = merge(out[-1], n)
            same.many = "*" if "*" in (out[-1].many + n.many) or {out[-1].many, n.many} <= {"?", "*"} else "+"
            out[-1] = same
        else:
            out.append(n)
    return out


def induced(node: Node) -> Node:
    """The wrapper of one page: repetitions folded, slots counted."""
    out = Node(node.label)
    if node.label == "#":
        text = _words(node)
        out.stats = (1, len(text), min(node.links, len(text)), f"{xxhash.xxh3_64_intdigest(text):x}")
    else:
        out.stats = 1
        out.kids = fold([induced(k) for k in node.kids])
    return out


def dump(n: Node) -> list:
    return [n.label, n.many, n.stats, [dump(k) for k in n.kids]]


def load(x: list) -> Node:
    out = Node(x[0], x[1])
    out.stats = tuple(x[2]) if x[0] == "#" else x[2]
    out.kids = [load(k) for k in x[3]]
    return out


def gathered(n: Node) -> Node:
    """A wrapper whose optional groups of one label and one parent are one group (merging
    templates in different orders leaves copies of a group, each with a part of its pages)."""
    out = Node(n.label, n.many)
    out.stats = n.stats
    at: dict[str, int] = {}
    for k in n.kids:
        optional = k.many in ("?", "*")
        if optional and k.label in at:
            out.kids[at[k.label]] = merge(out.kids[at[k.label]], k)
            continue
        if optional:
            at[k.label] = len(out.kids)
        out.kids.append(k)
    out.kids = [gathered(k) for k in out.kids]
    return out


def _is_main(label: str) -> bool:
    tag, _, named = label.partition(" ")
    return tag in MAIN_TAGS or "role=main" in named.split()


def align_page(n: Node, w: Node | None) -> None:
    """Aligns a page with its host's wrapper: ``stats`` of every node becomes its group there."""
    n.stats = w
    groups = w.kids if w else []
    at = 0
    for k in n.kids:
        here = next((i for i in range(at, len(groups)) if groups[i].label == k.label), None)
        if here is None:
            here = next((i for i in range(at) if groups[i].label == k.label), None)
        else:
            at = here
        align_page(k, groups[here] if here is not None else None)


def _plain(slot: Node, shared: bool, marked: bool) -> float:
    """Plain text expected in a slot: the wrapper's mean of characters that are no link
    text, none if all pages have one text there (within ``article`` or ``main`` that
    is no evidence: copies of one page look constant); else the page's own."""
    if shared and slot.stats:
        pages, chars, links, constant = slot.stats.stats
        return 0.0 if constant and pages >= CONSTANT_PAGES and not marked else max(0, chars - 2 * links) / pages
    size = len(_words(slot))
    return float(max(0, size - 2 * min(slot.links, size)))


def asides(page: Node, shared: bool, names: bool = True) -> tuple[set[int], list[Node]]:
    """Ids of a page's aside groups and its outermost ``article`` or ``main`` groups.

    No aside is what holds the main group: a form around a page's areas, or a group
    that is an aside by name only and has half of the page's plain text, unless the
    ``article`` or ``main`` groups with text are elsewhere.
    """
    mass: dict[int, float] = {}
    holds: dict[int, bool] = {}
    marked: list[Node] = []
    out: set[int] = set()
    named: list[Node] = []

    def walk(n: Node, within: bool) -> bool:
        """Whether ``n`` has a page's areas (``article``, ``main``, header, footer, nav)."""
        if n.label == "#":
            mass[id(n)] = _plain(n, shared, within)
            return False
        kind = aside_kind(n.label)
        tag = n.label.split(" ")[0]
        if kind == "tag" and tag != "form" or kind == "comment" and names:
            out.add(id(n))
            mass[id(n)] = 0.0
            return tag in ("nav", "header", "footer")
        before = len(marked)
        if not within and _is_main(n.label):
            marked.append(n)
            within = True
        areas = [walk(k, within) for k in n.kids]
        mass[id(n)] = sum(mass[id(k)] for k in n.kids)
        if tag == "form" and not any(areas):
            out.add(id(n))
            mass[id(n)] = 0.0
            del marked[before:]
        elif kind in ("sure", "weak") and names:
            named.append(n)
            holds[id(n)] = any(mass[id(m)] for m in marked[before:])
        return any(areas) or _is_main(n.label)

    walk(page, False)
    some = any(mass[id(m)] for m in marked)
    for n in named:
        if 2 * mass[id(n)] < mass[id(page)] or not mass[id(n)] or some and not holds[id(n)]:
            out.add(id(n))
    return out, marked


def main_groups(page: Node, dropped: set[int], marked: list[Node], shared: bool = True) -> list[Node]:
    """The main groups of an aligned page, chosen for its template (the wrapper's
    groups that occur in it) from the wrapper's slots, or from its own text alone."""
    mass: dict[int, float] = {}
    tops = set(map(id, marked))

    def walk(n: Node, within: bool) -> float:
        within = within or id(n) in tops
        m = mass[id(n)] = 0.0 if id(n) in dropped else _plain(n, shared, within) if n.label == "#" else sum([walk(k, within) for k in n.kids])
        return m

    total = walk(page, False)
    found = [n for n in marked if mass.get(id(n))]
    if 2 * sum(mass[id(n)] for n in found) >= total > 0:
        return found
    best = page
    while total:
        # text beside the heaviest area belongs to it, smaller areas do not
        areas = [k for k in best.kids if k.label.split(" ")[0] not in _TEXT_TAGS and k.label != "#"]
        heaviest = max(areas, key=lambda k: mass[id(k)], default=None)
        if heaviest is None or mass[id(heaviest)] < AREA_SHARE * mass[id(best)] or any(mass[id(k)] for k in best.kids if k not in areas):
            break
        best = heaviest
    return [best]


def _sums(n: Node, marked: bool) -> tuple[float, float]:
    """(plain, all) characters expected below a group."""
    if n.label == "#":
        return _plain(n, True, marked), n.stats.stats[1] / n.stats.stats[0] if n.stats else float(len(_words(n)))
    both = [_sums(k, marked) for k in n.kids]
    return sum(b[0] for b in both), sum(b[1] for b in both)


def extract(page: Node, wrapper: Node) -> str:
    """The page's main text, read off by aligning it with the wrapper; from the page's
    own best group if the wrapper's evidence leaves a page with text without any."""
    align_page(page, wrapper)
    out: list[str] = []
    dropped: set[int] = set()

    def read(n: Node, constant: bool, broad: bool) -> None:
        if n.label == "#":
            out.append(_words(n))
            return
        if id(n) in dropped:
            if aside_kind(n.label) != "weak" or broad and not n.label.startswith("section"):
                return
            plain, size = _sums(n, constant)
            if 2 * plain < size:
                return
        for k in n.kids:
            read(k, constant, broad)

    for shared, names in ((True, True), (False, True), (False, False)):
        dropped, marked = asides(page, shared, names)
        if not names and marked:
            break
        for n in main_groups(page, dropped, marked, shared):
            # a main group of constant text makes constancy no evidence, and what is
            # chosen as broadly as the page says little about the areas in it
            read(n, not _sums(n, False)[0], n.label.split(" ")[0] in ("page", "html", "body"))
        if any(out):
            break
    return " ".join(t for t in out if t)


def host_column(url: str = "url"):
    """The lower-cased host of a url, '' without one."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _page_wrappers(batches):
    """One wrapper for each host of a block of pages."""
    for batch in batches:
        hosts: dict[str, Node] = {}
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = induced(parse(page))
                hosts[host] = merge(hosts[host], own) if host in hosts else own
        yield pa.RecordBatch.from_arrays([pa.array(list(hosts), pa.string()), pa.array([json.dumps(dump(w)) for w in hosts.values()], pa.string())], names=["host", "wrapper"])


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    total = None
    for text in sorted(pdf["wrapper"]):
        one = load(json.loads(text))
        total = merge(total, one) if total else one
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [json.dumps(dump(total))]})


SALTS = 32


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): one wrapper for every host, from all its pages."""
    blocks = pages.select(host_column().alias("host"), "html").mapInArrow(_page_wrappers, "host string, wrapper string")
    salted = blocks.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    parts = salted.groupBy("host", "salt").applyInPandas(_merged, "host string, wrapper string")
    return parts.groupBy("host").applyInPandas(_merged, "host string, wrapper string")


def _texts(batches):
    wrappers: dict[str, Node] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out = []
            for page, wrapper in zip(part.column("html").to_pylist(), part.column("wrapper").to_pylist()):
                if (w := wrappers.get(wrapper)) is None:
                    if len(wrappers) > 500:
                        wrappers.clear()
                    w = wrappers[wrapper] = gathered(load(json.loads(wrapper)))
                out.append(extract(parse(page), w))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    wrappers = spilled(infer_wrappers(pages))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", host_column().alias("host"))
    found = join_by_size(rows, wrappers, "host")
    texts = found.select("page_id", "url", "html", "wrapper").mapInArrow(_texts, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
