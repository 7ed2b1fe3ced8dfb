"""Main text of web pages by site template removal.

A page is parsed into a tree. Every element subtree gets a hash of its tags, classes and text; Spark
counts in how many pages of a host each hash occurs, and subtrees that recur across many pages of their
host are the site's template and are deleted. Pages of a host with the same text are one page there, so
that copies of a page make no template. This comes first, and over the whole page. What it leaves of
navigation, forms, scripts, adverts by class and the like, as where a host has few pages or their texts
differ, goes by what HTML itself says of an element.

Where a page names its content (article, main), the one with the most prose of its own is taken, with articles of
like size beside it or in it; cards that are links for the most part, or hold next to no prose against it, are none.
Text outside it is not content, and the prose inside it
(paragraphs, headings, quotations, code, and the lists and tables among them) is never taken for a template,
whatever box it is in, as an article recurs too where several pages show it.

Pages are parsed twice, once for the hashes and once for the text, rather than kept in parsed form: what is
written between is some hashes a page. Templates reach the pages as a broadcast while they are counted to
be few, else each page meets those of its own in a join.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from emberwave.llm.common import saved, slices

#: A subtree is template where it is on at least so many pages of its host, and on such a share of them. The
#: share holds for a host of LEAST_PAGES / LEAST_SHARE pages and falls with the root of the host's size, so
#: that the boxes of a large host's sections go: with these figures, the root of the host's pages is enough.
LEAST_PAGES, LEAST_SHARE = 5, 0.2

#: Templates are broadcast up to this many, 16 bytes each.
BROADCAST_TEMPLATES = 1_000_000
#: Parts into which the rows of one template, or of one repeated page, are dealt in joins.
SALT = 16

MARKS = "key_a long, key_b long, host long, same long, subtrees array<long>"
TEXTS = "page_id long, url string, text string, n_chars long, n_template long, n_listed long"

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|(?P<text>[^<]+|<)", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_TOKENS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that end a line of text.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
#: Prose as well, where they stand among prose or right in the content, not in a box of their own.
LISTS = frozenset("ul ol dl table".split())
#: Elements that never hold article text.
NEVER = frozenset("head script style noscript template iframe object svg math canvas audio video nav footer aside form button select option textarea input menu dialog datalist title".split())
#: Classes, ids and roles that mark an element as none of the article; a compound does if all its words do
#: (cookie-notice), so that a layout class (with-sidebar, widget-area) is none.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies copyright disclaimer disqus "
    "footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related recommended "
    "reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Words that say where or how such an element stands, and nothing about what it holds: comments-area, ad-slot, site-footer.
STANDS = frozenset(
    "area article bar block body bottom box container entry fixed global inner item items left links list main menu outer page panel post primary region right row secondary section site slot sticky top unit "
    "user users view wrap wrapper zone".split()
)
#: A card is an article of which so much is link text, or that has so little prose against the page's largest. A named
#: element that holds most of a page goes if what is left has so much of its prose.
CARD_LINKS, CARD_PROSE, LEFT_PROSE = 1 / 3, 0.1, 0.1
HEADERS = frozenset("header site-header page-header main-header".split())
#: Starting one of these ends an open element of the second kind.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
WITHIN = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
CLOSES_P = BLOCK - {"br", "body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend"}


class Node:
    __slots__ = ("around", "card", "children", "content", "drop", "full", "hash", "hints", "holds", "linked", "names", "parent", "prose", "size", "tag")

    def __init__(self, tag: str, hints: str = "", drop: bool = False, names: tuple[str, ...] = ()) -> None:
        self.tag, self.hints, self.drop, self.names, self.children, self.parent = tag, hints, drop, names, [], None
        #: Hash of the subtree, size of its text that may be shown, and of all its text.
        self.hash = self.size = self.full = 0
        #: Of the text that may be shown, that in paragraphs and headings, and that of links.
        self.prose = self.linked = 0
        #: Whether it has prose in it, is named content, is around some, and is an article that is a card.
        self.holds = self.content = self.around = self.card = False


def _node(tag: str, rest: str) -> Node:
    hints, hidden, names = "", False, []
    if rest and ("=" in rest or "hidden" in rest):
        for m in _ATTRIBUTE.finditer(rest):
            value = (m[2] or m[3] or m[4] or "").lower()
            name = m[1].lower()
            hidden |= name == "hidden" or name == "aria-hidden" and value == "true"
            if name in ("class", "id", "role"):
                hints += f" {name}={value}"
                names += value.split()
    return Node(tag, hints, hidden or tag in NEVER, tuple(names))


def _hinted(node: Node) -> bool:
    """Whether one of an element's names says that it is none of the article, and at most where it stands besides."""
    return any(not HINTS.isdisjoint(words) and all(x in HINTS or x in STANDS for x in words) for words in map(_TOKENS.findall, node.names))


class _Open:
    """The open elements of a page, with the places of each tag, so that none is ever searched for."""

    def __init__(self, root: Node) -> None:
        self.stack, self.blocks, self.places = [root], [], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, at: int) -> None:
        while len(self.stack) > at:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def add(self, child: Node | str) -> None:
        self.stack[-1].children.append(child)
        if isinstance(child, Node):
            child.parent = self.stack[-1]


def parse(html: str) -> Node:
    """The tree of a page; any text has one. End tags that fit nothing open are skipped."""
    root = Node("html")
    now, at, size = _Open(root), 0, len(html)
    while at < size:
        m = _TOKEN.match(html, at)
        at = m.end()
        text = m["text"] or m["cdata"]
        if text is not None:
            now.add(unescape(text) if m["text"] and "&" in text else text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if now.places.get(tag):
                now.close(now.places[tag][-1])
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P and now.blocks and now.stack[now.blocks[-1]].tag == "p":
            now.close(now.blocks[-1])
        if tag in ENDS and (open_ := now.last(ENDS[tag])) > now.last(WITHIN[tag]):
            now.close(open_)
        node = _node(tag, m["rest"])
        now.add(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(html, at)
            node.children.append(html[at : close.start() if close else size])
            at = close.end() if close else size
        elif tag not in VOID and not m["rest"].endswith("/"):
            now.push(node)
    return root


def _walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """Every node twice, before and after its children, without recursion."""
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, done = todo.pop()
        yield node, done
        if not done:
            todo.append((node, True))
            todo += [(x, False) for x in reversed(node.children) if isinstance(x, Node)]


def _measure(root: Node) -> None:
    """Gives each element its hash, the sizes of its text, and whether it holds prose."""
    for node, done in _walk(root):
        if not done:
            continue
        inner, shown, full, prose, linked = [], 0, 0, 0, 0
        for x in node.children:
            if isinstance(x, str):
                inner.append(" ".join(x.split()))
                # Without white space at its ends.
                shown, full = shown + len(x.strip()), full + len(inner[-1])
            else:
                inner.append(format(x.hash, "x"))
                shown, full, prose, linked = shown + x.size, full + x.full, prose + x.prose, linked + x.linked
        node.size = 0 if node.drop else shown
        node.prose = node.size if node.tag in PROSE else 0 if node.drop else prose
        node.linked = node.size if node.tag == "a" else 0 if node.drop else linked
        node.full = 0 if node.tag in CODE else full
        node.hash = _hash("\x1e".join((node.tag, node.hints, "\x1f".join(inner))))
        if node.parent is not None and (node.holds or node.tag in PROSE):
            node.parent.holds = True


def _beside(node: Node) -> bool:
    """Whether an article in here is a comment or a teaser. A layout class such as with-sidebar is none."""
    return node.tag in NEVER or not {"comment", "comments", "commentlist", "related"}.isdisjoint(_TOKENS.findall(node.hints)) or "=sidebar" in node.hints


def _name_content(root: Node) -> bool:
    """Marks the elements that a page names its content, all elements around one, and articles that are cards."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    beside = 0
    for node, done in _walk(root):
        own = _beside(node)
        if done:
            beside -= own
            continue
        beside += own
        kind = "article" if node.tag == "article" else "main" if node.tag == "main" or "role=main" in node.hints else None
        if kind and not beside:
            found[kind].append(node)
    articles, mains = found["article"], found["main"]
    measure = (lambda x: x.prose) if any(x.prose for x in articles + mains) else lambda x: x.size
    # What a main element holds beside its articles; of articles in articles the inner ones are part of the outer.
    alone = {id(x): measure(x) for x in mains}
    for x in articles:
        above = x.parent
        while above is not None and above.tag != "article" and id(above) not in alone:
            above = above.parent
        if above is not None and id(above) in alone:
            alone[id(above)] -= measure(x)
    most = max([0, *map(measure, articles)])
    in_main = max(mains, key=lambda x: alone[id(x)], default=None)
    whole_main = in_main is not None and alone[id(in_main)] >= most
    least = max(most, alone[id(in_main)] if whole_main else 0)
    for x in articles:
        x.card = measure(x) < least and (x.linked >= CARD_LINKS * x.size or measure(x) < CARD_PROSE * least)
    chosen = mains if whole_main else [x for x in articles if not x.card] or articles
    for node in chosen:
        node.content = True
        above = node.parent
        while above is not None and not above.around:
            above.around = True
            above = above.parent
    return bool(chosen)


def _left_prose(root: Node) -> int:
    """The prose of a page outside all elements whose names say that they are none of the article."""
    left = named = inner = 0
    for node, done in _walk(root):
        own, prose = _hinted(node) or node.drop, node.tag in PROSE
        if done:
            named, inner = named - own, inner - prose
            continue
        if prose and not own and not named and not inner:
            left += node.prose
        named, inner = named + own, inner + prose
    return left


def _hash(text: str) -> int:
    return xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class Page:
    """The blocks of text of a page in order, and the elements whose recurrence would delete them.

    ``blocks`` has (text, element, whether it is no content by what HTML says); an element is a number, -1 for none,
    with its subtree's hash and the element it is in, which has a smaller number.
    """

    def __init__(self, html: str) -> None:
        self.blocks: list[tuple[str, int, bool]] = []
        self.hashes: list[int] = []
        self.above: list[int] = []
        root = parse(html)
        _measure(root)
        content = _name_content(root)
        left = 0 if content else _left_prose(root)
        buffers: tuple[list[str], list[str]] = ([], [])
        opened: list[tuple[int, bool, bool, bool, bool]] = []
        inside = dropped = prose = boxed = 0
        element = -1

        def flush() -> None:
            for listed, buffer in enumerate(buffers):
                text = " ".join("".join(buffer).split())
                buffer.clear()
                if text:
                    self.blocks.append((text, element, bool(listed)))

        todo: list[tuple[Node | str, bool]] = [(root, False)]
        while todo:
            node, done = todo.pop()
            if isinstance(node, str):
                buffers[bool(dropped) or content and not inside].append(node)
                continue
            if done:
                if node.tag in BLOCK:
                    flush()
                element, named, out, safe, box = opened.pop()
                inside, dropped, prose, boxed = inside - named, dropped - out, prose - safe, boxed - box
                continue
            if node.tag in CODE:
                continue
            header = node.tag == "header" or not HEADERS.isdisjoint(node.names)
            # A name drops no element that holds most of a page's text, unless the page names its content or has prose left.
            named_out = (_hinted(node) or header and not inside) and (content or 2 * node.size <= root.size or left >= max(1, LEFT_PROSE * node.prose))
            out = (node.drop or named_out or node.card) and not node.around and not node.content
            safe = content and (node.tag in PROSE or node.tag in LISTS and not boxed)
            # Inside named content prose is safe; what holds it or the content leaves no mark on what it holds.
            template = node is not root and node.full > 0 and not (node.content or node.around or (inside and (prose or safe or node.holds)))
            box = bool(inside) and template and node.tag in BLOCK
            if node.tag in BLOCK:
                flush()
            opened.append((element, node.content, out, safe, box))
            if template and node.tag in BLOCK:
                # An element inside a line of text is no block of its own, so it makes no cut either.
                self.hashes.append(node.hash)
                self.above.append(element)
                element = len(self.hashes) - 1
            inside, dropped, prose, boxed = inside + node.content, dropped + out, prose + safe, boxed + box
            todo.append((node, True))
            todo += [(unescape(x) if isinstance(x, str) and node.tag == "title" else x, False) for x in reversed(node.children)]
        flush()

    def subtrees(self) -> list[int]:
        return sorted(set(self.hashes))

    def same(self) -> int:
        """A hash of the text that HTML does not say is none, by which copies of a page are told."""
        return _hash("\x1e".join(text for text, _, listed in self.blocks if not listed))

    def cleaned(self, gone: Callable[[int], bool]) -> tuple[str, int, int]:
        """The text that neither goes by a template nor by what HTML says, and the characters of what goes so."""
        lost: list[bool] = []
        for own, above in zip(self.hashes, self.above, strict=True):
            lost.append(above >= 0 and lost[above] or gone(own))
        by_template = [k >= 0 and lost[k] for _, k, _ in self.blocks]
        text = " ".join(t for (t, _, listed), away in zip(self.blocks, by_template, strict=True) if not away and not listed)
        n_template = sum(len(t) for (t, _, _), away in zip(self.blocks, by_template, strict=True) if away)
        n_listed = sum(len(t) for (t, _, listed), away in zip(self.blocks, by_template, strict=True) if listed and not away)
        return text, n_template, n_listed


#: Elements whose text is code, or markup for browsers that lack something.
CODE = frozenset("script style template iframe noembed noframes".split())


def visible_text(html: str) -> list[str]:
    """The blocks of all text of a page, its title and its navigation too; only code and markup are left out."""
    pieces: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            pieces.append(text)

    todo: list[Node | str | None] = [parse(html)]
    while todo:
        node = todo.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            buffer.append(node)
        elif node.tag not in CODE:
            block = node.tag in BLOCK or node.tag in ("title", "option", "button", "textarea")
            if block:
                flush()
                todo.append(None)
            # Of the elements whose content is no markup, these two have character references.
            todo += [unescape(x) if isinstance(x, str) and node.tag in ("title", "textarea") else x for x in reversed(node.children)]
    flush()
    return pieces


def _host(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _own(pages: DataFrame) -> DataFrame:
    url, html = pages["url"].cast("string"), pages["html"].cast("string")
    return pages.select(pages["page_id"].cast("long").alias("page_id"), url.alias("url"), html.alias("html"))


def _host_key(url: str | None) -> int:
    return _hash(_host(url))


def _keys() -> tuple[Column, Column]:
    """Two hashes tell a page's address and content; equal pages share them."""
    return F.xxhash64("url", "html").alias("key_a"), F.xxhash64(F.lit(1), "html", "url").alias("key_b")


def page_marks(pages: DataFrame) -> DataFrame:
    """``MARKS``, a row per page: its keys, its host, its content and its subtrees with text, as hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            read = [Page(x or "") for x in part.column("html").to_pylist()]
            columns = {"key_a": part.column("key_a"), "key_b": part.column("key_b"), "host": pa.array(map(_host_key, part.column("url").to_pylist()), pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {"same": pa.array([x.same() for x in read], pa.int64()), "subtrees": pa.array([x.subtrees() for x in read], pa.list_(pa.int64()))})

    return _own(pages).select("url", "html", *_keys()).mapInArrow(run, MARKS)


def templates(marks: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, subtree) of subtrees on at least ``least_pages`` of their host's pages and the root of
    ``least_pages * least_share`` times all of them.

    Pages of a host with the same text (``same``) are one page; of its copies the least array counts.
    """
    pages = marks.groupBy("host", "same").agg(F.min("subtrees").alias("subtrees"))
    counts = pages.select("host", F.explode("subtrees").alias("subtree")).groupBy("host", "subtree").agg(F.count("*").alias("n"))
    hosts = marks.select("host", "same").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    often = counts.where(F.col("n") >= least_pages).join(hosts, "host")
    return often.where(F.col("n") >= F.sqrt(least_pages * least_share * F.col("host_pages"))).select("host", "subtree")


def _cleaned(part: pa.RecordBatch, gone: Callable[[int], Callable[[int], bool]]) -> pa.RecordBatch:
    """``TEXTS`` of a slice; ``gone`` gives the test of the subtrees of its k-th row."""
    read = [Page(x or "").cleaned(gone(k)) for k, x in enumerate(part.column("html").to_pylist())]
    columns = {"page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array([x[0] for x in read], pa.string())}
    columns["n_chars"] = pa.array([len(x[0]) for x in read], pa.int64())
    return pa.RecordBatch.from_pydict(columns | {n: pa.array([x[k] for x in read], pa.int64()) for k, n in ((1, "n_template"), (2, "n_listed"))})


def _by_broadcast(own: DataFrame, found: DataFrame) -> DataFrame:
    rows = found.toPandas()
    shared = own.sparkSession.sparkContext.broadcast((rows["host"].to_numpy(np.int64), rows["subtree"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, set[int]] = {}
        for host, subtree in zip(*(x.tolist() for x in shared.value), strict=True):
            sets.setdefault(host, set()).add(subtree)
        none: set[int] = set()
        for part in slices(batches, "html"):
            urls = part.column("url").to_pylist()
            yield _cleaned(part, lambda k, urls=urls: sets.get(_host_key(urls[k]), none).__contains__)

    return own.mapInArrow(run, TEXTS)


def _by_join(own: DataFrame, marks: DataFrame, found: DataFrame) -> DataFrame:
    """Each distinct page meets the templates of its host, and each row its page; both joins are salted."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    once = marks.dropDuplicates(["key_a", "key_b"]).select("key_a", "key_b", "host", F.explode("subtrees").alias("subtree"))
    met = once.withColumn("salt", F.pmod("key_b", F.lit(SALT)).cast("int")).join(found.withColumn("salt", salts), ["host", "subtree", "salt"])
    gone = saved(met.groupBy("key_a", "key_b").agg(F.collect_set("subtree").alias("gone")), "gone")
    dealt = own.select("*", *_keys(), F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).cast("int").alias("salt"))
    joined = dealt.join(gone.withColumn("salt", salts), ["key_a", "key_b", "salt"], "left").select("page_id", "url", "html", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            sets = [set(x or ()) for x in part.column("gone").to_pylist()]
            yield _cleaned(part, lambda k, sets=sets: sets[k].__contains__)

    return joined.mapInArrow(run, TEXTS)


def main_text(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """page_id, url, text and n_chars, a row per row of ``pages`` (page_id, url, html), and beside them the
    characters of the blocks that templates delete (n_template) and that HTML says are no text (n_listed).

    A null or empty page has an empty text. A null url, or one without a host, belongs to the host "".
    Repeated rows count as one page and give repeated results, as pages of a host with the same text do; an
    empty table gives none. Character references are decoded, white space in a block is one space, blocks
    are joined by one. Nothing of a page is cut off; other columns are not read, whatever their names.
    """
    own = _own(pages)
    marks = saved(page_marks(pages), "marks")
    found = saved(templates(marks, least_pages, least_share), "templates")
    return _by_broadcast(own, found) if found.count() <= BROADCAST_TEMPLATES else _by_join(own, marks, found)
