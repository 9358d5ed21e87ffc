"""Operator 9: main text of web pages by consensus host paths.

Each page's containers are scored by the running text right inside them. A page
votes, with that score, for the generalised path (tags and classes, digits
levelled) of its best container; Spark sums the votes per host; every page is
then extracted again from the containers at its host's winning path, or from its
own best one where the page doesn't have that path.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"[^>\"']*(?:\"[^\"]*\"|'[^']*')")
_PLAIN = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements whose content is text up to their end tag, and of those, whose text is shown.
_RAW = frozenset("script style textarea title iframe noembed noframes xmp plaintext".split())
_SHOWN = frozenset("xmp plaintext".split())
#: What leaves no border in the text around it.
_SILENT = frozenset("script style noscript template".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: A start tag of these ends a drawing that was never closed.
_BREAKS_OUT = frozenset("article aside b blockquote body br center code dd div dl dt em footer h1 h2 h3 h4 h5 h6 header hr i img li main nav ol p pre section small span strong sub sup table u ul".split())
_BESIDE = frozenset("nav footer aside form button select dialog menu object canvas video audio fieldset svg noscript template".split())
#: Words of classes and ids that say what stands beside an article: surely, and likely.
_BESIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot adunit sponsor sponsored promo promotion nav navbar navigation breadcrumb breadcrumbs topnav sidenav "
    "sidebar masthead topbar comment comments commentlist disqus respond logo copyright cookie cookies cookiebar consent gdpr newsletter subscribe signup login".split()
)
_LIKELY_WORDS = frozenset(
    "banner menu aside widget footer replies notice notices notification alert popup modal overlay share sharing social related recommended recommendations toolbar pager pagination skip hidden".split()
)
#: Of these, what says so inside an article, too; the others name parts of articles as
#: well (related work, a section on sharing), which are no lists of links.
_NEVER_ARTICLE = _LIKELY_WORDS - frozenset("share sharing social related recommended recommendations widget".split())
_BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_MAIN = frozenset(("article", "main"))
#: A start tag of these ends an open element of the same kind below the nearest container.
_CLOSES = {k: frozenset(v.split()) for k, v in {"p": "p", "li": "li", "tr": "tr td th", "td": "td th", "th": "td th", "dt": "dt dd", "dd": "dt dd", "option": "option"}.items()}
_CLOSED = frozenset().union(*_CLOSES.values())
_HOLDS = frozenset("div article section main body td th ul ol dl table blockquote aside nav header footer form".split())
_WORD = re.compile(r"[a-z]+")


class Element:
    """An open or closed element, as far as scoring needs it.

    ``path`` numbers the element's path in its page; ``block`` is the nearest
    element that isn't inline; ``doubt`` the nearest one that is likely beside the
    article, itself included.
    """

    __slots__ = ("tag", "path", "beside", "main", "parent", "chars", "links", "block", "link", "doubt", "likely", "total", "linked", "blank")

    def __init__(self, tag: str, path: int, beside: bool, main: bool, parent: "Element | None", likely: bool = False) -> None:
        self.tag, self.path, self.beside, self.main, self.parent, self.likely = tag, path, beside, main, parent, likely
        inline = parent is not None and tag in _INLINE
        self.block = parent.block if inline else self
        self.link = inline and (tag == "a" or parent.link)
        self.doubt = self if likely else parent.doubt if parent is not None else None
        self.chars = self.links = self.total = self.linked = 0
        #: Whether there is nothing but white space in it.
        self.blank = True


class Page:
    """Texts in page order, each with the element it is in ("" stands for a border
    between blocks), all elements, and the steps of their paths."""

    def __init__(self) -> None:
        self.root = Element("", 0, False, False, None)
        self.texts: list[tuple[Element, str]] = []
        self.elements = [self.root]
        #: Number of a path by its parent's number and its last step; and back.
        self.numbers: dict[tuple[int, str], int] = {}
        self.steps: list[tuple[int, str]] = [(-1, "")]

    def number(self, parent: int, step: str) -> int:
        n = self.numbers.setdefault((parent, step), len(self.steps))
        if n == len(self.steps):
            self.steps.append((parent, step))
        return n

    def name(self, n: int) -> str:
        """A path as text: its steps, each after a space (no class holds one)."""
        out = []
        while n > 0:
            n, step = self.steps[n]
            out.append(step)
        return " ".join(out[::-1])

    def find(self, name: str) -> int | None:
        """The number of a path that the page has."""
        n = 0
        for step in name.split(" ") if name else ():
            n = self.numbers.get((n, step))
            if n is None:
                return None
        return n


def _decode(text: str) -> str:
    n = text.count("&")
    if not n:
        return text
    return text.replace("&amp;", "&") if text.count("&amp;") == n else html.unescape(text)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text and not text.isspace() else {}


def _is_beside(tag: str, about: dict[str, str], inside_main: bool) -> tuple[bool, bool]:
    """Whether an element is known not to be the article, and whether it is likely
    not, which the share of links in its text decides."""
    if tag in _BESIDE or tag == "header" and not inside_main:
        return True, False
    if not about or tag in _MAIN or tag in ("html", "body"):
        return False, False
    if "hidden" in about or about.get("aria-hidden") == "true" or about.get("role") in _BESIDE_ROLES or "display:none" in about.get("style", "").replace(" ", ""):
        return True, False
    said = set(_WORD.findall(f"{about.get('class', '')} {about.get('id', '')}".lower()))
    if said & _BESIDE_WORDS or "header" in said and not inside_main:
        return True, False
    if not inside_main or said & _NEVER_ARTICLE:
        return bool(said & _LIKELY_WORDS), False
    return False, bool(said & _LIKELY_WORDS)


def _step(tag: str, about: dict[str, str]) -> str:
    """An element's part of a path: its tag and classes, digits levelled."""
    kinds = sorted({re.sub(r"\d+", "#", c.lower()) for c in about.get("class", "").split()})
    return ".".join([tag, *kinds])


def parse(page: str) -> Page:
    """A page's texts and elements, in time linear in its length."""
    out = Page()
    root = top = out.root
    #: How many elements of a tag are open; and of those that a start tag may end, since the last container.
    open_: Counter = Counter()
    frames: list[Counter] = [Counter()]
    svg = 0

    def push(e: Element) -> None:
        nonlocal top, svg
        top = e
        open_[e.tag] += 1
        svg += e.tag == "svg"
        if e.tag in _CLOSED:
            frames[-1][e.tag] += 1
        if e.tag in _HOLDS:
            frames.append(Counter())

    def pop_to(e: Element) -> None:
        """Close ``e`` and all that is open inside it."""
        nonlocal top, svg
        while True:
            x, top = top, top.parent
            open_[x.tag] -= 1
            svg -= x.tag == "svg"
            if x.tag in _HOLDS:
                frames.pop()
            if x.tag in _CLOSED:
                frames[-1][x.tag] -= 1
            if x is e:
                return

    at = said = 0
    quotes = True
    while (at := page.find("<", at)) >= 0:
        m = _NAME.match(page, at)
        if not m:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                end = len(page) if end < 0 else end + 3
            elif page.startswith(("<!", "<?"), at) and (end := page.find(">", at)) >= 0:
                end += 1
            else:
                at += 1
                continue
            if at > said:
                out.texts.append((top, page[said:at]))
            at = said = end
            continue
        # the tag's end: the first > that isn't quoted
        pos = m.end()
        while quotes and (q := _QUOTED.match(page, pos)):
            pos = q.end()
        pos = _PLAIN.match(page, pos).end()
        if pos < len(page) and page[pos] != ">" or pos == len(page) and quotes:
            # a quote that is never closed: from here on quotes don't count
            quotes = False
            pos = page.find(">", m.end())
        if pos < 0 or pos >= len(page):
            break
        if at > said:
            out.texts.append((top, page[said:at]))
        tag, inside = m[2].lower(), page[m.end() : pos]
        at = said = pos + 1
        if tag not in _INLINE and tag not in _SILENT:
            out.texts.append((top, ""))
        if m[1]:
            if open_[tag]:
                e = top
                while e.tag != tag:
                    e = e.parent
                pop_to(e)
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at) if tag != "plaintext" else None
            upto = end.start() if end else len(page)
            if tag in _SHOWN:
                # what is in it is no markup, so nothing there is decoded
                out.texts.append((top, html.escape(page[at:upto], quote=False)))
                out.texts.append((top, ""))
            at = said = end.end() if end else len(page)
            continue
        if svg and tag in _BREAKS_OUT:
            while svg:
                pop_to(top)
        if tag in _VOID:
            continue
        about = _attributes(inside)
        if tag in _CLOSES or tag not in _INLINE:
            shut = _CLOSES.get(tag, _CLOSES["p"])
            if any(frames[-1][x] for x in shut):
                e = top
                while e.tag not in shut:
                    e = e.parent
                pop_to(e)
        if tag in _MAIN and top.beside:
            # an article inside what was never closed
            while top is not root and top.beside:
                pop_to(top)
        beside, likely = _is_beside(tag, about, top.main)
        path = top.path if tag in _INLINE else out.number(top.path, _step(tag, about))
        e = Element(tag, path, top.beside or beside, top.main or tag in _MAIN, top, likely)
        out.elements.append(e)
        if not (inside.endswith("/") and tag not in _HOLDS):
            push(e)
    if said < len(page):
        out.texts.append((top, page[said:]))
    _settle(out)
    return out


def _settle(page: Page) -> None:
    """Sum the texts of elements, and decide which doubtful ones are beside."""
    for e, text in page.texts:
        if text and not e.beside:
            n = len(text)
            e.block.chars += n
            e.block.blank = e.block.blank and text.isspace()
            e.block.links += n if e.link else 0
            if e.doubt is not None:
                e.doubt.total += n
                e.doubt.linked += n if e.link else 0
    for e in reversed(page.elements):
        if e.likely and e.parent.doubt is not None:
            e.parent.doubt.total += e.total
            e.parent.doubt.linked += e.linked
    for e in page.elements:
        if e.likely:
            e.beside |= 3 * e.linked > e.total
        if e.parent is not None:
            e.beside |= e.parent.beside


def score(page: Page) -> dict[int, float]:
    """A score for each path of a page: the characters of running text in its
    elements and, by half, in their children; less what is in links; article and
    main elements count fourfold."""
    out: dict[int, float] = {}
    for e in page.elements:
        if not e.chars or e.beside:
            continue
        own = e.chars - 2 * e.links
        leaf = e.tag not in _HOLDS and e.parent is not None
        for box, part in ((e, 0.0 if leaf else 1.0), (e.parent, 1.0), (e.parent.parent if e.parent else None, 0.5)):
            if box is not None and part and not box.beside and (box.tag in _HOLDS or box.parent is None):
                out[box.path] = out.get(box.path, 0.0) + part * own * (4 if box.tag in _MAIN else 1)
    return {k: v for k, v in out.items() if v > 0}


def whole_article(page: Page, path: int) -> int:
    """The path, or that of the container around it where an article goes on in a
    sibling: text that isn't mostly links, beside nothing, in a container that isn't
    the page. How long it is doesn't matter."""
    tags = {e.path: e for e in page.elements if e.tag not in _INLINE}
    extra: dict[int, int] = {}
    for e in page.elements:
        if e.block is e and e.chars and not e.beside:
            net, n = e.chars - 3 * e.links, e.path
            if net > 0 and not e.blank:
                extra[n] = extra.get(n, 0) + net
    if not extra:
        return path
    above: dict[int, int] = {}
    for n, net in extra.items():
        while n > 0 and n != path:
            above[n] = above.get(n, 0) + net
            n = page.steps[n][0]
    while path > 0:
        up = page.steps[path][0]
        box = tags.get(up)
        if tags[path].tag in _MAIN or box is None or box.tag in ("", "html", "body") or box.beside:
            return path
        if box.tag not in _HOLDS or above.get(up, 0) <= above.get(path, 0):
            return path
        path = up
    return path


def text_at(page: Page, path: int) -> str:
    """Text of all elements at a path, without what stands beside the article.
    White space in a block is one space; blocks are joined by one."""
    inside: dict[int, bool] = {}

    def within(n: int) -> bool:
        way = []
        while n >= 0 and n != path and n not in inside:
            way.append(n)
            n = page.steps[n][0]
        found = n == path or n >= 0 and inside[n]
        inside.update((x, found) for x in way)
        return found

    return " ".join("".join(_decode(t) if t else " " for e, t in page.texts if not e.beside and within(e.path)).split())


def best_path(page: Page, scores: dict[int, float]) -> int:
    """The path of the greatest score; ties go to the longer, then the least name."""
    most = max(scores.values(), default=0.0)
    tied = [n for n, v in scores.items() if v == most]
    if len(tied) < 2:
        return tied[0] if tied else 0
    return min(tied, key=lambda n: (-len(page.name(n)), page.name(n)))


def extract(text: str, voted: str | None) -> str:
    """Main text of a page, given its host's winning path."""
    page = parse(text)
    scores = score(page)
    own = best_path(page, scores)
    path = page.find(voted) if voted is not None else None
    if path is None or path not in scores or scores[path] < 0.25 * scores.get(own, 0.0):
        path = own
    return text_at(page, whole_article(page, path))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path): the winning path of each host. Votes are summed before the
    shuffle, so a host with a third of all pages is no hot group."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, weights = [], []
            for text in batch.column("html"):
                page = parse(text.as_py() or "")
                scores = score(page)
                best = best_path(page, scores)
                paths.append(page.name(best) if scores else None)
                weights.append(float(round(scores.get(best, 0.0))))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string()), pa.array(weights)], ["host", "path", "weight"])

    cast = pages.mapInArrow(vote, "host string, path string, weight double").where("path IS NOT NULL")
    summed = cast.groupBy("host", "path").agg(F.sum("weight").alias("weight"))
    return summed.groupBy("host").agg(F.max_by("path", F.struct("weight", "path")).alias("path"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from its whole html.

    Null html is empty and gives an empty text; pages of a null url share a host
    of their own; repeated rows give repeated rows; an empty table gives none. A
    page's time and memory are linear in its length, however it is nested. Elements
    whose class or id says comment, advert, menu and the like are left out; inside
    an article, words that only make this likely (related, share, ...) do so where
    the element is mostly links, however long it is. A drawing, form or frame is left
    out, formulas are kept.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host.alias("host"))
    won = materialise(votes(rows.select("host", "html")), "host-paths").withColumnRenamed("path", "voted")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py(), v.as_py()) for h, v in zip(batch.column("html"), batch.column("voted"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    both = rows.join(won, "host", "left").select("page_id", "url", "html", "voted")
    kinds = dict(both.dtypes)
    return both.mapInArrow(read, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
