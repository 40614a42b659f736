"""Main text of web pages by tag-path ratios.

Every block of a page (the text between two block boundaries) has a path of block
tags from the root.  Per path the length of its blocks, without that of links,
and their punctuation are summed and divided by the number of its blocks.  Both
ratios are laid along the page in block order and smoothed by a Gaussian over
near blocks of near paths (a neighbour counts less with every edit between the
paths), fused by a geometric mean with the spread of the path's lengths and its
share of the page's text, and averaged again per path; paths at or above ``LEVEL``
times the mean of the page's text hold content.  A div or section counts with its
class (or id), so that a rail of links and the article are different paths.  What
lies in the container of a chosen path, deeper than body, belongs to the same
content and comes along: headings, list items, cells and quotations, and of inner
divisions the paths whose text is not mostly links.

The ratios decide alone where markup says nothing.  Where it does, lists of names
settle what text statistics cannot tell (a long reader comment reads like the
article): text under elements that by their tag, role, class or id are navigation,
page headers, footers, sidebars, notices, adverts, forms or reader comments takes
no part, and blocks of any kind come along inside an article element;
``lists=False`` leaves the lists out.  A form, or a division that only its class
or id names, is not believed against the ratios: if it holds ``MOST`` of the
page's fused score (half is enough if it alone holds the article element) and
prose to show for it, it is opened, and what is named inside is judged in turn.
Reader comments are opened only where nothing outside them reads like prose.
Comments that no markup names are text like any other.

The parser is forgiving and linear in the page, however deep it is nested: a
regular expression cuts it into tags, text and comments, and gives quotes that
never close up after ``TRIES`` page lengths; paths are numbers of a tree; unclosed tags are closed by their container, p by the next block, an
unclosed script or style by the page's end, and any other unclosed element
without text of its own (svg, object, title) by the next block.

Defined cases: null or empty html, and pages without content, give an empty text;
text outside any tag counts as a path of its own; unknown markup is passed over;
pages of any length and depth are read whole, few bytes at a time as Python
objects; repeated rows give the same text; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from isohyet.llm.common import slices

LEVEL = 0.5
#: The level of a division beside a container of content, in parts of the page's.
BESIDE = 0.25
RADIUS = 2
#: The part of the fused score beyond which a named wrapper is opened, and the characters of prose it must hold.
MOST, PROSE = 0.75, 250
#: Failed searches for the end of quoted attributes, in lengths of the page.
TRIES = 8
#: Paths further apart than so many edits don't smooth each other.
EDITS = 6
# Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object canvas audio video textarea select title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
LEAF = frozenset("h1 h2 h3 h4 h5 h6 p li dd dt blockquote pre td th caption figcaption summary".split())
ASIDE = frozenset("head nav footer aside form button dialog menu fieldset".split())
CLOSES = {
    "li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
LISTS, TABLES = ("ul", "ol", "dl", "table", "select", "menu"), ("table", "td", "th", "caption", "button")
#: Elements whose class or id is part of a path, and those that divide a container.
CLASSED = frozenset("div section main".split())
DIVIDES = frozenset("div section main article details form".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form toolbar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert newsletter subscribe signup popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer masthead comment comments disqus replies related share sharing social toolbar pagination pager login".split()
)
JOINED = tuple("footer sidebar cookie newsletter advert navbar breadcrumb masthead comments disqus sponsor sidenav topnav subnav mainnav commentlist commentform adbox adslot adunit adsbygoogle".split())
TALK = frozenset("comment comments disqus replies commentlist commentform".split())
LAYOUT = frozenset("no not has have with without hide hidden show".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_QUOTED = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_SENTENCE = re.compile(r"[.!?…。]")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_MARKS = re.compile(r"[.,;:!?…¿¡。、，]")


def _names_boilerplate(token: str) -> bool:
    """Whether a class or id names what holds no content (site-footer, siteFooter, sitefooter); one that tells of a layout (no-sidebar, has-sidebar, with-menu) does not."""
    parts = [p.lower() for p in _PARTS.findall(token)]
    named = not WORDS.isdisjoint(parts) or any(p.startswith(JOINED) or p.endswith(JOINED) for p in parts)
    return named and LAYOUT.isdisjoint(parts)


def _label(attributes: str) -> str:
    """The class of an element, else its id, without digits, so that numbered blocks have one path."""
    held = {name.lower(): "".join(values) for name, *values in _ATTRIBUTE.findall(attributes)}
    return re.sub(r"\d+", "", held.get("class") or held.get("id") or "")


#: What an element's names say of it: nothing, surely no content, likely none, likely reader comments.
CLEAR, SURE, LIKELY, COMMENTS = range(4)


def _shunned(tag: str, attributes: str, inside: bool) -> int:
    """Whether an element holds no content by its lists' names; ``inside``: an article or main is open."""
    if tag in ASIDE and tag != "form" or tag == "header" and not inside:
        return SURE
    found = LIKELY if tag == "form" else CLEAR
    if not attributes or tag in ("html", "body", "article", "main"):
        return found
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and value.lower() in ROLES:
            return SURE
        if name in ("class", "id") and any(_names_boilerplate(t) for t in value.split()):
            talk = not TALK.isdisjoint(p.lower() for p in _PARTS.findall(value))
            found = max(found, COMMENTS if talk else LIKELY)
    return found if tag in BLOCK or not found else SURE


@dataclass
class Blocks:
    """The blocks of a page in order: path number, raw text, and the text in links; and the tree of paths by number."""

    path: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: [""])
    depth: list[int] = field(default_factory=lambda: [0])
    #: The innermost named wrapper of each block (0: none), and of each wrapper the one around it, whether it is of comments, its articles and titles.
    wrapper: list[int] = field(default_factory=list)
    around: list[int] = field(default_factory=lambda: [-1])
    comments: list[bool] = field(default_factory=lambda: [False])
    articles: list[int] = field(default_factory=lambda: [0])
    titles: list[int] = field(default_factory=lambda: [0])


class _Parser:
    """The open elements of a page, and the blocks found so far."""

    def __init__(self, lists: bool):
        self.lists, self.found, self.numbers = lists, Blocks(), {}
        self.tags: list[str] = []
        self.paths: list[int] = []
        self.marks: list[int] = []
        self.wrappers: list[int] = [0]
        self.places: dict[str, list[int]] = {}
        self.bad = self.inside = 0
        self.block: list[str] = []
        self.links: list[str] = []

    def place(self, *tags: str) -> int:
        """The highest place of an open element of these names, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def say(self, text: str) -> None:
        if self.bad <= 0:
            self.block.append(text)
            if self.places.get("a"):
                self.links.append(text)

    def end_block(self) -> None:
        if self.block:
            text = "".join(self.block)
            if not text.isspace():
                self.found.path.append(self.paths[-1] if self.paths else 0)
                self.found.text.append(text)
                self.found.linked.append("".join(self.links))
                self.found.wrapper.append(self.wrappers[-1])
            self.block, self.links = [], []

    def pop_to(self, place: int) -> None:
        while len(self.tags) > place:
            if self.tags[-1] in BLOCK:
                self.end_block()
            tag = self.tags.pop()
            self.paths.pop()
            self.places[tag].pop()
            mark = self.marks.pop()
            self.bad -= mark == SURE
            if mark > SURE:
                self.wrappers.pop()
            self.inside -= tag in ("article", "main")

    def push(self, tag: str, attributes: str, mark: int = CLEAR) -> None:
        over = self.paths[-1] if self.paths else 0
        if self.lists and not mark:
            mark = _shunned(tag, attributes, self.inside > 0)
        self.inside += tag in ("article", "main")
        if tag in BLOCK:
            self.end_block()
            number = self.numbers.setdefault((over, tag, _label(attributes) if tag in CLASSED else ""), len(self.found.parent))
            if number == len(self.found.parent):
                self.found.parent.append(over)
                self.found.tag.append(tag)
                self.found.depth.append(self.found.depth[over] + 1)
            over = number
        self.places.setdefault(tag, []).append(len(self.tags))
        self.tags.append(tag)
        self.paths.append(over)
        self.marks.append(mark)
        self.bad += mark == SURE
        if mark > SURE:
            self.found.around.append(self.wrappers[-1])
            self.found.comments.append(mark == COMMENTS)
            self.found.articles.append(0)
            self.found.titles.append(0)
            self.wrappers.append(len(self.found.around) - 1)
        if self.bad <= 0:
            self.found.articles[self.wrappers[-1]] += tag in ("article", "main")
            self.found.titles[self.wrappers[-1]] += tag == "h1"

    def open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            if (at := self.place(*RAW)) >= 0:
                self.pop_to(at)
            if (at := self.place("p")) > self.place(*TABLES):
                self.pop_to(at)
        if tag in CLOSES and (at := self.place(*CLOSES[tag])) > self.place(*LISTS):
            self.pop_to(at)
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCK:
            if tag in BLOCK:
                self.end_block()
            elif tag == "br":
                self.say(" ")
            return
        self.push(tag, attributes)


def blocks(page: str, lists: bool = True) -> Blocks:
    """The blocks that may be content, in page order."""
    made, at, endless = _Parser(lists), 0, set()
    last, tries = page.rfind(">") + 1, TRIES * len(page)
    while at < last:
        start, m = at, _TAG.match(page, at)
        if not m:
            if page.startswith("<!--", at):
                end = page.find("-->", at)
                at = end + 3 if end >= 0 else len(page)
            elif page.startswith(("<!", "<?"), at):
                at = page.index(">", at) + 1
            else:
                end = page.find("<", at + 1)
                at = end if end >= 0 else len(page)
                made.say(page[start:at])
            continue
        end = _QUOTED.match(page, m.end()) if tries > 0 else None
        if end:
            at = end.end()
        else:
            tries -= len(page) - at
            at = page.index(">", m.end()) + 1
        tag, attributes = m[2].lower(), page[m.end() : at - 1]
        if m[1]:
            if (place := made.place(tag)) >= 0:
                made.pop_to(place)
            continue
        if tag in RAW and not attributes.rstrip().endswith("/"):
            close = None if tag in endless else re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at, last)
            if close:
                at = close.end()
            elif tag in ("script", "style"):
                at = len(page)
            else:
                endless.add(tag)
                made.push(tag, "", SURE)
            continue
        made.open(tag, attributes)
    if at < len(page):
        made.say(page[at:].partition("<!--")[0])
    made.pop_to(0)
    made.end_block()
    return _believed(made.found)


def _measures(found: Blocks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each block its characters, those outside links, and its punctuation."""
    plain = lambda text: len(" ".join(html.unescape(text).split()))
    full = np.array([plain(t) for t in found.text], float)
    long = np.maximum(0, full - [plain(a) for a in found.linked])
    return full, long, np.array([len(_MARKS.findall(html.unescape(t))) for t in found.text], float)


def _believed(found: Blocks) -> Blocks:
    """The blocks without those of named wrappers, but for wrappers that the ratios open."""
    if not any(found.wrapper):
        return found
    n, at = len(found.around), np.array(found.wrapper)
    raw = np.bincount(at, [max(0, len(t) - len(a)) for t, a in zip(found.text, found.linked, strict=True)], n)
    free = np.zeros(n, bool)
    free[0] = True
    if found.articles[0] == 0 and sum(found.articles) or raw[1:].sum() >= raw[0]:
        paths, score, *_ = path_scores(found)
        _, long, _ = _measures(found)
        prose = np.array([n if n >= 60 and _SENTENCE.search(t) else 0 for n, t in zip(long, found.text, strict=True)])
        own = np.bincount(at, score[np.searchsorted(paths, found.path)] * long, n)
        told = np.bincount(at, prose, n)
        inner: list[list[int]] = [[] for _ in range(n)]
        # score, prose, articles and titles of a wrapper and of all in it
        held = [own.copy(), told.copy(), np.array(found.articles, float), np.array(found.titles, float)]
        for w in range(n - 1, 0, -1):
            inner[found.around[w]].append(w)
            for sums in held:
                sums[found.around[w]] += sums[w]
        order = lambda w: (found.comments[w], -held[0][w], w)
        open_score, open_prose, open_articles = own[0], told[0], found.articles[0]
        queue = [order(w) for w in inner[0]]
        heapify(queue)
        while queue:
            *_, w = heappop(queue)
            mass, text, articles, titles = (sums[w] for sums in held)
            part = 0.5 if articles and not open_articles else MOST
            if found.comments[w]:
                ours = bool(articles or titles) and not open_prose
            else:
                ours = bool(articles and not open_articles or text >= PROSE) and mass >= part * (mass + open_score)
            if ours and mass > 0:
                free[w] = True
                open_score, open_prose, open_articles = open_score + own[w], open_prose + told[w], open_articles + found.articles[w]
                for child in inner[w]:
                    heappush(queue, order(child))
    keep = [k for k, w in enumerate(found.wrapper) if free[w]]
    found.path, found.text, found.linked, found.wrapper = ([held[k] for k in keep] for held in (found.path, found.text, found.linked, found.wrapper))
    return found


def edits(found: Blocks, a: int, b: int) -> int:
    """Tags to drop and add between two paths, up to EDITS + 1."""
    n = 0
    while a != b and n <= EDITS:
        if found.depth[a] >= found.depth[b]:
            a = found.parent[a]
        else:
            b = found.parent[b]
        n += 1
    return n


def smooth(values: np.ndarray, found: Blocks) -> np.ndarray:
    """Means of values (by block) over near blocks of near paths."""
    n = len(values)
    total, weight = values.astype(float), np.ones(n)
    for step in range(1, min(RADIUS, n - 1) + 1):
        far = np.fromiter((edits(found, a, b) for a, b in zip(found.path, found.path[step:], strict=False)), float, n - step)
        w = np.where(far > EDITS, 0.0, np.exp(-0.5 * ((step / RADIUS) ** 2 + far**2)))
        total[step:] += w * values[:-step]
        total[:-step] += w * values[step:]
        weight[step:] += w
        weight[:-step] += w
    return total / weight


def path_scores(found: Blocks) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Distinct paths, the fused ratio of each, the level that content reaches, and the share of each path's text outside links."""
    paths, owner = np.unique(np.array(found.path), return_inverse=True)
    full, long, marks = _measures(found)
    count = np.bincount(owner)
    text_ratio, mark_ratio = np.bincount(owner, long) / count, np.bincount(owner, marks) / count
    spread = np.sqrt(np.maximum(np.bincount(owner, long**2) / count - text_ratio**2, 0))
    laid = [smooth(x[owner], found) for x in (text_ratio, mark_ratio, spread)]
    share = np.bincount(owner, long) / max(1.0, long.sum())
    fused = np.sqrt(laid[0] * (1 + laid[1])) * np.sqrt(1 + laid[2] / (1 + text_ratio.max())) * np.sqrt(share[owner])
    level = LEVEL * float(fused @ long) / max(1.0, long.sum())
    return paths, np.bincount(owner, fused) / count, level, np.bincount(owner, long) / np.maximum(1, np.bincount(owner, full))


def content_paths(found: Blocks, lists: bool = True) -> set[int]:
    """Numbers of the paths that hold content."""
    if not found.path:
        return set()
    paths, score, level, own = path_scores(found)
    chosen = set(paths[score >= max(level, 1e-9)].tolist())
    n, parent, tag = len(found.parent), found.parent, found.tag
    around = {parent[p] for p in chosen}
    holds = [p in chosen for p in range(n)]
    for c in range(n - 1, 0, -1):  # a path has a greater number than the path around it
        holds[parent[c]] |= holds[c]
    # 2: in the container of a chosen path, without a division between; 1: behind a division; whole: in an article element.
    near = [2 if c in around and tag[c] not in ("", "html", "body") else 0 for c in range(n)]
    whole = [lists and holds[c] and tag[c] == "article" for c in range(n)]
    for c in range(1, n):
        whole[c] |= whole[parent[c]]
        if near[parent[c]] and not near[c]:
            near[c] = 1 if tag[c] in DIVIDES else near[parent[c]]
    beside = {parent[c] for c in around if tag[c] in DIVIDES and tag[parent[c]] not in ("", "html", "body")}
    for p, mine, own_score in zip(paths.tolist(), own.tolist(), score.tolist(), strict=True):
        leaf = tag[p] in LEAF
        if tag[p] in CLASSED and parent[p] in beside and mine >= 0.5 and own_score >= BESIDE * level:
            chosen.add(p)
        if whole[p] or near[p] == 2 and leaf or near[p] and mine >= 0.5 or leaf and parent[p] in around and tag[parent[p]] == "body":
            chosen.add(p)
    return chosen


def main_text(page: str, lists: bool = True) -> str:
    found = blocks(page, lists)
    chosen = content_paths(found, lists)
    lines = (" ".join(html.unescape(text).split()) for path, text in zip(found.path, found.text, strict=True) if path in chosen)
    return "\n".join(x for x in lines if x)


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [main_text(x.as_py() or "") for x in batch.column("html")]
        made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *made], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(_work, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
