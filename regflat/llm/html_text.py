"""Main text of web pages by a minimum cut.

A page becomes a list of text blocks with the path of elements around each.  A
linear classifier gives every block evidence for content and for boilerplate:
these are its capacities to the two terminals.  Blocks next to each other and
blocks under the same element are joined by smoothness edges, stronger the
closer they are in the tree.  The minimum cut between the terminals labels all
blocks at once; content blocks in page order are the text.

Names of classes and roles that hint at boilerplate, and forms, are evidence
like any other, against all blocks below; a hint that is only a part of a name
(``user-comment``, ``article__sidebar``) weighs less.  They are none on an
element that holds most of the page's text, and none below an article or main
that begins inside the element.  Navigation, asides, footers and hidden
elements are boilerplate for sure.

Blocks whose own evidence outweighs all their edges have that label in every
minimum cut; they are folded into the terminals first, and max-flow runs on
what is left, in phases over shortest paths.  Reading a page takes time linear
in its length whatever its markup: where a tag ends is worked out once for
every quote mark, and elements know the nearest block and hint around them.

Pages are rows of a narrow map: nothing is shuffled or gathered.  Defined
results: null or empty html, or a page without text: the empty text; broken
markup is read as far as it goes (an unclosed script, style or comment hides
the rest of the page, any other unclosed element that is not shown only its
own start tag; a head ends at its end tag or at the first element or text that
may not stand in it); repeated rows give repeated rows; an empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_EVENT = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAME = re.compile(r"[a-z]+")

# fixed sets of element and attribute names
# elements whose content is not shown, with their end tags; RAW has none but text until there
UNSEEN = {x: re.compile(rf"</{x}\s*>", re.I) for x in "script style noscript template svg iframe object textarea select title".split()}
RAW = frozenset("script style".split())
HEAD = frozenset("base basefont bgsound link meta noscript script style template title head".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub "
                   "sup time tt u var wbr label img picture source acronym".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FORM = frozenset("form fieldset".split())
AWAY = frozenset("nav aside footer menu dialog button head".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navigation navbar menu "
    "breadcrumb breadcrumbs pagination pager sidebar widget footer masthead cookie cookies consent notice notices gdpr banner "
    "alert newsletter subscribe subscription signup login popup modal overlay comment comments disqus respond reply replies "
    "related share sharing social toolbar copyright legal complementary contentinfo search toc skip "
    "ad-banner ad-container ad-slot ad-unit comment-body comment-form comment-list comments-area cookie-banner cookie-consent "
    "cookie-notice main-menu main-nav main-navigation nav-menu page-footer related-posts search-form share-buttons site-footer "
    "site-header skip-link social-links social-share table-of-contents widget-area".split())
# parts that turn a hint in the same name into a remark on the page's layout
LAYOUT = frozenset("no has with without".split())
MAIN = frozenset("article main".split())
BODY = frozenset("content post entry story article main".split())

FAR = 40.0     # evidence that no neighbourhood outweighs
NEXT = 0.8     # edge between neighbours in page order
SAME = 0.8     # further edge between neighbours under the same element
HINT = 6.0     # evidence of a hint or a form
PART = 4.0     # evidence of a hint that is part of a name
MOST = 0.5     # share of the page's text from which on an element is its frame, and a hint on it says nothing


class _Block:
    __slots__ = ("text", "linked", "tag", "away", "main", "body", "hints", "parent", "against")

    def __init__(self, text, linked, tag, away, main, body, hints, parent):
        self.text, self.linked, self.tag = text, linked, tag
        self.away, self.main, self.body, self.hints, self.parent = away, main, body, hints, parent
        self.against = 0.0


class _Tags:
    """Comments, declarations and tags of a page, in time linear in its length.

    A tag ends at the first ``>`` outside quotes; what has no end is text.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.ends: dict[int, int] = {}        # quote mark that opens a value -> end of the tag around it, -1 if it has none
        self.ahead = (len(page) + 1, -1)      # a place and the first quote mark or > from there on

    def _event(self, x: int) -> int:
        m = _EVENT.search(self.page, x)
        return m.start() if m else -1

    def _end(self, x: int) -> int:
        """Place of the ``>`` that ends a tag whose attributes begin at ``x``; -1 if none does."""
        since, e = self.ahead
        if x < since or -1 < e < x:
            e = self._event(x)
            self.ahead = (x, e)
        way = []
        while e >= 0 and self.page[e] != ">" and e not in self.ends:
            way.append(e)
            close = self.page.find(self.page[e], e + 1)
            e = self._event(close + 1) if close >= 0 else -1
        end = self.ends.get(e, e)
        for quote in way:
            self.ends[quote] = end
        return end

    def next(self, at: int) -> tuple[int, int, str | None, bool, str] | None:
        """The first one from ``at`` on: start, end, name (null unless a tag), is it an end tag, attributes."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            if page.startswith("!--", at):
                end = page.find("-->", at + 3)
                return start, len(page) if end < 0 else end + 3, None, False, ""
            if page.startswith(("!", "?"), at):
                if at < self.last:
                    return start, page.find(">", at + 1) + 1, None, False, ""
            elif (m := _TAG.match(page, start)) and (end := self._end(m.end())) >= 0:
                return start, end + 1, m.group(2).lower(), bool(m.group(1)), page[m.end():end]
        return None


def blocks(page: str) -> tuple[list[_Block], bool]:
    """Text blocks in page order; whether the page marks its main part."""
    found: list[_Block] = []
    # tag, boilerplate for sure (2: hidden), main, body, innermost hint and partial hint, number, place of the block around
    stack: list[tuple] = [("", 0, False, False, (0, 0), 0, 0)]
    opened: dict[str, int] = {}
    outer: dict[int, tuple[int, int]] = {}  # element with a hint -> the hints around it
    numbers = 0
    parts: list[str] = []
    linked = 0
    links = 0
    marked = False
    unclosed: set[str] = set()

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                around = stack[stack[-1][6]]
                found.append(_Block(text, min(1.0, linked / len(text)), around[0], *stack[-1][1:5], around[5]))
            parts.clear()
        linked = 0

    def close(place):
        for tag, *_ in stack[place:]:
            opened[tag] -= 1
        del stack[place:]

    def end_head():
        flush()
        close(len(stack) - 1)

    def text_of(raw):
        nonlocal linked
        if stack[-1][0] == "head" and raw.strip():
            end_head()
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if links:
                linked += len(raw.strip())

    at = 0
    scan = _Tags(page)
    while m := scan.next(at):
        start, end, name, ending, attributes = m
        if start > at:
            text_of(page[at:start])
        at = end
        if name is None:
            continue
        if stack[-1][0] == "head" and name not in HEAD and not ending:
            end_head()
        if name in UNSEEN and not ending:
            # once an element has no end tag, none that follows has
            shut = None if name in unclosed or attributes.endswith("/") and name == "svg" else UNSEEN[name].search(page, at)
            if shut:
                at = shut.end()
            elif name in RAW:
                at = len(page)
            elif not (attributes.endswith("/") and name == "svg"):
                unclosed.add(name)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if ending:
            if name == "a":
                links = max(0, links - 1)
            if opened.get(name):
                if name not in INLINE:
                    flush()
                place = len(stack) - 1
                while stack[place][0] != name:
                    place -= 1
                close(place)
            continue
        if name == "a":
            links += 1
        if name not in INLINE:
            flush()
            links = 0
            # a paragraph or list item ends where the next block begins
            ends = {"li": ("li", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tr": ("tr", "td", "th", "p"),
                    "dd": ("dt", "dd", "p"), "dt": ("dt", "dd", "p"), "option": ("option",)}.get(name, ("p",))
            if stack[stack[-1][6]][0] in ends:
                close(stack[-1][6])
        _, away, main, body, hints, _, around = stack[-1]
        if name in MAIN:
            # the first article or main starts afresh; main also where nothing hides it
            if not main:
                hints = (0, 0)
            if name == "main" and away < 2:
                away = 0
            main, marked = True, True
        if not away and (name in AWAY or (name == "header" and not main)):
            away = 1
        hint, partial = name in FORM, False
        if away < 2 and ("=" in attributes or "hidden" in attributes.lower()):
            for key, value in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), value.strip("\"'").lower()
                if key in ("class", "id", "role", "aria-label") and name not in ("body", "html"):
                    if name not in MAIN:
                        hint = hint or not HINTS.isdisjoint(value.split())
                        partial = partial or any(
                            not HINTS.isdisjoint(x) and LAYOUT.isdisjoint(x)
                            for x in (_NAME.findall(word) for word in value.split() if "-" in word or "_" in word))
                    body = body or not BODY.isdisjoint(_NAME.findall(value))
                    if key == "role" and value == "main":
                        main, marked = True, True
                elif key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "")):
                    away = 2
        if name not in VOID and not attributes.endswith("/"):
            numbers += 1
            if hint or partial:
                outer[numbers] = hints
                hints = (numbers if hint else hints[0], numbers if partial else hints[1])
            opened[name] = opened.get(name, 0) + 1
            stack.append((name, away, main, body, hints, numbers, around if name in INLINE else len(stack)))
    if at < len(page):
        text_of(page[at:])
    flush()
    # a hint on the frame of the page says nothing: the innermost hint around a block holds least
    held = [dict.fromkeys((0, *outer), 0) for _ in range(2)]
    shown = 0
    for b in found:
        if not b.away:
            shown += len(b.text)
            for side in range(2):
                held[side][b.hints[side]] += len(b.text)
    for number in sorted(outer, reverse=True):
        for side in range(2):
            # an element that has only the other kind of hint holds nothing on this side
            held[side][outer[number][side]] += held[side][number]
    for b in found:
        for side, weight in ((1, PART), (0, HINT)):
            if b.hints[side] and held[side][b.hints[side]] < MOST * shown:
                b.against = weight
    return found, marked


def costs(block: _Block, marked: bool) -> tuple[float, float]:
    """Evidence for content and for boilerplate: a linear classifier on place, length, links and punctuation."""
    if block.away:
        return 0.0, FAR
    words = block.text.count(" ") + 1
    score = -0.5
    # a hint inside the main part ends it
    score += 6.0 if block.main and not block.against else (-5.0 if marked else 0.0)
    score += 1.5 if block.body and not block.against else 0.0
    score -= block.against
    score += {"p": 1.5, "pre": 1.5, "blockquote": 1.5, "h": 1.0, "li": -0.5, "td": -0.3}.get(
        "h" if block.tag[:1] == "h" and block.tag[1:].isdigit() else block.tag, 0.0)
    score += min(words, 40) / 20.0
    score += 0.8 if block.text[-1] in ".!?…\"'”»:" else 0.0
    score -= 4.0 * block.linked
    return (score, 0.0) if score >= 0 else (0.0, -score)


def minimum_cut(content: list[float], other: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the content side; a node that either side may have goes to content."""
    n = len(content)
    content, other = list(content), list(other)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # fold nodes that are sure into the terminals
        i = todo.popleft()
        if label[i] is not None:
            continue
        gap = content[i] - other[i]
        if abs(gap) < sum(near[i].values()) or (gap < 0 and -gap == sum(near[i].values())):
            continue
        label[i] = gap >= 0
        for j, w in near[i].items():
            (content if label[i] else other)[j] += w
            del near[j][i]
            todo.append(j)
        near[i].clear()
    left = [i for i in range(n) if label[i] is None]
    if not left:
        return [bool(x) for x in label]
    # max-flow in phases, each over the shortest paths; nodes n (content terminal) and n + 1
    room: list[dict[int, float]] = [dict(x) for x in near] + [{}, {}]
    for i in left:
        room[n][i], room[i][n] = content[i], 0.0
        room[i][n + 1], room[n + 1][i] = other[i], 0.0
    while True:
        far = {n: 0}
        queue = deque([n])
        while queue and n + 1 not in far:
            x = queue.popleft()
            for y, c in room[x].items():
                if c > 1e-9 and y not in far:
                    far[y] = far[x] + 1
                    queue.append(y)
        if n + 1 not in far:
            break
        arcs = {x: list(room[x]) for x in far}  # those of the phase that may still carry flow
        way = [n]
        while way:
            x = way[-1]
            if x == n + 1:
                flow = min(room[a][b] for a, b in zip(way, way[1:]))
                full = None
                for k, (a, b) in enumerate(zip(way, way[1:])):
                    room[a][b] -= flow
                    room[b][a] += flow
                    if full is None and room[a][b] <= 1e-9:
                        full = k
                del way[full + 1:]  # on from the start of the first arc that is full
                continue
            out = arcs[x]
            while out and not (room[x][out[-1]] > 1e-9 and far.get(out[-1]) == far[x] + 1):
                out.pop()
            if out:
                way.append(out[-1])
            else:
                way.pop()
                if way:
                    arcs[way[-1]].pop()
    # the greatest content side: all that cannot reach the other terminal any more
    other_side = {n + 1}
    queue = deque([n + 1])
    while queue:
        y = queue.popleft()
        for x in room[y]:
            if x not in other_side and room[x].get(y, 0.0) > 1e-9:
                other_side.add(x)
                queue.append(x)
    for i in left:
        label[i] = i not in other_side
    return [bool(x) for x in label]


def main_text(page: str | None) -> str:
    """Main text of one page: content blocks joined by an empty line."""
    if not page:
        return ""
    found, marked = blocks(page)
    both = [costs(b, marked) for b in found]
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, NEXT))
        if b.parent in last:
            edges.append((last[b.parent], i, SAME))
        last[b.parent] = i
    kept = minimum_cut([c for c, _ in both], [o for _, o in both], edges)
    return "\n\n".join(b.text for b, k in zip(found, kept) if k)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            piece = batch.slice(lo, 200)
            out = [main_text(x.as_py()) for x in piece.column("html")]
            yield pa.record_batch({"id": piece.column("id"), "text": pa.array(out, pa.string()),
                                   "n_chars": pa.array([len(x) for x in out], pa.int64())})


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: str | None = "url") -> DataFrame:
    """id, ``keep`` (a column to carry, by default the URL), ``text`` and ``n_chars`` per page row."""
    held = F.struct(F.col(id_col).alias("a"), *([F.col(keep).alias("b")] if keep else []))
    one = pages.select(held.alias("id"), F.col(html_col).alias("html"))
    kind = one.schema["id"].dataType.simpleString()
    out = one.mapInArrow(_rows, f"id {kind}, text string, n_chars long")
    return out.select(F.col("id.a").alias(id_col), *([F.col("id.b").alias(keep)] if keep else []), "text", "n_chars")
