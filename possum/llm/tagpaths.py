"""Operator 2: main text of a page by tag-path ratios.

A page is read into blocks: the text between block-level tags, with the path
of block-level tags (and classes) from the root to it. Per path the text
length, the punctuation and the link text of its blocks are added up and
divided by their number. The two ratios are smoothed over neighbouring paths
in page order, fused into one score, and a path is content if its score
reaches ``THRESHOLD`` of the page's best. A path is lifted by the best path of
the article or main part it stands in, table cells and all, or else of its
section, so a short heading or closing line is kept with its article. Link text
counts against paths outside article and main only. Class names are a further
factor of a path's score, in articles too: the share of boilerplate words in
them is taken off, and off again by the share of link text, so ``related-work``
holding prose stays and holding links goes. Regions that are boilerplate by
their tag, role or whole class name (menus, headers, footers, sidebars, notices,
adverts, forms, comments) take no part; of a block that holds an inline element
of this kind only that element goes.

Nulls and odd input: a null, empty or text-free page has the text ""; broken
markup is read as far as it goes (an unclosed script or comment runs to the
end, a page cut off inside a tag ends with that tag's text) in time linear in
the page; whole pages are read, whatever their length; repeated rows are extracted
one by one; an empty table gives no rows; other columns pass through, but for
one that has the text column's name.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from possum.llm.tasks import arrow_map

THRESHOLD = 0.25
LIFT = 0.6      # share of the article's or section's best score that its other paths have
OUTSIDE = 0.3   # weight of paths outside article or main, on pages that have one
SMOOTHING = (0.25, 0.5, 0.25)

# fixed values: HTML element classes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"html", "head", "body", "option", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"},
            "tfoot": {"tbody", "thead", "tr", "td", "th"}}
SCOPE = frozenset("html body table ul ol dl select article section div main".split())
SECTION = frozenset("article main section div body td".split())
DROPPED = frozenset("head script style noscript template textarea title iframe object svg canvas audio video map math "
                    "nav footer aside form button select menu dialog xmp noembed noframes search".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                          "toolbar form".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside widget footer masthead topbar toolbar cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing "
    "social related recommended recommendations comment comments respond reply replies disqus pagination pager "
    "copyright legal disclaimer skip byline bio author tag tags discussion feedback reader readers responses policy privacy "
    "follow".split())
# words of a class name that say nothing of what an element holds
PLAIN_NAMES = frozenset(
    "a an the my our your this us with and of for in on at to id js box boxes container wrapper wrap list lists item items "
    "inner outer section sections block blocks area panel region group row col column grid post posts link links button "
    "buttons bar article entry site page content body text top bottom left right small large slot unit cloud form".split())
MAX_DEPTH = 512  # as in browsers; what is nested deeper belongs to the element at this depth

_OPEN = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_STOP = re.compile(r"""=\s*["']|>""")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")


def _name_share(names: str) -> float:
    """The largest share of boilerplate words in one of the class names, plain words apart."""
    best = 0.0
    for name in names.split():
        words = [w for w in (x.lower() for x in _NAME.findall(name)) if w not in PLAIN_NAMES]
        if words:
            best = max(best, sum(w in DROPPED_NAMES for w in words) / len(words))
    return best


def _tag_end(page: str, at: int, quotes: bool) -> int:
    """Where the ``>`` of a tag stands, from its name's end on; -1 if it has none outside quoted values."""
    if not quotes:
        return page.find(">", at)
    while (m := _STOP.search(page, at)) is not None:
        if m[0] == ">":
            return m.start()
        end = page.find(m[0][-1], m.end())
        at = m.end() if end < 0 else end + 1
    return -1


class _Element:
    __slots__ = ("tag", "label", "dropped", "share", "holds_main", "path", "section")

    def __init__(self, tag: str, attrs: str, parent: _Element | None):
        self.tag, self.label, self.holds_main = tag, tag, False
        self.dropped = tag in DROPPED  # by its tag; a class can be outweighed, see holds_main
        self.share = 0.0
        if attrs:
            values = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
            names = f"{values.get('class', '')} {values.get('id', '')}".strip()
            if names:
                self.label = tag + "." + ".".join(sorted(names.split()))
                self.share = _name_share(names) if tag not in ("html", "body", "article", "main") else 0.0
            self.dropped |= ("hidden" in values or values.get("aria-hidden") == "true"
                             or values.get("role", "") in DROPPED_ROLES
                             or "display:none" in values.get("style", "").replace(" ", ""))
        block = tag in BLOCK
        if self.share == 1 or (self.share >= 0.5 and tag == "a"):
            self.dropped = self.dropped or None  # None: dropped unless it holds the main part
        self.path = (f"{parent.path}/{self.label}" if parent else self.label) if block or not parent else parent.path
        self.section = self if tag in SECTION or not parent else parent.section


class _Block:
    __slots__ = ("pieces", "chain")

    def __init__(self, chain: list[_Element]):
        self.pieces: list[tuple[str, bool, _Element | None]] = []  # text, linked, innermost inline element dropped by class
        self.chain = chain


def read_blocks(page: str) -> Iterator[tuple[str, int, list[_Element]]]:
    """(text, characters of it in links, open block-level elements) of every block, in page order."""
    stack: list[_Element] = []
    done: list[_Block] = []
    block: _Block | None = None
    links = 0
    inline: list[_Element] = []  # open inline elements that are dropped, or are unless they hold the main part

    chain: list[_Element] | None = None  # open block-level elements, shared by the blocks they hold

    def add(text: str) -> None:
        nonlocal block, chain
        if not text or (inline and inline[-1].dropped):
            return
        if block is None:
            if chain is None:
                chain = [e for e in stack if e.tag in BLOCK]
            block = _Block(chain)
            done.append(block)
        block.pieces.append((text, links > 0, inline[-1] if inline else None))

    def close(n: int) -> None:
        nonlocal links, block, chain
        for e in reversed(stack[n:]):
            links -= e.tag == "a"
            if inline and inline[-1] is e:
                inline.pop()
            if e.tag in BLOCK:
                block = chain = None
        del stack[n:]

    at, n, last = 0, len(page), page.rfind(">")
    quotes = True  # until a tag is found whose quotes swallow the rest of the page
    over: dict[str, int] = {}  # open elements beyond MAX_DEPTH, by tag
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            add(html.unescape(page[at:lt]))
        if lt == n:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        if lt > last:  # no tag ends any more: a page cut off inside a tag, or plain text
            add(html.unescape(page[lt:]))
            break
        m = _OPEN.match(page, lt)
        if m is None:
            add("<")
            at = lt + 1
            continue
        end = _tag_end(page, m.end(), quotes)
        if end < 0:
            quotes = False
            end = page.find(">", m.end())
        attrs, at = page[m.end():end], end + 1
        tag = m[2].lower()
        if m[1]:
            if over.get(tag):
                over[tag] -= 1
                if tag in BLOCK:
                    block = None
                continue
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag), None)
            if k is not None:
                close(k)
            if tag in BLOCK:
                block = None
            continue
        if tag == "br":
            add(" ")
        if tag in BLOCK:
            if tag in CLOSES_P:
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == "p" or stack[k].tag in SCOPE), None)
                if k is not None and stack[k].tag == "p":
                    close(k)
            if tag in SIBLINGS:
                stop = SCOPE - {"div", "section"}
                k = len(stack)
                for q in range(len(stack) - 1, -1, -1):
                    if stack[q].tag in SIBLINGS[tag]:
                        k = q
                    elif stack[q].tag in stop:
                        break
                close(k)
            block = None
        if tag in VOID:
            continue
        element = _Element(tag, attrs, stack[-1] if stack else None)
        if tag in RAW:
            end = re.compile(f"</{tag}[\\s/>]", re.IGNORECASE).search(page, at)
            at = n if end is None else max(at, page.find(">", end.start()) + 1 or n)
            continue
        if tag in ("article", "main", "h1"):
            for e in stack:
                e.holds_main = True
        if len(stack) >= MAX_DEPTH:
            over[tag] = over.get(tag, 0) + 1
            continue
        stack.append(element)
        if tag in BLOCK:
            chain = None
        if tag not in BLOCK and element.dropped is not False:
            element.dropped = element.dropped or (inline[-1].dropped if inline else None)  # what it stands in goes too
            inline.append(element)
        links += tag == "a"
    for b in done:
        pieces = [(text, linked) for text, linked, e in b.pieces if e is None or e.holds_main]
        text = _SPACE.sub(" ", "".join(text for text, _ in pieces)).strip()
        if text:
            yield text, sum(len(t.strip()) for t, linked in pieces if linked), b.chain


def _boilerplate(chain: list[_Element]) -> bool:
    inside = False
    for e in chain:
        if e.dropped or (e.dropped is None and not e.holds_main):
            return True
        inside = inside or e.tag in ("article", "main")
        if e.tag == "header" and not inside:
            return True
    # an article's own header keeps its headings
    head = any(e.tag == "header" for e in chain)
    return head and not any(re.fullmatch("h[1-6]", e.tag) for e in chain)


def _named(chain: list[_Element]) -> float:
    """What the class names leave of a path's score: 1 without boilerplate words."""
    return math.prod(1 - e.share for e in chain if not e.holds_main)


def _smooth(values: list[float]) -> list[float]:
    padded = [values[0], *values, values[-1]]
    return [sum(w * x for w, x in zip(SMOOTHING, padded[k:k + 3], strict=True)) for k in range(len(values))]


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The content blocks of a page, joined by newlines."""
    blocks = list(read_blocks(page or ""))
    gone = {key: _boilerplate(chain) for key, chain in {id(chain): chain for _, _, chain in blocks}.items()}
    blocks = [b for b in blocks if not gone[id(b[2])]]
    if not blocks:
        return ""
    paths: dict[str, list] = {}  # path -> blocks, characters, punctuation, link characters, sections, articles, names' weight
    seen: set[int] = set()  # chains
    for text, linked, chain in blocks:
        path = chain[-1].path if chain else ""
        if (p := paths.get(path)) is None:
            p = paths[path] = [0, 0, 0, 0, set(), set(), _named(chain)]
        p[0] += 1
        p[1] += len(text)
        p[2] += len(_PUNCTUATION.findall(text))
        p[3] += min(linked, len(text))
        if id(chain) not in seen:
            seen.add(id(chain))
            p[4].add(id(chain[-1].section) if chain else 0)
            p[5].update(id(e) for e in chain if e.tag in ("article", "main"))
    stats = list(paths.values())
    length = _smooth([p[1] / p[0] for p in stats])
    marks = _smooth([p[2] / p[0] for p in stats])
    scores = [math.log1p(a) * (1 + math.log1p(b)) * (1 if p[5] else 1 - p[3] / p[1]) for a, b, p in zip(length, marks, stats, strict=True)]
    if any(p[5] for p in stats):
        scores = [s * (1 if p[5] else OUTSIDE) for s, p in zip(scores, stats, strict=True)]
    section: dict[int, float] = {}
    for s, p in zip(scores, stats, strict=True):
        for k in p[4] | p[5]:
            section[k] = max(section.get(k, 0.0), s)
    fused = {path: (max(s, LIFT * max(section[k] for k in p[5] or p[4])) if p[5] or p[3] < p[1] else s)
             * p[6] * (1 - (1 - p[6]) * p[3] / p[1])
             for path, s, p in zip(paths, scores, stats, strict=True)}
    limit = threshold * max(fused.values())
    return "\n".join(text for text, _, chain in blocks if fused[chain[-1].path if chain else ""] >= limit)


def extract(pages: DataFrame, html_col: str = "html", column: str = "text") -> DataFrame:
    """pages with the main text in place of the html."""
    if column != html_col:
        pages = pages.drop(column)
    place = pages.columns.index(html_col)
    fields = list(pages.schema.fields)
    fields[place] = T.StructField(column, T.StringType())

    def task(batches):
        for b in batches:
            out = [main_text(x.as_py()) for x in b.column(place)]
            columns = list(b.columns)
            columns[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return arrow_map(pages, task, T.StructType(fields))


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    return extract(pages.select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))
