"""HTML extraction by consensus host paths.

1. Each page's containers are scored by the running text in them (link text counts
   against it), and the page votes for the path of its best one: the innermost outside
   which there are only links, teasers and one lone word at most. A
   path is the container's ancestors as generalised ``tag.class`` steps, with all their classes: digits become #.
2. Votes are counted by host and path in Spark. A host's winning paths are those with a
   tenth of its votes at least (ten at most, therefore), by votes.
3. Each page is extracted again from the first winning path that it has; a page
   that has none keeps its own best container.

Below a chosen container, menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are left out by tag, role and class. Class and id
count on layout elements only and by whole names: one that only begins or ends with such
a word (as the ids made from headings do) drops an element only if links are half its text. Headings
that stand in an article's own header stay; its other text (author, date, standfirst) goes with
the header. A form that holds half the page's running text, with ``FIELD_CHARS`` of it for each
field, is the page's layout and no form. A formula gives its characters; ``hidden=until-found``
is content. A paragraph that is one link, outside the article's container, is a menu.

Time and memory are linear in the html: containers know their parent and their range of
blocks, and a path becomes text for the chosen container alone.

Every block lies in the root ``html>body``, whether the page has these tags or not. A page
without running text outside links casts no vote and gives what the root holds.

Defined cases: null and empty html give the empty text; a page without any tag is a body
(of ``parse`` itself it has no blocks); an open head ends where its content can't be a head's; a null or odd url belongs to the
host ''; repeated pages vote each; markup that breaks off is closed at its end; an empty
table gives no rows; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import small_side, stored

#: Winning paths are broadcast for up to so many hosts; more are shuffled.
HOSTS = 100_000
LEAST_VOTES = 0.1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_OPEN_END = re.compile(r"<[a-zA-Z/!?].*\Z", re.S)  # a tag that breaks off
_TAG = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"([a-zA-Z][-\w:]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_STEP = re.compile(r"\d+")

#: The container of everything; html and body tags open no other.
ROOT = "html>body"
PATH = ">"

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg object xmp annotation annotation-xml".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split())
IN_HEAD = frozenset("base link meta".split()) | RAW
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key ends an open element of these, up to the stop elements.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = frozenset("ul ol dl table article section body html".split())
PARAGRAPH_STOPS = STOPS | {"div", "td", "li"}

FIELDS = frozenset("input textarea select".split())

SKIP_TAGS = frozenset("nav footer aside menu dialog button select head".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
SKIP_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead banner cookie cookies consent gdpr notice notices newsletter subscribe "
    "subscription signup popup modal overlay promo promotion sponsor sponsored ad ads advert adverts advertisement advertising comment comments commentlist disqus "
    "respond reply replies related recommended recommendations share sharing social widget pagination pager toolbar toc skip form login".split())
#: Those that an id made from a heading is unlikely to be.
SKIP_IDS = frozenset("nav navbar breadcrumb breadcrumbs sidebar footer masthead cookie cookies gdpr newsletter modal overlay popup ad ads comments commentlist disqus pager pagination toolbar toc widget".split())
#: Layout elements, whose class and id count.
NAMEABLE = frozenset("div section ul ol dl table fieldset details center dir figure header hgroup".split())
#: Words that say nothing about the content of what they name.
LAYOUT = frozenset(
    "page site main body content article articles post posts entry story stories news text title header head list lists item items row col column columns group panel "
    "box boxes bar block area region zone slot unit section wrap wrapper container inner outer top bottom left right primary secondary global local sub "
    "mobile desktop small large sticky fixed link links button buttons icon icons".split())
HEADER = frozenset(["header"])


#: Containers that can be an article, and words by which others say that they only lead to one.
HOLDERS = frozenset("html body main article section div td center form".split())
TEASERS = frozenset("teaser teasers".split())
#: A single word shorter than this, alone outside the article, is no running text.
LONE_WORD = 20
#: Running text for each field from which a form may be the layout of a page.
FIELD_CHARS = 100


@dataclass
class Block:
    """A run of text between block boundaries; ``at``: the innermost open container."""

    at: int
    text: str
    link_chars: int
    chars: int
    heading: bool = False
    paragraph: bool = False


@dataclass
class Page:
    """Containers in the order of their start tags, so that a parent comes before all that it holds."""

    steps: list[list[str]] = field(default_factory=list)  # tag and generalised classes
    parents: list[int] = field(default_factory=list)
    paths: list[int] = field(default_factory=list)  # equal for containers of equal paths
    blocks: list[Block] = field(default_factory=list)
    known: dict[tuple[int, str], int] = field(default_factory=dict)

    def open(self, step: list[str], parent: int) -> int:
        self.steps.append(step)
        self.parents.append(parent)
        above = self.paths[parent] if parent >= 0 else -1
        self.paths.append(self.known.setdefault((above, ".".join(step)), len(self.known)))
        return len(self.steps) - 1

    def path(self, c: int) -> str:
        out = []
        while c >= 0:
            out.append(".".join(self.steps[c]))
            c = self.parents[c]
        return PATH.join(reversed(out))

    def number(self, path: str) -> int | None:
        """The number in ``paths`` of a path, None if the page has no such container."""
        steps = path.removeprefix(ROOT).split(PATH)[1:]
        at = 0 if path == ROOT or path.startswith(ROOT + PATH) else None
        for step in steps if at is not None else ():
            at = self.known.get((at, step))
            if at is None:
                return None
        return at

    def summed(self, values: list[float]) -> list[float]:
        """Each container's own value to the sum of all in it."""
        for c in range(len(values) - 1, 0, -1):
            values[self.parents[c]] += values[c]
        return values

    def inherited(self, marks: set[int]) -> list[int]:
        """How many of ``marks`` each container lies in or is."""
        out = []
        for c, above in enumerate(self.parents):
            out.append((out[above] if above >= 0 else 0) + (c in marks))
        return out

    def ranges(self) -> tuple[list[int], list[int]]:
        """The first block of each container and the one behind its last; a container's blocks follow each other."""
        first, stop = [len(self.blocks)] * len(self.steps), [0] * len(self.steps)
        for k, b in enumerate(self.blocks):
            first[b.at] = min(first[b.at], k)
            stop[b.at] = k + 1
        for c in range(len(self.steps) - 1, 0, -1):
            above = self.parents[c]
            first[above], stop[above] = min(first[above], first[c]), max(stop[above], stop[c])
        return first, stop


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _names(text: str) -> list[list[str]]:
    """The parts of each class or id name; what a layout has or lacks is left out."""
    text = re.sub(r"([a-z])([A-Z])", r"\1-\2", text).lower()
    return [re.findall(r"[^\W\d_]+", t) for t in text.split() if not re.match(r"(?:has|with|no|without)[-_]", t)]


def _named(a: dict[str, str], words: frozenset[str], ids: frozenset[str]) -> tuple[bool, bool]:
    """(whether a name consists of ``words`` and layout words, whether one begins or ends with one of ``words``); ids say the first only by ``ids``."""
    sure = maybe = False
    for attribute, certain in (("class", words), ("id", ids)):
        for parts in _names(a.get(attribute, "")):
            sure = sure or not certain.isdisjoint(parts) and all(p in words or p in LAYOUT for p in parts)
            maybe = maybe or bool(parts) and (parts[0] in words or parts[-1] in words)
    return sure, maybe


def _skipped(tag: str, a: dict[str, str]) -> tuple[bool, bool]:
    """(whether the element is left out, whether it is if links are half its text)."""
    if tag in SKIP_TAGS or a.get("role", "").lower() in SKIP_ROLES or a.get("hidden", "until-found").lower() != "until-found" or a.get("aria-hidden", "").lower() == "true":
        return True, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True, False
    return _named(a, SKIP_WORDS, SKIP_IDS) if tag in NAMEABLE else (False, False)


def _step(tag: str, a: dict[str, str]) -> list[str]:
    return [tag, *sorted({_STEP.sub("#", c).replace(PATH, "_").replace(".", "_") for c in a.get("class", "").lower().split()})]


@dataclass
class _Element:
    tag: str
    container: int = -1
    skipped: bool = False
    in_header: bool = False
    in_link: bool = False
    in_heading: bool = False


def parse(source: str) -> Page:
    """Containers and text blocks in page order, without what is skipped. One pass over the whole html."""
    page = Page()
    page.open([ROOT], -1)
    none = _Element("")
    stack: list[_Element] = []
    places: dict[str, list[int]] = {}  # of each open tag its places in the stack
    within = [0]  # open containers
    text: list[str] = []
    links = 0
    doubtful: set[int] = set()  # containers that are left out if links are half their text
    forms: dict[int, int] = {}  # forms and their fields
    open_forms: list[int] = []
    lower = None
    at, end = 0, len(source)
    last = source.rfind(">") + 1  # no tag ends behind it, so none is looked for there

    def top() -> _Element:
        return stack[-1] if stack else none

    def flush() -> None:
        nonlocal links
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if joined:
                page.blocks.append(Block(within[-1], joined, min(links, len(joined)), len(joined), top().in_heading, bool(places.get("p"))))
        links = 0

    def pop() -> None:
        e = stack[-1]
        if e.tag in BLOCK:
            flush()
        stack.pop()
        places[e.tag].pop()
        if e.container >= 0:
            within.pop()
            if open_forms and open_forms[-1] == e.container:
                open_forms.pop()

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def say(piece: str) -> None:
        nonlocal links
        if top().tag == "head" and piece.strip():
            pop()
        e = top()
        if not piece or e.skipped or e.in_header and not e.in_heading:
            return
        text.append(piece)
        if e.in_link:
            links += len(piece.strip())

    while at < end:
        m = _TOKEN.search(source, at, last) if at < last else None
        if m is None:
            if at:
                say(_OPEN_END.sub("", source[at:]))
            break
        say(source[at : m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if places.get(tag):
                for _ in range(len(stack) - places[tag][-1]):
                    pop()
            elif tag in BLOCK:
                flush()
            continue
        tag = (m[2] or m[4] or "").lower()
        if not tag:
            continue
        if top().tag == "head" and tag not in IN_HEAD:
            pop()
        given = m[3] or m[5] or ""
        if tag in FIELDS and open_forms and _attributes(given).get("type", "").lower() not in ("hidden", "submit", "button", "image"):
            forms[open_forms[-1]] += 1
        if tag in RAW:
            if not given.rstrip().endswith("/"):
                lower = lower if lower is not None else source.lower()
                stop = lower.find(f"</{tag}", at) if len(lower) == end else source.find(f"</{tag}", at)
                at = end if stop < 0 else stop
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCK:
            flush()
            # A block ends an open paragraph, and list items, cells and the like end their predecessors.
            for ends, stops in ((("p",), PARAGRAPH_STOPS), (ENDS.get(tag, ()), STOPS)):
                while (k := nearest(ends)) >= 0 and k > nearest(stops):
                    while len(stack) > k:
                        pop()
                    if tag != "tr":
                        break
        if tag in VOID:
            continue
        a = _attributes(given)
        above = top()
        page_head = tag == "header" and above.tag == "body"
        head = tag == "header" or tag in ("div", "section") and _named(a, HEADER, HEADER)[0]
        skipped, doubt = _skipped(tag, a)
        container = -1
        if tag in BLOCK and tag not in HEADINGS and tag not in ("p", "li", "td", "th", "dt", "dd", "tr", "option", "html", "body"):
            container = page.open(_step(tag, a), within[-1])
            within.append(container)
            if doubt:
                doubtful.add(container)
            if tag == "form":
                forms[container] = 0
                open_forms.append(container)
        places.setdefault(tag, []).append(len(stack))
        stack.append(_Element(
            tag, container, above.skipped or page_head or skipped, above.in_header or head, above.in_link or tag == "a", above.in_heading or tag in HEADINGS))
    while stack:
        pop()
    flush()
    _leave_out(page, doubtful, forms)
    return page


def _leave_out(page: Page, doubtful: set[int], forms: dict[int, int]) -> None:
    """Drop the blocks of ``doubtful`` containers that are half links, then those of forms that are no layout."""
    if doubtful:
        own = [0.0] * len(page.steps)
        for b in page.blocks:
            own[b.at] += b.chars - 2 * b.link_chars
        plain = page.summed(own)
        _drop(page, {c for c in doubtful if plain[c] <= 0})
    if forms:
        running = scores(page)
        _drop(page, {c for c, n in forms.items() if 2 * running[c] < running[0] or running[c] < FIELD_CHARS * max(n, 1)})


def _drop(page: Page, gone: set[int]) -> None:
    out = page.inherited(gone)
    page.blocks = [b for b in page.blocks if not out[b.at]]


def scores(page: Page) -> list[float]:
    """Score of each container: the characters of all text below it, less twice those in links."""
    own = [0.0] * len(page.steps)
    for b in page.blocks:
        own[b.at] += max(b.chars - 2.0 * b.link_chars, 0.0)
    return page.summed(own)


def best_container(page: Page) -> int | None:
    """From the outermost container inwards: on to the largest one inside while that loses no running text and no heading."""
    score = scores(page)
    if not score[0]:
        return None
    first, stop = page.ranges()
    largest: dict[int, int] = {}  # of each container the one inside with the highest score, the first of equals
    for c in range(1, len(score)):
        above = page.parents[c]
        if score[c] and page.steps[c][0] in HOLDERS and score[c] > score[largest.get(above, c)] * (above in largest):
            largest[above] = c
    teasers = page.inherited({c for c, step in enumerate(page.steps) if _teaser(step)})
    at = 0
    while at in largest:
        best = largest[at]
        outside = (page.blocks[k] for r in (range(first[at], first[best]), range(stop[best], stop[at])) for k in r)
        if _is_article(outside, at, teasers if not _teaser(page.steps[best]) and 2 * score[best] >= score[at] else None):
            return at
        at = best
    return at


def _is_article(blocks: Iterable[Block], at: int, teasers: list[int] | None) -> bool:
    """If these blocks of ``at`` are more than links, teasers (where given) and one lone word that is no paragraph of ``at``."""
    lone = 0
    for b in blocks:
        if teasers is not None and teasers[b.at] > teasers[at]:
            continue
        if not b.heading:
            if b.chars <= 2 * b.link_chars:
                continue
            own = b.paragraph and b.at == at
            if not own and " " not in b.text and b.text.isalnum() and b.text.isascii() and b.chars < LONE_WORD and not lone:
                lone += 1
                continue
        return True
    return False


def _teaser(step: list[str]) -> bool:
    return not TEASERS.isdisjoint(step[1:])


def best_path(page: Page) -> str | None:
    """The path of the best container."""
    best = best_container(page)
    return None if best is None else page.path(best)


def extract(page: Page, path: str | None) -> str:
    """The text of the blocks in the containers of this path, joined by empty lines. Where
    the path ends in a bare tag that any container could have, it stands for the fullest of
    them. Without a path it is all blocks."""
    wanted = page.number(path or ROOT)
    chosen = {c for c, p in enumerate(page.paths) if p == wanted}
    if len(chosen) > 1 and page.steps[min(chosen)] in (["div"], ["section"], ["td"]):
        score = scores(page)
        chosen = {max(chosen, key=lambda c: (score[c], -c))}
    held = page.inherited(chosen)
    return "\n\n".join(b.text for b in page.blocks if held[b.at])


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)


def _read(source: str | None) -> Page:
    source = source or ""
    return parse(source if _TAG.search(source) else f"<body>{source}")


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        paths = [best_path(_read(h)) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(paths, pa.string())], names=["host", "path"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, used = [], []
        for source, winners in zip(b.column("html").to_pylist(), b.column("paths").to_pylist()):
            page = _read(source)
            path = next((p for p in winners or () if page.number(p) is not None), None) or best_path(page)
            found = extract(page, path)
            if not found:  # the winning container is empty here
                path = best_path(page)
                found = extract(page, path)
            texts.append(found)
            used.append(path or (ROOT if found else None))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(used, pa.string())], names=["page_id", "url", "text", "path"])


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): by votes, ties by path. Votes of a host meet in a partial aggregation; no host's pages are gathered."""
    read = pages.select(host_of(F.col("url")).alias("host"), "html")
    votes = stored(read.mapInArrow(_votes, "host string, path string").where("path IS NOT NULL").groupBy("host", "path").count(), "votes")
    total = votes.groupBy("host").agg(F.sum("count").alias("total"))
    ranked = votes.join(total, "host").where(F.col("count") >= LEAST_VOTES * F.col("total"))
    ranked = ranked.groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("n"), "path"))).alias("ranked"))
    return ranked.select("host", F.col("ranked.path").alias("paths"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, path) of every row."""
    winners = small_side(stored(winning_paths(pages), "paths"), HOSTS)
    read = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html").join(winners, "host", "left")
    kind = dict(pages.dtypes)
    return read.select("page_id", "url", "html", "paths").mapInArrow(_extract, f"page_id {kind['page_id']}, url {kind['url']}, text string, path string")


def page_digest(pages: DataFrame) -> DataFrame:
    return extract_pages(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")
