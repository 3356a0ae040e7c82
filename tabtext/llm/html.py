"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines, one for each text block. Elements that are boilerplate by their tag or hidden
(menus, footers, forms, scripts, styles) and lines that are mostly links outside an article give empty lines. Text
lengths are summed over sliding windows of ``WIDTH`` lines: a stretch of text surges where the sum rises above
``SURGE`` and dives where it falls to zero.

Candidates are each outermost article, a main element's other text, and elsewhere the stretches whose containers
share a parent. Each weighs the text of its stretches, ``HINT`` times as much in an article or main element; the
heaviest holds the main text, with candidates of at least ``SHARE`` of its text (outside articles, where it is an
article itself, only those with more text). The innermost container of all these is kept whole (an article or main
element up to its own borders), short lines and those after an advert too, with a heading right in front, but
without smaller articles (teasers). If no sum surges, the stretch around the largest sum decides.

Elements with a boilerplate name (a class, id or role that ends in a word of ``NAMES``, words like "box" aside,
unless a word like "has" stands before) are between dives and weigh nothing, unless they hold the page's heaviest
stretch (of ``LONG`` characters or more, so that an advert does not beat a short article; of ``SURGE`` where nothing
surges outside and no article or main element has text there), or the heaviest in an article or main element where
all such text is under a name: those names are overruled, others are not.

Null and empty pages have the empty text. Repeated pages give repeated rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabtext.llm.common import ship_by_value, small_batches

ship_by_value(__name__)

WIDTH = 3
SURGE = 60
HINT = 2
SHARE = 0.5
LONG = 300
# fixed values: HTML element names
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset(("script style textarea title noscript template iframe xmp noembed noframes head nav footer aside "
                     "form button select option datalist menu menuitem dialog svg canvas object embed audio video "
                     "map math").split())
BLOCKS = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
                    "nav ol p pre section summary table tbody td tfoot th thead title tr ul").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"body", "html", "head"}
CONTAINERS = frozenset("article main section div td body center fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# fixed values: words in class, id and role that name boilerplate
NAMES = frozenset(("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar "
                   "menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices "
                   "comment comments commentlist disqus reply replies respond newsletter subscribe subscription signup "
                   "social share sharing related recommended recommendations widget popup modal overlay pagination pager "
                   "toolbar masthead complementary contentinfo search skip login alert").split())
HEADER_NAMES = frozenset("header topbar".split())
# fixed values: words after a name that leave it one, and words before it that tell of another element's
GENERIC = frozenset(("box boxes wrap wrapper container block area section list item items bar panel inner outer unit slot "
                     "top bottom left right main primary secondary mobile desktop").split())
STATES = frozenset("has have with without no not is hide hides show shows".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                   r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
SPLIT = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


def _named(value: str, in_article: bool) -> bool:
    """Whether a token of a class, id or role names boilerplate."""
    for word in value.split():
        parts = [x.lower() for x in SPLIT.findall(word)]
        while len(parts) > 1 and (parts[-1] in GENERIC or parts[-1].isdigit()):
            parts.pop()
        if parts and not STATES.intersection(parts[:-1]) and (parts[-1] in NAMES or not in_article and parts[-1] in HEADER_NAMES):
            return True
    return False


def _boilerplate(tag: str, attrs: str, in_article: bool) -> int:
    """2 by tag or hidden, 1 by name, else 0."""
    if tag in DROPPED:
        return 2
    if tag == "header":
        return 0 if in_article else 2
    if not attrs or tag in ("html", "body"):
        return 0
    named = 0
    for m in ATTR.finditer(attrs):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if tag not in ("article", "main"):
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                return 2
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return 2
        if name in ("class", "id", "role") and _named(value, in_article):
            named = 1
    return named


class Line(NamedTuple):
    text: str  # empty where markup or boilerplate stood
    hint: int  # outermost article or main element around it, or 0
    article: int  # outermost article around it, or 0
    linked: int  # characters of link text
    path: tuple[int, ...]  # open containers, outermost first
    names: tuple[int, ...]  # open elements with a boilerplate name, outermost first
    heading: bool


class Open(NamedTuple):
    tag: str
    bad: bool  # boilerplate by tag or hidden
    name: int  # number of an element with a boilerplate name, or 0
    hint: int  # number of an article or main element, or 0


def lines_of(page: str) -> list[Line]:
    """The page as lines."""
    out: list[Line] = []
    stack: list[Open] = []
    parts: list[str] = []
    path: list[int] = []
    names: list[int] = []
    hints: list[Open] = []  # open article and main elements
    depth = links = linked = serial = 0

    def line(text: str, chars: int, heading: bool) -> Line:
        return Line(text, hints[0].hint if hints else 0, next((x.hint for x in hints if x.tag == "article"), 0),
                    min(chars, len(text)), tuple(path), tuple(names), heading)

    def flush():
        nonlocal parts, linked
        out.append(line(" ".join(entities.unescape("".join(parts)).split()), linked, any(x.tag in HEADINGS for x in stack[-3:])))
        parts, linked = [], 0

    def dive():
        out.extend([line("", 0, False)] * WIDTH)

    def left(x: Open):
        nonlocal depth, links
        depth -= x.bad
        links -= x.tag == "a"
        if x.hint:
            hints.remove(x)
        if x.name:
            names.remove(x.name)

    def pop_to(k: int):
        inside = depth == 0 and any(x.name for x in stack[k:])
        if inside:
            flush()
        while len(stack) > k:
            x = stack.pop()
            left(x)
            if x.tag in CONTAINERS:
                path.pop()
        if inside:
            dive()

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        end = m.start() if m else n
        if end > at and depth == 0:
            parts.append(page[at:end])
            if links:
                linked += end - at
        if not m:
            break
        at = m.end()
        close, tag, attrs = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
        if not tag:
            if m.group().startswith("<![CDATA[") and depth == 0:
                parts.append(entities.escape(m.group()[9:-3], quote=False))
            continue
        tag = tag.lower()
        block = tag in BLOCKS
        if close:
            known = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag), None)
            if block:
                flush()
            if known is not None:
                # an inline close does not reach over an open block
                if block or not any(x.tag in BLOCKS for x in stack[known + 1:]):
                    pop_to(known)
                else:
                    named = depth == 0 and stack[known].name
                    if named:
                        flush()
                    left(stack.pop(known))  # never a container: those are blocks
                    if named:
                        dive()
            continue
        if tag == "br":
            if depth == 0:
                parts.append(" ")
            continue
        if block:
            flush()
            if tag in CLOSES_P:
                # a block ends an open paragraph, but not one outside its own container
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == "p":
                        pop_to(k)
                        break
                    if stack[k].tag in BLOCKS:
                        break
            if tag == "li":
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == "li":
                        pop_to(k)
                        break
                    if stack[k].tag in ("ul", "ol", "menu"):
                        break
        kind = _boilerplate(tag, attrs or "", bool(hints))
        bad = kind == 2
        if tag in RAW:
            e = re.compile(r"</" + tag + r"\s*>", re.I).search(page, at)
            at = e.end() if e else n
            if bad and depth == 0:
                flush()
            continue
        if tag in VOID or (attrs or "").rstrip().endswith("/"):
            continue
        hint = tag in ("article", "main")
        named = kind == 1 and not hint and depth == 0
        if depth == 0 and (bad or named):
            flush()
            dive()
        serial += 1
        # an article that is named boilerplate itself (a comment, a teaser) is no hint
        stack.append(Open(tag, bad, serial if named else 0, serial if hint and kind == 0 else 0))
        depth += bad
        if tag in CONTAINERS:
            path.append(serial)
        if stack[-1].hint:
            hints.append(stack[-1])
        if named:
            names.append(serial)
        links += tag == "a"
    flush()
    return out


def block_sums(lengths: list[int], width: int = WIDTH) -> list[int]:
    """Sum of each line's length and of the ``width`` - 1 lines after it."""
    out, total = [0] * len(lengths), 0
    for i in range(len(lengths) - 1, -1, -1):
        total += lengths[i] - (lengths[i + width] if i + width < len(lengths) else 0)
        out[i] = total
    return out


def stretches(lengths: list[int], surge: int = SURGE, width: int = WIDTH) -> list[tuple[int, int]]:
    """Line ranges between a surge and the next dive; widened to the non-empty windows around the surge."""
    sums, out, i = block_sums(lengths, width), [], 0
    while i < len(sums):
        if sums[i] == 0:
            i += 1
            continue
        j = i
        while j < len(sums) and sums[j] > 0:
            j += 1
        if max(sums[i:j]) >= surge:
            out.append((i, j))
        i = j
    return out


def extract(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    lines = lines_of(page)
    # a line of links is a menu, unless an article or main element holds it
    whole = [len(x.text) if x.hint or 2 * x.linked <= len(x.text) else 0 for x in lines]
    overruled = _overruled(lines, whole)
    lengths = [n if overruled.issuperset(x.names) else 0 for x, n in zip(lines, whole)]
    if not any(lengths):
        return ""
    found = stretches(lengths)
    if not found:
        sums = block_sums(lengths)
        top = max(range(len(sums)), key=lambda i: (sums[i], -i))
        found = [(top, min(top + WIDTH, len(lines)))]
    border, small = _main(lines, lengths, found)
    keep = [n > 0 and x.path[:len(border)] == border and x.article not in small for x, n in zip(lines, lengths)]
    first = keep.index(True)
    before = next((i for i in range(first - 1, -1, -1) if lengths[i]), None)
    if before is not None and lines[before].heading:
        keep[before] = True
    return "\n".join(x.text for x, k in zip(lines, keep) if k)


def _overruled(lines: list[Line], lengths: list[int]) -> set[int]:
    """Elements whose boilerplate name does not count. A stretch never crosses the border of a named element."""
    if not any(x.names for x in lines):
        return set()
    best: dict = {}  # (under a name, in an article or main element) -> heaviest stretch
    for a, z in stretches(lengths, 1):
        for hint in (True, False):
            at = [i for i in range(a, z) if lengths[i] and (lines[i].hint > 0) == hint]
            if at:
                names, text = lines[at[0]].names, sum(lengths[i] for i in at)
                key = (bool(names), hint)
                if key not in best or text > best[key][0]:
                    best[key] = (text, names)
    none = (0, ())
    out = set()
    if (False, True) not in best:
        out.update(best.get((True, True), none)[1])
    weight = {k: (HINT if k[1] else 1) * v[0] for k, v in best.items()}
    outside = max(weight.get((False, True), 0), weight.get((False, False), 0))
    k = max([(True, True), (True, False)], key=lambda k: weight.get(k, 0))
    alone = (False, True) not in best and best.get((False, False), none)[0] < SURGE
    if weight.get(k, 0) > outside and best[k][0] >= (SURGE if alone else LONG):
        out.update(best[k][1])
    return out


def _main(lines: list[Line], lengths: list[int], found: list[tuple[int, int]]) -> tuple[tuple[int, ...], set[int]]:
    """Path of the main text's container, and the articles that are too small to belong to it."""
    text: dict = {}  # candidate -> characters
    border: dict = {}  # candidate -> path
    for a, z in found:
        plain = []
        for i in range(a, z):
            x = lines[i]
            if lengths[i] and x.hint:
                key = (True, x.article or x.hint)
                text[key] = text.get(key, 0) + lengths[i]
                # the element itself is no container of the path only if it was closed out of order
                border[key] = x.path[:x.path.index(x.hint) + 1] if x.hint in x.path else x.path
            elif lengths[i]:
                plain.append(i)
        if plain:
            least = min(SURGE, max(lengths[i] for i in plain))
            path = _shared([lines[i].path for i in plain if lengths[i] >= least])
            key = (False, path[:-1])
            text[key] = text.get(key, 0) + sum(lengths[i] for i in plain)
            border[key] = _shared([border[key], path]) if key in border else path
    top = max(text, key=lambda k: (HINT if k[0] else 1) * text[k])  # the first of equals
    own = {k for k in text if text[k] >= SHARE * text[top] and (k[0] or not top[0] or text[k] > text[top])}
    path = _shared([border[k] for k in own | {top}])
    articles = {x.article for x in lines if x.article}
    return path, articles.difference(k[1] for k in own | {top} if k[0])


def _shared(paths: list[tuple[int, ...]]) -> tuple[int, ...]:
    a, z = min(paths), max(paths)
    n = next((i for i, (x, y) in enumerate(zip(a, z)) if x != y), min(len(a), len(z)))
    return a[:n]


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    small_batches(pages.sparkSession)
    src = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    kinds = dict(src.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return src.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
