"""Main-text extraction from HTML by line-block distribution.

Markup is stripped into lines, one per block element. A window of a few lines slides over them and
sums their text lengths (text of links counts nothing). Where the sums surge from zero a region
begins, where they dive to zero it ends; a region counts if its sums reach a threshold, or the page's
own peak if that is lower. If a region lies within an ``article`` or ``main`` element (whose borders are
gaps for the window), all lines of all such elements are kept, link lines before, between and behind the
regions too. Else the region with most text is kept, without short lines at its ends that are in no block of running
text, and with it all regions in the element that encloses its lines, from the first surge to the last dive (link lines
between them too), besides the lines of articles too short for a surge. What carries no article text by its element, role, class or id (menus, page
headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles) leaves no line. An element
that encloses an article or main element is not dropped for being a form or header nor for its role, class
or id (what it encloses is judged by itself), and a form with most of the text of the page's lines is not
dropped; their controls are.

Null or empty html gives the empty text, as does a page without text. Each page is handled alone and
whole, however long; repeated rows give repeated results and an empty table an empty result."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import only

#: Lines in a window, and the sum of text lengths that makes a surge.
WINDOW, SURGE = 3, 80

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select|object|canvas|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>|<[!?/][^>]*>""", re.S | re.I)  # quotes count behind = alone
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text goes on in the line they stand in; any other begins and ends a line.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr td th".split())
DROPPED = frozenset("head nav footer aside form button dialog menu video audio map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset("nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar footer masthead topbar ad ads adv advert "
                  "adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
                  "notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
                  "recommended recommendations comment comments disqus respond replies widget widgets pagination pager search "
                  "toolbar copyright disclaimer skip hidden".split())
#: Words that make a name such as "share-buttons" or "related-posts" out of one of these; any other makes it a name of its own.
PARTS = frozenset("area articles bar block box button buttons container form icons inner item items link links list outer panel posts section "
                  "slot stories top unit wrap wrapper bottom left right".split())
#: Names of reader comments that may also name a part of an article; they count if what follows looks like comments.
TALK = frozenset("discussion discussions feedback responses reactions thread".split())
TALKED = re.compile(r"""(?i)(?:class|id)\s*=\s*["']?[^"'>]*(?:comment|reply|avatar|author|user)|<time\b|\b(?:reply|replied|says|wrote|posted|commented)\b""")
TALK_AHEAD = 1500
#: Blocks that hold running text; other short lines at the ends of a region are no part of it.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt figcaption".split())
SHORT = 40
#: With one of these the element may hold the article itself.
HOLDERS = frozenset("article main wrapper container layout page with has site".split())


class Line(NamedTuple):
    """Text, its length without links, article number, tag of its block, and the tokens that open the elements it stands in."""

    text: str
    length: int
    article: int
    tag: str
    path: tuple[int, ...]


def widget(value: str) -> bool:
    """Whether a class or id attribute has a name that is a boilerplate word, alone or with words of ``PARTS``."""
    return any((words := set(re.split(r"[^a-z]+", name)) - {""}) & NAMES and not words - NAMES - PARTS for name in value.split())


def dropped(tag: str, attributes: str, inside: bool, spared: bool = False, ahead: str = "") -> bool:
    """Whether an element is no part of an article; inside: it stands within one, where names count only if they
    are a widget's as a whole; spared: being a form or header, its role, class and id count nothing; ahead: what follows."""
    if tag in DROPPED and not (spared and tag == "form") or tag == "header" and not (inside or spared):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if spared:
            continue
        if name == "role" and value in ROLES:
            return True
        if name in ("class", "id"):
            if TALK & set(value.split()) and TALKED.search(ahead):
                return True
            words = set(re.split(r"[^a-z]+", value))
            if words & HOLDERS and not (inside and widget(value)):
                continue
            if (widget(value) if inside else words & NAMES or "header" in words):
                return True
    return False


def holders(tokens: list[re.Match]) -> set[int]:
    """Which tokens open an element that encloses an article or main element."""
    out: set[int] = set()
    stack: list[tuple[str, int, bool]] = []  # tag, token, whether it is dropped whatever it encloses
    for i, m in enumerate(tokens):
        tag = (m[3] or "br").lower()
        if tag in VOID:
            continue
        if not m[2]:
            if tag in ("article", "main") and not dropped(tag, m[4], True) and not any(gone for _, _, gone in stack):
                out.update(k for _, k, _ in stack)
            if tag == "body":
                stack = [(t, k, False) for t, k, _ in stack]
            stack.append((tag, i, dropped(tag, m[4], True, True)))
        elif any(t == tag for t, _, _ in stack):
            while stack.pop()[0] != tag:
                pass
    return out


def large_forms(html: str, tokens: list[re.Match], spared: set[int]) -> set[int]:
    """Which tokens open a form that holds more than half of the text of the page's lines."""
    forms = {i for i, m in enumerate(tokens) if not m[2] and m[3] and m[3].lower() == "form"} - spared
    if not forms:
        return forms
    held = dict.fromkeys(forms, 0)
    total = sum(len(x[0]) for x in walk(html, tokens, spared | forms, held=held))
    return {i for i in forms if 2 * held[i] > total}


def lines(html: str, everything: bool = False) -> list[Line]:
    """The lines of ``walk``, with the elements spared that enclose an article or most of the page's text."""
    tokens = list(TOKEN.finditer(html))
    spared = set() if everything else holders(tokens)
    return walk(html, tokens, spared if everything else spared | large_forms(html, tokens, spared), everything)


def walk(html: str, tokens: list[re.Match], spared: set[int], everything: bool = False,
         held: dict[int, int] | None = None) -> list[Line]:
    """Every line; article 0 is outside of any. Where an
    article begins or ends there are as many empty lines as a window has. With ``everything`` the lines of
    menus, adverts and the like stand among them (scripts and styles never do). The lengths of lines that end
    within the elements of ``held`` are added up there."""
    out: list[Line] = []
    text: list[str] = []
    linked = at = number = articles = links = 0
    stack: list[str] = []
    opened: list[int] = []  # tokens of the stack
    skip = 0  # height of the stack above which nothing counts
    holder = 0  # height of the stack at which the article was opened
    forms: list[tuple[int, int]] = []  # height of the stack and token of open elements of ``held``

    def end_line() -> None:
        nonlocal linked
        if text:
            line = " ".join("".join(text).split())
            if line:
                own = next((k for k in range(len(stack) - 1, -1, -1) if stack[k] not in INLINE), -1)
                out.append(Line(line, max(0, len(line) - linked), number, stack[own] if own >= 0 else "", tuple(opened[:own + 1])))
                for _, k in forms:
                    held[k] += len(line)
            text.clear()
        linked = 0

    def gap() -> None:
        out.extend([Line("", 0, 0, "", ())] * WINDOW)

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not skip:
            raw = entities.unescape(raw) if "&" in raw else raw
            text.append(raw)
            if links:
                linked += len(" ".join(raw.split()))

    for i, m in enumerate(tokens):
        add(html[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag, block = tag.lower(), tag.lower() not in INLINE
        if tag == "br":  # white space inside a block
            if not skip:
                text.append(" ")
            continue
        if block:
            if not skip:
                end_line()
        elif tag in ("td", "th") and not skip:
            text.append(" ")
        if tag == "a":
            links = 0 if m[2] else 1
        if tag in VOID:
            continue
        if not m[2]:
            stack.append(tag)
            opened.append(i)
            if tag == "body":
                skip = 0  # an unclosed head ends here
            if not skip and (tag == "head" if everything else dropped(tag, m[4], bool(number), i in spared, html[at:at + TALK_AHEAD])):
                skip = len(stack)
                if not block:
                    text.append(" ")
            elif not skip and tag in ("article", "main") and not number:
                gap()
                articles += 1
                number, holder = articles, len(stack)
            if held and not skip and i in held:
                forms.append((len(stack), i))
        elif tag in stack:
            while stack.pop() != tag:
                pass
            del opened[len(stack):]
            if skip > len(stack):
                skip = 0
            while forms and forms[-1][0] > len(stack):
                forms.pop()
            if number and holder > len(stack):
                number = 0
                gap()
    add(html[at:])
    end_line()
    return out


def trimmed(found: list[Line], begin: int, end: int) -> tuple[int, int]:
    """A region without the short lines at its ends that are in no block of running text and end no sentence."""
    def loose(x: Line) -> bool:
        return x.tag not in TEXTUAL and len(x.text) < SHORT and not x.text.endswith((".", "!", "?", ":", "…", "。"))

    while begin < end and loose(found[begin]):
        begin += 1
    while end > begin and loose(found[end - 1]):
        end -= 1
    return begin, end


def around(found: list[Line], regions: list[tuple[int, int]]) -> range:
    """The lines of the region with most text, and from the first to the last region in the element that encloses it."""
    sizes = [sum(x.length for x in found[a:b]) for a, b in regions]
    best = regions[max(range(len(regions)), key=lambda k: (sizes[k], -k))]
    begin, end = trimmed(found, *best)
    if begin == end:
        return range(*best)
    paths = [x.path[:-1] if x.tag in TEXTUAL or x.tag == "li" else x.path for x in found[begin:end]]
    shared = 0
    while all(len(p) > shared and p[shared] == paths[0][shared] for p in paths):
        shared += 1
    home = paths[0][:shared]
    ends = [t for t in (trimmed(found, *r) for r in regions) if t[0] < t[1] and all(x.path[:shared] == home for x in found[t[0]:t[1]])]
    return range(min(t[0] for t in ends), max(t[1] for t in ends))


def main_text(html: str | None) -> str:
    found = lines(html) if html else []
    lengths = [x.length for x in found]
    sums = [sum(lengths[i:i + WINDOW]) for i in range(len(found))]
    least = min(SURGE, max(sums, default=0))
    kept = {k for k, x in enumerate(found) if x.article}
    regions, i = [], 0
    while i < len(found):
        if not sums[i]:
            i += 1
            continue
        end = i
        while end < len(found) and sums[end]:
            end += 1
        if max(sums[i:end]) >= least:
            regions.append((i, end))
        i = end
    # gaps keep regions within articles apart from others
    if regions and not any(k in kept for r in regions for k in range(*r)):
        kept.update(around(found, regions))
    return "\n".join(found[k].text for k in sorted(kept) if found[k].text)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` of ``pages(page_id, url, html)``; rows are independent of each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["page_id", "url", "text"])

    return only(pages, page_id="bigint", url="string", html="string").mapInArrow(run, "page_id bigint, url string, text string")


def article_text(pages: DataFrame) -> DataFrame:
    """The query's rows: the main text and its length in code points."""
    return extract(pages).withColumn("n_chars", F.length("text").cast("bigint"))
