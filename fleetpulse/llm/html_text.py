"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  Elements that say what they
are (navigation, footers, adverts, forms, comments, ... by tag, role, class or
id) are left out, with the articles in them; an element that only its class or
id names is taken back if it holds decided content and the rest of the page
holds none.  Pass one decides the other blocks by length, link density
and stop-word density: long text with stop words is content, link lists and
long text without stop words are not, and short or middling blocks stay open.
In pass two an open block takes the label of its nearest decided neighbours,
those in its own article before others.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
a about after all also an and any are as at be been but by can could did do for from had has have he her his how i if
in into is it its more no not of on one or our out she so some such than that the their them then there these they this
to up was we were what when which who will with would you your
aber als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem einen einer er es für
hat ich ihr im in ist ja kann mit nach nicht noch nur oder ohne sein sich sie sind so über um und uns von vor war was
wenn wie wir wird zu zum zur
au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais ne nous on ont ou par pas
plus pour qu que qui sa se ses son sont sur un une vous y à
al como con de del el ella en entre era es esta este fue ha hay la las le lo los más me mi muy no nos o para pero por
que se sin sobre su sus también un una y ya
""".split())

#: Elements whose content isn't text.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "canvas", "object", "title")
#: Elements that aren't part of an article.
SIDE = frozenset("nav footer aside form button select menu dialog head option label fieldset".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of a class or id that mark such an element.
SIDE_NAMES = frozenset("""
ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr
notice notification popup modal overlay newsletter subscribe subscription signup login sidebar menu navbar navigation nav
breadcrumb breadcrumbs footer masthead comment comments disqus respond reply replies share sharing social related recommended
widget toolbar pagination pager disclaimer copyright tags
""".split())
#: Words before such a word that make it say what an element has or lacks, not what it is.
SIDE_PREFIXES = frozenset("no non not with without has have hide hides show shows".split())
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th
thead tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A paragraph ends where another block begins.
ENDS_PARAGRAPH = BLOCKS - {"body", "html"}

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>%s)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|</\Z" % "|".join(RAW), re.DOTALL | re.IGNORECASE)
_ATTR = re.compile(r"\b(class|id|role|hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")

GOOD, BAD, OPEN = 1, -1, 0


@dataclass
class Block:
    """One block of a page's visible text; ``region`` numbers the article it is in (0: none)."""

    text: str
    link_chars: int
    region: int
    heading: bool
    label: int = OPEN
    at: int = 0  # where in the page it ends
    linked: bool = False  # mostly links


def named_side(value: str, article: bool, in_article: bool) -> bool:
    """Whether a class or id names such an element; an article's has many words, so the first of a name counts."""
    for one in value.split():
        parts = [p.lower() for p in _NAME_PART.findall(one)]
        for k, part in enumerate(parts[:1] if article else parts):
            if (part in SIDE_NAMES or part == "header" and not in_article and not article) and not (
                    k and parts[k - 1] in SIDE_PREFIXES):
                return True
    return False


def is_side(name: str, attrs: str, in_article: bool, by_name: bool = True) -> str:
    """How an element says of itself that it isn't the article's text: ``kind``, ``name`` (class or id) or not at all."""
    if name in SIDE or (name == "header" and not in_article):
        return "kind"
    if not attrs or name in ("main", "body", "html"):
        return ""
    found = ""
    for kind, *values in _ATTR.findall(attrs):
        kind, value = kind.lower(), "".join(values)
        if kind == "hidden" and value.lower() in ("", "hidden", "true"):
            return "kind"
        if kind == "role" and value.strip().lower() in SIDE_ROLES:
            return "kind"
        if by_name and kind in ("class", "id") and named_side(value, name == "article", in_article):
            found = "name"
    return found


def closed_tags(html: str) -> set[int]:
    """Where the tags begin that a closing tag of their name belongs to."""
    opened: dict[str, list[int]] = {}
    closed = set()
    for m in _MARKUP.finditer(html):
        name = (m["name"] or m["name2"] or "").lower()
        if not name or name in VOID:
            continue
        if not (m["close"] or m["close2"]):
            if not (m["attrs"] or m["attrs2"] or "").endswith("/"):
                opened.setdefault(name, []).append(m.start())
        elif opened.get(name):
            closed.add(opened[name].pop())
    return closed


def blocks_of(html: str, taken: frozenset[int] | None = frozenset()) -> tuple[list[Block], list[tuple[int, int]]]:
    """The blocks of a page outside the elements that say they aren't text, and where those lie that only a class or
    id names; the ones that begin at ``taken`` (None: all of these) aren't left out."""
    out: list[Block] = []
    words: list[str] = []
    link_chars = links = region = regions = 0
    articles = 0
    side, nested = "", 0  # the element being left out, and elements of its name within
    inner = 0  # articles open in it
    named: list[tuple[int, int]] = []
    begun = -1  # where it begins, if its class or id names it
    closed: set[int] | None = None
    side_at = 0
    heading = False

    def flush() -> None:
        nonlocal link_chars
        text = " ".join("".join(words).split())
        if text:
            out.append(Block(text, link_chars, region, heading, at=here))
        words.clear()
        link_chars = 0

    def add(raw: str) -> None:
        nonlocal link_chars
        if side or not raw:
            return
        text = unescape(raw)
        words.append(text)
        if links:
            link_chars += len("".join(text.split()))

    at = here = 0
    for m in _MARKUP.finditer(html):
        add(html[at:m.start()])
        at, here = m.end(), m.start()
        if m["cdata"] is not None:
            add(m["cdata"])
            continue
        name = m["name"] or m["name2"]
        if not name:
            continue
        name, closing = name.lower(), bool(m["close"] or m["close2"])
        attrs = m["attrs"] or m["attrs2"] or ""
        if side:
            if name in ("article", "main") and name != side:
                if closing:
                    ends = inner == 0 and articles > 0  # the article around it
                    inner = max(0, inner - 1)
                else:
                    closed = closed_tags(html) if closed is None else closed
                    ends = name == "main" or side_at not in closed or side == "p"
                    inner += 1
                if not ends:
                    continue
                side = ""
            elif name in ("body", "html") and side != name:
                side = ""  # an unclosed side element ends where the page does
            elif side in ("p", "li") and not closing and (name == side or side == "p" and name in ENDS_PARAGRAPH):
                side = ""
            elif side == "li" and closing and name in ("ul", "ol"):
                side = ""
            elif name == side:
                nested += -1 if closing else 0 if attrs.endswith("/") else 1
                if nested == 0:
                    side = ""
                    if begun >= 0:
                        named.append((begun, m.end()))
                        begun = -1
                    # Its opening tag was counted before it was left out.
                    if name == "article":
                        articles = max(0, articles - 1)
                        region = regions if articles else 0
                continue
            else:
                continue
            if begun >= 0:
                named.append((begun, m.start()))
                begun = -1
        if name in BLOCKS:
            flush()
            links = 0
        elif name == "br":
            words.append(" ")
        if name in ("article", "main"):
            articles = max(0, articles + (-1 if closing else 1))
            if articles and not closing and articles == 1:
                regions += 1
            region = regions if articles else 0
        if name[0] == "h" and name[1:].isdigit():
            heading = not closing
        elif name in BLOCKS:
            heading = False
        if name == "a":
            links = 0 if closing else 1
        if not closing and name not in VOID and not attrs.endswith("/"):
            how = is_side(name, attrs, articles > 0, taken is not None and m.start() not in taken)
            if how:
                flush()
                side, nested, inner, side_at = name, 1, 0, m.start()
                begun = m.start() if how == "name" else -1
    add(html[at:])
    here = len(html)
    flush()
    if begun >= 0:
        named.append((begun, len(html)))
    return out, named


def _latin(text: str) -> bool:
    """Whether most letters are Latin: the stop words' script."""
    letters = [c for c in text if c.isalpha()]
    return 2 * sum(c < "\u0250" for c in letters) >= len(letters)


def stop_density(text: str) -> float:
    found = [w.lower() for w in _WORD.findall(text)]
    return sum(w in STOP_WORDS for w in found) / max(1, len(found))


def decide(block: Block, long_chars: int, min_stop: float, max_links: float, stops: bool = True) -> int:
    """Pass one: a block's label from itself alone; without ``stops``, or in another script, by length and links."""
    text = block.text
    visible = max(1, len(text) - text.count(" "))
    block.linked = block.link_chars / visible > max_links
    if block.linked:
        return BAD
    if "©" in text and len(text) < 2 * long_chars:
        return BAD
    if len(text) < long_chars:
        return OPEN
    if not stops or not _latin(text):
        return GOOD
    density = stop_density(text)
    if density >= min_stop:
        return GOOD
    if block.region or density >= min_stop / 2:
        return OPEN
    return BAD


def inherit(blocks: list[Block]) -> None:
    """Pass two: open blocks take the label of the nearest decided block, content first if two are as near.

    Blocks of an article look at its decided blocks only, and are content
    without any; other blocks look at all, and are content if the page has
    neither a decided block nor an article.  Lists of links in an article
    decide nothing about the blocks beside them.
    """
    decided = [(i, b.region, b.label) for i, b in enumerate(blocks) if b.label != OPEN and not (b.region and b.linked)]
    any_article = any(b.region for b in blocks)
    regions: dict[int, list[tuple[int, int]]] = {}
    for i, region, label in decided:
        regions.setdefault(region, []).append((i, label))
        if region:
            regions.setdefault(0, []).append((i, label))
    for region in {b.region for b in blocks}:
        near = sorted(regions.get(region, []))
        if region and not any(label == GOOD for _, label in near):
            near = []
        k = 0
        for i, b in enumerate(blocks):
            if b.region != region or b.label != OPEN:
                continue
            while k < len(near) and near[k][0] < i:
                k += 1
            sides = near[max(0, k - 1):k + 1]
            if not sides:
                b.label = GOOD if region or not any_article else BAD
                continue
            b.label = max(sides, key=lambda x: (-abs(x[0] - i), x[1]))[1]
            if b.heading and len(sides) == 2 and sides[1][1] == GOOD:
                b.label = GOOD  # a heading goes with what follows


def main_text(html: str, long_chars: int = 70, min_stop: float = 0.2, max_links: float = 0.33) -> str:
    """The article's blocks, one per line."""
    def labelled(taken: frozenset[int] | None = frozenset()) -> tuple[list[Block], list[tuple[int, int]]]:
        blocks, named = blocks_of(html, taken)
        # A page whose long blocks hold next to no stop words is in a language without a list here.
        long = " ".join(b.text for b in blocks if len(b.text) >= long_chars)
        stops = stop_density(long) >= min_stop / 2
        for b in blocks:
            b.label = decide(b, long_chars, min_stop, max_links, stops)
        return blocks, named

    blocks, named = labelled()
    if named and not any(b.region or b.label == GOOD for b in blocks):
        # The names left no content: take the elements back that hold some, else look below the outermost ones too.
        starts = [start for start, _ in named]

        def inside(b: Block) -> int | None:
            k = bisect_left(starts, b.at) - 1
            return starts[k] if k >= 0 and b.at <= named[k][1] else None

        for every in (frozenset(starts), None):
            shown, _ = labelled(every)
            held = {inside(b) for b in shown if b.label == GOOD} | {None}
            if len(held) > 1:
                blocks = [b for b in shown if inside(b) in held]
                break
    inherit(blocks)
    return "\n".join(b.text for b in blocks if b.label == GOOD)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), **rules) -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` (its code points) of every row.

    A null page is empty; a page without main text gets the empty string; a
    text without markup is one block.  Repeated rows keep a row each; other
    columns are ignored; an empty table gives no rows.  Pages are read whole,
    each in one piece of memory.
    """
    source = pages.select(*keep, F.col(html_col).cast("string").alias("_html"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "", **rules) for x in batch.column("_html")]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), sizes],
                                             [*keep, "text", "n_chars"])

    return source.mapInArrow(run, f"{fields}, text string, n_chars long")
