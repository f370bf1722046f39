"""Main text of web pages by two passes of block rules.

One linear scan cuts the html into blocks at block-level tags.  The first pass
decides a block by link density, by stop-word density and length, and by the
container it stands in; short blocks, and long ones whose words say nothing,
stay undecided.  The second pass gives those the label of the nearest decided
neighbours.  Neighbours are looked for within the block's region first (one
``<article>`` or ``<main>``, or all that is outside of these), and a region
without any decided block goes by what it is: an article is text, and what is
outside counts only in pages without an article.

Defined cases: a null or empty html has the empty text.  Tags that never end
take the rest of the page with them, as in browsers; so do comments and
scripts.  White space is Unicode's.  A line break element is white space.
Repeated rows are extracted alike, each on its own.  Other columns pass through
by name; an existing ``text`` or ``n_chars`` is replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import fresh_name, text_or_empty
from .quality_rules import STOP_WORDS
from .tokens import in_chunks

# Elements that begin and end a block.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul template noscript svg math button canvas object "
    "audio video label".split()
)
VOID = frozenset("hr input img br".split())
# Elements whose content is no markup: everything up to the end tag is skipped.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
# Containers that never hold the main text.
HARD = frozenset("head nav aside footer template noscript svg math select button canvas object audio video dialog menu".split())
# Containers that lose this when an <article> or <main> stands inside them.
SOFT = frozenset("form fieldset label legend header".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
HARD_NAMES = frozenset(
    "aside sidebar comment comments discussion disqus replies respond related recommended share sharing social footer "
    "widget breadcrumb breadcrumbs pagination".split()
)
SOFT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu "
    "header masthead toolbar copyright legal disclaimer paywall form search".split()
)
NOT_THAT = frozenset("no not has have with without".split())
# An element of the first kind ends where one of the group begins, looking no further than the scope.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
SCOPES = frozenset("article aside div footer form header main nav section table ul ol menu dl select".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTUAL = HEADINGS | frozenset("p blockquote pre figcaption".split())

SHORT = 70  # characters below which a block stays undecided
LINKS = 0.5  # part of a block's characters inside links, above which it is boilerplate
DENSE, SPARSE = 0.12, 0.04  # stop words among the words: text from the first on, boilerplate below the second

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_REST = re.compile(r"""(?:"[^"]*"|'[^']*'|[^"'>])*+>""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_STOP = frozenset(STOP_WORDS)
_MARKS = ".,;:!?\"'()[]«»“”„"


def _named(names: str) -> tuple[bool, bool]:
    """Whether a class or id value names a (hard, soft) boilerplate container."""
    hard = soft = False
    for name in names.split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        if not parts or parts[0] in NOT_THAT:
            continue
        ends = {parts[0], parts[-1]}
        hard = hard or bool(ends & HARD_NAMES)
        soft = soft or bool(ends & SOFT_NAMES)
    return hard, soft


@dataclass
class Block:
    tag: str
    boilerplate: bool  # by the container it stands in
    region: int  # which <article> or <main>; 0 is outside
    pieces: list[str] = field(default_factory=list)
    in_links: int = 0


@dataclass
class _Open:
    tag: str
    hard: bool
    soft: bool
    region: int
    in_article: bool = False


def blocks(page: str) -> list[Block]:
    """The page's blocks that have text, in order, in one scan whose time is linear in the page."""
    stack = [_Open("", False, False, 0)]
    held: Counter[str] = Counter()
    found: list[Block] = []
    regions = 0
    link_depth = -1  # stack height at which the open <a> began
    current: Block | None = None

    def pop_to(height: int) -> None:
        nonlocal link_depth
        while len(stack) > height:
            held[stack.pop().tag] -= 1
        if link_depth > len(stack):
            link_depth = -1

    def add(raw: str) -> None:
        nonlocal current
        text = entities.unescape(raw) if "&" in raw else raw
        if current is None:
            if text.isspace():
                return
            top = stack[-1]
            current = Block(top.tag, top.hard or top.soft, top.region)
            found.append(current)
        current.pieces.append(text)
        if link_depth >= 0:
            current.in_links += len(" ".join(text.split()))

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        if page.startswith("<!--", lt):
            if page.startswith((">", "->"), lt + 4):
                at = page.index(">", lt) + 1
                continue
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        after = page[lt + 1:lt + 2]
        closing = after == "/"
        name = _NAME.match(page, lt + 1 + closing)
        if not name:
            if closing or after in ("!", "?"):  # doctype, processing instruction, stray end: skipped up to its >
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                add("<")
                at = lt + 1
            continue
        rest = _REST.match(page, name.end())
        if not rest:
            break  # a tag that never ends
        at, tag = rest.end(), name.group().lower()
        if tag in RAW:
            if closing:
                continue
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            if not end:
                break
            close = page.find(">", end.end())
            at = n if close < 0 else close + 1
            continue
        if tag == "a":
            link_depth = -1 if closing else len(stack)
            continue
        if tag == "br":
            if current is not None:
                current.pieces.append(" ")
            continue
        if tag not in BLOCK:
            continue
        current = None
        if closing:
            if held[tag] > 0:
                height = len(stack)
                while stack[height - 1].tag != tag:
                    height -= 1
                pop_to(height - 1)
            continue
        if stack[-1].tag == "p":
            pop_to(len(stack) - 1)
        if held["head"] and stack[-1].tag == "head" and tag not in ("template", "noscript"):
            pop_to(len(stack) - 1)  # an unclosed head ends at the first element of the body
        if tag in ENDS:
            group, scope = ENDS[tag]
            height = len(stack)
            while height > 1 and stack[height - 1].tag not in scope and stack[height - 1].tag not in SCOPES:
                height -= 1
                if stack[height].tag in group:
                    pop_to(height)
                    break
        if tag in VOID:
            continue
        top = stack[-1]
        hard, soft, region, in_article = top.hard, top.soft, top.region, top.in_article or tag == "article"
        if tag in ("article", "main"):
            soft = False
            if not hard and not region:
                regions += 1
                region = regions
        if tag in HARD:
            hard = True
        elif tag in SOFT and not (tag == "header" and in_article):
            soft = True
        attributes = rest.group()
        if "=" in attributes and tag not in ("html", "body", "main"):
            for m in _ATTRIBUTE.finditer(attributes):
                key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
                if key in ("class", "id"):
                    if tag == "article":  # an article's own names say what it has, unless it is a comment itself
                        hard = hard or bool({"comment", "comments"} & set(value.lower().split()))
                        continue
                    by_name = _named(value)
                    hard = hard or by_name[0]
                    if by_name[1] and not (in_article and "header" in value.lower()):
                        soft = True
                elif key == "role" and value.lower() in ROLES:
                    hard = True
        stack.append(_Open(tag, hard, soft, region, in_article))
        held[tag] += 1
    return found


def first_pass(block: Block, text: str) -> bool | None:
    """Text (True), boilerplate (False), or undecided."""
    if block.boilerplate:
        return False
    if block.in_links > LINKS * len(text):
        return None if block.region and block.tag in TEXTUAL else False
    if not block.region and text.lower().startswith(("©", "(c)", "copyright")):
        return False
    if len(text) < SHORT:
        return None
    words = [w.strip(_MARKS).lower() for w in text.split()]
    density = sum(w in _STOP for w in words) / len(words)
    if density >= DENSE:
        return True
    return False if density < SPARSE and not block.region else None


def second_pass(labels: list[bool | None], tags: list[str], default: bool, article: bool = False) -> list[bool]:
    """Undecided blocks of one region inherit from the nearest decided ones on both sides (the edge counts as ``default``).

    Where those differ, a block of an article is text.  Elsewhere the nearer
    one wins; at equal distance a heading follows what comes after it, and other text elements count as text.
    """
    n = len(labels)
    before, after = [(default, n)] * n, [(default, n)] * n  # label, distance
    for near, order, step in ((before, range(n), -1), (after, range(n - 1, -1, -1), 1)):
        last: int | None = None
        for i in order:
            if last is not None:
                near[i] = (bool(labels[last]), abs(i - last))
            if labels[i] is not None:
                last = i
    out = []
    for i, label in enumerate(labels):
        (b, b_far), (a, a_far) = before[i], after[i]
        if label is not None:
            out.append(label)
        elif article:
            out.append(a or b)
        elif a == b or a_far < b_far:
            out.append(a)
        elif b_far < a_far:
            out.append(b)
        else:
            out.append(a if tags[i] in HEADINGS else tags[i] in TEXTUAL)
    return out


def main_text(page: str) -> str:
    """The page's main text: its kept blocks, one a line."""
    found = [(b, " ".join("".join(b.pieces).split())) for b in blocks(page)]
    found = [(b, text) for b, text in found if text]
    by_region: dict[int, list[tuple[int, Block, bool | None]]] = {}
    for i, (b, text) in enumerate(found):
        if not b.boilerplate or not b.region:
            by_region.setdefault(b.region, []).append((i, b, first_pass(b, text)))
    kept: set[int] = set()
    for region in sorted(by_region, reverse=True):
        members = by_region[region]
        if not region and kept:
            break  # the page marks its article
        labels = [label for _, _, label in members]
        default = bool(region) or all(x is None for x in labels)
        final = second_pass(labels, [b.tag for _, b, _ in members], default, bool(region))
        kept.update(i for (i, _, _), keep in zip(members, final) if keep)
    return "\n".join(found[i][1] for i in sorted(kept))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without its html column, plus ``text`` and ``n_chars`` (code points)."""
    passing = [c for c in pages.columns if c.lower() not in (html.lower(), "text", "n_chars")]
    source = fresh_name(pages.select(*[F.col(f"`{c}`") for c in passing]), "__html")
    narrow = pages.select(*[F.col(f"`{c}`") for c in passing], text_or_empty(F.col(f"`{html}`")).alias(source))
    schema = StructType([f for f in narrow.schema.fields if f.name != source] + [StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(batch.schema.names.index(source)).to_pylist()
            rest = batch.drop_columns([source])
            for a, b in in_chunks(raw):
                texts = pa.array([main_text(h) for h in raw[a:b]], pa.string())
                yield pa.RecordBatch.from_arrays([*rest.slice(a, b - a).columns, texts], names=[*rest.schema.names, "text"])

    return narrow.mapInArrow(run, schema).withColumn("n_chars", F.char_length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages)
