"""Main text of HTML pages by two-pass block rules.

A page is read once, left to right, into blocks: text between block-level tags, with the share of
it in links, its heading mark and where it stands. Then

1. each block is classified by itself: with much of its text in links it is bad; a short one is
   ambiguous; of the others those with many stop words are good if long and near-good if not, and
   those with few are bad if they have any link, else ambiguous too. The stop words are those of the language that has most of them on the
   page; a page with hardly any is of another language, and its blocks are judged by length and
   links alone.
2. ambiguous (short) and near-good blocks inherit the label of the nearest decided neighbours on
   both sides; a heading that of the text after it. Where both sides differ, the nearer one holds,
   and of equally near ones the good one for near-good blocks, else the bad one.

Where a block stands goes before both passes: menus, page headers, footers, sidebars, notices,
adverts, forms, reader comments and hidden parts, by element, role, class or id, are bad and are
no one's neighbours. Of marked-up articles the pass 1 rules are milder (a block is bad only for its
links, else ambiguous where it is not good), and where they hold the page's text, nothing outside
them is taken; the latter goes for ``main`` too.

Defined results: a null or empty html, and one without good blocks, has an empty text. Broken
markup is read as far as it goes: unclosed elements end with those around them, an unclosed
comment, script or style reaches to the end. Pages of any length are read whole, in one pass.
Repeated rows get equal results, and an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm import common

# Frequent function words of the languages told apart.
STOP_WORDS = {
    "en": "the of and to in a is that it for was on are as with be at by this from or an not have but which you he they we his her were been",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son aux elle cette mais",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando",
}
STOP_SETS = {lang: frozenset(words.split()) for lang, words in STOP_WORDS.items()}
SHORT, LONG = 70, 200  # code points
LOW, HIGH = 0.1, 0.2  # share of stop words
KNOWN_LANGUAGE = 0.05  # below, the page's language isn't one of those above
LINKED, LINKED_ARTICLE = 0.33, 0.67  # share of text in links
OUTSIDE = 4  # articles that hold less than a quarter of the text found outside them aren't the page's

# Names of elements, by what they are to a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset(
    "aside button canvas datalist dialog fieldset footer form head input label legend map menu meter nav noscript object optgroup option output progress search select "
    "svg template title audio video".split()
)
RAW = frozenset("script style textarea xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar tooltip".split())
# Words of a class or id that tell what an element is.
MARKS = frozenset(
    "ad ads adbox adsense adslot advert advertisement advertising adverts banner breadcrumb breadcrumbs consent cookie cookies copyright disclaimer footer gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion "
    "recommended related share sharing sidebar sidenav signup skyscraper social sponsor sponsored subscribe subscription teaser toolbar topbar widget".split()
)
COMMENT_MARKS = frozenset("comment comments commentlist disqus replies reply respond responses".split())
LAYOUT = frozenset("has no not with without".split())  # before a mark: says what a page has, not what it is
CELLS = frozenset("td th caption".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dd": ("dd dt", ("dl",)), "dt": ("dd dt", ("dl",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "tr": ("tr", ("table",)), "option": ("option", ("select",))}

TAG = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|(!--)|[!?/])")
QUOTED = re.compile(r"""((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TOKEN = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
WORD = re.compile(r"[^\W\d_]+")

BODY, MAIN, ARTICLE = 0, 1, 2


@dataclass(slots=True)
class Block:
    text: str
    linked: int  # code points in links
    heading: bool
    level: int  # BODY, MAIN or ARTICLE
    dropped: bool
    label: str = ""


@dataclass(slots=True)
class Place:
    """An open element: what its text is to the page."""

    name: str
    level: int = BODY
    dropped: bool = False
    comment: bool = False
    heading: bool = False
    head_of_article: bool = False


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _marks(attributes: dict[str, str]) -> set[str]:
    """Words of class and id that stand for themselves, such as sidebar but not has-sidebar."""
    found = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in TOKEN.findall(name)]
        found.update(w for before, w in zip(["", *words], words) if before not in LAYOUT)
    return found


def _opened(name: str, attributes: dict[str, str], inside: Place) -> Place:
    place = Place(name, inside.level, inside.dropped, inside.comment, inside.heading or name in HEADINGS, inside.head_of_article)
    marks = _marks(attributes) if "class" in attributes or "id" in attributes else set()
    if name in ("html", "body"):
        return place
    is_article = name == "article" or "articlebody" in attributes.get("itemprop", "").lower().split()
    if marks & COMMENT_MARKS or (is_article and name == "article" and inside.level == ARTICLE and not inside.dropped):
        place.dropped = place.comment = True  # an article in an article is a reader's comment
    elif "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
        place.dropped = True
    elif is_article or name == "main" or attributes.get("role") == "main":
        # a page may have its whole content in a form or an unclosed menu
        place.dropped = inside.comment or bool(marks & {"ad", "ads", "advert", "promo", "promoted", "related", "sponsored", "teaser"})
        place.level = max(inside.level, ARTICLE if is_article else MAIN)
    elif name == "header" and inside.level == ARTICLE:
        place.head_of_article = True  # its headings are the article's
    elif name in DROPPED or name == "header" or attributes.get("role") in ROLES:
        place.dropped = True
    elif marks & MARKS:
        if inside.level == ARTICLE and marks & MARKS == {"header"}:
            place.head_of_article = True
        else:
            place.dropped = True
    return place


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, without labels."""
    found: list[Block] = []
    open_ = [Place("")]
    pieces: list[str] = []
    linked = link = breaks = 0  # link: depth of the stack where the link opened, 0 outside links
    quotes = True
    at, size = 0, len(page)

    def say(text: str) -> None:
        nonlocal linked, breaks
        if "&" in text:
            text = html.unescape(text)
        pieces.append(text)
        if not text.isspace():
            breaks = 0
            if link:
                linked += len(text)

    def flush() -> None:
        nonlocal linked, breaks
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                here = open_[-1]
                found.append(Block(text, linked, here.heading, here.level, here.dropped or (here.head_of_article and not here.heading)))
            pieces.clear()
        linked = breaks = 0

    def close(down_to: int) -> None:
        nonlocal link
        flush()
        del open_[down_to:]
        if link > len(open_):
            link = 0

    while at < size:
        m = TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        if not m[2]:
            if m[3]:  # <!-- ... -->, also <!--> and <!--->
                end = page.find("-->", m.end() - 2)
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", m.end())
                at = size if end < 0 else end + 1
            continue
        inside = QUOTED.match(page, m.end()) if quotes else None
        if inside:
            at, text = inside.end(), inside[1]
        else:  # a quote that is never closed: from here on tags end at the next >
            quotes = False
            end = page.find(">", m.end())
            at, text = (size, "") if end < 0 else (end + 1, page[m.end() : end])
        name = m[2].lower()
        if m[1]:
            if name == "a":
                link = 0
            elif name == "p" and not any(x.name == "p" for x in open_[-1:]):
                flush()
            elif name in BLOCKS or name in DROPPED:
                flush()
                for depth in range(len(open_) - 1, 0, -1):
                    if open_[depth].name == name:
                        close(depth)
                        break
                    if open_[depth].name in CELLS and name not in ("table", "tr", "tbody", "thead", "tfoot"):
                        break
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else size
            if name in ("textarea", "iframe"):
                flush()
            continue
        if name == "br":
            breaks += 1
            pieces.append(" ")
            if breaks > 1:
                flush()
            continue
        if name == "a":
            link = len(open_) if "href" in text.lower() else 0
            continue
        if name not in BLOCKS and name not in DROPPED:
            continue
        flush()
        if name in VOID:
            continue
        if open_[-1].name == "p" and name in BLOCKS:
            close(len(open_) - 1)
        if name in CLOSES:
            ends, bounds = CLOSES[name]
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].name in ends.split():
                    close(depth)
                    break
                if open_[depth].name in bounds:
                    break
        if open_[-1].name in HEADINGS and name in HEADINGS:
            close(len(open_) - 1)
        open_.append(_opened(name, _attributes(text) if text else {}, open_[-1]))
    flush()
    return found


def _language(texts: list[list[str]]) -> frozenset[str] | None:
    """Stop words of the page's language; None if it is none of those known."""
    total = sum(map(len, texts))
    counts = {lang: sum(sum(map(words.__contains__, text)) for text in texts) for lang, words in STOP_SETS.items()}
    lang = max(counts, key=counts.get)
    return STOP_SETS[lang] if total and counts[lang] >= KNOWN_LANGUAGE * total else None


def _decide(block: Block, words: list[str], stop: frozenset[str] | None) -> str:
    """Pass 1: good, bad, near-good or short."""
    article = block.level == ARTICLE
    if not (block.heading and block.level) and block.linked > (LINKED_ARTICLE if article else LINKED) * len(block.text):
        return "bad"
    if len(block.text) < SHORT:
        return "short"
    if stop is not None:
        share = sum(map(stop.__contains__, words)) / max(1, len(words))
        if share < LOW:
            return "near-good" if article else "bad" if block.linked else "short"
        if share < HIGH:
            return "near-good"
    return "good" if len(block.text) >= LONG else "near-good"


def _inherit(group: list[Block]) -> None:
    """Pass 2 over blocks in page order: undecided ones take the label of the nearest decided neighbours."""
    first = [b.label for b in group]
    decided = [i for i, x in enumerate(first) if x in ("good", "bad")]
    for i, (block, label) in enumerate(zip(group, first)):
        if label in ("good", "bad"):
            continue
        k = bisect_right(decided, i)
        sides = [(abs(j - i), first[j]) for j in decided[max(0, k - 1) : k + 1]]
        if block.heading and k < len(decided):
            sides = [(0, first[decided[k]])]
        if not sides:
            block.label = "bad" if block.linked and label == "short" and block.level != ARTICLE else "good"
        elif len({x for _, x in sides}) == 1:
            block.label = sides[0][1]
        else:
            likely = "good" if block.level == ARTICLE or label == "near-good" else "bad"
            block.label = min(sides, key=lambda x: (x[0], x[1] != likely))[1]


def labelled(page: str) -> list[Block]:
    """The page's blocks in order, each labelled good or bad."""
    found = blocks(page)
    words = [WORD.findall(b.text.lower()) for b in found]
    stop = _language([w for b, w in zip(found, words) if not b.dropped])
    for b, w in zip(found, words):
        b.label = "bad" if b.dropped else _decide(b, w, stop)
    for level in (BODY, MAIN, ARTICLE):
        _inherit([b for b in found if b.level == level and not b.dropped])
    for level in (ARTICLE, MAIN):
        held = sum(len(b.text) for b in found if b.level >= level and b.label == "good")
        other = sum(len(b.text) for b in found if b.level < level and b.label == "good")
        if held and OUTSIDE * held >= other:
            for b in found:
                if b.level < level:
                    b.label = "bad"
            break
    return found


def main_text(page: str | None) -> str:
    """The good blocks, two line feeds between them."""
    return "\n\n".join(b.text for b in labelled(page or "") if b.label == "good")


def page_blocks(pages: DataFrame) -> DataFrame:
    """Every block of every page: page_id, url, number, text, label, linked, heading, dropped."""

    def split(texts: pd.Series) -> pd.Series:
        return pd.Series([[(i, b.text, b.label, b.linked, b.heading, b.dropped) for i, b in enumerate(labelled(t))] for t in texts], dtype=object)

    kind = "array<struct<number:int,text:string,label:string,linked:int,heading:boolean,dropped:boolean>>"
    made = pages.select("page_id", "url", F.pandas_udf(split, kind)(common.whole_text("html")).alias("x"))
    return made.select("page_id", "url", F.explode("x").alias("x")).select("page_id", "url", "x.*")


def extract(pages: DataFrame) -> DataFrame:
    """Every page: page_id, url and its main text."""

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(t) for t in batch], dtype=object)

    return pages.select("page_id", "url", F.pandas_udf(texts, "string")(common.whole_text("html")).alias("text"))
