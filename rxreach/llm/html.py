"""HTML extraction: two-pass block rules.

A page is read as a stream of tags and text; block-level tags end a block.
Pass 1 decides each block by itself: blocks in containers that never hold the
article (menus, footers, sidebars, forms, notices, adverts, comments) and
blocks that are mostly links are out; long blocks with enough stop words are
in; short blocks without links and headings, linked or not, are undecided.
Inside a marked article a paragraph of prose is in however many links it has,
unless it is one whole link.  Pass 2 gives an undecided block the label of its
nearest decided neighbours: both sides' where they agree, in where a heading
leads to a block that is in or where a block of ordinary prose stands between
the two.  Blocks in barred containers are no neighbours: a short last paragraph
before a footer goes with the article.

Where a page marks its article, blocks outside it are out and undecided blocks
look for neighbours inside it; a mark that holds under a quarter of the prose
outside of it (a teaser) counts for nothing.  Stop words decide only on pages
where some long block has enough of them: prose in a language without a list
goes by its length and links.

Class and id names bar by their parts, except names of a state (``no-sidebar``,
``has-comments``, ``with-social``); names of what also stands around a text
(``tags``, ``share``) bar as the first or last part alone (not ``story-tags-body``).
A long block of prose with few links and many stop words overrules such a name.  A head ends where the body or the first tag
that can't stand in it begins.  A container that bars by its tag and is never
closed on the page bars no such prose either.

Stop words are function words of the languages below; a word counts by its
letters, so marks glued to it don't hide it.

Cases: null and empty pages give an empty text; markup that is cut off or
never closed ends with the page; a comment or script that is never closed runs
to the end; equal rows give equal texts; no rows give no rows; extra columns
pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"<!--(?P<comment>.*?)(?:--!?>|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
                   r"(?P<attrs>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
LETTERS = re.compile(r"[^\W\d_]+")
RAW = frozenset("script style noscript template svg math iframe object textarea title select canvas audio video".split())
OUT = frozenset("nav footer aside form button menu dialog head fieldset".split())
IN_HEAD = RAW | frozenset("head html meta link base basefont bgsound".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = OUT | frozenset("div section article main header ul ol dl table blockquote figure details center body html".split())
BLOCKS = CONTAINERS | HEADINGS | frozenset(
    "p li dd dt tr td th thead tbody tfoot caption pre hr figcaption summary address option legend".split())
BARRING = re.compile(rf"<(/?)({'|'.join(sorted(OUT - {'head'} | {'header'}))})(?=[\s/>])", re.I)
OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
OUT_NAMES = frozenset(
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice popup modal overlay comment comments "
    "reply replies disqus respond share sharing social related recommended newsletter subscribe signup login widget "
    "toolbar pagination pager tags".split())
STOP = frozenset((
    "the of and to in is that it for as was with be by on not he his but at are this have from or an they which "
    "der die das und ist nicht ein eine zu den mit von auf für im dem sich des auch als wie bei oder aus "
    "le la les de des et un une du en est que qui dans pour pas sur au avec ce il par plus ne se "
    "el los las del y una por con para es se lo su al como más pero o").split())
AROUND = frozenset("tags related social share sharing recommended notice widget".split())
STATE = re.compile(r"(?:no|not|non|has|have|with|without)[-_]")
PROSE, FEW_LINKS, DENSE = 200, 0.1, 0.25   # overrule a name: code points; share of linked text; share of stop words
TEASER = 4                               # a marked article under 1/4 of the prose outside it is none
SHORT, LINKS, STOPS = 70, 0.4, 0.12      # code points; share of linked text; share of stop words


class Block:
    __slots__ = ("text", "linked", "heading", "out", "article", "label")

    def __init__(self, text: str, linked: int, heading: bool, out: int, article: bool):
        self.text, self.linked, self.heading, self.out, self.article = text, linked, heading, out, article
        self.label: bool | None = None


def _bars(token: str) -> bool:
    """Whether a class or id name is that of a container that holds no article."""
    if STATE.match(token):
        return False
    parts = [x for x in re.split(r"[_-]+|(?<=[a-z])\d+", token) if x]
    return any(x in OUT_NAMES and (x not in AROUND or i in (0, len(parts) - 1)) for i, x in enumerate(parts))


def _barred(tag: str, attrs: str, article: bool) -> int:
    """0: not barred; 1: by a name, which prose overrules; 2: by tag, role or as hidden."""
    if tag in OUT or tag == "header" and not article:
        return 2
    if not attrs or tag in ("html", "body", "article", "main"):
        return 0
    named = 0
    for name, *values in ATTR.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value in OUT_ROLES or name == "aria-hidden" and value == "true":
            return 2
        if name in ("class", "id") and any(map(_bars, value.split())):
            named = 1
    return 2 if " hidden" in attrs.lower().replace("=", " ") and "overflow" not in attrs.lower() else named


def _unclosed(page: str) -> set[int]:
    """Places of the tags that bar by themselves and have no close tag of their own."""
    still: dict[str, list[int]] = {}
    for m in BARRING.finditer(page):
        opened = still.setdefault(m[2].lower(), [])
        if not m[1]:
            opened.append(m.start())
        elif opened:
            opened.pop()
    return {at for opened in still.values() for at in opened}


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, int, bool]] = []              # tag, barred, article
    text: list[str] = []
    state = {"linked": 0, "heading": False, "link": False, "br": False}

    def end() -> None:
        whole = " ".join(html.unescape("".join(text)).split())
        if whole:
            barred, article = (stack[-1][1], stack[-1][2]) if stack else (0, False)
            out.append(Block(whole, min(state["linked"], len(whole)), state["heading"], barred, article))
        text.clear()
        state.update(linked=0, br=False)

    def say(part: str) -> None:
        if part:
            text.append(part)
            if not part.isspace():
                state["br"] = False
                if state["link"]:
                    state["linked"] += len(" ".join(html.unescape(part).split()))

    at, size = 0, len(page)
    unclosed = _unclosed(page)
    while at < size:
        m = TOKEN.search(page, at)
        say(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at, tag = m.end(), (m["tag"] or "").lower()
        if not tag:
            continue
        if stack and stack[-1][0] == "head" and not m["close"] and tag not in IN_HEAD:
            end()
            stack.pop()
        if tag in RAW:
            if not m["close"] and not (m["attrs"] or "").endswith("/"):
                shut = re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
                at = shut.end() if shut else size
        elif tag == "br":
            if state["br"]:
                end()
            else:
                text.append(" ")
                state["br"] = True
        elif tag == "a":
            state["link"] = not m["close"]
        elif tag in BLOCKS:
            end()
            state["link"], state["heading"] = False, tag in HEADINGS and not m["close"]
            if tag not in CONTAINERS:
                continue
            if not m["close"]:
                barred, article = (stack[-1][1], stack[-1][2]) if stack else (0, False)
                own = _barred(tag, m["attrs"], article)
                if own == 2 and m.start() in unclosed:
                    own = 1
                stack.append((tag, max(barred, own), article or tag in ("article", "main")))
            elif any(s[0] == tag for s in stack):
                while stack.pop()[0] != tag:
                    pass
    end()
    return out


def _stops(text: str) -> float:
    """Share of stop words."""
    words = LETTERS.findall(text.lower())
    return sum(w in STOP for w in words) / max(1, len(words))


def _first_pass(b: Block, stops: float, listed: bool) -> None:
    """``listed``: the page's language has a list of stop words."""
    links, size = b.linked / len(b.text), len(b.text)
    prose = stops >= STOPS or not listed
    if b.out:
        b.label = False
    elif b.heading and (links or size < SHORT):
        b.label = None
    elif links > LINKS:
        b.label = b.article and links < 1 and size >= SHORT and prose
    elif size < SHORT:
        b.label = False if links > LINKS / 2 and not b.article else None
    else:
        b.label = True if prose or b.article else None


def _second_pass(all_blocks: list[Block], marked: bool) -> None:
    all_blocks = [b for b in all_blocks if not b.out]
    decided = [b.label for b in all_blocks]
    after, last = [(None, 0)] * len(all_blocks), (None, 0)
    for i in reversed(range(len(all_blocks))):
        after[i] = last
        if decided[i] is not None:
            last = (decided[i], i)
    before = None
    for i, b in enumerate(all_blocks):
        if decided[i] is not None:
            before = decided[i]
            continue
        ahead = after[i][0]
        sides = {x for x in (before, ahead) if x is not None}
        if not sides:
            b.label = marked
        elif len(sides) == 1:
            b.label = sides.pop()
        else:                                   # a heading belongs to what follows, prose to the article
            b.label = ahead if b.heading else len(b.text) >= SHORT or marked


def extract(page: str | None) -> str:
    """Main text of a whole page: its blocks that are in, joined by a blank line."""
    found = blocks(page or "")
    stops = [_stops(b.text) for b in found]
    for b, share in zip(found, stops):
        if b.out == 1 and len(b.text) >= PROSE and b.linked <= FEW_LINKS * len(b.text) and share >= DENSE:
            b.out = 0
    listed = any(share >= STOPS and len(b.text) >= SHORT for b, share in zip(found, stops) if not b.out)
    for b, share in zip(found, stops):
        _first_pass(b, share, listed)
    held = {x: sum(len(b.text) for b in found if b.label is not False and b.article is x) for x in (False, True)}
    inside = [b for b in found if b.article and not b.out]
    marked = bool(inside) and TEASER * held[True] >= held[False]
    if marked:
        found = inside
    _second_pass(found, marked)
    return "\n\n".join(b.text for b in found if b.label)


def main_text(pages: DataFrame, column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each page's html."""
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in parts:
            yield pd.Series([extract(x) for x in p], dtype=object)

    return pages.withColumn(out, F.pandas_udf(run, "string", F.PandasUDFType.SCALAR_ITER)(F.col(column).cast("string")))
