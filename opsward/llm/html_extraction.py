"""Main text of web pages by line-block distribution.

Markup is stripped to lines: every block-level tag ends one, and every tag of a container adds an empty
one. A line weighs its characters. It weighs nothing in parts that are no article by their element, role,
class or id (menus, page headers, footers, sidebars, notices, adverts, forms, comments). Sums over WINDOW
successive lines then surge where text begins and fall to nothing where it ends, and the lines
between surge and dive are kept.

Where a page marks its article (``article``, ``main``, or a container named like one), only the marked part with
the most text weighs, and every line in it counts, however short. Elsewhere lines that are mostly links
weigh nothing, and a surge needs SURGE characters in a window; if no window reaches that, the heaviest part stays.

Defined cases: null or empty html gives the empty text, as does a page without an article; unclosed elements end
with their parent; an unclosed comment, script or style lasts to the end of the page; repeated pages are
extracted each; an empty table gives an empty result. Each page is one row's work, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 3
SURGE = 80

_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TOKEN = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))
      | <(?P<raw>script|style|title|textarea|iframe|noframes|noembed)(?=[\s/>]){_ATTRIBUTES}(?:>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)|\Z)
      | <(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attributes>{_ATTRIBUTES})(?:>|\Z)
      | <[!?/][^>]*+(?:>|\Z)""",
    re.IGNORECASE | re.DOTALL | re.VERBOSE,
)
_ATTRIBUTE = re.compile(r"""([a-z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

CONTAINERS = frozenset("article aside body details div dl fieldset footer form header main menu nav ol section table ul".split())
BLOCKS = CONTAINERS | frozenset(
    "address blockquote br caption center dd dialog dt figcaption figure h1 h2 h3 h4 h5 h6 head hgroup hr html legend li"
    " option p pre search select summary tbody td tfoot th thead tr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements outside the article; an article inside one of LOOSE (an unclosed menu, a form around the page) counts again.
LOOSE = frozenset("form header menu nav".split())
OUTSIDE = LOOSE | frozenset(
    "aside audio button canvas datalist dialog fieldset footer head noscript object search select svg template video".split()
)
OUTSIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
OUTSIDE_WORDS = frozenset(
    "alert alerts banner breadcrumb breadcrumbs consent cookie cookies copyright footer gdpr login masthead menu menus modal"
    " nav navbar navigation newsletter notice notices overlay pager pagination popup share sharing signup skip social"
    " subscribe toolbar topbar".split()
)
#: What stands in these is foreign even if it calls itself an article.
FOREIGN_WORDS = frozenset(
    "ad ads aside comment comments commentform commentlist disqus promo promos recommended related replies reply respond"
    " sidebar teaser widget widgets".split()
)
FOREIGN_STEMS = ("advert", "sponsor")
#: Words that say what a part has, not what it is: "with-sidebar".
MODIFIERS = frozenset("has hide is js no not show with without".split())
MARKED = re.compile(r"(?:main|article|entry|post|story|page)[-_]?(?:content|body|text)|content|main|article|entry|post|story", re.IGNORECASE)
#: What ends unclosed elements of a kind, up to the next element of BARRIERS.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tr": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
BARRIERS = frozenset("article aside body dl form main menu nav ol section select table ul".split())


@lru_cache(maxsize=10_000)
def part_of(name: str, attributes: str) -> str:
    """What an element is: foreign, outside, header (outside unless in an article), article, marked, or nothing."""
    given = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    role = given.get("role", "").lower()
    if name in ("html", "body"):
        return ""
    if "hidden" in given or re.search(r"display\s*:\s*none", given.get("style", "")):
        return "foreign"
    words = f"{given.get('class', '')} {given.get('id', '')}".split()
    part = "" if name not in OUTSIDE and role not in OUTSIDE_ROLES else "header" if name == "header" else "outside" if name in LOOSE else "foreign"
    for word in words if name != "main" else ():
        parts = {p.lower() for p in _PARTS.findall(word)}
        if MODIFIERS.isdisjoint(parts) and not (name == "article" and len(parts) > 1):
            if not FOREIGN_WORDS.isdisjoint(parts) or any(p.startswith(FOREIGN_STEMS) for p in parts):
                return "foreign"
            if not OUTSIDE_WORDS.isdisjoint(parts):
                part = part or "outside"
            elif "header" in parts and parts.isdisjoint({"article", "entry", "post", "story", "content"}):
                part = part or "header"
    if part:
        return part
    if name in ("article", "main") or role in ("article", "main"):
        return "article"
    if name in CONTAINERS and ("articlebody" in given.get("itemprop", "").lower() or any(MARKED.fullmatch(w) for w in words)):
        return "marked"
    return ""


class _Lines:
    """The lines of a page outside no article: text, characters within links, and marked part (None: unmarked)."""

    def __init__(self, html: str):
        self.lines: list[tuple[str, int, object]] = []
        self.open: list[tuple[str, str, object]] = []
        self.count: Counter[str] = Counter()
        #: What this place is outside by (empty: not), and the marked part it stands in.
        self.outside, self.marked = "", None
        self.n_marked = 0
        self.pieces: list[str] = []
        self.links = at = 0
        for token in _TOKEN.finditer(html):
            self.text(html[at : token.start()])
            at = token.end()
            if name := token["name"]:
                (self.end if token["end"] else self.start)(name.lower(), token["attributes"])
        self.text(html[at:])
        self.finish()

    def text(self, piece: str) -> None:
        if piece and not self.outside:
            piece = unescape(piece)
            self.pieces.append(piece)
            if self.count["a"]:
                self.links += len(piece)

    def finish(self) -> None:
        if self.pieces:
            if text := " ".join("".join(self.pieces).split()):
                self.lines.append((text, self.links, self.marked))
            self.pieces, self.links = [], 0

    def empty(self, n: int = 1) -> None:
        self.lines.extend([("", 0, None)] * n)

    def start(self, name: str, attributes: str) -> None:
        block = name in BLOCKS
        if block:
            self.finish()
            if name != "br":
                self.close("p")
        if name == "a":
            self.close("a")
        if name in ENDS:
            for other in [x for x, _, _ in self.above(BARRIERS) if x in ENDS[name]]:
                self.close(other)
        if name in CONTAINERS:
            self.empty()
        if name in VOID:
            return
        part = part_of(name, attributes)
        self.open.append((name, self.outside, self.marked))
        self.count[name] += 1
        if part in ("foreign", "outside") or part == "header" and self.marked is None:
            if block and not self.outside:
                self.empty(WINDOW)
            if self.outside != "foreign":
                self.outside = part
        elif part == "article" and self.outside != "foreign":
            self.n_marked += 1
            self.outside, self.marked = "", self.n_marked
        elif part == "marked" and not self.outside and self.marked is None:
            self.n_marked += 1
            self.marked = attributes

    def end(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.finish()
            self.close(name)
        elif any(x == name for x, _, _ in self.above(BLOCKS)):
            self.close(name)
        if name in CONTAINERS:
            self.empty()

    def above(self, barriers: frozenset[str]) -> list[tuple[str, str, object]]:
        """Open elements from the innermost up to the first of the barriers, without it."""
        n = len(self.open)
        while n and self.open[n - 1][0] not in barriers:
            n -= 1
        return self.open[n:][::-1]

    def close(self, name: str) -> None:
        """End the innermost open element of this name, if there is one, and all in it."""
        while self.count[name]:
            last, outside, marked = self.open.pop()
            self.count[last] -= 1
            if last in BLOCKS and (outside, marked) != (self.outside, self.marked):
                self.finish()
                if self.outside and not outside:
                    self.empty(WINDOW)
            self.outside, self.marked = outside, marked
            if last == name:
                return


def spans(weights: list[int], surge: int) -> list[tuple[int, int]]:
    """First and last line of each stretch from a surge of the window sums to the dive after it."""
    blocks = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    found, first, high = [], None, 0
    for i, block in enumerate([*blocks, 0]):
        if first is None and block and weights[i]:
            first, high = i, 0
        if first is not None:
            high = max(high, block)
            if not block:
                last = max(k for k in range(max(first, i - WINDOW), i) if weights[k])
                found.append((first, last, high))
                first = None
    sharp = [(a, b) for a, b, high in found if high >= surge]
    return sharp or [max(((a, b) for a, b, _ in found), key=lambda s: sum(weights[s[0] : s[1] + 1]))] if found else []


def main_text(html: str | None) -> tuple[str, int]:
    """The article's text and the number of stretches it was found in."""
    page = _Lines(html or "")
    totals: Counter[object] = Counter()
    for text, _, marked in page.lines:
        totals[marked] += len(text)
    best = max((k for k in totals if k is not None and totals[k]), key=totals.__getitem__, default=None)
    if page.n_marked:
        weights = [len(text) if marked == best else 0 for text, _, marked in page.lines]
    else:
        weights = [0 if 2 * links > len(text) else len(text) for text, links, _ in page.lines]
    if page.n_marked and best is None:
        return "", 0
    found = spans(weights, 1 if page.n_marked else SURGE)
    kept = [text for a, b in found for text, _, marked in page.lines[a : b + 1] if text and marked == best]
    return " ".join(kept), len(found)


_FOUND = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_spans", T.LongType())])


@F.pandas_udf(_FOUND)
def _main_text(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([main_text(h) for h in html], columns=["text", "n_spans"])


def extract_main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns to keep, the main text, its code points, and the number of stretches of lines it came from."""
    name = "_main" + "_" * max(map(len, keep), default=0)
    found = pages.select(*[F.col(f"`{c}`") for c in keep], _main_text(F.col(html).cast("string")).alias(name))
    text = F.col(f"{name}.text")
    return found.select(*[F.col(f"`{c}`") for c in keep], text.alias("text"), F.length(text).cast("long").alias("n_chars"), F.col(f"{name}.n_spans"))
