"""Main text of web pages by line-block distribution.

A page is stripped of markup into lines, one per block of text, white space inside a
line as one space; a block element that closes without text is an empty line, tags around
other blocks make none. Text inside elements that never hold the article (menus, headers,
footers, sidebars, adverts, forms, scripts, reader comments) leaves an empty line, as do
hidden parts, but not within an article element. Each line counts its length without link text, wherever it stands; the bounds
of an article element are dives. Sums of these lengths over sliding windows of
`WINDOW` lines form the distribution: a surge is where the sum rises above the
threshold, a dive where it falls to nothing again; the text between them is kept, and
short blocks before the surge that no dive parts from it. On a page without any surge the
highest sum is one.

A page is read in time linear in its length, whatever its tags look like.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entidex.llm.common import map_texts

#: Lines per window, and the sum that starts a run.
WINDOW, SURGE = 3, 80

#: Fixed values of HTML: elements whose content is no markup, elements without content,
#: inline elements (all others start a new line).
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "select")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())

#: Elements and roles that never hold the article.
OUTSIDE = frozenset("nav header footer aside form button menu dialog head fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
#: Words of class and id names that mark the same.
MARKED = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies footer header login masthead menu nav navbar navigation newsletter notice notices pager pagination popup promo promoted related share sharing sidebar signup social sponsor sponsored subscribe toolbar widget disqus consent".split()
)
MAIN = frozenset(("article", "main"))
#: Words that turn such a name into one of what is around or beside the part.
AROUND = frozenset("has with without no not is layout".split())
#: Elements that an opening tag of the same kind closes.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())

#: What opens with `<`: a comment, an element whose content is no markup, a tag's name, other markup.
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.DOTALL)
RAW_TAG = re.compile("<(" + "|".join(RAW) + r")\b[^>]*>.*?(?:</\1\s*>|\Z)", re.DOTALL | re.IGNORECASE)
TAG_NAME = re.compile(r"<(/?)([A-Za-z][^\s/<>\"']*)")
OTHER = re.compile(r"<[!?/][^>]*(?:>|\Z)")
CUT = re.compile(r"<[A-Za-z][^<>]*\Z")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.IGNORECASE)


def marked(names: str) -> bool:
    """Whether a class or id names a part that never holds the article: `sidebar`, not `has-sidebar`."""
    words = (set(re.findall(r"[a-z]+", name)) for name in names.split())
    return any(not MARKED.isdisjoint(w) and AROUND.isdisjoint(w) for w in words)


def hidden(name: str, attributes: str, by_class: bool = True) -> bool:
    """Whether an element never holds the article, from its name and attributes."""
    if name in OUTSIDE:
        return True
    if not attributes or name in ("body", "html", "article", "main"):
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id") and by_class and marked(value):
            return True
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


class Tags:
    """Tags of a page in order, as (start, end, closes, name, attributes); no name where it is other markup."""

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self.marks = [m.start() for m in re.finditer("[\"'>]", page)]
        self.dead: set[int] = set()  # quotes from which no tag ends

    def end_of(self, at: int) -> int | None:
        """Place of the `>` that ends a tag whose name ends at `at`; those in quotes are none of it.

        A quote that is never closed is a character like others. Searches that found none
        leave their quotes behind, so that no later one goes the same way.
        """
        seen = []
        i = bisect_left(self.marks, at)
        while i < len(self.marks):
            place = self.marks[i]
            mark = self.page[place]
            if mark == ">":
                return place
            if place in self.dead:
                break
            seen.append(place)
            i = i + 1 if place == self.last[mark] else bisect_left(self.marks, self.page.index(mark, place + 1)) + 1
        self.dead.update(seen)
        return None

    def __iter__(self) -> Iterator[tuple[int, int, bool, str, str]]:
        page, at = self.page, self.page.find("<")
        while at >= 0:
            end = at + 1
            other = COMMENT.match(page, at) or at < self.last[">"] and RAW_TAG.match(page, at)
            named = None if other else TAG_NAME.match(page, at)
            close = self.end_of(named.end()) if named else None
            if close is not None:
                end = close + 1
                yield at, end, bool(named.group(1)), named.group(2).lower(), page[named.end() : close]
            elif other := other or OTHER.match(page, at) or CUT.match(page, at):
                end = other.end()
                yield at, end, False, "", ""
            at = page.find("<", end)


def lines(page: str, shown: frozenset = frozenset()) -> list[tuple[str, int]]:
    """Lines of a page as (text, length without links). Where all article elements lie in parts hidden by
    their class or id, those parts are `shown` (starts of their tags).
    """
    out: list[tuple[str, int, bool]] = []
    pieces: list[str] = []
    stack: list[tuple[str, bool, int]] = []
    depth: Counter[str] = Counter()  # open elements by name
    hiding: list[int] = []  # starts of the open hidden elements
    state = {"links": 0, "linked": 0, "main": 0}
    opened = False  # whether the last block tag opened an element
    around: set[int] = set()  # hidden elements that an article element lies in

    def flush(closes: bool = False) -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text or closes and opened and not (hiding and state["main"]):
            out.append((text, max(0, len(text) - state["linked"]), state["main"] > 0))
        pieces.clear()
        state["linked"] = 0

    def leave(name: str) -> None:
        closed = None
        while depth[name] and closed != name:
            closed, was_hidden, _ = stack.pop()
            depth[closed] -= 1
            if was_hidden:
                hiding.pop()
            state["main"] -= closed in MAIN
            state["links"] -= closed == "a"

    at = 0

    def keep(text: str) -> None:
        if text and not hiding:
            pieces.append(text)
            if state["links"]:
                state["linked"] += len(text)

    for start, end, closes, name, attributes in Tags(page):
        keep(page[at:start])
        at = end
        if not name:
            continue
        if name not in INLINE:
            flush(closes or name == "hr")
            opened = not closes
        elif name == "br":
            pieces.append(" ")
        if closes:
            leave(name)
        elif name not in VOID and not attributes.endswith("/"):
            if name in SELF_CLOSING and any(open_name == name for open_name, *_ in stack[-3:]):
                leave(name)
            gone = hidden(name, attributes, start not in shown)
            stack.append((name, gone, start))
            depth[name] += 1
            if name in MAIN:
                # What hides an element already noted is noted too.
                around.update(takewhile(lambda s: s not in around, reversed(hiding)))
            if gone:
                hiding.append(start)
            state["main"] += name in MAIN
            state["links"] += name == "a"
    keep(page[at:])
    flush()
    has_main = any(inside and text for text, _, inside in out)
    if not has_main and around - shown:
        return lines(page, shown | around)
    parted: list[tuple[str, int]] = []
    before = False
    for text, length, inside in out:
        if inside != before:
            parted += [("", 0)] * WINDOW
        parted.append((text, length))
        before = inside
    return parted


def between(page_lines: list[tuple[str, int]], threshold: int) -> list[str]:
    """Texts between the surges and dives of the distribution."""
    lengths = [length for _, length in page_lines]
    sums = [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]
    if sums and any(c.isalnum() for text, length in page_lines if length for c in text):
        threshold = min(threshold, max(sums) - 1)
    kept, i, end = [], 0, 0
    while i < len(sums):
        if sums[i] <= threshold:
            i += 1
            continue
        start = i
        while start > end and sums[start - 1] > 0:
            start -= 1
        while i < len(sums) and sums[i] > 0:
            i += 1
        end = i
        kept += [text for text, _ in page_lines[start:i] if text]
    return kept


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in order, joined by empty lines."""
    if not page:
        return ""
    return "\n\n".join(between(lines(page), SURGE))


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """`id_col` and `text` of every page; empty if there is none or the page is null.

    Repeated rows repeat; an empty table gives none; other columns are not read.
    """
    make = lambda: lambda texts: [pa.array([main_text(t) for t in texts], pa.string())]
    return map_texts(pages, id_col, html_col, make, "text string")


def with_url(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`id_col`, `url_col`, `text` and `n_chars`, in one pass over the pages."""
    keyed = pages.select(F.struct(id_col, url_col).alias("page"), html_col)
    found = extract_text(keyed, "page", html_col)
    return found.select(f"page.{id_col}", f"page.{url_col}", "text", F.char_length("text").cast("long").alias("n_chars"))
