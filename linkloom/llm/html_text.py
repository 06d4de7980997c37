"""Main text of web pages by line-block distribution.

Markup is stripped and the page becomes lines, one per block of text. Every line has a weight: the length of its text.
The page's markup can only lower it, never raise it:

- lines in page furniture (menus, adverts, forms, notices, reader comments, by element, role or name) weigh nothing, and
  inside of an article they are taken out like scripts, so they don't part it;
- outside of article and main elements, text of links weighs nothing, nor do lines of a few characters that are no paragraph or heading.

Weights are summed over a sliding window of lines. Where the sum leaves zero text surges, where it is zero again it dives; a
stretch between the two is main text if some window in it reaches the surge. Of such stretches all lines but furniture are
kept, whatever they weigh. Where no window reaches the surge, all lines with a weight are kept, and on pages without an
article all that are more than links.

A name doesn't decide alone: an element that holds the bulk of the page's text isn't furniture for its name. Pages are read by a scanner in time linear in their length, however broken they are.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

#: Lines of a window; weight in a window at which text surges; characters of a line below which it weighs nothing outside of articles.
WINDOW, SURGE, SHORT = 3, 120, 30

# Names from the HTML standard, and names that pages give their furniture.
RAW = "script style".split()
MUTED = set("noscript template svg math iframe object select textarea button canvas audio video".split())
#: Of the muted ones, those that no block lies in: they end at the next block.
MUTED_INLINE = set("select button textarea".split())
FURNITURE = "head nav footer aside menu dialog".split()
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead title tr ul".split())
SCOPES = set("article aside body center details dialog dir div dl fieldset figure footer form head header html main menu nav ol section table ul".split())
WRITTEN = set("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
CLEARLY = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|adsense|adbox|banners?|sponsor\w*|promo\w*|cookies?|consent|gdpr|popups?|newsletter|side-?bars?|nav|navbar|navigation|menus?|breadcrumbs?"
    r"|site-?header|page-?header|footers?|copyright)(?![a-z])"
)
NAMED = re.compile(
    r"(?<![a-z])(?:notices?|alerts?|modals?|overlay|subscri\w*|signup|widgets?|toolbar|masthead|share|sharing|social|related|recommend\w*|pagination|pager|login|search)(?![a-z])"
)
COMMENTS = re.compile(r"(?<![a-z])(?:comments?|commentlist|disqus|respond|reply|replies)(?![a-z])")
_ROLES = re.compile(r"(?<![a-z])(?:navigation|banner|contentinfo|complementary|search|form|dialog|alert|menu|menubar)(?![a-z])")

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)")
_STOP = re.compile(r">|=\s*[\"']")
_NAMES = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HREF = re.compile(r"(?<![\w-])href\s*=", re.I)
_LONG_NUMBER = re.compile(r"&#([0-9]{8,});?")
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


class Tokens:
    """The page's texts and tags in order, as (text, tag, is_end, attributes): a text has no tag, a tag no text.

    Quotes are minded only as an attribute's value. A tag that no > ends outside of quotes ends at the first >; from there
    on quotes are not minded, so no part of a page is read more than a few times. With no > left, all the rest is text,
    as is a < that starts nothing. A comment without an end goes to the next >; a script or style without an end, to the
    end of the page.
    """

    def __init__(self, page: str):
        self.page, self.quotes, self.comments = page, True, True

    def tag_end(self, at: int) -> int:
        """The place behind the tag whose name ends at ``at``; 0 if nothing ends it."""
        page, first = self.page, at
        while self.quotes:
            m = _STOP.search(page, at)
            if m and m.group() == ">":
                return m.end()
            close = page.find(page[m.end() - 1], m.end()) if m else -1
            if close < 0:
                self.quotes = False
            at = close + 1
        return page.find(">", first) + 1

    def declaration_end(self, at: int) -> int:
        """The place behind the comment or declaration that starts at ``at``; 0 if nothing ends it."""
        page = self.page
        if page.startswith("<!--", at) and self.comments:
            for short in ("<!-->", "<!--->"):
                if page.startswith(short, at):
                    return at + len(short)
            end = page.find("-->", at + 4)
            if end >= 0:
                return end + 3
            self.comments = False
        return page.find(">", at) + 1

    def __iter__(self) -> Iterator[tuple[str, str, bool, str]]:
        page, at, text_from = self.page, 0, 0
        while (at := page.find("<", at)) >= 0:
            m, tag = _OPEN.match(page, at), ""
            if m:
                end, tag = self.tag_end(m.end()), m[2].lower()
            elif page.startswith(("<!", "<?"), at):
                end = self.declaration_end(at)
            else:
                at += 1
                continue
            if not end:
                break
            if at > text_from:
                yield page[text_from:at], "", False, ""
            if tag:
                yield "", tag, bool(m[1]), page[m.end() : end - 1]
                if tag in RAW and not m[1]:
                    close = _ENDS[tag].search(page, end)
                    end = (page.find(">", close.end()) + 1 if close else 0) or len(page)
            at = text_from = end
        if text_from < len(page):
            yield page[text_from:], "", False, ""


def decoded(text: str) -> str:
    """Text with character references decoded, of numbers of any length."""
    if "&" not in text:
        return text

    def short(m):
        digits = m[1].lstrip("0") or "0"
        return html.unescape(f"&#{digits};") if len(digits) < 8 else "�"

    return html.unescape(_LONG_NUMBER.sub(short, text) if "&#" in text else text)


class Line:
    """A block's text, its characters outside of links, its place among suspects (0: none), whether it is in an article, and in a paragraph or heading."""

    __slots__ = ("text", "prose", "suspect", "article", "written")

    def __init__(self, text: str, prose: int, suspect: int, article: bool, written: bool):
        self.text, self.prose, self.suspect, self.article, self.written = text, prose, suspect, article, written


#: Kinds of suspects: furniture by its element, comments, furniture by a clear name, by another name.
ELEMENT, TALK, CLEAR, OTHER = "element", "talk", "clear", "other"
#: The part of the page's prose that a suspect must hold, besides a surge of it, not to be furniture (of all, for comments).
PARDON = {TALK: (1, 1), CLEAR: (9, 10), OTHER: (1, 2)}


def suspicion(tag: str, attributes: str, in_article: bool) -> str:
    """What kind of furniture an element may be; empty if none."""
    if tag in FURNITURE or (tag == "header" and not in_article):
        return ELEMENT
    found = OTHER if tag == "form" else ""
    if tag in ("html", "body", "main"):
        return found
    for name, value in _NAMES.findall(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1-\2", value.strip("\"'")).replace("_", "-").lower()
        if name.lower() == "role":
            found = found or (OTHER if _ROLES.search(value) else "")
        elif COMMENTS.search(value):
            return TALK
        elif CLEARLY.search(value):
            found = CLEAR
        elif NAMED.search(value):
            found = found or OTHER
    return found


def lines_of(page: str) -> tuple[list[Line], list[tuple[int, str]]]:
    """The page's lines in order, and its suspects as (suspect around it, kind), the first of which is the page itself.

    An element that isn't closed ends with the element around it.
    """
    out: list[Line] = []
    suspects: list[tuple[int, str]] = [(0, "")]
    stack: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, innermost suspect, in an article
    opened: Counter[str] = Counter()
    muted: list[str] = []  # muted elements that are open, and how many scopes were open around each
    depth: list[int] = []
    parts: list[str] = []
    links, prose, written = False, 0, False

    def flush():
        nonlocal parts, prose
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Line(text, min(prose, len(text)), stack[-1][1], stack[-1][2], written))
        parts, prose = [], 0

    for text, tag, end, attributes in Tokens(page):
        if not tag:
            if not muted:
                text = decoded(text)
                parts.append(text)
                if not links:
                    prose += len(" ".join(text.split()))
            continue
        if tag in MUTED:
            if end and tag in muted:
                while muted.pop() != tag:
                    depth.pop()
                depth.pop()
            elif not end and not attributes.endswith("/") and len(muted) < 64:  # so many at once are one
                muted.append(tag)
                depth.append(len(stack))
        elif tag == "a":
            links = not end and bool(_HREF.search(attributes))
        elif tag in ("br", "td", "th"):
            parts.append(" ")
        elif tag in BLOCKS:
            while muted and muted[-1] in MUTED_INLINE and tag not in ("option", "optgroup"):
                muted.pop()
                depth.pop()
            flush()
            written = tag in WRITTEN and not end
            if tag not in SCOPES:
                continue
            if end:
                if opened[tag]:
                    while True:
                        name = stack.pop()[0]
                        opened[name] -= 1
                        if name == tag:
                            break
                    links = False
                    while depth and depth[-1] > len(stack):
                        muted.pop()
                        depth.pop()
            elif not attributes.endswith("/"):
                _, suspect, article = stack[-1]
                kind = suspicion(tag, attributes, article)
                if kind:
                    suspects.append((suspect, kind))
                    suspect = len(suspects) - 1
                stack.append((tag, suspect, article or tag in ("article", "main")))
                opened[tag] += 1
    flush()
    return out, suspects


def furniture_of(lines: list[Line], suspects: list[tuple[int, str]], surge: int = SURGE) -> list[bool]:
    """Which suspects are furniture: all but those that hold a surge of prose and the part of the page's that PARDON says.

    Furniture by its element always is, and its prose isn't counted; nor are comments, but for themselves.
    """
    within, talk = [0] * len(suspects), [0] * len(suspects)  # prose in a suspect, and what comments have of it
    for x in lines:
        within[x.suspect] += x.prose
    for k in range(len(suspects) - 1, 0, -1):  # suspects come after those around them
        around, kind = suspects[k]
        if kind != ELEMENT:
            if kind == TALK:
                talk[k] = within[k]
            within[around] += within[k]
            talk[around] += talk[k]
    out = [False] * len(suspects)
    for k in range(1, len(suspects)):
        around, kind = suspects[k]
        own = kind == ELEMENT
        if not own:
            part, whole = PARDON[kind]
            held, of = (within[k], within[0]) if kind == TALK else (within[k] - talk[k], within[0] - talk[0])
            own = held < surge or (held * whole < of * part if part == whole else held * whole <= of * part)
        out[k] = own or out[around]
    return out


def weight(x: Line, furniture: bool, short: int = SHORT) -> int:
    if furniture:
        return 0
    if x.article:
        return len(x.text)
    return x.prose if x.prose >= short or x.written else 0


def stretches(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """(first, behind the last) of every stretch of main text among lines of these weights."""
    w = np.asarray(weights, dtype=np.int64)
    at = np.flatnonzero(w)
    if not len(at):
        return []
    total = np.concatenate([[0], np.cumsum(w)])
    sums = total[np.minimum(np.arange(len(w)) + window, len(w))] - total[:-1]
    first = np.concatenate([[True], np.diff(at) > window])  # a window between two lines with a weight is empty: a dive
    starts = at[first]
    ends = at[np.concatenate([first[1:], [True]])] + 1
    high = np.concatenate([[0], np.cumsum(sums >= surge)])
    # A window that begins up to window - 1 lines before a stretch holds nothing but lines of it or zeros.
    return [(int(a), int(b)) for a, b in zip(starts, ends, strict=True) if high[b] > high[a]]


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE, short: int = SHORT) -> str:
    """Blocks of the main text joined by two line feeds; empty if the page has none."""
    lines, suspects = lines_of(page or "")
    out = furniture_of(lines, suspects, surge)
    lines = [x for x in lines if not (x.article and out[x.suspect])]
    weights = [weight(x, out[x.suspect], short) for x in lines]
    kept = [x.text for a, b in stretches(weights, window, surge) for x in lines[a:b] if not out[x.suspect]]
    if not kept:  # nothing surges
        article = any(x.article for x in lines)
        kept = [x.text for x, w in zip(lines, weights, strict=True) if (w if article else x.prose and not out[x.suspect])]
    return "\n\n".join(kept)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """The main text of every page, from its whole html, in time linear in its length.

    Returns the id, the url, text and n_chars. Null, empty and textless pages have the empty text, an empty table gives no
    rows, and a null id or url stays null. Repeated rows give repeated results; stretches of equal weight are all kept, so there
    are no ties; other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(p.as_py(), window, surge) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())], names=["id", "url", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    out = map_arrow(rows, run, f"id {kind}, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))
