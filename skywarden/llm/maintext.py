"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped so that each block of a page gives one line: its text, or nothing where a menu, notice, advert, form
and the like stood. Text lengths are summed over a window of lines that slides down the page. Where the sum surges from
nothing and where it dives back to nothing, a stretch of text begins and ends; stretches that hold enough text are kept,
with every line between their surge and dive point.

Text of links counts nothing towards a length, so that lists of links make a valley even where no tag names them a menu.
Lines of a marked article count in full however short they are, as nothing of an article may be lost.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lines of a window, characters that a stretch needs in some window, and lines without text that end a stretch.
WINDOW, SURGE = 3, 80
# Pages that are worked on together.
BATCH_ROWS = 256

# Elements by what they mean for the lines of a page (fixed values: names of HTML).
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
_NEVER = {"nav", "footer", "aside", "form", "button", "select", "datalist", "dialog", "menu", "svg", "canvas", "object",
          "audio", "video", "map", "fieldset", "label", "option", "math", "head"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
          "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
          "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table",
          "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "head", "search"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Elements whose end tag may be left out, and the elements whose start ends them.
_ENDED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
             "th": {"td", "th", "tr", "tbody", "tfoot"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "option": {"option"},
             "p": _BLOCK, "head": _BLOCK - {"head"}}
# Elements beyond which an end tag or an implied end does not reach.
_FENCE = {"article", "main", "body", "table", "ul", "ol", "dl", "td", "th"}

# Words in a class, id or role that name a part beside the article.
_BESIDE = frozenset("""
    nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager header masthead topbar banner footer
    colophon sidebar aside complementary widget widgets related recommended recommendations teaser teasers
    ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion
    cookie cookies consent gdpr notice notices notification alert alertdialog popup modal overlay paywall
    comment comments commentlist disqus respond replies discussion form search searchbox login signup subscribe
    subscription newsletter share sharing social skip toolbar contentinfo hidden copyright
""".split())
# In one name with these, such a word does not name the part itself: "has-sidebar", "entry-header".
_NOT_ITSELF = {"no", "has", "with", "without", "layout"}
_HEADING = {"header", "masthead", "banner"}
_TEXT_ITSELF = {"article", "entry", "post", "story", "title"}
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?P<close>>|\Z)", re.S)
_LOOSE = re.compile(r"[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_READ = {"class", "id", "role", "hidden", "aria-hidden", "itemprop", "style"}


@dataclass
class _Line:
    """Text of a block, how much of it is linked, whether it stands in a marked article, whether other text went."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0
    article: bool = False
    dropped: bool = False


def _attributes(rest: str) -> dict[str, str]:
    """The attributes that matter here; of repeated ones the first."""
    if "=" not in rest and "hidden" not in rest:
        return {}
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(rest):
        if name.lower() in _READ:
            found.setdefault(name.lower(), entities.unescape(value.strip("\"'")))
    return found


def _beside(name: str, attributes: dict[str, str], article: bool) -> bool:
    """Does a class, id or role say that this is no part of the article?"""
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return True
    if name in ("html", "body", "main"):
        return False
    named = f"{attributes.get('class', '')} {attributes.get('id', '')} {attributes.get('role', '')}"
    for one in named.split():
        words = {w.lower() for w in _WORDS.findall(one)}
        found = words & _BESIDE
        if found <= _HEADING and (article or words & _TEXT_ITSELF):
            continue
        if found and not words & _NOT_ITSELF:
            return True
    return False


def lines(html: str) -> list[_Line]:
    """One line for each block in page order; blocks beside the article give empty lines."""
    out = [_Line()]
    # Open elements: name, and whether text in them is dropped, linked, in an article, or kept as it is.
    stack: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]
    opened: Counter[str] = Counter()
    at, seen_article = 0, False

    def cut() -> None:
        if out[-1].parts or out[-1].dropped:
            out.append(_Line())

    def text(raw: str) -> None:
        _, drop, linked, article = stack[-1]
        line = out[-1]
        if not raw or (raw.isspace() and not line.parts):
            return
        if drop:
            line.dropped = True
            return
        found = entities.unescape(raw) if "&" in raw else raw
        line.parts.append(found)
        line.article = article
        if linked:
            line.linked += len(found.strip())

    def shut(k: int) -> None:
        """Close the open elements from number ``k`` on."""
        block = any(x[0] in _BLOCK for x in stack[k:])
        opened.subtract(x[0] for x in stack[k:])
        del stack[k:]
        if block:
            cut()

    def find(name: str, fence: set[str]) -> int:
        for k in range(len(stack) - 1, 0, -1) if opened[name] else ():
            if stack[k][0] == name:
                return k
            if stack[k][0] in fence:
                break
        return 0

    while (m := _next_tag(html, at)) is not None:
        start, end, closing, name, rest = m
        text(html[at:start])
        at = end
        if not name:
            continue
        if closing:
            if k := find(name, _FENCE if name not in _FENCE and name not in _NEVER else set()):
                shut(k)
            elif name in ("p", "br"):
                cut()
            continue
        if name in _RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = close.end() if close else (len(html) if name != "title" else at)
            continue
        for open_name, enders in _ENDED_BY.items():
            if name in enders and (k := find(open_name, _FENCE - {open_name})):
                shut(k)
        if name == "br":
            text(" ")
            continue
        if name in _BLOCK:
            cut()
        if name in _VOID:
            continue
        _, drop, linked, article = stack[-1]
        attributes = _attributes(rest)
        real = name in ("article", "main") or attributes.get("itemprop", "").lower() == "articlebody"
        beside = name in _NEVER or (name == "header" and not article) or _beside(name, attributes, article)
        if real and not beside and drop and not seen_article and not any(x[0] in _NEVER for x in stack):
            # What was taken for something beside the article holds it.
            drop = False
        if real and not (drop or beside):
            seen_article = article = True
        opened[name] += 1
        stack.append((name, drop or beside, linked or name == "a", article and not beside))
    text(html[at:])
    return out


def _next_tag(html: str, at: int) -> tuple[int, int, bool, str, str] | None:
    """First and past the last character of the next piece of markup, whether it ends an element, name and the rest."""
    while (start := html.find("<", at)) >= 0:
        m = _TOKEN.match(html, start)
        if m:
            return start, m.end(), m["end"] == "/", (m["name"] or "").lower(), m["rest"] or ""
        if re.compile(r"</?[a-zA-Z]").match(html, start):
            # A quote that never ends: the tag goes to the next bracket.
            loose = _LOOSE.match(html, start)
            name = re.compile(r"</?([a-zA-Z][^\s/>]*)").match(html, start)
            return start, loose.end(), html[start + 1] == "/", name[1].lower(), ""
        if html.startswith("</", start):
            loose = _LOOSE.match(html, start)
            return start, loose.end(), False, "", ""
        at = start + 1
    return None


def main_text(html: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Blocks of the main text, joined by empty lines; an empty string if there are none."""
    found = [(" ".join("".join(x.parts).split()), x) for x in lines(html or "")]
    marked = any(t and x.article for t, x in found)
    # What a line adds to its windows. Where an article is marked, its lines count in full and others not at all.
    weight = [0 if not t or (marked and not x.article) else len(t) + surge if marked else max(0, len(t) - x.linked)
              for t, x in found]
    total = [0, *accumulate(weight)]
    n = len(weight)
    sums = [total[min(n, k + window)] - total[k] for k in range(n)]
    kept: list[str] = []
    k = 0
    while k < n:
        if not sums[k]:
            k += 1
            continue
        # Surge: the first line of the first window with text. Dive: the window behind the last line with any.
        dive = k
        while dive < n and sums[dive]:
            dive += 1
        if max(sums[k:dive]) > surge:
            inside = [i for i in range(k, dive) if weight[i]]
            kept += [found[i][0] for i in range(inside[0], inside[-1] + 1) if found[i][0] and (not marked or found[i][1].article)]
        k = dive
    return "\n\n".join(kept)


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (page_id, url, html and any other columns).

    The whole html is read, however long. Null or empty html, and pages without a stretch of text, give an empty text.
    Markup that is cut off or never closed ends with the page or the element around it. Repeated rows give repeated
    results; null ids and urls stay null. An empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = [main_text(html.as_py()) for html in part["html"]]
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(texts, pa.string())],
                                                 ["page_id", "url", "text"])

    read = pages.select("page_id", "url", "html")
    types = dict(read.dtypes)
    out = read.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
