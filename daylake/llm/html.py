"""Main text of web pages by composite text density (Sun, Song and Liao, 2011).

Each node's density is its characters per tag, adjusted by what share of them is links. The node with
the greatest sum of its children's densities marks the article; the least density on its path to the
body is the threshold that other regions must reach. Elements that are boilerplate by their kind
(menus, forms, scripts and so on, or a class that says so) are left out before.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import batch, workers_import

# Element names of HTML, by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small"
    " span strike strong sub sup time tt u var wbr"
    " math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover semantics".split()
)
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
LEFT_OUT = RAW | frozenset(
    "head nav footer aside button select option optgroup fieldset input dialog menu svg canvas object embed"
    " audio video map datalist annotation annotation-xml".split()
)
HEAD_ONLY = frozenset("base link meta title style script noscript template".split())
ARTICLE = frozenset(("article", "main"))
#: What a start tag closes if it is open, up to the element named with it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Words in a class, id or role that mark boilerplate.
MARKS = frozenset(
    "ad ads adbox adsense adslot adunit advert adverts advertisement advertising sponsor sponsored promo promotion"
    " promoted nav navbar navigation navigationbar menu menubar breadcrumb breadcrumbs pagination pager sidebar"
    " sidebars sidenav rail masthead topbar footer colophon copyright cookie cookies consent gdpr notice notices"
    " notification notifications alert banner popup modal overlay newsletter subscribe subscription signup login"
    " paywall comment comments commentlist respond replies disqus discussion share sharing social related recommended"
    " recommendations trending outbrain taboola widget widgets toolbar search searchform complementary contentinfo"
    " hidden skip skiplink disclaimer".split()
)
#: Of these, inside an article, where they are words like others, only as the whole of a class, id or role.
WEAK = frozenset(
    "alert search searchform widget widgets rail hidden banner overlay disclaimer toolbar complementary contentinfo"
    " notification notifications discussion popup modal social menu pager".split()
)
#: Marked only outside an article: there, a header is that of the site.
SITE_MARKS = frozenset("header siteheader pageheader".split())

_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
#: Classes that say how a page is laid out, though they name a part of it.
_LAYOUT = re.compile(
    r"(?<!\S)(?:(?:has|no|with|without|overflow)[-_]\S*|elementor-widget(?=-|\s|$)(?:-(?:container|wrap|text-editor|theme-\S*))?)(?!\S)",
    re.IGNORECASE,
)
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE) for tag in RAW}


class Page:
    """Elements in page order as parallel lists; a parent comes before its children."""

    def __init__(self, source: str):
        self.tags, self.parents, self.dropped, self.marked = ["#root"], [-1], [False], [False]
        #: (element, text) in page order; text None is a boundary of blocks.
        self.pieces: list[tuple[int, str | None]] = []
        self._stack, self._open = [0], {"#root": 1}
        self._parse(source)

    def _parse(self, source: str) -> None:
        at, text_from, no_quote_after = 0, 0, {'"': len(source) + 1, "'": len(source) + 1}
        while (at := source.find("<", at)) >= 0:
            head = source[at + 1 : at + 2]
            if not (head.isalpha() and head.isascii()) and head not in ("/", "!", "?"):
                at += 1
                continue
            self._text(source[text_from:at])
            if source.startswith("<!--", at):
                end = source.find("-->", at + 4)
                at = text_from = len(source) if end < 0 else end + 3
                continue
            end = source.find(">", at)
            if end < 0:
                text_from = len(source)
                break
            for quote in "\"'":
                # A tag may hold > within quotes.
                if head.isalpha() and source.count(quote, at, end) % 2 and end < no_quote_after[quote]:
                    closing = source.find(quote, end)
                    if closing < 0:
                        no_quote_after[quote] = end
                    elif (later := source.find(">", closing)) >= 0 and "<" not in source[end:closing]:
                        end = later
            inside = source[at + 1 : end]
            at = text_from = end + 1
            if head == "/":
                if name := _NAME.match(inside, 1):
                    self._close(name[0].lower())
            elif name := _NAME.match(inside):
                tag = name[0].lower()
                self._start(tag, inside[name.end() :])
                if tag in RAW:
                    found = _ENDS[tag].search(source, at)
                    at = text_from = found.end() if found else len(source)
                    self._close(tag)
        self._text(source[text_from:])

    def _text(self, text: str) -> None:
        if text:
            if "head" in self._open and self.tags[self._stack[-1]] == "head" and text.strip():
                self._close("head")
            self.pieces.append((self._stack[-1], text))

    def _boundary(self, element: int) -> None:
        self.pieces.append((element, None))

    def _start(self, tag: str, attributes: str) -> None:
        if self._open.get("head") and tag not in HEAD_ONLY:
            self._close("head")
        if tag not in INLINE and self._open.get("p"):
            self._close("p")
        if tag in CLOSES and any(self._open.get(name) for name in CLOSES[tag][0]):
            closed, within = CLOSES[tag]
            for element in reversed(self._stack):
                if self.tags[element] in within:
                    break
                if self.tags[element] in closed:
                    self._close(self.tags[element])
                    break
        number = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        left_out = tag in LEFT_OUT or (tag == "header" and not any(self._open.get(name) for name in ARTICLE))
        hidden = tag not in ("html", "body", *ARTICLE) and self._hidden(attributes)
        self.dropped.append(left_out or hidden)
        self.marked.append(self._marked(tag, attributes))
        if tag not in INLINE:
            self._boundary(number)
        if tag not in VOID:
            self._stack.append(number)
            self._open[tag] = self._open.get(tag, 0) + 1

    def _marked(self, tag: str, attributes: str) -> bool:
        # A form is no part of an article, but may wrap the whole page.
        if tag == "form":
            return True
        in_article = any(self._open.get(name) for name in ARTICLE)
        if not attributes or tag in ("html", "body", "header", *ARTICLE):
            return False
        for name, *values in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role"):
                given = _LAYOUT.sub(" ", "".join(values))
                if in_article and not WEAK.isdisjoint(given.lower().split()):
                    return True
                for word in re.split(r"[^A-Za-z]+", given):
                    low = word.lower()
                    parts = {low, *(p.lower() for p in _WORD.findall(word))}
                    if parts & (MARKS - WEAK if in_article else MARKS | SITE_MARKS):
                        return True
        return False

    def _hidden(self, attributes: str) -> bool:
        if not attributes:
            return False
        for name, *values in _ATTRIBUTE.findall(attributes):
            if name.lower() == "aria-hidden" and "".join(values).lower() == "true":
                return True
        return bool(re.search(r"\bhidden\b(?!\s*=)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)))

    def _close(self, tag: str) -> None:
        if not self._open.get(tag):
            return
        while True:
            element = self._stack.pop()
            name = self.tags[element]
            self._open[name] -= 1
            if name not in INLINE:
                self._boundary(element)
            if name == tag:
                return

    def _drop_marked(self) -> None:
        """Drop marked elements, except wrappers of the whole article.

        If no article or main element stands outside the marked ones, those that hold one, or that hold most
        of the page's text outside links, are left to the density.
        """
        size, tags = len(self.tags), self.tags
        left_out, under, linked = self.dropped[:], self.marked[:], [False] * size
        for i in range(1, size):
            up = self.parents[i]
            left_out[i] = left_out[i] or left_out[up]
            under[i] = under[i] or under[up]
            linked[i] = tags[i] == "a" or linked[up]
        chars, holds = [0] * size, [False] * size
        for element, text in self.pieces:
            if text and not left_out[element] and not linked[element]:
                chars[element] += len("".join(text.split()))
        for i in range(size - 1, 0, -1):
            up = self.parents[i]
            chars[up] += chars[i]
            holds[up] = holds[up] or holds[i] or (tags[i] in ARTICLE and not left_out[i] and chars[i] > 0)
        plain = any(tags[i] in ARTICLE and chars[i] and not under[i] for i in range(1, size))
        for i in range(1, size):
            if self.marked[i] and (plain or not (holds[i] or 2 * chars[i] > chars[0])):
                self.dropped[i] = True

    def content(self) -> list[bool]:
        """Which elements hold the article."""
        size = len(self.tags)
        if any(self.marked):
            self._drop_marked()
        dropped = self.dropped
        for i in range(1, size):
            dropped[i] = dropped[i] or dropped[self.parents[i]]
        in_link = [False] * size
        for i in range(1, size):
            in_link[i] = self.tags[i] == "a" or in_link[self.parents[i]]
        chars, links, tags, link_tags = ([0] * size for _ in range(4))
        for element, text in self.pieces:
            if text and not dropped[element]:
                count = len("".join(text.split()))
                chars[element] += count
                links[element] += count * in_link[element]
        for i in range(size - 1, 0, -1):
            if not dropped[i]:
                up = self.parents[i]
                chars[up] += chars[i]
                links[up] += links[i]
                tags[up] += tags[i] + 1
                link_tags[up] += link_tags[i] + (self.tags[i] == "a")
        opened = self._follows_text(in_link)
        for i in range(1, size):
            # A list of links alone is a menu, unless it comes after text of the article element it is in.
            if link_tags[i] >= 3 and links[i] > 0.8 * chars[i] and self.tags[i] not in INLINE and not opened[i]:
                dropped[i] = True
            dropped[i] = dropped[i] or dropped[self.parents[i]]
        body = self.tags.index("body") if "body" in self.tags else 0
        share = links[body] / max(1, chars[body])
        density = [0.0] * size
        for i in range(size):
            if chars[i] and not dropped[i]:
                c, lc, t, lt = chars[i], max(1, links[i]), max(1, tags[i]), max(1, link_tags[i])
                base = math.log(c / max(1, c - links[i]) * links[i] + share * c + math.e)
                density[i] = c / t * math.log(max(c * t / (lc * lt), 1.0) + 1) / max(math.log(base), 0.1)
        sums = [0.0] * size
        for i in range(1, size):
            sums[self.parents[i]] += density[i]
        best = max(range(size), key=lambda i: (sums[i] or density[i], -i))
        path = [best]
        while path[-1] > 0 and path[-1] != body:
            path.append(self.parents[path[-1]])
        # The innermost article element around the best node holds all of it, however uneven its parts are.
        within = [i for i in path if self.tags[i] in ARTICLE]
        if within:
            roots = {within[0]}
        else:
            threshold = min((density[i] for i in path), default=0.0)
            roots = {best} | {i for i in range(size) if density[i] >= threshold > 0 and self.tags[i] not in INLINE}
            roots -= set(path[1:])
            if self.parents[best] == body or best == body or not chars[best]:
                roots.add(best)
            else:
                # Plain siblings of the best node that are no links belong to it.
                roots |= {i for i in range(size) if self.parents[i] == self.parents[best] and 2 * links[i] <= chars[i]}
        out = [False] * size
        for i in range(size):
            out[i] = not dropped[i] and (i in roots or (i > 0 and out[self.parents[i]]))
        return out

    def _follows_text(self, in_link: list[bool]) -> list[bool]:
        """Whether each element begins after text, other than links, of the innermost article element around it."""
        size = len(self.tags)
        around, begun, follows = [-1] * size, [False] * size, [False] * size
        for i in range(1, size):
            around[i] = i if self.tags[i] == "article" else around[self.parents[i]]
        met = [False] * size
        for element, text in self.pieces:
            if not met[element]:
                met[element] = True
                follows[element] = around[element] >= 0 and begun[around[element]]
            if text and around[element] >= 0 and not in_link[element] and not self.dropped[element] and text.strip():
                begun[around[element]] = True
        return follows

    def text(self) -> str:
        """Text of the article: references decoded, white space collapsed, blocks joined by a space."""
        inside = self.content()
        blocks: list[str] = []
        run: list[str] = []
        for element, text in self.pieces:
            if text is None:
                blocks.append(entities.unescape("".join(run)))
                run = []
            elif inside[element]:
                run.append(text)
        blocks.append(entities.unescape("".join(run)))
        return " ".join(word for block in blocks for word in block.split())


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for part in batches:
        for at in range(0, part.num_rows, rows):
            some = part.slice(at, rows)
            texts = [main_text(source) for source in some.column(2).to_pylist()]
            yield batch(RESULT, some.column(0), some.column(1), texts, [len(t) for t in texts])


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html).

    Null and empty html give an empty text; broken html is read as far as it goes: an open tag, comment
    or script at the end takes what follows. Null ids and urls stay null, repeated rows give repeated
    rows, an empty table none; other columns are not read. Every page is parsed to its end, in time
    that grows with its length.
    """
    workers_import(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
