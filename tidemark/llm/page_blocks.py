"""Pages to text blocks with their root-to-leaf tag paths, for use inside tasks.

The reader follows the parts of the HTML standard that decide where text belongs: elements whose end
tag may be left out, raw text elements, comments, and tags that are not closed at the end of a page.
Inline markup never splits a block and is not part of a path.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
IN_HEAD = frozenset("base link meta script style title noscript template".split())
# Elements, roles and class words of page parts that are no main text.
DROPPED = frozenset(
    "head script style noscript template nav aside footer form button select option textarea label fieldset svg math iframe object canvas audio video map dialog menu".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar tooltip".split())
READERS = frozenset("comment comments commentlist disqus replies respond discussion".split())
WORDS = READERS | frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs consent cookie cookies copyright footer form "
    "gdpr header login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination popup promo "
    "promotion recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag closes an open element of the first set unless one of the second lies between.
_TABLE = frozenset({"table"})
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr"}), _TABLE),
    "td": (frozenset({"td", "th"}), _TABLE | {"tr"}),
    "th": (frozenset({"td", "th"}), _TABLE | {"tr"}),
    "tbody": (frozenset({"thead", "tbody", "tfoot"}), _TABLE),
    "tfoot": (frozenset({"thead", "tbody", "tfoot"}), _TABLE),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
_WALL = frozenset({"table", "td", "th", "caption", "button", "object"})

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_QUOTE = re.compile(r"""=\s*["']""")
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE | re.ASCII) for tag in RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True, eq=False)
class Element:
    tag: str
    path: int = 0  # number of the tag path from the root
    parent: Element | None = None
    gone: bool = False  # dropped by its name, role or being hidden, or inside such an element
    marked: bool = False  # named by a class word; undone if it turns out to hold the article
    heads: bool = False  # marked as a header and nothing else
    readers: bool = False
    scope: str = ""  # "article" or "main" around it


@dataclass(slots=True)
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: list[bool] = field(default_factory=list)


class PageReader:
    """Reads one page into `blocks`."""

    def __init__(self, html: str) -> None:
        self.html = html
        self.paths: dict[tuple[int, str], int] = {}
        self.stack = [Element("html")]
        self.open: dict[str, int] = {"html": 1}
        self.blocks: list[Block] = []
        self.link: int | None = None  # depth of the stack at the open anchor
        self.fresh = True  # the next text begins a block
        self.ended: set[str] = set()  # ends that do not occur any more
        self._read()

    def _find(self, end: str, at: int) -> int:
        """Place of `end` from `at` on, or the page's end; what was not found is not sought again."""
        found = -1 if end in self.ended else self.html.find(end, at)
        if found < 0:
            self.ended.add(end)
            return len(self.html)
        return found

    def _raw_end(self, tag: str, at: int) -> int:
        """Place of the end tag of a raw text element, or the page's end."""
        found = None if tag in self.ended else _RAW_END[tag].search(self.html, at)
        if not found:
            self.ended.add(tag)
            return len(self.html)
        return found.start()

    def _tag_end(self, at: int) -> int:
        """Place of the `>` that ends the tag whose attributes begin at `at`."""
        end = self._find(">", at)
        if self.html.find("=", at, end) < 0:
            return end
        while True:
            quote = _QUOTE.search(self.html, at, end)
            if not quote:
                return end
            close = self._find(self.html[quote.end() - 1], quote.end())
            if close == len(self.html):  # a quote that is never closed is taken as a letter
                return end
            at = close + 1
            if at > end:
                end = self._find(">", at)

    def _read(self) -> None:
        html, at, size = self.html, 0, len(self.html)
        while at < size:
            mark = self._find("<", at)
            self._text(html[at:mark])
            if mark == size:
                return
            if html.startswith("<!--", mark):
                at = self._find("-->", mark + 2) + 3
                continue
            if html[mark + 1 : mark + 2] in ("!", "?"):
                at = self._find(">", mark) + 1
                continue
            closing = html.startswith("</", mark)
            name = _NAME.match(html, mark + 1 + closing)
            if not name:
                self._text("<")
                at = mark + 1
                continue
            tag, end = name.group().lower(), self._tag_end(name.end())
            at = end + 1
            if closing:
                self._close(tag)
                continue
            self._begin(tag, html[name.end() : end])
            if tag in RAW:
                at = self._raw_end(tag, at)

    def _text(self, raw: str) -> None:
        if not raw:
            return
        top = self.stack[-1]
        if self.fresh or not self.blocks:
            if raw.isspace():
                return
            self.blocks.append(Block(top))
            self.fresh = False
        self.blocks[-1].parts.append(unescape(raw) if "&" in raw else raw)
        self.blocks[-1].linked.append(self.link is not None)

    def _pop_to(self, depth: int) -> None:
        for element in self.stack[depth:]:
            self.open[element.tag] -= 1
        del self.stack[depth:]
        if self.link is not None and self.link > depth:
            self.link = None
        self.fresh = True

    def _close_open(self, tags: frozenset[str], walls: frozenset[str]) -> None:
        if not any(self.open.get(t) for t in tags):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                self._pop_to(depth)
                return
            if self.stack[depth].tag in walls:
                return

    def _close(self, tag: str) -> None:
        if tag == "a":
            self.link = None
        elif tag == "br":
            self._text(" ")
        elif tag not in INLINE and tag not in VOID and tag not in RAW and tag not in ("html", "body"):
            self._close_open(frozenset({tag}), frozenset() if tag in _WALL or tag in ("tr", "tbody", "thead", "tfoot") else _WALL)
            self.fresh = True

    def _begin(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            if tag == "body" and self.open.get("head"):
                self._close("head")
            return
        if tag in INLINE:
            if tag == "a":
                self.link = len(self.stack)
            elif tag == "br":
                self._text(" ")
            return
        if self.open.get("head") and tag not in IN_HEAD:
            self._close("head")
        if tag in VOID or tag in RAW:
            self.fresh |= tag == "hr"
            return
        self.fresh = True
        self._close_open(frozenset({"p"}), _WALL)
        if tag in CLOSES:
            self._close_open(*CLOSES[tag])
        self.stack.append(self._element(tag, attributes))
        self.open[tag] = self.open.get(tag, 0) + 1

    def _element(self, tag: str, attributes: str) -> Element:
        above = self.stack[-1]
        if not attributes and tag not in DROPPED and tag not in ("article", "main", "header"):
            path = self.paths.setdefault((above.path, tag), len(self.paths) + 1)
            return Element(tag, path, above, gone=above.gone, readers=above.readers, scope=above.scope)
        named = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if attributes.strip(" /") else {}
        classes = _WORD.findall(f"{named.get('class', '')} {named.get('id', '')}")
        words = {w.lower() for w in classes}
        label = f"{tag}.{'.'.join(sorted(words))}" if words else tag
        path = self.paths.setdefault((above.path, label), len(self.paths) + 1)
        made = Element(tag, path, above, gone=above.gone, readers=above.readers, scope=above.scope)
        made.gone |= tag in DROPPED or named.get("role", "").lower() in ROLES or "hidden" in named or named.get("aria-hidden") == "true"
        made.gone |= "display:none" in named.get("style", "").replace(" ", "").lower()
        made.gone |= tag == "article" and above.scope == "article"  # an article in an article is a reader's
        made.marked = bool(words & WORDS) or tag == "header"
        made.heads = made.marked and words & WORDS <= {"header"}
        made.readers |= bool(words & READERS)
        if tag in ("article", "main") or named.get("itemprop") == "articleBody":
            if not made.marked:
                made.scope = "main" if tag == "main" and above.scope != "article" else "article"
                while above is not None and not made.readers:  # a marked element around the article is a wrapper
                    above.marked, above = False, above.parent
        return made
