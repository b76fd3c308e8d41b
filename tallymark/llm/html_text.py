"""Main text of web pages by tree scoring.

A page's blocks of text give points to the elements around them: one for being
there, one for each comma, and up to three for length, less the share of the
text that lies in links. The parent gets all points, each farther ancestor half
of what the one before got; one walk over the elements in reverse page order adds
them up. The element with the most points, weighed by its own link density, is
the article; its siblings that are not mostly links belong to it, and so does all
around it in an article or main element. The body of a page may be its article
too, without what is mostly links. Elements whose tag, attributes or whole names
say that they are not article text are left out before that.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tallymark.functions.names import col
from tallymark.llm.arrow import with_computed
from tallymark.llm.text import texts

# Element names of HTML.
_RAW = frozenset("script style noscript template iframe object svg math canvas audio video textarea select".split())
_DROPPED = frozenset("head nav header footer aside form button dialog menu fieldset label title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol"
    " p pre section summary table tbody td tfoot th thead tr ul".split()
) | _DROPPED
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A start tag of the first kind ends an open element of the same kind.
_SELF_CLOSING = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
_BONUS = {"article": 10.0, "main": 8.0, "section": 1.0, "div": 1.0, "blockquote": 1.0, "ul": -3.0, "ol": -3.0, "li": -3.0}

# Words that name what is not article text, words that say nothing beside them, and those that decide as
# the last word of a name.
_BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner nav navigation navbar menu breadcrumb"
    " breadcrumbs header footer sidebar aside widget related share sharing social comment comments disqus replies cookie"
    " cookies consent gdpr notice popup modal overlay subscribe newsletter login signup search pagination pager toolbar"
    " hidden skip".split()
)
_EMPTY_WORDS = frozenset(
    "site page main top bottom left right box bar list area section container wrapper wrap block item items link links"
    " posts slot unit label button buttons form inner outer content global reader user visually bg js the and to 1 2 3".split()
)
_LAST_WORDS = frozenset(
    "ads advert nav navbar menu breadcrumbs sidebar footer comments banner newsletter widget toolbar pagination".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_NAME_PART = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
_COMMAS = re.compile("[,，、،]")


def _says_not_text(token: str) -> bool:
    """Whether a whole class, id or role says that an element is not article text: all its words do, or its last one."""
    words = [w.lower() for w in _NAME_PART.split(token) if w]
    if not words or not any(w in _BESIDE_WORDS for w in words):
        return False
    return words[-1] in _LAST_WORDS or all(w in _BESIDE_WORDS or w in _EMPTY_WORDS for w in words)


def _is_left_out(attrs: str, by_name: bool) -> bool:
    """Whether an element's attributes hide it, or (``by_name``) name it as something beside the article."""
    values = {n.lower(): v.strip("\"'") for n, v in reversed(_ATTRIBUTE.findall(attrs))}
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        return True
    style = "".join(values.get("style", "").lower().split())
    if "display:none" in style or "visibility:hidden" in style:
        return True
    return by_name and any(_says_not_text(t) for a in ("class", "id", "role") for t in values.get(a, "").split())


@dataclass(slots=True)
class _Element:
    name: str
    parent: int
    dropped: bool
    score: float = 0.0
    chars: int = 0
    link_chars: int = 0


@dataclass(slots=True)
class _Block:
    element: int
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""


class _Page:
    """Elements in page order, and the blocks of text between their edges."""

    def __init__(self, source: str):
        self.elements = [_Element("html", -1, False)]
        self.blocks: list[_Block] = []
        self._open = [0]
        # depths in the stack of open elements: of each name, and of all blocks
        self._by_name: dict[str, list[int]] = {}
        self._open_blocks: list[int] = []
        self._links = 0
        self._block: _Block | None = None
        self._read(source)
        for block in self.blocks:
            block.text = " ".join("".join(block.parts).split())
        self.blocks = [b for b in self.blocks if b.text]

    def _read(self, source: str) -> None:
        at = 0
        while match := _TOKEN.search(source, at):
            self._text(source[at : match.start()])
            at = match.end()
            name = match["name"]
            if name is None:
                continue
            name = name.lower()
            if match["end"]:
                self._end(name)
            elif name in _RAW:
                if not match["attrs"].endswith("/"):
                    close = re.compile(rf"</{re.escape(name)}\s*(?:>|$)", re.I).search(source, at)
                    at = close.end() if close else len(source)
            else:
                self._start(name, match["attrs"])
        self._text(source[at:])

    def _text(self, text: str) -> None:
        if not text or self.elements[self._open[-1]].dropped:
            return
        if self._block is None:
            self._block = _Block(self._open[self._open_blocks[-1]] if self._open_blocks else 0)
            self.blocks.append(self._block)
        text = html.unescape(text) if "&" in text else text
        self._block.parts.append(text)
        if self._links:
            self._block.link_chars += len(text)

    def _start(self, name: str, attrs: str) -> None:
        if name == "br":
            self._text(" ")
        if name in _BLOCKS:
            self._block = None
            # a paragraph ends where a block begins
            if self._open_blocks and self.elements[self._open[self._open_blocks[-1]]].name == "p":
                self._close_to(self._open_blocks[-1])
        if name in _SELF_CLOSING:
            depth = self._deepest(_SELF_CLOSING[name].split())
            if depth > self._deepest(("ul", "ol", "dl", "table", "select")):
                self._close_to(depth)
        if name in _VOID or attrs.endswith("/") and name not in _BLOCKS:
            return
        parent = self._open[-1]
        dropped = self.elements[parent].dropped or name in _DROPPED
        # the outermost elements are never left out for their names, html and body for nothing
        if not dropped and attrs and name not in ("html", "body"):
            dropped = _is_left_out(attrs, name not in ("article", "main"))
        self.elements.append(_Element(name, parent, dropped))
        self._by_name.setdefault(name, []).append(len(self._open))
        if name in _BLOCKS:
            self._open_blocks.append(len(self._open))
        self._open.append(len(self.elements) - 1)
        self._links += name == "a"

    def _deepest(self, names) -> int:
        return max((self._by_name[n][-1] for n in names if self._by_name.get(n)), default=0)

    def _end(self, name: str) -> None:
        if name in _BLOCKS:
            self._block = None
        if self._by_name.get(name):
            self._close_to(self._by_name[name][-1])

    def _close_to(self, depth: int) -> None:
        while len(self._open) > depth:
            name = self.elements[self._open.pop()].name
            self._by_name[name].pop()
            if name in _BLOCKS:
                self._open_blocks.pop()
            self._links -= name == "a"

    # -- scores -------------------------------------------------------------------------

    def _score(self) -> None:
        own = [0.0] * len(self.elements)
        for block in self.blocks:
            n = len(block.text)
            density = min(1.0, block.link_chars / n)
            own[block.element] += (1 + len(_COMMAS.findall(block.text)) + min(n / 100, 3.0)) * (1 - density)
            self.elements[block.element].chars += n
            self.elements[block.element].link_chars += min(n, block.link_chars)
        # children come after their parents
        for i in range(len(self.elements) - 1, -1, -1):
            element = self.elements[i]
            if element.parent >= 0:
                parent = self.elements[element.parent]
                parent.score += own[i] + element.score / 2
                parent.chars += element.chars
                parent.link_chars += element.link_chars
            if element.name not in ("p", "td", "th", "pre", "li") and element.name not in _HEADINGS:
                element.score += own[i]  # text right inside a container
            if element.chars:
                element.score = (element.score + _BONUS.get(element.name, 0.0)) * (1 - element.link_chars / element.chars)

    def main_text(self) -> str:
        """Text of the best container and its kept siblings, blocks in page order, joined by one space."""
        if not self.blocks:
            return ""
        self._score()
        candidates = [i for i, e in enumerate(self.elements) if e.chars and not e.dropped and e.name not in ("p", *_HEADINGS)]
        best = max(candidates, key=lambda i: self.elements[i].score)
        top = self.elements[best]
        children: dict[int, list[int]] = {}
        for i, e in enumerate(self.elements):
            if e.chars:
                children.setdefault(e.parent, []).append(i)

        def reads(i: int) -> bool:
            return self.elements[i].link_chars < 0.25 * self.elements[i].chars

        if top.name in ("html", "body"):
            kept, beside = set(filter(reads, children.get(best, []))), {best}
        else:
            kept = {best, *filter(reads, children[top.parent])}
            beside = set(kept)
        # all of an article or main element around the best container
        above = [best]
        while (parent := self.elements[above[-1]].parent) >= 0:
            above.append(parent)
        around = next((k for k, i in enumerate(above) if k and self.elements[i].name in ("article", "main")), 0)
        for i in above[1 : around + 1]:
            beside.add(i)
            kept.update(filter(reads, children[i]))
        kept -= set(above[1:])
        inside = [False] * len(self.elements)
        for i, element in enumerate(self.elements):
            inside[i] = i in kept or element.parent >= 0 and inside[element.parent]
        return " ".join(b.text for b in self.blocks if b.element in beside or inside[b.element])


def main_text(source: str) -> str:
    """The article of a page; empty for a page without text."""
    return _Page(source).main_text()


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All rows of ``pages`` with ``text``, the main text of the whole page.

    A NULL or empty page has an empty text; a page cut anywhere is read as far
    as it goes; repeated rows give repeated results. A column of ``pages``
    called text is replaced; an empty table gives an empty result.
    """
    def start():
        return lambda columns: [pa.array([main_text(source) for source in texts(columns[0])], pa.string())]

    return with_computed(pages, [col(html_col).cast("string")], "text string", start)
