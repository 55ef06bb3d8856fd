"""The visible text of web pages, laid out: blocks, lists and table cells keep their places."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from scorespark.llm.blocks import slices, text_array

# Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset form hr menu".split())
BLOCKS = PARAGRAPHS | frozenset("address article aside body center dd details dialog dir div dt figcaption footer header hgroup html legend li main nav option optgroup search section summary caption thead tbody tfoot tr".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
INVISIBLE = frozenset("head script style template noscript title iframe noembed noframes object audio video canvas datalist param".split())
HEAD_ONLY = frozenset("base link meta title style script noscript template".split())
# A start tag of the key ends an open element of the first set, unless one of the second stands between.
_LISTS, _TABLES = frozenset("ul ol menu dir dl table".split()), frozenset("table".split())
IMPLIED = {
    "li": (frozenset(["li"]), _LISTS),
    "dt": (frozenset(["dt", "dd"]), _LISTS),
    "dd": (frozenset(["dt", "dd"]), _LISTS),
    "tr": (frozenset(["tr", "caption", "colgroup"]), _TABLES),
    "td": (frozenset(["td", "th"]), _TABLES),
    "th": (frozenset(["td", "th"]), _TABLES),
    "thead": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), _TABLES),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), _TABLES),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), _TABLES),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "rt": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
    "rp": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
}
ENDS_PARAGRAPH = BLOCKS - frozenset("body html option optgroup caption thead tbody tfoot tr legend".split())
PARAGRAPH_SCOPE = frozenset("table td th caption button object template".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?")
SPACE = re.compile(r"[ \t\n\f\r]+")
HIDES = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
SIMPLE_SELECTOR = re.compile(r"[A-Za-z][\w-]*|[.#][\w-]+")
NAME_REST = re.compile(r"[^\s/>]*")
TAG_START = re.compile(r"</?[A-Za-z]|<[!?]")
GAP = "  "
SAME_FORMATTING = 3  # as many equal formatting elements go on behind an implied end, as in browsers


@dataclass
class Element:
    name: str
    attributes: dict[str, str]
    hidden: bool


@dataclass
class Box:
    """Lines of text under way; a gap of two is a line break, of more a blank line too."""

    lines: list[str] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)  # of the line under way
    space: bool = False
    blank: bool = False
    indents: list[int] = field(default_factory=list)
    indent: int = 0
    marker: str = ""

    def word(self, text: str, before: bool, after: bool) -> None:
        if text:
            self.add((" " if (before or self.space) and self.parts else "") + text)
            self.space = after
        else:
            self.space = self.space or before

    def add(self, text: str) -> None:
        if text:
            self.parts.append(text)

    def take(self) -> str:
        line = "".join(self.parts)
        self.parts = []
        return line

    def shift(self, columns: int) -> None:
        self.indents.append(columns)
        self.indent += columns

    def unshift(self) -> None:
        self.indent -= self.indents.pop()

    def break_(self, blank: bool = False) -> None:
        if self.parts:
            self.put(self.take())
        self.space = False
        self.blank = self.blank or blank

    def put(self, line: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        indent = self.indent
        if self.marker and indent >= len(self.marker):
            self.lines.append(" " * (indent - len(self.marker)) + self.marker + line)
        else:
            self.lines.append((" " * indent + line) if line else "")
        self.marker = ""

    def text(self) -> list[str]:
        self.break_()
        return self.lines


@dataclass
class Table:
    """Rows of cells under way: per cell its lines and the columns and rows that it spans."""

    rows: list[list[tuple[list[str], int, int]]] = field(default_factory=list)

    def lines(self) -> list[str]:
        """Cells of one column start at one place; a cell over several columns sets no width.

        What rows above hold of a row is kept as spans of columns, so a cell
        costs the same however far it reaches.
        """
        placed, reaching = [], []  # reaching: (first column, column behind, row behind) of cells over several rows
        for r, row in enumerate(self.rows):
            reaching = [x for x in reaching if x[2] > r]
            taken: list[list[int]] = []
            for low, high, _ in sorted(reaching):
                if taken and low <= taken[-1][1]:
                    taken[-1][1] = max(taken[-1][1], high)
                else:
                    taken.append([low, high])
            column, k, cells = 0, 0, []
            for lines, across, down in row:
                while k < len(taken) and taken[k][1] <= column:
                    k += 1
                if k < len(taken) and taken[k][0] <= column:
                    column = taken[k][1]
                cells.append((column, across, lines))
                if down > 1:
                    reaching.append((column, column + across, r + down))
                column += across
            placed.append(cells)
        widths: dict[int, int] = {}
        for cells in placed:
            for column, across, lines in cells:
                if across == 1:
                    widths[column] = max(widths.get(column, 0), *map(len, lines or [""]))
        columns = sorted(widths)
        ends = [0, *accumulate(widths[c] + len(GAP) for c in columns)]
        out = []
        for cells in placed:
            live = [(ends[bisect_left(columns, column)], lines) for column, _, lines in cells]
            k = 0
            while live := [x for x in live if k < len(x[1])]:
                parts, length = [], 0
                for start, lines in live:
                    if lines[k]:
                        gap = start - length if length <= start else len(GAP)
                        parts += [" " * gap, lines[k]]
                        length += gap + len(lines[k])
                out.append("".join(parts).rstrip())
                k += 1
        return out


class Page:
    """Tree builder and layout in one: the stack of open elements is the path in the tree, boxes and tables are what they fill."""

    def __init__(self) -> None:
        self.open: list[Element] = []
        self.at: dict[str, list[int]] = defaultdict(list)  # places of the open elements by name
        self.boxes = [Box()]
        self.tables: list[Table] = []
        self.numbers: list[int | None] = []
        self.hiding: set[str] = set()
        self.fresh = False  # a line break right behind the start of preformatted text does not count

    # ---- tree builder

    def start(self, name: str, attributes: dict[str, str]) -> None:
        if name == "html" or name == "body" and self.at["body"]:
            return
        if self.at["head"] and name not in HEAD_ONLY and name != "head":
            self._end_if_open({"head"}, frozenset())
        if self.at["p"] and name in ENDS_PARAGRAPH:
            again = self._end_if_open({"p"}, PARAGRAPH_SCOPE)
        else:
            again = []
        if name in IMPLIED:
            ends, scope = IMPLIED[name]
            again += self._end_if_open(ends, scope)
            if name in ("thead", "tbody", "tfoot", "tr"):
                self._end_if_open({"td", "th"}, scope)
                self._end_if_open(ends, scope)
        if name in ("td", "th") and self.tables and not self._inside("tr"):
            self.start("tr", {})
        if name in "h1 h2 h3 h4 h5 h6".split() and self.open and re.fullmatch("h[1-6]", self.open[-1].name):
            self._pop()
        self._push(name, attributes)
        if name in VOID:
            self._pop()
        # Formatting that a paragraph's implied end has cut goes on behind it.
        for e in again:
            if e.name != name:
                self._push(e.name, e.attributes)

    def end(self, name: str) -> None:
        if name in ("html", "body"):
            return
        if name == "br":
            self.start("br", {})
            return
        scope = PARAGRAPH_SCOPE if name not in ("td", "th", "tr", "table", "thead", "tbody", "tfoot", "caption") else frozenset(["table"])
        k = self._innermost([name])
        if k < 0 or self._innermost(scope) > k:
            return
        cut = self._cut(k) if name in BLOCKS or name in FORMATTING else []
        while len(self.open) > k:
            self._pop()
        for e in cut:
            self._push(e.name, e.attributes)

    def _innermost(self, names: Iterable[str]) -> int:
        """Place of the innermost open element of ``names``, -1 if there is none."""
        place = -1
        for n in names:
            at = self.at.get(n)
            if at and at[-1] > place:
                place = at[-1]
        return place

    def _inside(self, name: str) -> bool:
        return self._innermost([name]) > self._innermost(["table"])

    def _cut(self, k: int) -> list[Element]:
        """Formatting inside element ``k`` that goes on when it ends; of equal elements the innermost few."""
        seen: Counter = Counter()
        kept = []
        for e in reversed(self.open[k + 1 :]):
            if e.name in FORMATTING:
                key = (e.name, tuple(e.attributes.items()))
                seen[key] += 1
                if seen[key] <= SAME_FORMATTING:
                    kept.append(e)
        return kept[::-1]

    def _end_if_open(self, names: Iterable[str], scope: Iterable[str]) -> list[Element]:
        """End the innermost open element of ``names``; returns formatting that was open inside it."""
        k = self._innermost(names)
        if k < 0 or self._innermost(scope) > k:
            return []  # most often: nothing to end
        cut = self._cut(k)
        while len(self.open) > k:
            self._pop()
        return cut

    def _hidden(self, name: str, attributes: dict[str, str]) -> bool:
        if self.open and self.open[-1].hidden or name in INVISIBLE or "hidden" in attributes:
            return True
        if "style" in attributes and HIDES.search(attributes["style"]):
            return True
        if name == "dialog" and "open" not in attributes:
            return True
        if self.open and self.open[-1].name == "details" and name != "summary" and "open" not in self.open[-1].attributes:
            return True
        if self.hiding:
            keys = [name, "#" + attributes.get("id", ""), *("." + c for c in attributes.get("class", "").split())]
            return any(k in self.hiding for k in keys)
        return False

    def style(self, text: str) -> None:
        """Rules that hide what a plain name, class or id selects."""
        for rule in text.split("}")[:-1]:
            *_, selectors, body = ["", *rule.split("{")]
            if "{" in rule and HIDES.search(body):
                self.hiding.update(s for s in map(str.strip, selectors.split(",")) if SIMPLE_SELECTOR.fullmatch(s))

    # ---- layout

    def _push(self, name: str, attributes: dict[str, str]) -> None:
        e = Element(name, attributes, self._hidden(name, attributes))
        self.at[name].append(len(self.open))
        self.open.append(e)
        if e.hidden:
            return
        box = self.boxes[-1]
        if name == "br":
            if box.parts:
                box.break_()
            elif box.lines:
                box.put("")
        elif name in ("td", "th") and self.tables:
            if not self.tables[-1].rows:
                self.tables[-1].rows.append([])
            self.boxes.append(Box())
        elif name in BLOCKS:
            box.break_(name in PARAGRAPHS and not (name in ("ul", "ol", "menu") and self.numbers))
        self.fresh = name in ("pre", "textarea")
        if name == "table":
            self.tables.append(Table())
        elif name == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif name in ("ul", "ol", "menu"):
            start = attributes.get("start", "1")
            self.numbers.append((int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1) if name == "ol" else None)
        elif name == "li":
            number = self.numbers[-1] if self.numbers else None
            if number is not None:
                value = attributes.get("value", "")
                number = int(value) if re.fullmatch(r"-?\d{1,9}", value) else number
                self.numbers[-1] = number + 1
            marker = "- " if number is None else f"{number}. "
            box.shift(len(marker))
            box.marker = marker
        elif name in ("blockquote", "dd"):
            box.shift(4)

    def _pop(self) -> None:
        e = self.open.pop()
        self.at[e.name].pop()
        if e.hidden:
            return
        name = e.name
        if name in ("td", "th") and len(self.boxes) > 1 and self.tables:
            lines = self.boxes.pop().text()
            spans = [int(v) if re.fullmatch(r"[1-9]\d{0,2}", v) else 1 for v in (e.attributes.get("colspan", ""), e.attributes.get("rowspan", ""))]
            self.tables[-1].rows[-1].append((lines, *spans))
            return
        box = self.boxes[-1]
        if name == "table" and self.tables:
            box.break_(True)
            for line in self.tables.pop().lines():
                box.put(line)
            box.break_(True)
        elif name in BLOCKS:
            box.break_(name in PARAGRAPHS and not (name in ("ul", "ol", "menu") and len(self.numbers) > 1))
        if name in ("ul", "ol", "menu") and self.numbers:
            self.numbers.pop()
        elif name in ("li", "blockquote", "dd") and box.indents:
            if name == "li" and box.marker:
                box.put("")
            box.unshift()

    def text(self, data: str) -> None:
        if self.open and (self.open[-1].hidden or self.open[-1].name == "details" and "open" not in self.open[-1].attributes):
            return
        box = self.boxes[-1]
        if "&" in data:
            data = unescape(data)
        if self.at["pre"] or self.at["textarea"]:
            lines = data.replace("\r\n", "\n").removeprefix("\n" if self.fresh else "").split("\n")
            self.fresh = False
            for k, line in enumerate(lines):
                if k:
                    box.put(box.take())
                box.add(line)
            return
        plain = SPACE.sub(" ", data)
        box.word(plain.strip(" "), plain[:1] == " ", plain[-1:] == " ")

    def close(self) -> str:
        while self.open:
            self._pop()
        lines = [line.rstrip() for line in self.boxes[0].text()]
        return "\n".join(lines).strip("\n")


class TagEnds:
    """Where the tag that starts at a place ends, for all places of a text at once: its first > outside of quotes, -1 if none."""

    def __init__(self, html: str):
        self.special = [m.start() for m in re.finditer("[>\"']", html)]
        following = {'"': len(self.special), "'": len(self.special)}  # the next mark of its kind, by number
        self.ends = [-1] * (len(self.special) + 1)
        for k in range(len(self.special) - 1, -1, -1):
            c = html[self.special[k]]
            if c == ">":
                self.ends[k] = self.special[k]
            else:
                other = following[c]
                self.ends[k] = self.ends[other + 1] if other < len(self.special) else -1
                following[c] = k

        self.last, self.html = html.rfind(">"), html
        self.name = (0, 0)  # a stretch of text in which every name ends at its end

    def may_end(self, at: int) -> bool:
        """Whether a tag whose name goes on at ``at`` has an end."""
        if at > self.last:
            return False
        if not self.name[0] <= at <= self.name[1]:
            self.name = (at, NAME_REST.match(self.html, at).end())
        return self.ends[bisect_left(self.special, self.name[1])] >= 0


def _next_token(html: str, at: int, ends: list[TagEnds]) -> re.Match | None:
    """The next comment, declaration or tag; ``ends`` is filled when a tag turns out to have no end, and asked from then on."""
    while m := TAG_START.search(html, at):
        is_tag = m[0][1] not in "!?"
        if not is_tag or not ends or ends[0].may_end(m.end()):
            if token := TOKEN.match(html, m.start()):
                return token
            if is_tag and not ends:
                ends.append(TagEnds(html))
        at = m.start() + 1
    return None


def page_text(html: str) -> str:
    """Laid-out visible text; broken markup is mended as a browser would, with missing tags implied.  Takes time in proportion to the page."""
    page, at, ends = Page(), 0, []
    while at < len(html):
        m = _next_token(html, at, ends)
        if not m:
            page.text(html[at:])
            break
        if m.start() > at:
            page.text(html[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            page.end(name)
            continue
        attributes: dict[str, str] = {}
        if m[3] and m[3] != "/":
            for k, v in ATTRIBUTE.findall(m[3]):
                attributes.setdefault(k.lower(), unescape(v[1:-1] if v[:1] in "\"'" and v else v))
        page.start(name, attributes)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            inside = html[at : end.start() if end else len(html)]
            if name == "style":
                page.style(inside)
            elif inside:
                page.text(inside)
            page.end(name)
            at = end.end() if end else len(html)
    return page.close()


def visible_text(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text) of every page, one row per row; nothing is shuffled.

    Null and empty pages have an empty text; null ids stay; repeated rows are
    rendered one by one; other columns are not read; no rows give none.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, html_col):
            texts = [page_text(h) for h in text_array(block.column(html_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column(id_col), pa.array(texts, pa.string())], [id_col, "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInArrow(render, f"`{id_col}` {kind}, text string")
