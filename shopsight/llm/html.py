"""HTML extraction by layout-aware rendering: all visible text, with block spacing, lists and aligned tables.

A tree builder keeps the stack of open elements, closes what a new element implies (a paragraph before a block, a list item before
the next, cells and rows; an open head before what cannot stand in it) and ignores stray end tags. What browsers do not show (scripts, styles, the head, templates, hidden
attributes and styles, closed dialogs, all but the summary of closed details, options not chosen) gives no text; `visibility: visible` shows again
what lies in invisible text. Blocks begin on lines of their own, paragraphs and headings are set apart by a blank line, as are two line breaks in
a row; list items have a marker and are indented by depth. The cells of a table begin at the same place in every row, blocks and
lists in them are lines of the row; a cell over several rows keeps its column. Wide characters count as two.

Time and output grow in proportion to the page, whatever its markup: the tokenizer never goes back, blanks that align tables stay below
ROOM times the page's length (columns are then aligned up to ALIGN characters, at last not at all; no text is cut), lists
are indented by DEEP levels at most, and tables nested deeper than DEEP are written cell after cell.

Defined results: null and empty pages give an empty text; broken markup is read to its end, a tag or comment that the end cuts off
gives nothing, as in browsers; nesting of any depth is worked off without recursion; entities are decoded, numbers beyond the character set
give U+FFFD; white space collapses outside `pre`. Every row of the table gives one row, repeated rows too; an empty table gives an empty
result; all other columns come back unchanged in the struct column `row`, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from unicodedata import combining, east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Element names of the HTML standard by their role in rendering.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head script style template noscript title meta link iframe object audio video canvas svg datalist noembed noframes rp".split())
APART = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure".split())
BLOCK = APART | set("address article aside body center dd details dialog div dt fieldset figcaption footer form header hr html legend li main nav section summary tr caption thead tbody tfoot".split())
ENDS_P = BLOCK - {"tr", "caption", "thead", "tbody", "tfoot", "legend", "summary", "html", "body"}
# text in these is read up to their own end tag
RAW = set("script style iframe noembed noframes xmp title textarea".split())
DECODED = {"title", "textarea"}
# what may stand in a head; anything else ends it
IN_HEAD = set("html head title meta link script style base template noscript noframes basefont bgsound".split())
# what an opening element closes first, up to the nearest of the elements that hold it
SECTIONS = {"thead", "tbody", "tfoot", "caption", "tr"}
IMPLIED = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "caption"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "thead": (SECTIONS, {"table"}),
    "tbody": (SECTIONS, {"table"}),
    "tfoot": (SECTIONS, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
STRUCTURE = set("table thead tbody tfoot tr td th caption body html".split())  # end tags that reach beyond a cell
ROOM, ALIGN, DEEP = 4, 40, 32

_W = " \t\n\r\f"
_SPACE = re.compile(rf"[{_W}]+")
_NAME = re.compile(rf"[a-zA-Z][^{_W}/>]*+")
_ATTRIBUTE = re.compile(rf"""[{_W}/]*+(?:(>)|([^{_W}/>][^{_W}/>=]*+)(?:[{_W}]*+=[{_W}]*+(?:"([^"]*+)"|'([^']*+)'|(["'])|([^{_W}>]*+)))?)""")
_RAW_END = {name: re.compile(rf"</{name}(?=[{_W}/>])", re.I) for name in RAW}
_ZEROS = re.compile(r"&#([xX]?)0{8,}+")
_BEYOND = re.compile(r"&#(?:0*+[1-9][0-9]{7,}+|[xX]0*+[1-9a-fA-F][0-9a-fA-F]{6,}+);?")
_NUMBER = re.compile(r"-?\d{1,9}", re.A)


def decoded(text: str) -> str:
    """Text with its entities decoded, numbers of any length included."""
    if "&" not in text:
        return text
    return unescape(_BEYOND.sub("�", _ZEROS.sub(r"&#\g<1>0", text)))


def tokens(html: str) -> Iterator[tuple[str, str, dict]]:
    """(kind, name or text, attributes) of kinds text, start and end, in one pass."""
    at, size = 0, len(html)
    while at < size:
        here = html.find("<", at)
        if here < 0:
            here = size
        stop = here
        name = None
        if here < size:
            closes = html.startswith("</", here)
            name = _NAME.match(html, here + 1 + closes)
            if not name and not closes and html[here + 1 : here + 2] not in ("!", "?"):  # a lone sign is text
                stop = here + 1
        if stop > at:
            yield "text", decoded(html[at:stop]), {}
        if stop > here or here == size:
            at = stop
            continue
        if not name:
            at = _after_comment(html, here)
            continue
        tag, at = name.group().lower(), name.end()
        attributes: dict[str, str] = {}
        while True:
            found = _ATTRIBUTE.match(html, at)
            if not found or found.group(5):
                return  # the end of the page cuts the tag off
            at = found.end()
            if found.group(1):
                break
            value = found.group(3) or found.group(4) or found.group(6) or ""
            attributes.setdefault(found.group(2).lower(), decoded(value))
        yield ("end" if closes else "start"), tag, attributes
        if not closes and tag in RAW:
            end = _RAW_END[tag].search(html, at)
            stop = end.start() if end else size
            raw = html[at:stop]
            yield "text", decoded(raw) if tag in DECODED else raw, {}
            at = stop
        elif not closes and tag == "plaintext":
            yield "text", html[at:], {}
            return


def _after_comment(html: str, at: int) -> int:
    """Where a comment, a declaration or what is read as one ends."""
    if html.startswith("<!--", at):
        if html.startswith(("<!-->", "<!--->"), at):
            return html.index(">", at) + 1
        end, width = html.find("-->", at + 4), 3
    else:
        end, width = html.find(">", at), 1
    return len(html) if end < 0 else end + width


def width_of(text: str) -> int:
    """Places that a text takes up; wide characters take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if combining(c) else 2 if east_asian_width(c) in "WF" else 1 for c in text)


class _Lines:
    """Text laid out in lines; `gap` asks for a line break (1) or a blank line (2) before what follows."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the line that is being written
        self.last, self.gap, self.lead = "", 0, ""

    def break_line(self, gap: int) -> None:
        if self.parts:
            line = "".join(self.parts).rstrip()
            if line:
                self.lines.append(line)
                self.gap = 0
            self.parts = []
        self.gap = max(self.gap, gap)

    def line_break(self) -> None:
        """As `br` does: the second one in a row leaves a blank line."""
        self.break_line(1 if self.parts else 2)

    def verbatim_break(self) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip())
            self.parts, self.gap = [], 0
        elif self.lines:
            self.lines += [""] * (2 if self.gap == 2 else 1)
            self.gap = 0

    def add(self, text: str, indent: str, verbatim: bool) -> None:
        if not verbatim and (not self.parts or self.last == " "):
            text = text.lstrip(" ")
        if not text:
            return
        if not self.parts:
            if self.gap == 2 and self.lines:
                self.lines.append("")
            self.gap = 0
            self.parts.append(indent + self.lead)
            self.lead = ""
        self.parts.append(text)
        self.last = text[-1]

    def finish(self) -> list[str]:
        self.break_line(0)
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class _Cell:
    def __init__(self, lines: list[str], across: int, down: int):
        self.lines, self.across, self.down, self.column = lines, across, down, 0
        self.wide = max(map(width_of, lines), default=0)


def _number(text: str | None, default: int) -> int:
    text = (text or "").strip(_W)
    return int(text) if _NUMBER.fullmatch(text) else default


def _placed(rows: list[list[_Cell]]) -> bool:
    """Gives every cell its column, beside those that reach down from rows above; False if that takes too many steps."""
    until: dict[int, int] = {}  # by column: the first row that is free again
    steps = 16 * sum(map(len, rows)) + 4096
    for y, row in enumerate(rows):
        column = 0
        for cell in row:
            while until.get(column, 0) > y:
                column += 1
                steps -= 1
            cell.column = column
            if cell.down > 1:
                steps -= cell.across
                if steps > 0:
                    until.update((x, y + cell.down) for x in range(column, column + cell.across))
            column += cell.across
            if steps <= 0:
                return False
    return True


def table_lines(rows: list[list[_Cell]], room: int) -> tuple[list[str], int]:
    """The lines of a table and the blanks they took to align, `room` at most."""
    for limit in (1 << 40, ALIGN) if _placed(rows) else ():
        wide: dict[int, int] = {}
        for row in rows:
            for cell in row:
                if cell.across == 1 and cell.wide <= limit:
                    wide[cell.column] = max(wide.get(cell.column, 0), cell.wide)
        starts, x, last = {}, 0, 0
        for column in sorted({c.column for row in rows for c in row} | set(wide)):  # columns that no cell begins in take two blanks
            x += 2 * (column - last)
            starts[column], last = x, column
            x += wide.get(column, 0)
        need = sum(starts[c.column] for row in rows for c in row[-1:] for _ in range(max(len(d.lines) for d in row)))
        if need <= room:
            out = []
            for row in rows:
                for i in range(max((len(c.lines) for c in row), default=0)):
                    parts, end = [], 0
                    for cell in row:
                        if i < len(cell.lines) and cell.lines[i]:
                            blanks = max(starts[cell.column] - end, 2 if parts else 0)
                            parts.append(" " * blanks + cell.lines[i])
                            end += blanks + width_of(cell.lines[i])
                    out.append("".join(parts).rstrip())
            return out, need
    out = []
    for row in rows:
        for i in range(max((len(c.lines) for c in row), default=0)):
            out.append("  ".join(c.lines[i] for c in row if i < len(c.lines) and c.lines[i]))
    return out, 0


def _shown(tag: str, attributes: dict) -> tuple[bool, bool | None]:
    """Whether an element has no box, and whether its text is invisible (None: as around it)."""
    gone, veiled = "hidden" in attributes or (tag == "dialog" and "open" not in attributes), None
    for declaration in attributes.get("style", "").lower().split(";"):
        name, _, value = declaration.partition(":")
        name, value = name.strip(), value.replace("!important", "").strip()
        if name == "display" and value:
            gone = value == "none"
        elif name == "visibility" and value in ("visible", "hidden", "collapse"):
            veiled = value != "visible"
    return gone or tag in HIDDEN, veiled


class Renderer:
    def __init__(self, size: int):
        self.open: list[tuple[str, bool, bool, str]] = []  # element, whether text around it is gone, is veiled, what it collects
        self.heads: dict[str, list[int]] = {}  # places in `open`, by element
        self.gone = self.veiled = False
        self.outs = [_Lines()]
        self.lists: list[list] = []  # kind and number of the last item
        self.tables: list[list[list[_Cell]]] = []
        self.cells: list[tuple[int, int]] = []  # columns and rows of the open cells
        self.options: list[list] = []  # of the open choices: whether all show, the texts, the chosen one
        self.pre = 0
        self.fresh = False  # directly behind the start of a `pre`, whose first line break does not count
        self.summed: set[int] = set()  # places of closed details that have had their summary
        self.room = ROOM * size

    def read(self, kind: str, name: str, attributes: dict) -> None:
        if kind == "text":
            self.text(name)
        elif kind == "start":
            self.start(name, attributes)
        else:
            self.end(name)
            self.fresh = False

    def start(self, tag: str, attributes: dict) -> None:
        self.fresh = False
        if tag not in IN_HEAD:
            self._end_head()
        if tag in IMPLIED:
            self._close_until(*IMPLIED[tag])
        if tag in ENDS_P and self.heads.get("p"):
            self._close_until({"p"}, {"td", "th", "table", "button", "body"})
        gone, veiled = _shown(tag, attributes)
        if tag in VOID:
            if not (gone or self.gone):
                if tag == "br":
                    self.outs[-1].line_break()
                elif tag == "hr":
                    self.outs[-1].break_line(1)
            return
        before = self.gone, self.veiled
        place = len(self.open)
        if tag == "summary" and self.open and self.open[-1][3] == "closed" and place - 1 not in self.summed:
            self.summed.add(place - 1)
            self.gone = self.open[-1][1]
        self.gone = self.gone or gone
        if veiled is not None:
            self.veiled = veiled
        collects = "" if self.gone else self._begin(tag, attributes)
        self.heads.setdefault(tag, []).append(place)
        self.open.append((tag, *before, collects))
        if collects == "closed":
            self.gone = True

    def _begin(self, tag: str, attributes: dict) -> str:
        """Lays out the start of a shown element; what it collects."""
        out = self.outs[-1]
        if tag in BLOCK:
            out.break_line(2 if tag in APART and not (tag in ("ul", "ol") and self.lists) else 1)
        if tag in ("ul", "ol"):
            self.lists.append([tag, _number(attributes.get("start"), 1) - 1])
            return "list"
        if tag == "li":
            out.lead = "- "
            if self.lists and self.lists[-1][0] == "ol":
                self.lists[-1][1] = _number(attributes.get("value"), self.lists[-1][1] + 1)
                out.lead = f"{self.lists[-1][1]}. "
            return "item"
        if tag == "pre":
            self.pre += 1
            self.fresh = True
            return "pre"
        if tag == "table" and len(self.tables) < DEEP:
            self.tables.append([])
            return "table"
        if tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th"):
            if not self.tables or self._loose():
                out.add(" ", "", False)
                return ""
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.cells.append((max(1, min(1000, _number(attributes.get("colspan"), 1))), max(1, _number(attributes.get("rowspan"), 1))))
            self.outs.append(_Lines())
            return "cell"
        elif tag == "select":
            self.options.append(["multiple" in attributes or _number(attributes.get("size"), 1) > 1, [], 0])
            self.outs.append(_Lines())
            return "choice"
        elif tag == "option" and self.options:
            if "selected" in attributes:
                self.options[-1][2] = len(self.options[-1][1])
            self.outs.append(_Lines())
            return "option"
        elif tag == "details" and "open" not in attributes:
            return "closed"
        return ""

    def _loose(self) -> bool:
        """Whether the nearest open table is one too deep to collect cells."""
        return bool(self.heads.get("table")) and self.open[self.heads["table"][-1]][3] != "table"

    def end(self, tag: str) -> None:
        if tag == "br":
            return self.start("br", {})
        places = self.heads.get(tag)
        if tag in VOID or not places:
            return  # a stray end tag
        if tag not in ("table", "body", "html"):
            held = self._last({"table"} if tag in STRUCTURE else {"table", "td", "th", "caption"})
            if places[-1] < held:
                return
        while len(self.open) > places[-1] + 1:
            self._pop()
        self._pop()

    def _last(self, names: set) -> int:
        return max((self.heads[x][-1] for x in names if self.heads.get(x)), default=-1)

    def _close_until(self, closed: set, holders: set) -> None:
        held = self._last(holders)
        depth = self._last(closed)
        while depth > held:
            while len(self.open) > depth:
                self._pop()
            depth = self._last(closed)

    def _pop(self) -> None:
        tag, gone, veiled, collects = self.open.pop()
        self.heads[tag].pop()
        self.summed.discard(len(self.open))
        shown = not self.gone
        self.gone, self.veiled = gone, veiled
        if not shown:
            return
        if collects == "cell":
            lines = self.outs.pop().finish()
            self.tables[-1][-1].append(_Cell(lines, *self.cells.pop()))
        elif collects == "table":
            self._table(self.tables.pop())
        elif collects == "option":
            self.options[-1][1].append(" ".join(" ".join(self.outs.pop().finish()).split()))
        elif collects == "choice":
            self.outs.pop()
            self._choice(*self.options.pop())
        out = self.outs[-1]
        if tag in BLOCK:
            out.break_line(2 if tag in APART and not (tag in ("ul", "ol") and len(self.lists) > 1) else 1)
        if collects == "list":
            self.lists.pop()
        elif collects == "item":
            out.lead = ""
        elif collects == "pre":
            self.pre -= 1

    def _indent(self) -> str:
        return "  " * min(DEEP, max(0, len(self.lists) - 1))

    def _choice(self, whole: bool, texts: list[str], chosen: int) -> None:
        out = self.outs[-1]
        for text in texts if whole else texts[chosen : chosen + 1]:
            if whole:
                out.break_line(1)
            out.add(text, self._indent(), False)
            if whole:
                out.break_line(1)

    def _table(self, rows: list[list[_Cell]]) -> None:
        rows = [row for row in rows if row]
        lines, taken = table_lines(rows, self.room)
        self.room -= taken
        out = self.outs[-1]
        for line in lines:
            if line:
                out.add(line, self._indent(), True)
                out.break_line(1)

    def _end_head(self) -> None:
        """An open head ends at what cannot stand in it, unless that lies in one of its own elements."""
        while self.heads.get("head") and self.open[-1][0] == "head":
            self._pop()

    def text(self, data: str) -> None:
        if data.strip(_W):
            self._end_head()
        fresh, self.fresh = self.fresh, False
        if self.gone or self.veiled:
            return
        out = self.outs[-1]
        if not self.pre:
            out.add(_SPACE.sub(" ", data), self._indent(), False)
            return
        data = data.replace("\r\n", "\n").replace("\r", "\n")
        for i, part in enumerate(data.removeprefix("\n").split("\n") if fresh else data.split("\n")):
            if i:
                out.verbatim_break()
            out.add(part, self._indent(), True)


def render(html: str | None) -> str:
    """Visible text of one page."""
    if not html:
        return ""
    page = Renderer(len(html))
    for token in tokens(html):
        page.read(*token)
    while page.open:
        page._pop()
    return "\n".join(page.outs[0].finish())


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """Per page: `visible_text` and all its columns but the markup in `row`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(html_column)
            texts = pa.array([render(x.as_py()) for x in batch.column(at)], pa.string())
            rest = batch.drop_columns([html_column])
            yield pa.RecordBatch.from_arrays([texts, pa.StructArray.from_arrays(rest.columns, fields=list(rest.schema))], names=["visible_text", "row"])

    rest = T.StructType([f for f in pages.schema.fields if f.name != html_column])
    return pages.mapInArrow(run, T.StructType().add("visible_text", "string").add("row", rest))
