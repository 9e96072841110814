"""Class-marked legal pages to ordered sections, as one relational job over page parts.

Raw pages are shuffled once, by page. A page's tokens are then folded over the stack of its open elements, inside the row, which
leaves one entry for each part that a text takes: title, preamble, main content, the heading or body of a section. All that is done with the
parts (cells, lines, tables, repeats, order) are aggregations keyed by page first, so they run in place.

Elements need not be closed or nested well. A closing tag ends its own element and all that are still open inside it; one without
an opening tag is ignored. ``IMPLIED`` names the tags that end an open element they cannot be inside of, as HTML has it:
an item ends the item before it, a cell the cell, a block the paragraph.
"""

from __future__ import annotations

import itertools
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import text as T
from docloom.functions.arrays import text_slices
from docloom.operators.pages import without_scripts
from docloom.session import by_key

# Fixed values of HTML: elements without a closing tag, and blocks that end a paragraph.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
#: Tag to the open elements that it ends, and to those beyond which it does not look.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    **{b: ({"p"}, {"td", "th", "li", "dd", *BLOCKS} - {"p"}) for b in BLOCKS}}

# Flags of an element.  The lowest four name the heading class, in the order of HEADING_CLASSES.
HEADING = 0b1111
(ANNEX, TITLE, PREAMBLE, BOX, SUBDIVISION, NORMAL, NOTE, ENUM, UNWANTED, TABLE, CELL, SPAN, ROW, PARA,
 INLINE) = (1 << i for i in range(4, 19))
#: Of these only a page's first element counts.
FIRST_ONLY = TITLE | PREAMBLE | BOX

# Parts a token can take.
HEADER, OPENING, MAIN, HEAD_TITLE, SECTION = range(5)
WHOLE, LISTED, STRING = range(3)

TOKEN = re.compile("<[^>]+>|[^<]+")
TAG = re.compile("</?([a-zA-Z][a-zA-Z0-9]*)")
ATTRIBUTE = {n: re.compile(rf"""(?i)\s{n}\s*=\s*["']([^"']*)["']""") for n in ("class", "style", "width")}

PART = ("pos int, scope int, way int, head long, head_flags int, o1 long, o2 long, o3 long, unit long, table boolean, sub long, "
        "row_no int, cell_no int, in_cell boolean, tok string, in_note boolean, mark boolean, is_col boolean, narrow boolean")
NAMES = [c.split()[0] for c in PART.split(", ")]
TYPES = pa.struct([(n, {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}[t])
                   for n, t in (c.split() for c in PART.split(", "))])


def attribute_of(tok: str, name: str) -> str:
    found = ATTRIBUTE[name].search(tok)
    return found[1] if found else ""


def flags_of(tag: str, tok: str) -> int:
    classes = set(re.split(r"\s+", attribute_of(tok, "class")))
    div, para = tag == "div", tag == "p"
    tests = [(name in classes, 1 << i) for i, name in enumerate(K.HEADING_CLASSES)] + [
        ("oj-doc-ti" in classes, ANNEX), (div and "eli-main-title" in classes, TITLE), (div and "eli-preamble" in classes, PREAMBLE),
        (div and "eli-container" in classes, BOX), (div and "eli-subdivision" in classes, SUBDIVISION),
        (para and "oj-normal" in classes, NORMAL), (tag in ("a", "span") and "oj-note-tag" in classes, NOTE),
        (div and "oj-enumeration-spacing" in classes, ENUM), (not classes.isdisjoint(K.UNWANTED_CLASSES), UNWANTED), (tag == "table", TABLE),
        (tag in ("td", "th"), CELL), (tag == "span", SPAN), (tag == "tr", ROW), (para, PARA),
        (para and attribute_of(tok, "style") == "display: inline;", INLINE)]
    return sum(flag for test, flag in tests if test)


class Open:
    """An open element; ``around``: the flags of it and all around it; ``head``: the last heading among its children, ``part``: 1 inside it, 2 after it."""

    __slots__ = ("around", "flags", "head", "name", "part", "pos")

    def __init__(self, name: str, pos: int, flags: int, around: int) -> None:
        self.name, self.pos, self.flags, self.around, self.head, self.part = name, pos, flags, flags | around, None, 0


class Page:
    """The fold's state: the open elements and what was last opened of each kind."""

    def __init__(self) -> None:
        self.stack = [Open("", -1, 0, 0)]
        self.seen = self.rows = self.cells = 0
        self.block = self.para = None
        self.enum = 0
        self.parts: list[tuple] = []

    def close(self, depth: int) -> None:
        """Ends the elements from that depth on."""
        while len(self.stack) > depth:
            gone = self.stack.pop()
            if gone.flags & HEADING and not gone.around & UNWANTED:
                self.stack[-1].part = 2
            if self.block and self.block[0] is gone:
                self.block = None
            if self.para is gone:
                self.para = None

    def ended_by(self, name: str) -> int:
        """Depth of the outermost element that an opening tag ends, or that of the stack."""
        ends, limits = IMPLIED.get(name, ((), ()))
        depth = len(self.stack)
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].name in ends:
                depth = i
            elif self.stack[i].name in limits:
                break
        return depth

    def opened(self, pos: int, name: str, tok: str) -> None:
        up, flags = self.stack[-1], flags_of(name, tok)
        new = Open(name, pos, flags & ~(self.seen & FIRST_ONLY), up.around)
        self.stack.append(new)
        if new.around & UNWANTED:
            return
        self.seen |= flags & FIRST_ONLY
        self.rows += bool(flags & ROW)
        self.cells += bool(flags & CELL)
        if flags & HEADING:
            up.head, up.part = new, 1
        # Blocks of the main content, by rank: paragraphs, tables and spans of a subdivision, then paragraphs directly in the container.
        rank = None
        if up.flags & SUBDIVISION:
            rank = 0 if flags & NORMAL else 1 if flags & TABLE else 2 if flags & SPAN and not flags & NOTE else None
        elif up.flags & BOX and flags & NORMAL:
            rank = 3
        if rank is not None:
            self.block = (new, rank, up.pos)
        if flags & ENUM:
            self.enum = pos
        if flags & PARA:
            self.para = new

    def take(self, pos: int, tok: str | None, mark: bool = False, is_col: bool = False, narrow: bool = False) -> None:
        """The parts of a text (or, in tables, of a cell, a marked element or a column)."""
        top = self.stack[-1].around
        if top & UNWANTED:
            return

        def part(scope, way, head=None, order=(0, 0, 0), unit=0, table=False, sub=0):
            self.parts.append((pos, scope, way, head.pos if head else 0, head.flags & (HEADING | ANNEX) if head else 0, *order, unit, table, sub,
                               self.rows, self.cells, bool(top & CELL), tok, bool(top & NOTE), mark, is_col, narrow))

        text = tok is not None
        if text and top & TITLE:
            part(HEADER, WHOLE)
        if text and top & PREAMBLE:
            part(OPENING, WHOLE)
        if top & BOX:
            if text and top & ENUM and self.para and self.para.flags & INLINE:
                part(MAIN, LISTED, order=(-1, 0, 0), unit=self.enum, sub=self.para.pos)
            if self.block and (text or self.block[1] == 1):
                block, rank, up = self.block
                part(MAIN, WHOLE, order=(int(rank == 3), 0 if rank == 3 else up, rank), unit=block.pos, table=rank == 1)
        for up, child in zip(self.stack, self.stack[1:]):
            if up.part == 1 and text:
                part(HEAD_TITLE, WHOLE, up.head)
            elif up.part == 2:
                table = bool(child.flags & TABLE)
                if text or table:
                    part(SECTION, STRING, up.head, unit=child.pos if table else pos, table=table, sub=child.pos)


def parts_of(html: str | None, implied: bool = True) -> list[tuple]:
    """The parts of a page, in the order of ``NAMES``."""
    page = Page()
    for pos, found in enumerate(TOKEN.finditer(html or "")):
        tok = found[0]
        if tok[0] != "<":
            page.take(pos, tok)
            continue
        tag = TAG.match(tok)
        if not tag:
            continue
        name = tag[1].lower()
        if tok[1] == "/":
            depth = next((i for i in range(len(page.stack) - 1, 0, -1) if page.stack[i].name == name), len(page.stack))
            page.close(depth)
            continue
        if implied:
            page.close(page.ended_by(name))
        if name in VOID or tok.endswith("/>"):
            if name == "col":
                page.take(pos, None, is_col=True, narrow="4%" in attribute_of(tok, "width"))
            continue
        page.opened(pos, name, tok)
        new = page.stack[-1]
        if new.flags & (CELL | NORMAL | SPAN):
            page.take(pos, None, mark=bool(new.flags & (NORMAL | SPAN)))
    return page.parts


def _parts(pages: DataFrame, key: str, html: str, implied: bool) -> DataFrame:
    """One row per token and part it takes."""

    def fold_slice(texts: pa.Array) -> pa.Array:
        found = [parts_of(t.as_py(), implied) for t in texts]
        columns = list(zip(*(p for page in found for p in page))) or [()] * len(NAMES)
        rows = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, TYPES)], fields=list(TYPES))
        ends = [0, *itertools.accumulate(map(len, found))]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    def fold(texts: pa.Array) -> pa.Array:
        # The parts are Python objects for a slice of the batch only.
        return pa.concat_arrays([fold_slice(part) for part in text_slices(texts)] or [fold_slice(texts)])

    # A column function keeps the pages' partitioning, so what follows needs no further shuffle.
    folded = F.arrow_udf(fold, f"array<struct<{PART.replace(' ', ':').replace(',:', ',')}>>")
    df = by_key(pages.select(F.col(key).alias("key"), F.col(html).alias("html")), "key")
    rows = df.select("key", F.inline(folded(without_scripts(F.col("html")))))
    return rows.withColumns({"plain": F.when(F.col("tok").isNotNull(), F.when(F.col("in_note"), F.lit("")).otherwise(F.col("tok"))), "full": F.col("tok")})


def _joined(text: Column, order: Column, glue: str) -> Column:
    rows = F.sort_array(F.collect_list(F.when(text.isNotNull(), F.struct(order.alias("o"), text.alias("t")))))
    return F.array_join(F.transform(rows, lambda r: r["t"]), glue)


def _is(column: str, flag: int) -> Column:
    return F.coalesce(F.col(column).bitwiseAND(F.lit(flag)) != 0, F.lit(False))


def _units(df: DataFrame) -> DataFrame:
    """One text per unit: a block, an enumeration, a table, or a single string of a section."""
    base = ["key", "scope", "way", "head", "head_flags", "o1", "o2", "o3", "unit", "table"]
    table = F.col("table")
    raw = T.decode_entities(F.when(table, F.col("plain")).otherwise(F.col("full")))
    cells = (
        df.withColumns({
            "raw": raw,
            "line": F.when(table, F.col("row_no")).otherwise(0),
            "cell": F.when(table & F.col("in_cell"), F.col("cell_no").cast("long")).when(table, F.lit(-1))
            .when(F.col("way") == LISTED, F.col("sub")).otherwise(F.lit(0)),
        })
        .groupBy(*base, "line", "cell")
        .agg(_joined(F.col("raw"), F.col("pos"), "").alias("text"), F.max("mark").alias("mark"),
             F.count_if("is_col").alias("n_cols"), F.max("narrow").alias("narrow"),
             F.max(F.when(F.col("way") == STRING, F.col("sub"))).alias("sib"))
    )
    is_cell = table & (F.col("cell") >= 0)
    cells = cells.withColumns({
        "clean": T.clean(T.strip(F.col("text"))),
        "n_cells": F.count_if(is_cell).over(Window.partitionBy(*base, "line")),
    })
    wanted = (F.col("clean") != "") & (~table | (
        is_cell & ~F.col("clean").rlike("^[0-9]+$") & (F.col("mark") | (F.col("n_cells") > 1))))
    lines = cells.groupBy(*base, "line").agg(
        _joined(F.when(wanted, F.col("clean")), F.col("cell"), " ").alias("shown"),
        F.sum("n_cols").alias("n_cols"), F.max("narrow").alias("narrow"), F.max("sib").alias("sib"),
        F.max(F.contains(F.col("text"), F.lit("AR"))).alias("has_ar"),
        F.sort_array(F.collect_list(F.when(is_cell, F.struct("cell", T.strip(F.col("text")).alias("t"))))).alias("cells"))
    units = lines.groupBy(*base).agg(
        _joined(F.when(F.col("shown") != "", F.col("shown")), F.col("line"), "\n").alias("regular"),
        F.sum("n_cols").alias("n_cols"), F.max("narrow").alias("narrow"), F.max("sib").alias("sib"),
        F.max("has_ar").alias("has_ar"), F.sort_array(F.flatten(F.collect_list("cells"))).alias("cells"))
    first, second = F.get("cells", F.lit(0))["t"], F.get("cells", F.lit(1))["t"]
    numbered = F.when(F.coalesce(second, F.lit("")) != "", F.concat(first, F.lit(" "), second)).otherwise("")
    return units.withColumn("text", F.when(
        table & (F.col("n_cols") == 2) & F.col("narrow"), numbered).otherwise(F.col("regular")))


def sections(pages: DataFrame, key: str, html: str, implied: bool = True) -> DataFrame:
    """(key, section_order, title, content, section_type), in emission order. ``implied``: tags end elements by ``IMPLIED``.

    Title and preamble come first, then the main content, then one section per heading, class by
    class.  Inside a section repeated parts are dropped, and once a part begins with "AR" the
    later strings of elements that mention it.
    """
    units = _units(_parts(pages, key, html, implied))
    by_section = Window.partitionBy("key", "scope", "head")
    starts_ar = F.startswith(T.strip(F.col("text")), F.lit("AR"))
    units = units.withColumns({
        "ar_from": F.min(F.when(starts_ar, F.col("unit"))).over(by_section),
        "sib_ar": F.max("has_ar").over(Window.partitionBy("key", "scope", "head", "sib")),
    })
    dropped = ((F.col("way") == STRING) & ~F.col("table") & F.col("sib_ar") & (F.col("unit") > F.col("ar_from")))
    kept = units.filter((F.col("text") != "") & ~F.coalesce(dropped, F.lit(False)))
    ordered = lambda cond: F.transform(F.sort_array(F.collect_list(
        F.when(cond, F.struct("o1", "o2", "o3", "unit", "text")))), lambda p: p["text"])
    # Heading and body of a section share the heading's position and meet in one row.
    kind = F.when(F.col("scope") == HEAD_TITLE, SECTION).otherwise(F.col("scope"))
    rows = kept.withColumn("kind", kind).groupBy("key", "kind", "head", "head_flags").agg(
        ordered(F.col("scope") == HEAD_TITLE).alias("heading"), ordered(F.col("scope") != HEAD_TITLE).alias("parts"))
    is_section = F.col("kind") == SECTION
    heading = F.array_join("heading", "\n")
    content = F.array_join(F.when(is_section, F.array_distinct("parts")).otherwise(F.col("parts")), "\n")
    rank, name = F.lit(-1), F.lit("")
    for i, cls in reversed(list(enumerate(K.HEADING_CLASSES))):
        rank = F.when(_is("head_flags", 1 << i), i).otherwise(rank)
        name = F.when(_is("head_flags", 1 << i), cls).otherwise(name)
    titles = {HEADER: "Document Title", OPENING: "Preamble", MAIN: "Main Content"}
    types = {HEADER: "header", OPENING: "preamble", MAIN: "main"}
    by_kind = lambda names, other: F.coalesce(*[
        F.when(F.col("kind") == k, F.lit(v)) for k, v in names.items()], other)
    out = rows.select(
        "key", F.when(is_section, rank + SECTION).otherwise(F.col("kind")).alias("place"), "head",
        by_kind(titles, heading).alias("title"), content.alias("content"), by_kind(types, name).alias("section_type"),
        (_is("head_flags", ANNEX) & heading.rlike("^ANNEX [IVX]+$")).alias("annex"))
    out = out.filter(~F.col("annex") & T.is_meaningful(F.col("content")) & T.is_meaningful(F.col("title")))
    order = Window.partitionBy("key").orderBy("place", "head")
    return out.select(F.col("key").alias(key), (F.row_number().over(order) - 1).alias("section_order"),
                      "title", "content", "section_type")
