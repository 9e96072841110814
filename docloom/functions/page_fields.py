"""The metadata fields of a document page, read in Python.

A page is read by compiled patterns that are looked for from one ``<`` to the next, so its text is walked through at the speed of a
search for a character. Nothing is kept from page to page. Texts become Python objects a slice at a time.
Bytes that are no UTF-8 are read as replacement characters.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint

import pyarrow as pa

from docloom import constants as K
from docloom.functions.arrays import text_slices

#: Labels of the definition list, in the order of the fields they give.
LABELS = ("Form", "Author", "Responsible body", "EUROVOC descriptor", "Subject matter", "Directory code")
DATES = tuple(label.lower() for label in K.DATE_LABELS)
TEXT, LIST = pa.string(), pa.list_(pa.string())
FIELDS = [
    ("celex_number", TEXT), ("title", TEXT), ("identifier", TEXT), ("eli_uri", TEXT), *[(f"date_{n}", TEXT) for n in range(len(DATES))],
    ("authors", LIST), ("responsible_body", TEXT), ("form", TEXT), ("eurovoc_descriptors", LIST), ("subject_matters", LIST),
    ("directory_codes", LIST), ("directory_descriptions", LIST),
]
#: The same as a type of Spark.
SCHEMA = f"struct<{', '.join(f'{n}: {dict([(TEXT, 'string'), (LIST, 'array<string>')])[t]}' for n, t in FIELDS)}>"


def pattern(text: str) -> re.Pattern[str]:
    """Letters of either case and blanks are ASCII ones; a name goes on over letters of any script."""
    return re.compile(text.replace(r"\b", r"(?u:\b)"), re.ASCII | re.IGNORECASE | re.DOTALL)


def paragraph(attr: str, value: str) -> re.Pattern[str]:
    return pattern(rf"""<p\b[^>]*\s{attr}\s*=\s*["']{value}["'][^>]*>(.*?)</p\s*>""")


def among(value: str) -> str:
    """One of the blank-separated words of a value."""
    return rf"""(?:[^"']*\s)?{value}(?:\s[^"']*)?"""


HIDDEN = pattern(r"<(?:!--.*?-->|s(?:cript\b.*?</script|tyle\b.*?</style)\s*>)")
CELL, CELL_TAG = pattern(r"<d([td])\b[^>]*>([^<]*+(?:<(?!/d[td]\s*>)[^<]*+)*+)</d[td]\s*>"), pattern(r"<d[td]\b")
NUMBER, TITLE = paragraph("class", among("DocumentTitle")), paragraph("id", among("title"))
ONLY_TITLE, ORIGINAL, PARAGRAPH = paragraph("id", "title"), paragraph("id", "originalTitle"), pattern(r"<p\b[^>]*>(.*?)</p\s*>")
ELI = pattern(r"""<a\b[^>]*\shref\s*=\s*["'](http://data\.europa\.eu/eli/[^"']*)["']""")
DATE_LIST = pattern(rf"""<dl\b[^>]*\sclass\s*=\s*["']{among("NMetadata")}["'][^>]*>""")
LISTS, DIVISIONS = pattern(r"</?dl\b[^>]*>"), pattern(r"</?div\b[^>]*>")
ITEM, SPAN = pattern(r"<li\b[^>]*>(.*?)</li\s*>"), pattern(r"<span\b[^>]*>(.*?)</span\s*>")
TAG = pattern(r"<[^>]+>")
REFERENCE = pattern(r"&(#[0-9]{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]{1,31});")
CHARACTERS = {**{n: chr(c) for n, c in name2codepoint.items()}, "nbsp": " ", "apos": "'"}


def character(found: re.Match[str]) -> str:
    name = found[1]
    if name[0] != "#":
        return CHARACTERS.get(name, found[0])
    point = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
    if point == 160:
        return " "
    if point == 0xFEFF:  # a mark of the order of bytes, no text
        return ""
    return chr(point) if 0 < point <= 0x10FFFF and not 0xD800 <= point <= 0xDFFF else found[0]


def decoded(text: str) -> str:
    """As ``decode_entities``."""
    return REFERENCE.sub(character, text) if "&" in text else text


def raw_text(fragment: str) -> str:
    if "<" in fragment:
        fragment = TAG.sub("", fragment)
    return (REFERENCE.sub(character, fragment) if "&" in fragment else fragment).strip()


def inner_text(fragment: str) -> str:
    if "<" in fragment:
        return "".join([(decoded(p) if "&" in p else p).strip() for p in TAG.split(fragment)])
    return decoded(fragment).strip()


def first(found: re.Match[str] | None) -> str | None:
    """What stands between the tags; an empty paragraph counts as none."""
    return raw_text(found[1]) if found and found[1] else None


def behind(page: str, tags: re.Pattern[str], start: int, depth: int) -> int:
    """Where the element ends that is ``depth`` elements of that name deep at ``start``: behind its closing tag, or else the last tag."""
    end = start
    for tag in tags.finditer(page, start):
        depth += -1 if tag[0][1] == "/" else 1
        end = tag.end()
        if depth <= 0:
            break
    return end


def cells(found: list[tuple[str, str]], terms: list[tuple[int, str]], values: list[str | None]) -> None:
    """Adds cells in order: the content of a definition, null for a term, and of a term its place and text, where only blanks at its ends may be left."""
    for kind, body in found:
        if "</" in body:  # up to the closing tag, or to one before it that is left open
            cut = body.find("</", body.rfind(">") + 1)
            if cut >= 0:
                body = body[:cut]
        if kind in "tT":
            terms.append((len(values), raw_text(body) if "<" in body or "&" in body else body))
            values.append(None)
        else:
            values.append(body)


def lists(page: str) -> tuple[list[str], list[str | None]]:
    """The dates, and for each label the definition that follows the first term holding it.

    The dates are in the first definition list of its class: terms and definitions pair up by position, a term names the first date it
    holds, the last wins. The cells of the page are those of that list and what follows, unless a cell lies before it or across its ends.
    """
    dates: list[str] = [""] * len(DATES)
    terms: list[tuple[int, str]] = []
    values: list[str | None] = []
    end, opening = 0, DATE_LIST.search(page)
    if opening:
        start = opening.start()
        end = behind(page, LISTS, start, 0)
        found = CELL.findall(page, start, end)
        cells(found, terms, values)
        for (_, term), value in zip(terms, [x for x in values if x is not None]):
            label = term.lower()
            for n, name in enumerate(DATES):
                if name in label:
                    dates[n] = raw_text(value).split(";", 1)[0]
                    break
        if CELL_TAG.search(page, 0, start) or len(CELL_TAG.findall(page, start, end)) != len(found):
            end, terms, values = 0, [], []
    cells(CELL.findall(page, end), terms, values)
    out: list[str | None] = []
    for label in LABELS:
        value = None
        for at, term in terms:
            if label in term:
                for value in values[at + 1:]:
                    if value is not None:
                        break
                break
        out.append(value)
    return dates, out


def identifier(page: str) -> str | None:
    """The paragraph after the title, or after the hidden original title, among what follows up to the end of the division around both."""
    title = ONLY_TITLE.search(page)
    if not title and not page.startswith("<div>"):
        return None
    start, depth = (title.end(), 1) if title else (0, 0)
    end = behind(page, DIVISIONS, start, depth)
    hidden = ORIGINAL.search(page, start, end)
    return first(PARAGRAPH.search(page, hidden.end() if hidden else start, end))


def fields(html: str) -> tuple:
    """The values of FIELDS for one page."""
    page = HIDDEN.sub("", html)
    number, title, eli = first(NUMBER.search(page)), first(TITLE.search(page)), ELI.search(page)
    words = number.rsplit(None, 1) if number else None
    dates, (form, author, body, descriptors, subjects, directory) = lists(page)
    items = ITEM.findall(directory) if directory else []
    tokens = [raw_text(li).split(None, 1) for li in items]
    return (
        words[-1] if words else None, title, identifier(page) or title, decoded(eli[1]) if eli else None, *dates,
        [] if author is None else [a.strip() for a in raw_text(author).split(",")], raw_text(body) if body else "", raw_text(form) if form else "",
        [inner_text(li) for li in ITEM.findall(descriptors)] if descriptors else [], [inner_text(li) for li in ITEM.findall(subjects)] if subjects else [],
        [t[0] if t else None for t in tokens], [" / ".join([inner_text(s) for s in SPAN.findall(li)]) for li in items],
    )


def read(pages: pa.Array) -> pa.Array:
    """FIELDS of each page (bytes), as an array of structs."""
    names = [n for n, _ in FIELDS]
    parts = []
    for part in text_slices(pages):
        columns = zip(*[fields("" if page is None else page.decode("utf-8", "replace")) for page in part.to_pylist()])
        parts.append(pa.StructArray.from_arrays([pa.array(values, kind) for (_, kind), values in zip(FIELDS, columns)], names))
    return pa.concat_arrays(parts or [pa.StructArray.from_arrays([pa.array([], kind) for _, kind in FIELDS], names)])
