"""Text columns: counts, cleaning, sentences, leading extracts."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.arrays import let


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(K.WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """White-space separated runs; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(K.WORD)), F.lit(0)).cast("long")


def char_count(text: Column) -> Column:
    """Code points; null counts 0."""
    return F.coalesce(F.length(text), F.lit(0)).cast("long")


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(text, F.lit(K.SPACES))


def is_meaningful(text: Column) -> Column:
    """At least one run of two letters.  Such a text can never be digits and marks only."""
    return F.coalesce(text.rlike(K.TWO_LETTERS), F.lit(False))


def clean(text: Column) -> Column:
    """Drop URLs and control characters, collapse blanks and blank lines; '' unless meaningful."""
    t = F.coalesce(text, F.lit(""))
    for pattern, replacement in (
        (K.URL_WITH_SCHEME, ""),
        (K.URL_WWW, ""),
        (K.CONTROL, ""),
        (r"[ \t]+", " "),
        (r"(?U)\n\s*\n", "\n\n"),
        (r"(?U)\n\s+", "\n"),
    ):
        t = F.regexp_replace(t, pattern, replacement)
    return F.regexp_replace(strip(t), K.WITHOUT_WORDS, "")


def distinct_lines(text: Column) -> Column:
    """Trimmed, non-empty lines, each kept at its first occurrence."""
    lines = F.transform(F.split(text, "\n", -1), strip)
    return F.array_join(F.array_distinct(F.filter(lines, lambda x: x != "")), "\n")


def sentences(text: Column) -> Column:
    """Sentences by closing punctuation: a declared stand-in for a trained splitter."""
    parts = F.transform(F.regexp_extract_all(text, F.lit(K.SENTENCE), F.lit(0)), strip)
    return F.filter(parts, lambda x: x != "")


def lead_words(text: Column, n: Column | int) -> Column:
    """The first n words joined by one blank."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.array_join(F.slice(words(text), F.lit(1), n.cast("int")), " ")


def lead_summary(text: Column, low: Column, high: Column, model: Column | str) -> Column:
    """Deterministic summary text: a head naming model and bounds, then the first `low` words."""
    model = F.lit(model) if isinstance(model, str) else model
    head = F.concat(
        F.lit("["), model, F.lit(" summary ("), low.cast("string"), F.lit("-"),
        high.cast("string"), F.lit(" words)]: "),
    )
    return F.concat(head, lead_words(text, low), F.lit("..."))


def before_semicolon(text: Column) -> Column:
    return F.split_part(text, F.lit(";"), F.lit(1))


def last_token(text: Column) -> Column:
    return F.try_element_at(words(text), F.lit(-1))


def first_token(text: Column) -> Column:
    return F.try_element_at(words(text), F.lit(1))


def comma_list(text: Column) -> Column:
    return F.transform(F.split(text, ",", -1), strip)


def decode_entities(text: Column) -> Column:
    """Character references, numeric and named, each once; a no-break space becomes a space.

    The names are the standard library's table of HTML 4. What is no reference stays as it is.
    """
    # One constant, folded to a map while planning: a map of literals would be walked through by every rule of the optimiser.
    # The usual names come first, as a map is searched in order.
    known = {**dict.fromkeys(("amp", "lt", "gt", "quot", "apos", "nbsp")), **{n: chr(c) for n, c in name2codepoint.items()}, "nbsp": " ", "apos": "'"}
    names = F.str_to_map(F.lit("\x02".join(f"{n}\x01{c}" for n, c in known.items())), F.lit("\x02"), F.lit("\x01"))

    def character(point: Column) -> Column:
        valid = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        return F.when(point == 160, F.lit(" ")).when(valid, char)

    def referred(ref: Column) -> Column:
        # Each part is reached by texts of its shape only: a cast that fails costs an exception for every reference.
        decimal = F.substr(ref, F.lit(2)).cast("bigint")
        hexadecimal = F.conv(F.substr(ref, F.lit(3)), 16, 10).cast("bigint")
        point = F.when(ref.rlike("^#[0-9]"), decimal).otherwise(hexadecimal)
        return F.when(F.startswith(ref, F.lit("#")), let(point, character)).otherwise(F.try_element_at(names, ref))

    def piece(p: Column) -> Column:
        ref = F.regexp_extract(p, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        return let(ref, lambda r: let(referred(r), lambda char: F.when(char.isNull(), F.concat(F.lit("&"), p)).otherwise(
            F.concat(char, F.substr(p, F.length(r) + 2)))))

    def decoded(parts: Column) -> Column:
        return F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), piece), ""))

    # Bound once: inside a lambda every mention of the text would be worked out again.
    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), let(F.split(t, "&", -1), decoded)).otherwise(t))
