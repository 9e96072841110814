"""Raw pages to text and links, by expressions inside the row, and to metadata, by an Arrow column function: no shuffle, no parser."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import ids as I
from docloom.functions import page_fields as M
from docloom.functions import text as T
from docloom.functions.arrays import hold, let

# Private-use characters that stand for markup inside a row, and the one that spells them in a text.
BLOCK, SKIPPED, INLINE, ESCAPE = "\ue001", "\ue002", "\ue003", "\ue000"
SPELT = [(c, f"{ESCAPE}{n}") for n, c in enumerate((ESCAPE, BLOCK, SKIPPED, INLINE))]
ANCHOR, EDGE = r"(?i)(?=<a\s)", r"(?i)</?(?:p|li|div|td|h[1-6])\b[^>]*>"
BLOCK_TAGS = "p|div|table|tr|td|th|li|ul|ol|dl|dt|dd|h[1-6]|article|section|header|footer|nav"


def escape(text: Column) -> Column:
    """A text that may hold the marks, without them."""
    for char, spelt in SPELT:
        text = F.replace(text, F.lit(char), F.lit(spelt))
    return text


def restore(text: Column) -> Column:
    for char, spelt in reversed(SPELT):  # the escape itself last
        text = F.replace(text, F.lit(spelt), F.lit(char))
    return text


def without_scripts(html: Column) -> Column:
    """Comments, scripts and styles go first: they may hold text that looks like markup."""
    return F.regexp_replace(
        html, r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>)", "")


def element(html: Column, opening: str, tag: str) -> Column:
    """The first element whose opening tag matches, with its balanced content; null if absent.

    Tags of that name are counted up and down from the opening one.  The text is cut at these
    tags once and the pieces up to the closing one are put back together, in linear time.
    Where the next tag of that name closes the element, nothing is cut.
    """
    tags = rf"(?i)</?{tag}\b[^>]*>"
    plain = rf"(?is)^<{tag}\b[^>]*>.*?(</?{tag}\b[^>]*>)"

    def inside(rest):
        return F.when(F.startswith(F.regexp_extract(rest, plain, 1), F.lit("</")), F.regexp_extract(rest, plain, 0)).otherwise(nested(rest))

    def nested(rest):
        return let(F.regexp_extract_all(rest, F.lit(tags), F.lit(0)), lambda ts: let(
            F.split(rest, tags, -1), lambda parts: let(closing(ts), lambda end: F.concat_ws("", F.flatten(
                F.transform(F.sequence(F.lit(0), end), lambda i: F.array(
                    F.get(ts, i), F.when(i < end, F.get(parts, i + 1)).otherwise(F.lit("")))))))))

    def closing(ts):
        empty = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("i"), F.lit(-1).alias("end"))

        def step(acc, t):
            depth = acc["depth"] + F.when(F.startswith(t, F.lit("</")), -1).otherwise(1)
            ends = (acc["end"] < 0) & (depth <= 0)
            return F.struct(depth.alias("depth"), (acc["i"] + 1).alias("i"),
                            F.when(ends, acc["i"]).otherwise(acc["end"]).alias("end"))

        return F.aggregate(ts, empty, step, lambda acc: F.when(acc["end"] < 0, acc["i"] - 1).otherwise(acc["end"]))

    start = F.regexp_instr(html, F.lit(opening))
    return let(start, lambda s: F.when(s > 0, let(F.substr(html, s), inside)))


def attribute(tag: Column, name: str) -> Column:
    """Value of a quoted attribute; '' when absent."""
    return F.regexp_extract(tag, rf"""(?i)\s{name}\s*=\s*["']([^"']*)["']""", 1)


def container(html: Column, ids: Sequence[str] = K.TEXT_CONTAINERS) -> Column:
    """The first of the named containers that exists."""
    return F.coalesce(*[
        element(html, rf"""(?i)<div\b[^>]*\sid\s*=\s*["']{i}["'][^>]*>""", "div") for i in ids])


def inner_text(fragment: Column) -> Column:
    """All text of a fragment with its pieces trimmed and joined without a separator."""
    pieces = F.split(fragment, "<[^>]+>", -1)
    return F.array_join(F.transform(pieces, lambda p: T.strip(T.decode_entities(p))), "")


def raw_text(fragment: Column) -> Column:
    """All text of a fragment as it stands, trimmed at both ends."""
    untagged = lambda f: F.when(F.contains(f, F.lit("<")), F.regexp_replace(f, "<[^>]+>", "")).otherwise(f)
    return T.strip(T.decode_entities(let(fragment, untagged)))


def block_lines(fragment: Column, skipped: Sequence[str] = K.SKIPPED_BLOCKS) -> Column:
    """One line per innermost block, empty ones dropped.

    A block whose first class is on the skip list loses the text that directly follows its
    opening tag.
    """
    skip = rf"""(?i)<(?:{BLOCK_TAGS})\b[^>]*\sclass\s*=\s*["']\s*(?:{'|'.join(skipped)})(?=[\s"'])[^>]*>"""
    marked = F.regexp_replace(escape(fragment), skip, BLOCK + SKIPPED)
    marked = F.regexp_replace(marked, rf"(?i)</?(?:{BLOCK_TAGS})\b[^>]*>", BLOCK)
    kept = F.filter(F.split(marked, BLOCK, -1), lambda s: ~F.startswith(s, F.lit(SKIPPED)))
    return F.filter(F.transform(kept, lambda s: inner_text(restore(s))), lambda s: s != "")


def page_text(pages: DataFrame, html: str, region: Column | None = None) -> DataFrame:
    """Adds full_text and status; a page without a container fails, the others go on."""
    body = hold(pages, _clean=without_scripts(F.col(html)))
    body = hold(body, _region=container(F.col("_clean")) if region is None else region)
    return body.withColumn(
        "full_text", F.when(F.col("_region").isNotNull(), F.array_join(block_lines(F.col("_region")), "\n"))
    ).withColumn(
        "status", F.when(F.col("_region").isNull(), "no container").otherwise("ok")
    ).drop("_clean", "_region")


def heading_sections(pages: DataFrame, html: str, key: str, region_tag: str, heading: str = "h[1-6]") -> DataFrame:
    """(key, section_order, title, content) for pages whose headings are plain heading tags."""
    df = hold(pages.select(key, html), _clean=without_scripts(F.col(html)))
    df = hold(df, _region=element(F.col("_clean"), rf"(?i)<{region_tag}\b[^>]*>", region_tag))
    cuts = F.split(F.regexp_replace(escape(F.col("_region")), rf"(?i)<({heading})\b[^>]*>", INLINE + "$0"), INLINE, -1)
    pieces = F.filter(F.transform(cuts, restore), lambda p: p.rlike(rf"(?i)^<{heading}\b"))
    rows = df.select(key, F.posexplode(pieces).alias("section_order", "piece"))
    close = rf"(?i)</{heading}\s*>"
    halves = hold(rows, _h=F.split("piece", close, 2))
    title = T.clean(raw_text(F.get("_h", F.lit(0))))
    content = F.array_join(block_lines(F.coalesce(F.get("_h", F.lit(1)), F.lit(""))), "\n")
    return hold(halves, title=title, content=content).filter(F.col("title") != "").select(
        key, "section_order", "title", "content")


def links(pages: DataFrame, html: str, key: str, base_url: str, main: Column | None = None) -> DataFrame:
    """Links to documents inside the main container: valid ids only.

    The title is the text of the anchor, or of the list item or paragraph around it when the
    anchor has none: all text between the block edges before and behind it, other anchors' included.
    """
    df = hold(pages.select(key, html), _clean=without_scripts(F.col(html)))
    opening = r"""(?i)<div\b[^>]*\sid\s*=\s*["']MainContent["'][^>]*>"""
    df = hold(df, _main=element(F.col("_clean"), opening, "div") if main is None else main)
    # Cut before every anchor, and apart from that at block edges: an anchor's fallback title is all of its block's text.
    df = hold(df.filter(F.col("_main").isNotNull()), _p=F.split("_main", ANCHOR, -1), _b=F.split("_main", EDGE, -1))
    in_block = F.flatten(F.transform("_b", lambda b, i: F.array_repeat(i, F.size(F.split(b, ANCHOR, -1)) - F.when(b.rlike(r"(?i)^<a\s"), 0).otherwise(1))))
    df = hold(df, _at=in_block)
    own = lambda p: raw_text(F.regexp_extract(p, r"(?is)^<a\s[^>]*>(.*?)</a\s*>", 1))
    around = lambda i: raw_text(F.get(F.col("_b"), F.get(F.col("_at"), i - 1)))
    pairs = F.transform(F.col("_p"), lambda p, i: F.struct(p.alias("piece"), let(own(p), lambda t: F.when(t != "", t).otherwise(around(i))).alias("title")))
    rows = df.select(key, pairs.alias("_pairs")).select(key, F.posexplode("_pairs").alias("link_no", "_pair"))
    rows = rows.filter(F.col("link_no") > 0).select(key, "link_no", "_pair.*")
    href = T.decode_entities(attribute(F.regexp_extract("piece", r"(?i)^<a\s[^>]*>", 0), "href"))
    rows = rows.withColumn("href", href).filter(F.contains("href", F.lit(K.LEGAL_PATH)))
    rows = rows.withColumn("document_id", I.uri_document_id(F.col("href")))
    rows = rows.filter(I.valid_document_id(F.col("document_id")))
    return rows.select(key, "link_no", I.absolute_url(base_url, F.col("href")).alias("url"), "title", "document_id")


# --- metadata pages -----------------------------------------------------------------------------


def page_metadata(pages: DataFrame, html: str) -> DataFrame:
    """Adds the metadata columns of a document page and status; a missing mandatory part fails it.

    All fields of a page are read in one step (``page_fields``).
    """
    df = pages.withColumn("_m", F.arrow_udf(M.read, M.SCHEMA)(F.col(html).cast("binary")))
    field = lambda name: F.col(f"_m.{name}")
    none = F.array().cast("array<string>")
    complete = field("celex_number").isNotNull() & field("title").isNotNull() & field("eli_uri").isNotNull()
    return df.select(
        *pages.columns, *[field(n) for n in ("celex_number", "title", "identifier", "eli_uri")],
        F.create_map(*[x for i, label in enumerate(K.DATE_LABELS) for x in (F.lit(label), F.coalesce(field(f"date_{i}"), F.lit("")))]).alias("dates"),
        F.coalesce(field("authors"), none).alias("authors"),
        *[F.coalesce(field(n), F.lit("")).alias(n) for n in ("responsible_body", "form")],
        *[F.coalesce(field(n), none).alias(n) for n in ("eurovoc_descriptors", "subject_matters", "directory_codes", "directory_descriptions")],
        F.when(complete, "ok").otherwise("incomplete").alias("status"),
    )
