"""Identifiers, addresses, paths and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import constants as K


def valid_document_id(doc_id: Column) -> Column:
    """Nine characters starting with a year; a 9 in fifth place marks a correction and is refused."""
    bare = F.regexp_replace(doc_id, "^L_", "")
    ok = (
        (F.substring(bare, 5, 1) != "9")
        & (F.length(bare) == 9)
        & bare.rlike("^[0-9]{4}")
    )
    return F.coalesce(ok, F.lit(False))


def normalise_identifier(identifier: Column) -> Column:
    trimmed = F.trim(identifier)
    return F.when(trimmed.rlike(K.IDENTIFIER), trimmed).otherwise(F.lit(""))


def parse_date(text: Column) -> Column:
    """Day-first with slashes or dots, or ISO; anything else, or no real calendar day, is null."""
    def shaped(pattern, fmt):
        # Texts of another shape never reach the parser, whose failures are exceptions.
        return F.when(text.rlike(pattern), F.try_to_date(text, fmt))

    return F.coalesce(
        shaped(r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
        shaped(r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
        shaped(r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    )


def parse_timestamp(text: Column) -> Column:
    """A timestamp, or null for anything that does not begin like one."""
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}"), F.try_to_timestamp(text))


def coerced_timestamp(text: Column) -> Column:
    """A timestamp from text in any of several shapes, or null.

    Year first (dashes, slashes, or digits alone), month first with slashes (day first where the first number is no month), day first
    with dots, and English month names; a time of day may follow.
    """
    parts = F.regexp_extract(F.trim(text), r"^(.*?)(?:[ T]+(\d{1,2}:\d{2}(?::\d{2})?))?$", 1)
    time = F.regexp_extract(F.trim(text), r"[ T](\d{1,2}:\d{2}(?::\d{2})?)$", 1)
    named = F.initcap(F.lower(F.regexp_replace(parts, r"[ ,]+", " ")))

    def shaped(value, pattern, *formats):
        # Texts of another shape never reach the parser.
        return F.coalesce(*[F.when(value.rlike(pattern), F.try_to_date(value, f)) for f in formats])

    day = F.coalesce(
        shaped(parts, r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), shaped(parts, r"^\d{4}-\d{1,2}$", "yyyy-M"),
        shaped(parts, r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"), shaped(parts, r"^\d{8}$", "yyyyMMdd"),
        shaped(parts, r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy", "d/M/yyyy"), shaped(parts, r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
        shaped(named, r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"), shaped(named, r"^\d{1,2} [A-Z][a-z]{2,} \d{4}$", "d MMMM yyyy"),
        shaped(named, r"^[A-Z][a-z]{2} \d{1,2} \d{4}$", "MMM d yyyy"), shaped(named, r"^[A-Z][a-z]{2,} \d{1,2} \d{4}$", "MMMM d yyyy"))
    full = F.when(F.length(time) == 0, "00:00:00").when(F.length(time) <= 5, F.concat(time, F.lit(":00"))).otherwise(time)
    return F.try_to_timestamp(F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), F.when(day.isNotNull(), full)))


def daily_view_url(base: str, day: Column) -> Column:
    return F.concat(F.lit(f"{base}/oj/daily-view/L-series/default.html?ojDate="),
                    F.date_format(day, "ddMMyyyy"))


def document_url(base: str, doc_id: Column, view: str = "ALL") -> Column:
    return F.concat(F.lit(f"{base}/{K.LEGAL_PATH}{view}/?{K.URI_MARK}"), doc_id)


def journal_id(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def uri_document_id(href: Column) -> Column:
    """What follows the last uri mark, up to the next '&'; null without a mark."""
    tail = F.substring_index(href, K.URI_MARK, -1)
    return F.when(F.contains(href, F.lit(K.URI_MARK)), F.split_part(tail, F.lit("&"), F.lit(1)))


def absolute_url(base: str, href: Column) -> Column:
    return (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.lit(base.split("://")[0] + ":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(F.lit(base), href))
        .otherwise(F.concat(F.lit(base + "/"), href))
    )


def path_date(path: Column) -> Column:
    """Date from a parent folder named yyyyMMdd (exactly eight characters); null otherwise."""
    folder = F.try_element_at(F.split(path, "/", -1), F.lit(-2))
    return F.when(folder.rlike("^[0-9]{8}$"), F.try_to_date(folder, "yyyyMMdd"))


def snapshot_time(name: Column) -> Column:
    """Second and third underscore parts of a file name as a time; the epoch on failure."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    stamp = F.concat_ws("_", F.split_part(stem, F.lit("_"), F.lit(2)),
                        F.split_part(stem, F.lit("_"), F.lit(3)))
    return F.coalesce(F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss")),
                      F.timestamp_seconds(F.lit(0)))
