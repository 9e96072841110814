"""Metadata rules and request planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import ids as I


def metadata_errors(meta: str = "metadata") -> Column:
    """Names of violated rules: celex_number is required, title is required and not empty."""
    celex, title = F.col(f"{meta}.celex_number"), F.col(f"{meta}.title")
    rules = F.array(
        F.when(celex.isNull(), F.lit("celex_number")),
        F.when(title.isNull() | (F.length(title) < 1), F.lit("title")),
    )
    return F.filter(rules, lambda r: r.isNotNull())


# Fields of a metadata record that must be strings, or lists of strings.
STRING_FIELDS = ("celex_number title identifier eli_uri html_url pdf_url responsible_body form").split()
DATE_FIELDS = ("Date of document", "Date of effect", "Date of end of validity")
LIST_FIELDS = "authors eurovoc_descriptors subject_matters directory_codes directory_descriptions".split()


def type_errors(record: Column) -> Column:
    """Names of the fields of a raw JSON record that are there with a wrong type; ``record`` if it is no JSON object.

    Works on the text, before a schema turns what does not fit into nulls.
    """
    tree = F.try_parse_json(record)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(tree, path, "variant"))
    wrong = lambda path, name, *right: F.when(kind(path).isNotNull() & ~kind(path).isin(*right), F.lit(name))
    checks = [F.when(tree.isNull() | ~F.startswith(F.schema_of_variant(tree), F.lit("OBJECT")), F.lit("record"))]
    checks += [wrong(f"$.{f}", f, "STRING") for f in STRING_FIELDS]
    checks += [wrong(f"$.dates['{f}']", f"dates.{f}", "STRING") for f in DATE_FIELDS]
    checks += [wrong(f"$.{f}", f, "ARRAY<STRING>", "ARRAY<VOID>") for f in LIST_FIELDS]
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def validate(docs: DataFrame) -> DataFrame:
    """Adds errors and blanks identifiers that do not fit; rows are split by size(errors)."""
    return docs.withColumn("errors", metadata_errors()).withColumn(
        "metadata", F.col("metadata").withField("identifier", I.normalise_identifier(F.col("metadata.identifier"))))


def date_range_plan(requests: DataFrame, base_url: str) -> DataFrame:
    """One row per day of every accepted (start, end) request, with its address and journal id."""
    ok = (F.col("start") >= F.lit(K.COLLECTION_START).cast("date")) & (F.col("end") >= F.col("start"))
    return requests.filter(ok).select(
        "request", F.explode(F.sequence("start", "end")).alias("day")
    ).select(
        "request",
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        I.daily_view_url(base_url, F.col("day")).alias("url"),
        I.journal_id(F.col("day")).alias("journal_id"),
    )
