"""Ingest job: metadata page and text page of a document to a stored record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions import ids as I
from docloom.operators import pages as P
from docloom.session import materialise
from docloom.sources import documents as store

SUCCESS = "success"
OUTCOMES = (SUCCESS, "metadata failed", "already stored", "text failed")


def assembled(pages: DataFrame, seen: DataFrame, base_url: str, doc_id: str = "doc_id", meta_html: str = "meta_html", text_html: str = "text_html") -> DataFrame:
    """Adds ``status``, and for a success ``metadata`` and ``content`` in the DOCUMENT schema.

    Both pages of a document are in one row and are read there. Seen keys are taken out after the metadata is read, as the
    key is part of it. ``seen``: column celex_number.
    """
    rows = P.page_metadata(pages, meta_html).withColumnRenamed("status", "_meta")
    rows = P.page_text(rows, text_html).withColumnRenamed("status", "_text")
    known = seen.select("celex_number").distinct().withColumn("_seen", F.lit(True))
    rows = rows.join(known, "celex_number", "left")
    status = (F.when(F.col("_meta") != "ok", OUTCOMES[1]).when(F.col("_seen"), OUTCOMES[2])
              .when(F.col("_text") != "ok", OUTCOMES[3]).otherwise(SUCCESS))
    own: dict[str, Column] = {"html_url": I.document_url(base_url, F.col(doc_id), "TXT"), "pdf_url": I.document_url(base_url, F.col(doc_id), "TXT/PDF")}
    metadata = F.struct(*[own.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schemas.METADATA.fields])
    ok = F.col("status") == SUCCESS
    return rows.withColumn("status", status).select(
        *[c for c in pages.columns if c not in (meta_html, text_html)], "status",
        F.when(ok, metadata).alias("metadata"), F.when(ok, F.col("full_text")).alias("content"))


@dataclass
class Ingested:
    """What a run left: the outcome of every document, counts by outcome seen while it was written, and the folder of the store."""

    outcomes: DataFrame
    counts: dict[str, int]
    path: str


def ingest(pages: DataFrame, seen: DataFrame, path: str, base_url: str, day: Column, journal: Column, **columns: str) -> Ingested:
    """Assembles all documents in one pass and upserts the successful ones into the store at ``path``.

    The pages are parsed once: what comes of them is written and counted on the way, and the store takes its records
    from the successes among it. Of all others no texts are written.
    """
    rows = store.with_partitions(assembled(pages, seen, base_url, **columns), day, journal)
    rows = rows.withColumn("n_chars", F.coalesce(F.length("content"), F.lit(0)))
    counted = Observation("outcomes")
    rows = rows.observe(counted, *[F.count_if(F.col("status") == s).alias(s) for s in OUTCOMES])
    written = materialise(rows, "ingested")
    done = written.filter(F.col("status") == SUCCESS).withColumn("doc_id", F.col("metadata.celex_number"))
    if counted.get[SUCCESS]:
        store.store(done, path, written=True)
    return Ingested(written, counted.get, path)
