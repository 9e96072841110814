"""Star schema of a document collection and the questions asked of it."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.ids import parse_date
from docloom.operators import heavy as H
from docloom.session import materialise

# --- building the schema from document records ---------------------------------------------


def numbered(written: DataFrame, id_name: str) -> DataFrame:
    """Numbers 1, 2, 3, ... without gaps, from a written table's column ``_at`` (its rows' increasing ids).

    Every partition of the job that wrote the rows counted on from a start of its own; the partitions' sizes, one row each,
    move them together. So numbers cannot collide, and no task sees all rows.
    """
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    rows = written.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return rows.select((F.col("_before") + place + 1).alias(id_name), *[c for c in written.columns if c != "_at"])


def at_rest(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once with the column ``_at``."""
    return materialise(rows.withColumn("_at", F.monotonically_increasing_id()), purpose)


def members(docs: DataFrame, values: Column, name: str) -> DataFrame:
    """Distinct members of an array column (or of a plain column wrapped in an array)."""
    return docs.select(F.explode(values).alias(name)).filter(F.col(name).isNotNull() & (F.col(name) != "")).distinct()


def dimension(docs: DataFrame, values: Column, id_name: str, name: str) -> DataFrame:
    """A dimension numbered in order of its names: sorted by range, so that no task sorts all of them."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = members(docs, values, name).repartitionByRange(n, name).sortWithinPartitions(name)
    return numbered(at_rest(ordered, "members"), id_name)


def natural_dimension(docs: DataFrame, values: Column, id_name: str, name: str) -> DataFrame:
    """A dimension whose members are their own keys."""
    return members(docs, values, name).select(F.col(name).alias(id_name), name)


def junction(docs: DataFrame, doc_key: str, values: Column, dim: DataFrame, id_name: str, name: str) -> DataFrame:
    """Distinct (document, member) pairs; repeats inside one document go before the shuffle."""
    links = docs.select(doc_key, F.explode(F.array_distinct(values)).alias(name))
    return links.join(dim.select(id_name, name), name).select(doc_key, id_name)


def one_per_celex(docs: DataFrame) -> DataFrame:
    """The documents with a key, each key once: of several the one with the greatest digest, found by a combined maximum."""
    key = F.col("metadata.celex_number")
    marked = docs.filter(key.isNotNull()).withColumn("_digest", F.md5(F.to_json(F.struct(*docs.columns))))
    best = marked.groupBy(key.alias("_key")).agg(F.max("_digest").alias("_best"))
    same = (key == F.col("_key")) & (F.col("_digest") == F.col("_best"))
    return marked.withColumn("_k", key).join(best, same, "left_semi").dropDuplicates(["_k"]).select(*docs.columns)


#: Dimension to the documents' column, its key and its name; the first two are looked up from the fact table.
DIMENSIONS = {
    "forms": ("form", "form_id", "form_name"),
    "responsible_bodies": ("responsible_body", "responsible_body_id", "body_name"),
    "authors": ("authors", "author_id", "name"),
    "eurovoc_descriptors": ("eurovoc_descriptors", "descriptor_id", "descriptor_name"),
    "subject_matters": ("subject_matters", "subject_id", "subject_name"),
}
LOOKUPS = ("forms", "responsible_bodies")
TABLES = ("documents", *DIMENSIONS, "directory_codes", *[f"document_{d}" for d in (*DIMENSIONS, "directory_codes") if d not in LOOKUPS])


def star_schema(docs: DataFrame, wanted: Collection[str] = TABLES) -> dict[str, DataFrame]:
    """Fact, lookup, dimension and junction tables from documents in the DOCUMENT schema, ``html_content`` beside it if there is one.

    Keys are numbers without gaps. Dimensions are written before facts look their names up, so the planner knows their size;
    what is not wanted is not built.
    """
    html = F.col("html_content") if "html_content" in docs.columns else F.lit(None).cast("string")
    unique = one_per_celex(docs).select("metadata.*", "content", html.alias("html_content"))
    # Documents are numbered where they lie: their texts are not sorted for it.
    m = numbered(at_rest(unique, "documents"), "document_id")
    pairs = F.arrays_zip(F.col("directory_codes").alias("code"), F.col("directory_descriptions").alias("label"))
    codes = m.select("document_id", F.explode(pairs).alias("d")).select(
        "document_id", F.col("d.code").alias("directory_code"), F.col("d.label").alias("directory_label"))
    codes = codes.filter(F.col("directory_code").isNotNull() & (F.col("directory_code") != ""))
    built: dict[str, DataFrame] = {}

    def dim(name: str) -> DataFrame:
        if name not in built:
            if name == "directory_codes":
                labels = codes.groupBy("directory_code").agg(F.min("directory_label").alias("directory_label"))
                built[name] = numbered(at_rest(labels, "members"), "directory_id")
            else:
                column, key, label = DIMENSIONS[name]
                built[name] = dimension(m, F.array(F.col(column)) if name in LOOKUPS else F.col(column), key, label)
        return built[name]

    def links(name: str) -> DataFrame:
        if name == "directory_codes":
            keys = dim(name).select("directory_id", "directory_code")
            return codes.select("document_id", "directory_code").distinct().join(keys, "directory_code").select("document_id", "directory_id")
        column, key, label = DIMENSIONS[name]
        return junction(m, "document_id", F.col(column), dim(name), key, label)

    def facts() -> DataFrame:
        date = lambda label: parse_date(F.try_element_at("dates", F.lit(label)))
        known = m
        for name in LOOKUPS:
            column, _, label = DIMENSIONS[name]
            known = known.join(dim(name).withColumnRenamed(label, column), column, "left")
        return known.select(
            "document_id", "celex_number", "title", "identifier", "eli_uri", "html_url", "pdf_url", "responsible_body_id", "form_id",
            date("Date of document").alias("date_of_document"),
            date("Date of effect").alias("date_of_effect"),
            date("Date of end of validity").alias("date_of_end_validity"),
            "content", "html_content")

    return {t: facts() if t == "documents" else links(t.removeprefix("document_")) if t.startswith("document_") else dim(t) for t in wanted}


# --- questions ---------------------------------------------------------------------------


def enrich(docs: DataFrame, forms: DataFrame, bodies: DataFrame) -> DataFrame:
    """Left lookups of form and body names.

    The lookups are written first, so the planner sees their true size: the facts stay where they
    are beside small ones, and a large one gets a skew-split join.
    """
    bodies, forms = materialise(bodies, "bodies"), materialise(forms, "forms")
    return docs.join(bodies, "responsible_body_id", "left").join(forms, "form_id", "left")


def count_by_lookup(docs: DataFrame, lookup: DataFrame, key: str, name: str, doc_key: str) -> DataFrame:
    """Documents per lookup member through a left join, the null member kept.

    Counting comes first, so the join sees one row per key however often the key occurs.
    """
    counts = docs.groupBy(key).agg(F.count(doc_key).alias("doc_count"))
    matched = counts.join(lookup.withColumn("_hit", F.col(key)), key, "left")
    return matched.groupBy("_hit").agg(
        F.first(name, ignorenulls=True).alias(name), F.sum("doc_count").alias("doc_count")
    ).drop("_hit").orderBy(F.desc("doc_count"), name)


def count_by_member(links: DataFrame, dim: DataFrame, key: str, name: str, doc_key: str) -> DataFrame:
    """Documents per dimension member: pre-aggregated links joined to the dimension."""
    counts = links.groupBy(key).agg(F.count(doc_key).alias("doc_count"))
    return counts.join(dim, key).select(name, "doc_count", key)


def top(counts: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    return counts.orderBy(F.desc(by), *ties).limit(k)


def pivot_counts(counts: DataFrame, index: str, column: str, values: Sequence[str], measure: str) -> DataFrame:
    """Cross table over a declared set of columns; absent cells are 0."""
    return counts.groupBy(index).pivot(column, list(values)).agg(F.sum(measure)).na.fill(0)


BLOCK = 256


def pairs_of(links: DataFrame, doc: str, member: str) -> DataFrame:
    """(member1, member2), the lesser first, of every two members of a document; from distinct (document, member) links.

    The members of a document are gathered in blocks of about ``BLOCK``, and paired within a block inside the row. An
    ordinary document is a single block; one with very many members is spread over its pairs of blocks.
    """
    sizes = links.groupBy(doc).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    blocked = links.join(sizes, doc).withColumn("block", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
    arrays = blocked.groupBy(doc, "block").agg(F.sort_array(F.collect_list(member)).alias("m"), F.max("blocks").alias("blocks"))
    pair = lambda a, b: F.struct(a.alias("member1"), b.alias("member2"))
    within = F.flatten(F.transform("m", lambda a, i: F.transform(F.slice("m", i + 2, F.size("m")), lambda b: pair(a, b))))
    inside = arrays.select(F.inline(within))
    x = arrays.filter(F.col("blocks") > 1).select(doc, "block", "m")
    y = x.select(F.col(doc).alias("_doc"), F.col("block").alias("_block"), F.col("m").alias("_m"))
    across = F.flatten(F.transform("m", lambda a: F.transform("_m", lambda b: pair(F.least(a, b), F.greatest(a, b)))))
    between = x.join(y, (F.col(doc) == F.col("_doc")) & (F.col("block") < F.col("_block"))).select(F.inline(across))
    return inside.union(between)


def pair_counts(links: DataFrame, doc: str, member: str) -> DataFrame:
    """Documents per unordered pair of members."""
    return pairs_of(links, doc, member).groupBy("member1", "member2").agg(F.count(F.lit(1)).alias("pair_count"))


def top_pairs(links: DataFrame, doc: str, member: str, k: int, seeds: int = H.SEEDS) -> DataFrame:
    """The k most frequent pairs, exactly; pairs that cannot be among them are counted by bucket only and never shuffled.

    This holds for flat degrees too, where no member can be left out. The distinct links are written once, as several steps read them.
    """
    links = materialise(links.select(doc, member), "links")
    best = H.most_frequent(pairs_of(links, doc, member), ["member1", "member2"], k, seeds=seeds)
    return best.withColumnRenamed("n", "pair_count")


def missing_report(df: DataFrame) -> DataFrame:
    """Nulls and their percentage per column, from one pass."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in cols])
    return row.select("n", F.explode(cells).alias("c")).select(
        "c.column", "c.missing",
        F.round(F.when(F.col("n") > 0, F.col("c.missing") * 100.0 / F.col("n")).otherwise(0.0), 6).alias("percent"))


def missing_share(df: DataFrame, column: str, by: str) -> DataFrame:
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(
        F.round(F.avg(F.col(column).isNull().cast("int")), 6).alias("missing_share")
    ).orderBy(F.desc("missing_share"), by)


def column_inventory(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with the number of values it holds."""
    row = df.agg(*[F.count(c).alias(c) for c in df.columns])
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("n_values"))
        for i, f in enumerate(df.schema.fields)
    ])
    return row.select(F.explode(cells).alias("c")).select("c.*")


def add_missing_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, value)


def monthly_counts(df: DataFrame, date: str) -> DataFrame:
    return df.filter(F.col(date).isNotNull()).groupBy(
        F.date_format(date, "yyyy-MM").alias("year_month")).agg(F.count(F.lit(1)).alias("doc_count"))


def seasonality(df: DataFrame, date: str) -> DataFrame:
    return df.filter(F.col(date).isNotNull()).groupBy(
        F.month(date).alias("month")).agg(F.count(F.lit(1)).alias("doc_count"))


ORDINAL_BUCKET = 1024


def with_ordinal(df: DataFrame, group: str, order: str, *ties: str) -> DataFrame:
    """0-based position inside a group by an integer order column.

    Rows are numbered inside (group, bucket of the order column) and shifted by the size of the
    earlier buckets, so a group that holds a third of all rows is not numbered in one task.
    """
    df = df.withColumn("_b", F.floor(F.col(order) / ORDINAL_BUCKET))
    upto = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).drop("_n")
    )
    inside = Window.partitionBy(group, "_b").orderBy(order, *ties)
    return df.join(offsets, [group, "_b"]).withColumn(
        "ordinal", F.col("_before") + F.row_number().over(inside) - 1).drop("_b", "_before")
