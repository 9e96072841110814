"""Sharding by a hierarchical weighted hash tree (operator 10): built-in functions only.

A topology is regions of racks of shards, each shard with a weight; racks and regions weigh what
is below them. A key starts at the root and draws among the regions, then among that region's
racks, then among that rack's shards: a child's draw is -ln(u) / weight with u in (0, 1) from a
hash of the child's name and the key, and the smallest draw wins, which falls on each child in
proportion to its weight. A draw depends on no other child, so a key only moves when the weight
of a subtree on its way changes, and then only into what grew or out of what shrank. ``grow``
adds a shard as a region of its own: no other weight changes, so it alone takes keys.

Law of the query: ``key``. doc_id and the topology, eight equal shards or those and one more,
decide.

Defined results: a null doc_id is a key as any other; a null text has no bytes (size 1, CRC 0) like
an empty one; repeated rows share a shard and have slots of their own; an empty table gives no rows;
other columns are not read. Slots are numbered through buckets of a hash of doc_id and text, so no
task holds a whole shard unless all its rows are equal.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import common as C
from docloom.llm.registry import query
from docloom.sources.tables import load


class Shard(NamedTuple):
    number: int
    region: str
    rack: str
    weight: float = 1.0


def even_topology(shards: int, racks: int = 2, regions: int = 2) -> list[Shard]:
    """Equal shards over so many racks in each of so many regions."""
    return [Shard(i, f"region{i % regions}", f"rack{i // regions % racks}") for i in range(shards)]


def grow(topology: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, in a region of its own."""
    n = max(s.number for s in topology) + 1
    return [*topology, Shard(n, f"grown{n}", "rack0", weight)]


def draw(name: str, weight: float, key: Column) -> Column:
    """-ln(u) / weight, u from 52 bits of the MD5 of name and key."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(name), key)), 1, 13), 16, 10).cast("long")
    return -F.ln((bits.cast("double") + 0.5) / F.lit(float(1 << 52))) / F.lit(weight)


def descend(shards: list[Shard], key: Column, level: int = 0, name: str = "") -> Column:
    """Number of the shard that the key comes to, among those below one node."""
    if level == 3:
        return F.lit(shards[0].number)
    below: dict[str, list[Shard]] = {}
    for s in shards:
        below.setdefault((s.region, s.rack, str(s.number))[level], []).append(s)
    found = {child: descend(some, key, level + 1, f"{name}/{child}") for child, some in below.items()}
    if len(below) == 1:
        return next(iter(found.values()))
    draws = {child: draw(f"{name}/{child}", sum(s.weight for s in some), key) for child, some in below.items()}
    least = F.least(*draws.values())
    *first, last = below
    out = found[last]
    for child in reversed(first):
        out = F.when(draws[child] == least, found[child]).otherwise(out)
    return out


def place(docs: DataFrame, topology: list[Shard]) -> DataFrame:
    """Adds shard and slot, its gapless number within the shard from 0; columns of these names are replaced."""
    rows = docs.drop("shard", "slot").withColumn("shard", descend(topology, F.col("doc_id").cast("string")))
    rows = rows.withColumn("__order", C.hex_hash(F.col("doc_id").cast("string"), F.col("text"))).withColumn("__one", F.lit(1).cast("long"))
    return C.running(rows, "shard", "__order", "__one", "slot").drop("__order", "__one")


def sql_tree(shards: list[Shard], level: int = 0, name: str = "") -> str:
    if level == 3:
        return str(shards[0].number)
    below: dict[str, list[Shard]] = {}
    for s in shards:
        below.setdefault((s.region, s.rack, str(s.number))[level], []).append(s)
    if len(below) == 1:
        child, some = next(iter(below.items()))
        return sql_tree(some, level + 1, f"{name}/{child}")
    draws = [f"-ln((('0x' || substr(md5('{name}/{c}' || coalesce(':' || doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)"
             f" / 4503599627370496.0::DOUBLE) / {sum(s.weight for s in some)}::DOUBLE" for c, some in below.items()]
    # arg_min over the children of this node
    numbers = [sql_tree(some, level + 1, f"{name}/{c}") for c, some in below.items()]
    return f"[{', '.join(numbers)}][list_position([{', '.join(draws)}], list_min([{', '.join(draws)}]))]"


SHARDS = 8
TOPOLOGY = even_topology(SHARDS)
ORACLE = f"""WITH tab AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) r(i)),
d AS (SELECT doc_id, text, coalesce(octet_length(encode(text)), 0)::BIGINT AS n, {sql_tree(TOPOLOGY)}::INT AS shard, {sql_tree(grow(TOPOLOGY))}::INT AS grown_shard,
  {C.hex_hash_sql("doc_id::VARCHAR", "text")} AS h FROM documents),
c AS (SELECT *, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes FROM d)
SELECT doc_id, n + 1 AS size, xor(4294967295, list_reduce(bytes, lambda c, x: xor(c >> 8, t[((xor(c, ('0x' || x)::BIGINT)) & 255) + 1]), 4294967295::BIGINT)) AS text_crc32,
  'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY h, doc_id) - 1 AS slot, grown_shard FROM c, tab"""


@query("op10_shard_tree", ORACLE)
def op10_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.col("doc_id").cast("string")
    narrow = docs.select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.lit("key").alias("law"),
        descend(TOPOLOGY, key).alias("shard"), descend(grow(TOPOLOGY), key).alias("grown_shard"),
        C.hex_hash(key, F.col("text")).alias("order"), F.lit(1).cast("long").alias("one"))
    return C.running(narrow, "shard", "order", "one", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
