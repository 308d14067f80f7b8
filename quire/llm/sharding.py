"""Sharding by a hierarchical weighted hash tree.

Shards are leaves under racks under regions.  A row descends from the root: at
each level every child draws ``-ln(u) / weight``, u a hash of the row's key and the
child's name, and the least draw wins.  A draw depends on nothing but its own
child, so a change of one weight moves rows only into or out of that child's
subtree.  The first ``BASE`` shards fill regions of two racks of five; each further
shard opens a region of its own, so one more shard takes rows only into itself.

Native expressions only: a row is placed without a shuffle.  Slots number the rows
of a shard from 0 without gaps: rows are numbered in hash parts of every shard, by id,
checksum and size, and a small table (shards times parts) holds where each part begins.
A part is chosen by key and checksum, so rows without an id are spread too, and there
are more parts with more rows: a part holds some ``PART_ROWS`` rows at any size.

Results for odd rows: a null id is the key ``null``; null texts have 16 bytes and
the checksum of the empty text; repeated rows share a shard and have a slot each.
An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BASE, RACKS, LEAVES, PARTS, PART_ROWS, FEW = 40, 2, 5, 64, 250_000, 1_000_000


@dataclass
class Node:
    name: str
    weight: float
    shard: int | None = None
    children: list["Node"] = field(default_factory=list)


def tree(shards: int, weights: dict[int, float] | None = None, base: int = BASE) -> Node:
    """Region, rack and shard levels for ``shards`` leaves."""
    w = weights or {}
    root = Node("", 0.0)
    place: dict[tuple[int, int], Node] = {}
    for s in range(shards):
        region = s // (RACKS * LEAVES) if s < base else -(-base // (RACKS * LEAVES)) + s - base
        rack = s // LEAVES % RACKS if s < base else 0
        if (region, -1) not in place:
            place[region, -1] = Node(f"g{region}", 0.0)
            root.children.append(place[region, -1])
        if (region, rack) not in place:
            place[region, rack] = Node(f"g{region}r{rack}", 0.0)
            place[region, -1].children.append(place[region, rack])
        leaf = Node(f"s{s}", w.get(s, 1.0), s)
        place[region, rack].children.append(leaf)
        for n in (place[region, rack], place[region, -1], root):
            n.weight += leaf.weight
    return root


def _literal(nodes: list[Node], depth: int) -> Column:
    """Children as array<struct<name, weight, below>>; below a leaf is its shard."""
    below = lambda n: _literal(n.children, depth - 1) if depth else F.lit(n.shard)
    return F.array(*[F.struct(F.lit(n.name).alias("name"), F.lit(n.weight).alias("weight"), below(n).alias("below")) for n in nodes])


def _least(key: Column, children: Column) -> Column:
    """What lies below the child with the least draw."""

    def draw(c: Column, i: Column) -> Column:
        digits = F.substring(F.md5(F.concat(key, F.lit("/"), c["name"])), 1, 12)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)
        return F.struct((-F.log(u) / c["weight"]).alias("d"), i.alias("i"))

    chosen = lambda nodes: nodes[F.array_min(F.transform(nodes, draw))["i"]]["below"]
    return F.transform(F.array(children), chosen)[0]  # the level is named twice, worked out once


def descend(key: str, root: Node) -> Column:
    """The shard of a key: region, rack, then leaf."""
    k = F.col(key)
    return _least(k, _least(k, _least(k, _literal(root.children, 2)))).cast("int")


def shard(docs: DataFrame, shards: int = BASE, weights: dict[int, float] | None = None, parts: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("__key"))
    # A generator's columns are worked out once, whatever is joined or grouped by them.
    placed = F.struct(descend("__key", tree(shards, weights)).alias("shard"), descend("__key", tree(shards + 1, weights)).alias("grown_shard"))
    rows = rows.select("*", F.inline(F.array(placed)))
    parts = parts or max(PARTS, -(-docs.count() // (shards * PART_ROWS)))
    digits = F.substring(F.md5(F.concat_ws("/", "__key", F.col("text_crc32").cast("string"))), 1, 8)
    rows = rows.withColumn("__part", (F.conv(digits, 16, 10).cast("long") % parts).cast("int"))
    counts = rows.groupBy("shard", "__part").agg(F.count("*").alias("__n"))
    first = counts.select("shard", "__part", (F.sum("__n").over(Window.partitionBy("shard").orderBy("__part")) - F.col("__n")).alias("__first"))
    place = Window.partitionBy("shard", "__part").orderBy("doc_id", "text_crc32", "size")
    few = shards * parts <= FEW
    out = rows.withColumn("__at", F.row_number().over(place) - 1).join(F.broadcast(first) if few else first, ["shard", "__part"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("__first") + F.col("__at")).cast("long").alias("slot"), "grown_shard")


def _sql_draw(node: Node) -> str:
    return f"-ln((CAST(('0x' || substr(md5(k || '/{node.name}'), 1, 12)) AS UBIGINT) + 0.5) / {float(1 << 48)!r}) / {node.weight!r}"


def _sql_least(nodes: list[Node]) -> str:
    if len(nodes) == 1:
        return "0"
    return "list_aggregate([" + ", ".join(f"{{'d': {_sql_draw(n)}, 'i': {i}}}" for i, n in enumerate(nodes)) + "], 'min').i"


def _sql_shard(root: Node) -> str:
    case = []
    for g, region in enumerate(root.children):
        racks = " ".join(f"WHEN {r} THEN CASE {_sql_least(rack.children)} " + " ".join(f"WHEN {i} THEN {x.shard}" for i, x in enumerate(rack.children)) + " END" for r, rack in enumerate(region.children))
        case.append(f"WHEN {g} THEN CASE {_sql_least(region.children)} {racks} END")
    return f"CAST(CASE {_sql_least(root.children)} {' '.join(case)} END AS INTEGER)"


#: Checksum of a blob's bytes in SQL: the table of 256 remainders is worked out from its polynomial.
_SQL_CRC = """
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, octet_length(b)), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS UBIGINT))),
        lambda a, c: xor(a >> 8, r[CAST(xor(a, c) & 255 AS INTEGER) + 1])), 4294967295::UBIGINT)"""


def oracle(shards: int = BASE, parts: int = PARTS) -> str:
    """The same in DuckDB SQL, for tables of no more than ``parts`` parts a shard."""
    return f"""
        WITH t AS (
            SELECT list(list_reduce(list_prepend(n, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) ORDER BY n) AS r
            FROM (SELECT unnest(range(256))::UBIGINT AS n)
        ), d AS (
            SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS x FROM documents
        ), c AS (
            SELECT doc_id, k, CAST(octet_length(b) + 16 AS BIGINT) AS size, CAST({_SQL_CRC} AS BIGINT) AS text_crc32 FROM d, t
        ), s AS (
            SELECT *, {_sql_shard(tree(shards))} AS shard, {_sql_shard(tree(shards + 1))} AS grown_shard,
                   CAST('0x' || substr(md5(k || '/' || text_crc32), 1, 8) AS UBIGINT) % {parts} AS part
            FROM c
        )
        SELECT doc_id, size, text_crc32, 'key' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY part, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
        FROM s"""
