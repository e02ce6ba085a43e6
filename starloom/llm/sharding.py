"""Shards by a weighted hash tree (operator 11).

The tree has three levels: regions hold racks, racks hold shards. A row descends by its key: at every level each child
draws a hash of the key and of its own path, divided by its weight (an exponential clock), and the child whose clock
rings first wins, so a child gets its share of the weight and the draws of the others never change. The weight of a rack
or region is that of its shards, so a change moves rows only between a subtree whose weight has changed and the rest;
a shard in a region of its own takes rows only into itself.

Rows get a gapless place in their shard by a range sort over all shards and an offset for every range, so no shard has
to fit a task.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import read, store, text_or_empty
from .registry import query

LEVELS = 3
_DIGITS = 13  # hexadecimal digits of a draw: 52 bits, so that adding one half is exact
_ROW_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def balanced(regions: int = 2, racks: int = 2, shards: int = 2) -> list[Leaf]:
    """A tree of equal weights: ``shards`` shards in each rack, ``racks`` racks in each region."""
    return [Leaf(r, k, (r * racks + k) * shards + s) for r in range(regions) for k in range(racks) for s in range(shards)]


def with_one_more(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree and a further shard, in a region of its own: it takes rows from all others, which exchange none."""
    return [*tree, Leaf(max((x.region for x in tree), default=-1) + 1, 0, max((x.shard for x in tree), default=-1) + 1, weight)]


def _children(tree: list[Leaf]) -> dict[str, dict[int, float]]:
    """Children and their weights for every inner node; nodes are named by their path from the root."""
    if len({x.shard for x in tree}) < len(tree):
        raise ValueError("a shard stands twice in the tree")
    found: dict[str, dict[int, float]] = defaultdict(lambda: defaultdict(float))
    for leaf in tree:
        if leaf.weight < 0:
            raise ValueError(f"shard {leaf.shard} has a negative weight")
        if leaf.weight:
            for node, child in (("", leaf.region), (f"/{leaf.region}", leaf.rack), (f"/{leaf.region}/{leaf.rack}", leaf.shard)):
                found[node][child] += leaf.weight
    if not found:
        raise ValueError("no shard has any weight")
    return found


def descend(key: Column, tree: list[Leaf]) -> Column:
    """The shard of a key, a string. The tree travels with the expression: its size is that of the list of shards."""
    nodes = F.create_map(*[
        part for node, children in _children(tree).items()
        for part in (F.lit(node), F.array(*[
            F.struct(F.lit(child).alias("child"), F.lit(float(weight)).alias("weight")) for child, weight in sorted(children.items())]))])

    def lower(node: Column, child: Column) -> Column:
        draw = F.conv(F.substring(F.md5(F.concat_ws("/", key, F.concat(node, F.lit("/"), child["child"].cast("string")))), 1, _DIGITS), 16, 10)
        clock = -F.log((draw.cast("double") + 0.5) / float(16**_DIGITS)) / child["weight"]
        return F.struct(clock.alias("clock"), child["child"].alias("child"))

    def level(node: Column, _) -> Column:
        first = F.array_min(F.transform(F.element_at(nodes, node), lambda child: lower(node, child)))
        return F.concat(node, F.lit("/"), first["child"].cast("string"))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), F.lit(""), level)
    return F.substring_index(path, "/", -1).cast("int")


def assign(docs: DataFrame, tree: list[Leaf], grown: list[Leaf] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard): the shard of every row and its place there, from 0 and gapless.

    The shard depends on doc_id and tree alone, so rows of one doc_id, and all rows without one, share a shard. Null
    texts have the size 1, that of an empty text. Places follow a hash of doc_id, then doc_id, size and checksum; rows
    equal in all of these are interchangeable and stand side by side. ``grown_shard`` is the shard in the tree
    ``grown``, null if that is not given. Other columns are not read. An empty table gives none.
    """
    text = F.encode(text_or_empty(), "UTF-8")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(key).alias("order"), descend(key, tree).alias("shard"),
        (descend(key, grown) if grown is not None else F.lit(None).cast("int")).alias("grown_shard"))
    # Once written, a row has a number of its own, which lets any number of equal rows be dealt over many ranges.
    rows = store(rows.withColumn("row", F.monotonically_increasing_id()), "shards")
    order = ["shard", "order", "doc_id", "size", "text_crc32", "row"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ranged = store(ranged.drop("order", "row").withColumn("range", F.shiftright("at", _ROW_BITS)), "ranges")
    # A range holds the end of one shard and the beginning of others: ranges + shards rows.
    runs = ranged.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "range", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return ranged.join(F.broadcast(runs), ["shard", "range"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("shift")).alias("slot"), "grown_shard")


def _draw_sql(node: str, child: str) -> str:
    number = f"CAST('0x' || substr(md5(concat_ws('/', key, {node} || '/' || {child})), 1, 13) AS BIGINT)"
    return f"-ln((CAST({number} AS DOUBLE) + 0.5) / 4503599627370496.0::DOUBLE)"


def _pick_sql(node: str, children: str) -> str:
    """Of the (child, weight) structs ``children`` the child whose clock rings first."""
    return f"list_min([{{'clock': {_draw_sql(node, 'CAST(c.child AS VARCHAR)')} / c.weight, 'child': c.child}} for c in {children}]).child"


def _crc_sql(data: str) -> str:
    """CRC-32 of the bytes that ``data`` spells in hexadecimal, four bits at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(f"{value}::BIGINT")
    step = lambda c: f"xor({c} >> 4, [{','.join(table)}][({c} & 15) + 1])"
    bytes_ = f"[CAST('0x' || b AS BIGINT) for b in regexp_extract_all({data}, '..')]"
    return f"xor(list_reduce({bytes_}, lambda c, b: {step(step('xor(c, b)'))}, 4294967295::BIGINT), 4294967295::BIGINT)"


OP11_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key, hex(encode(coalesce(text, ''))) AS t FROM documents),
regions AS (SELECT *,
    {_pick_sql("''", "[{'child': 0, 'weight': 4.0}, {'child': 1, 'weight': 4.0}]")} AS region,
    {_pick_sql("''", "[{'child': 0, 'weight': 4.0}, {'child': 1, 'weight': 4.0}, {'child': 2, 'weight': 1.0}]")} AS grown FROM t),
racks AS (SELECT *,
    {_pick_sql("'/' || region", "[{'child': 0, 'weight': 2.0}, {'child': 1, 'weight': 2.0}]")} AS rack FROM regions),
shards AS (SELECT *,
    {_pick_sql("'/' || region || '/' || rack",
               "[{'child': 4 * region + 2 * rack, 'weight': 1.0}, {'child': 4 * region + 2 * rack + 1, 'weight': 1.0}]")} AS shard FROM racks),
sized AS (SELECT doc_id, md5(key) AS ordered, strlen(t) // 2 + 1 AS size, {_crc_sql('t')} AS text_crc32, shard,
    CASE WHEN grown = 2 THEN 8 ELSE shard END AS grown_shard FROM shards)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY ordered, doc_id, size, text_crc32) - 1 AS BIGINT) AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM sized
"""


@query("op11_hash_tree_shards", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = balanced()
    return assign(read(spark, sf_dir, "documents"), tree, with_one_more(tree)).withColumn("law", F.lit("key"))
