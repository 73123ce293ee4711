"""Sharding: a hierarchical weighted hash tree.

Regions hold racks, racks hold shards. A row descends from the root: at every level each child draws
-ln(u) / weight, with u from a hash of the row's key and the child's name, and the least draw wins. A child
whose weight grows only wins rows, one whose weight falls only loses some, and draws in other subtrees do
not change; so rows move only within, into or out of subtrees whose weights change. A shard added in a
region of its own takes rows only into itself.

All of it is column expressions. A shard's rows are numbered by way of buckets: rows within a bucket, and
buckets by their counts, so that no task holds a shard.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a numbering bucket, on average.
BUCKET_ROWS = 8192


@dataclass
class Node:
    """A leaf is a shard and has its number; a node's name must be unique and lasting."""

    name: str
    weight: float = 1.0
    shard: int | None = None
    children: list[Node] = field(default_factory=list)

    def total(self) -> float:
        return sum(c.total() for c in self.children) if self.children else self.weight


def tree(shards: int = 8, per_rack: int = 2, per_region: int = 4) -> Node:
    """Even shards, per_rack to a rack and per_region to a region."""
    root = Node("root")
    for s in range(shards):
        if s % per_region == 0:
            root.children.append(Node(f"region{s // per_region}"))
        region = root.children[-1]
        if s % per_rack == 0:
            region.children.append(Node(f"rack{s // per_rack}"))
        region.children[-1].children.append(Node(f"shard{s}", 1.0, s))
    return root


def grown(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own."""
    leaf = Node(f"shard{shard}", weight, shard)
    return Node(root.name, children=[*root.children, Node(f"region-of-{shard}", children=[Node(f"rack-of-{shard}", children=[leaf])])])


def draw(key: Column, node: Node) -> Column:
    """-ln(u) / weight with 0 < u < 1 from 52 bits of the hash of the child's name and the key."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(node.name), key), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / node.total()


def descend(key: Column, node: Node) -> Column:
    """Number of the shard that the key reaches below the node."""
    children = [c for c in node.children if c.total() > 0]
    if not children:
        return F.lit(node.shard).cast("int")
    if len(children) == 1:
        return descend(key, children[0])
    best = F.array_min(F.array(*[F.struct(draw(key, c).alias("draw"), F.lit(i).alias("child")) for i, c in enumerate(children)]))["child"]
    way = F.when(best == 0, descend(key, children[0]))
    for i, child in enumerate(children[1:], 1):
        way = way.when(best == i, descend(key, child))
    return way


def number(rows: DataFrame, group: str, key: str, to: str, bucket_rows: int = BUCKET_ROWS, *ties: str) -> DataFrame:
    """Number the rows of each group from 0 without a gap, in column ``to``. Rows alike in key and ties get different numbers.

    Rows alike in all columns are counted first and told apart last, and buckets go by key and ties: neither a row nor a key
    that repeats without end fills a task.
    """
    buckets = max(1, -(-rows.count() // bucket_rows))
    kinds = rows.groupBy(*rows.columns).agg(F.count("*").alias("_rows"))
    kinds = kinds.withColumn("_bucket", F.pmod(F.xxhash64(F.lit("slot"), key, *ties), F.lit(buckets)))
    sizes = kinds.groupBy(group, "_bucket").agg(F.sum("_rows").alias("_own"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "_bucket", F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(group, "_bucket").orderBy(key, *ties)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = kinds.withColumn("_at", F.sum("_rows").over(upto) - F.col("_rows")).join(starts, [group, "_bucket"])
    first = F.col("_start") + F.col("_at")
    return numbered.select(*rows.columns, F.explode(F.sequence(first, first + F.col("_rows") - 1)).alias(to))


def shard(docs: DataFrame, root: Node | None = None, more: Node | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs; more is the grown tree.

    A null text has size 1 and the crc32 of no bytes, 0. Rows of one doc_id, repeated ones and null ids included, share
    a shard and get a slot each. Texts stay out of the shuffle: only these columns move. Other columns are not read.
    """
    root = root or tree()
    more = more or grown(root, 8)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(data).cast("long") + 1).alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"),
        descend(F.col("doc_id").cast("long"), root).alias("shard"),
        descend(F.col("doc_id").cast("long"), more).alias("grown_shard"),
    )
    return number(rows, "shard", "doc_id", "slot", BUCKET_ROWS, "size", "text_crc32").select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )
