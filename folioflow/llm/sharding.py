"""Sharding by a hierarchical weighted hash tree."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from folioflow.llm.common import table

#: Rows numbered by one task; the number of slot buckets follows from the count of rows.
BUCKET_ROWS = 100_000


@dataclass(frozen=True)
class Node:
    """A region, a rack or a shard. A shard has a number and a weight; others have children."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def even_tree(regions: int = 2, racks: int = 2, shards: int = 2) -> Node:
    """Regions of racks of shards, all of weight 1, numbered from 0."""
    number = iter(range(regions * racks * shards))

    def rack(name: str) -> Node:
        return Node(name, tuple(Node(f"{name}/s{i}", shard=next(number)) for i in range(shards)))

    return Node(
        "",
        tuple(
            Node(f"r{r}", tuple(rack(f"r{r}/k{k}") for k in range(racks))) for r in range(regions)
        ),
    )


def grown(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard in a region of its own.

    No weight of another subtree changes, so rows move only into the new region, hence only
    into the new shard.
    """
    name = f"r+{shard}"
    leaf = Node(f"{name}/k0/s0", shard=shard, own_weight=weight)
    region = Node(name, (Node(f"{name}/k0", (leaf,)),))
    return replace(tree, children=(*tree.children, region))


def _draw(key: Column, node: Node) -> Column:
    """-ln(u) / weight with u in (0, 1] from the first 52 bits of a keyed hash. The smallest
    draw among siblings wins with a chance in proportion to its weight."""
    digest = F.md5(F.concat(F.lit(f"{node.name}|"), key))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((bits + 1) / F.lit(float(1 << 52))) / F.lit(float(node.weight))


def shard_of(tree: Node, key: Column) -> Column:
    """Descend region, rack and shard levels; at each level the smallest weighted draw wins."""
    live = [c for c in tree.children if c.weight > 0]
    if tree.shard is not None:
        return F.lit(tree.shard)
    if not live:
        raise ValueError(f"no shard of any weight below {tree.name or 'the root'}")
    if len(live) == 1:
        return shard_of(live[0], key)
    winner = F.array_min(
        F.array(*[F.struct(_draw(key, c).alias("draw"), F.lit(i).alias("child")) for i, c in enumerate(live)])
    ).getField("child")
    choice = F.when(winner == 0, shard_of(live[0], key))
    for i, c in enumerate(live[1:], 1):
        choice = choice.when(winner == i, shard_of(c, key))
    return choice


def assign_shards(docs: DataFrame, tree: Node, larger: Node | None = None, key: str = "doc_id") -> DataFrame:
    """All columns of `docs` that `assign_shards` needs, plus shard and grown shard.

    The key alone decides, with the tree. A null key counts as the empty text and is sharded
    like any other; equal keys share a shard. Empty tables give no rows.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    out = docs.withColumn("shard", shard_of(tree, text).cast("int"))
    return out.withColumn(
        "grown_shard", (shard_of(larger, text) if larger else F.lit(None)).cast("int")
    )


def number_rows(
    rows: DataFrame, group: str, key: str, columns: Iterable[str], bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Number the rows of every group from 0 without gaps, in tasks of bounded size.

    The order is that of the md5 of the key, then of the other columns. Rows are counted by
    value first (combined before the shuffle, so a value that comes very often is one row) and
    put in buckets by the leading digits of the md5, which are even whatever the keys are. They
    are numbered within group and bucket; the offsets of the buckets are a running sum over one
    row per group and bucket.
    """
    columns = list(columns)
    digits, n_rows = 0, rows.count()
    while 16**digits * bucket_rows < n_rows:
        digits += 1
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    place = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    bucketed = counted.withColumn("_place", place).withColumn("_bucket", F.substring("_place", 1, digits))
    totals = bucketed.groupBy(group, "_bucket").agg(F.sum("_n").alias("_total"))
    earlier = (Window.unboundedPreceding, -1)
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(*earlier)
    offsets = totals.select(
        F.col(group).alias("_group"),
        F.col("_bucket").alias("_of_bucket"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
    )
    within = Window.partitionBy(group, "_bucket").orderBy("_place", *columns).rowsBetween(*earlier)
    placed = bucketed.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(
        offsets, (F.col(group) == F.col("_group")) & (F.col("_bucket") == F.col("_of_bucket"))
    )
    first = F.col("_offset") + F.col("_before")
    return placed.select(*columns, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias("slot"))


def op9_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by law `key`, and their shard with a ninth."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    tree = even_tree()
    sharded = assign_shards(sized, tree, grown(tree, 8))
    numbered = number_rows(
        sharded, "shard", "doc_id", ["doc_id", "size", "text_crc32", "shard", "grown_shard"]
    )
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _draw_sql(node: Node) -> str:
    bits = f"CAST('0x' || substr(md5('{node.name}|' || k), 1, 13) AS BIGINT)"
    return f"(-ln((CAST({bits} AS DOUBLE) + 1) / {1 << 52}.0) / {node.weight})"


def _shard_sql(tree: Node) -> str:
    live = [c for c in tree.children if c.weight > 0]
    if tree.shard is not None:
        return str(tree.shard)
    if len(live) == 1:
        return _shard_sql(live[0])
    draws = [_draw_sql(c) for c in live]
    least = f"least({', '.join(draws)})"
    cases = " ".join(f"WHEN {d} = {least} THEN {_shard_sql(c)}" for d, c in zip(draws, live))
    return f"(CASE {cases} END)"


def op9_sql() -> str:
    """The same in SQL; crc32 is a fold over the bytes of the text with its table of 256."""
    tree = even_tree()
    step = "list_reduce(range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)"
    return f"""
WITH lut AS (SELECT list_transform(range(256), lambda i: {step}) AS t),
docs AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, hex(encode(coalesce(text, ''))) AS h,
    coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM documents
),
sized AS (
  SELECT doc_id, k, CAST(len(h) // 2 + 1 AS BIGINT) AS size,
    xor(list_reduce(
      list_transform(range(len(h) // 2), lambda j: CAST('0x' || substr(h, CAST(2 * j + 1 AS BIGINT), 2) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295), 4294967295) AS text_crc32
  FROM docs, lut
),
sharded AS (
  SELECT *, CAST({_shard_sql(tree)} AS INTEGER) AS shard,
    CAST({_shard_sql(grown(tree, 8))} AS INTEGER) AS grown_shard
  FROM sized
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(k), doc_id, size, text_crc32, grown_shard) - 1 AS slot,
  grown_shard
FROM sharded
"""
