"""Classes of linked items: candidates by shared keys, connected components, bounded groups.

A similarity join gives every item some keys such that linked items share at least one. What
follows here finds the classes of linked items without forming all pairs of a group:

* Items that share a key are tied to one of them (a star), never to each other. Map tasks do so
  for what they see, and pass on one posting per key and slice, packed in blocks by key range.
* Connected components of the stars gather every item that could possibly link with another.
* Within a component the join's own exact test runs, in groups of bounded size: a large component
  is cut into blocks, and every pair of blocks is one group. A group reports a spanning forest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folioflow.llm.common import released, stage

#: Postings per key range aimed at: a range is sorted in one task.
RANGE_BYTES = 16 << 20
MAX_RANGES = 1 << 16

_BLOCKS = pa.schema([("range", pa.int64()), ("edges", pa.bool_()), ("a", pa.binary()), ("b", pa.binary())])
BLOCKS_DDL = "range long, edges boolean, a binary, b binary"
EDGES_DDL = "src long, dst long"


def key_ranges(text_bytes: int, range_bytes: int = RANGE_BYTES) -> int:
    """A power of two, in proportion to the bytes of text."""
    return 1 << max(5, min(MAX_RANGES, text_bytes // range_bytes).bit_length())


def _stars(key: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, ...]:
    """One (key, item) per key, and an edge to that item from every other with the key."""
    order = np.lexsort((item, key))
    key, item = key[order], item[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    heads = np.flatnonzero(fresh)
    hub = item[heads][np.cumsum(fresh) - 1] if len(key) else item
    tied = np.flatnonzero(item != hub)
    edges = np.unique(np.stack([item[tied], hub[tied]]), axis=1) if len(tied) else np.zeros((2, 0), np.int64)
    return key[heads], item[heads], edges[0], edges[1]


def _edge_batch(src: np.ndarray, dst: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])


def packed_postings(key: np.ndarray, item: np.ndarray, n_ranges: int) -> Iterator[pa.RecordBatch]:
    """The postings of one slice, by key range, and the edges of keys it holds several times.

    A key travels as its six bytes below the range, which only decide who is a candidate.
    """
    key, item, src, dst = _stars(key, item)
    rows = []
    if len(key):
        bits = n_ranges.bit_length() - 1
        at = (key >> np.uint64(64 - bits)).astype(np.int64)
        short = ((key << np.uint64(bits)) >> np.uint64(16)).astype("<u8")
        short = short.view(np.uint8).reshape(-1, 8)[:, :6]
        cuts = np.flatnonzero(np.diff(at)) + 1
        for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(at)].tolist()):
            rows.append((int(at[a]), False, short[a:b].tobytes(), item[a:b].astype("<i8").tobytes()))
    if len(src):
        # Edges go through the same exchange; which task hands them on does not matter.
        rows.append((int(abs(src[0])) % n_ranges, True, src.astype("<i8").tobytes(), dst.astype("<i8").tobytes()))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCKS)], schema=_BLOCKS)


def _join_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come sorted by range: sort the postings of a range by key and tie them to a star."""
    now, keys, items = None, [], []

    def solve() -> pa.RecordBatch:
        short = np.concatenate([np.frombuffer(k, np.uint8).reshape(-1, 6) for k in keys])
        wide = np.zeros((len(short), 8), np.uint8)
        wide[:, :6] = short
        _, _, src, dst = _stars(wide.view("<u8").ravel(), np.concatenate([np.frombuffer(i, "<i8") for i in items]))
        return _edge_batch(src, dst)

    for batch in batches:
        for at, edges, a, b in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if edges:
                yield _edge_batch(np.frombuffer(a, "<i8"), np.frombuffer(b, "<i8"))
                continue
            if at != now and keys:
                yield solve()
                keys, items = [], []
            now = at
            keys.append(a)
            items.append(b)
    if keys:
        yield solve()


def candidate_edges(blocks: DataFrame) -> DataFrame:
    """Star edges (src, dst) between items that share a key, from packed postings."""
    ordered = blocks.repartition("range").sortWithinPartitions("range")
    return ordered.mapInArrow(released(_join_ranges), EDGES_DDL).distinct()


def _state(edges: DataFrame) -> tuple:
    found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    return tuple(found)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """The smallest item connected with each item that has an edge: (item, component).

    Alternating star contraction: neighbours are handed to the smallest neighbour, larger ones
    first, then smaller ones, until every item points at the smallest of its component. The
    number of rounds grows with the logarithm of the items; edges never grow in number. The
    smallest neighbour is a minimum, combined before the shuffle, so hubs do not gather; each
    round is a written table.
    """
    oriented = (
        edges.where(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct()
    )
    now = stage(oriented, label)
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.min("dst").alias("_m")).select(
            "src", F.least("_m", "src").alias("_m")
        )
        large = (
            both.join(least, "src")
            .where((F.col("dst") > F.col("src")) & (F.col("dst") != F.col("_m")))
            .select(F.col("dst").alias("src"), F.col("_m").alias("dst"))
            .distinct()
        )
        low = large.groupBy("src").agg(F.min("dst").alias("_m"))
        small = (
            large.join(low, "src")
            .where(F.col("dst") != F.col("_m"))
            .select(F.col("dst").alias("src"), F.col("_m").alias("dst"))
            .unionByName(low.select("src", F.col("_m").alias("dst")))
            .distinct()
        )
        now = stage(small, label)
        before, state = state, _state(now)
        if state == before:
            break
    members = now.select(F.col("src").alias("item"), F.col("dst").alias("component"))
    return members.unionByName(now.select(F.col("dst").alias("item"), F.col("dst").alias("component")).distinct())


def groups_of(members: DataFrame, max_items: int, max_weight: int) -> DataFrame:
    """Where the items of each component meet: (item, group, split), from (item, component, weight).

    A component within both bounds is one group. A larger one is cut into blocks by hash, and
    each pair of blocks is a group, so every two items meet in one.
    """
    sizes = members.groupBy("component").agg(
        F.count(F.lit(1)).alias("_items"), F.sum("weight").alias("_weight")
    )
    blocks = sizes.select(
        "component",
        F.greatest(
            F.ceil(2 * F.col("_items") / F.lit(max_items)), F.ceil(2 * F.col("_weight") / F.lit(max_weight))
        ).cast("int").alias("_cut"),
    ).select("component", F.when(F.col("_cut") > 2, F.col("_cut")).otherwise(1).alias("_blocks"))
    placed = members.join(blocks, "component").withColumn(
        "_own", F.pmod(F.xxhash64("item"), F.col("_blocks")).cast("int")
    )
    met = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return met.select(
        "item",
        F.xxhash64("component", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("group"),
        (F.col("_blocks") > 1).alias("split"),
    )


LINKS_DDL = "item long, root long, split boolean"


def solve_groups(rows: DataFrame, solve: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """Run `solve` on the payloads of every group of (group, item, split, payload).

    `solve` gets the payloads and returns for each the index of the smallest one it is
    connected with. A group is gathered in one task; its size is bounded by `groups_of`.
    Items that meet nobody they link with give no row. A key that two groups share by chance
    only makes one larger group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            unique = {r[1]: r for r in held}
            order = sorted(unique)
            root = solve([unique[i][3] for i in order])
            items = np.array(order, np.int64)
            tied = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(items[tied], pa.int64()),
                    pa.array(items[root[tied]], pa.int64()),
                    pa.array([held[0][2]] * len(tied), pa.bool_()),
                ],
                names=["item", "root", "split"],
            )

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if held and row[0] != held[0][0]:
                    yield done()
                    held = []
                held.append(row)
        if held:
            yield done()

    # The rows are few and their work is not: a given number of tasks, not one per so many bytes.
    n_tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        rows.select("group", "item", "split", "payload")
        .repartition(n_tasks, "group")
        .sortWithinPartitions("group")
    )
    return ordered.mapInArrow(released(run), LINKS_DDL)


def classes(links: DataFrame, label: str) -> DataFrame:
    """(item, class) of every item that links with another: the smallest item of its class.

    Groups of whole components already name the class; only components that were cut need
    their forests connected.
    """
    links = stage(links, label)
    whole = links.where(~F.col("split")).select("item", F.col("root").alias("class"))
    cut = links.where("split").select(F.col("item").alias("src"), F.col("root").alias("dst"))
    if not cut.isEmpty():
        joined = components(cut, label)
        whole = whole.unionByName(joined.select("item", F.col("component").alias("class")))
    return whole
