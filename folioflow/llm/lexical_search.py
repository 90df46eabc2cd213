"""Ranked lexical search by dual-tree search.

Term statistics, term weights and every document's contribution per term are plain Spark
aggregates and joins; only the terms that some item holds are carried on. The ranking itself
is items x documents by definition. Documents are cut into blocks by hash and every item
visits every block once (a stated set of items against all rows, in blocks).

Within a block, documents and items are both put into hierarchies: leaves of a few documents
(or items), and above them nodes that join two children. Every node keeps the maxima of its
members' coordinates: a document node the largest contribution of each term, an item node the
largest count of each term. For a pair of nodes the sum over shared terms of count maximum
times contribution maximum bounds every score of the pair from above. The search runs from the
pair of roots down, the more promising child first; a pair is dropped whole when its bound
falls under the weakest k-th score of its items (or under 1, scores must be above 0). Pairs of
leaves are scored exactly. The blocks' lists are merged by a window.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from folioflow.llm.common import released, stage, table
from folioflow.operators.sizes import broadcast_if_small

# Fixed values of the contract: the characters that are not part of a term, the constants of
# the score, the size of each item's list.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
K1_MILLI = 1000
B_PERCENT = 25
TOP = 20

#: Documents per block, documents per leaf, items per leaf.
BLOCK_DOCS = 16_384
LEAF_DOCS = 32
LEAF_ITEMS = 8
#: Distinct terms of all items up to which they are broadcast to the scan of the texts.
BROADCAST_TERMS = 1_000_000

_OUT = pa.schema([("_item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text) -> "F.Column":
    """The terms of a text in order, A-Z lower-cased; none for null.

    The maximal matches of TERM_PATTERN are the pieces between runs of the other characters:
    a split by SEPARATORS without its empty pieces, which is cheaper than extracting matches.
    """
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, SEPARATORS), lambda term: term != F.lit(""))


class _Node:
    """Members [first, last) of a leaf order, the sorted terms present and their maxima."""

    __slots__ = ("first", "last", "terms", "most", "children")

    def __init__(self, first, last, terms, most, children=()):
        self.first, self.last, self.terms, self.most, self.children = first, last, terms, most, children


def _maxima(term: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((-value, term))
    term, value = term[order], value[order]
    fresh = np.r_[True, term[1:] != term[:-1]] if len(term) else np.zeros(0, bool)
    return term[fresh], value[fresh]


def _tree(row_of: np.ndarray, term: np.ndarray, value: np.ndarray, n_rows: int, leaf: int) -> _Node | None:
    """A hierarchy over rows 0..n_rows-1 (entries row_of, term, value sorted by row)."""
    if not n_rows:
        return None
    cuts = np.searchsorted(row_of, np.arange(0, n_rows + leaf, leaf).clip(max=n_rows))
    level = []
    for i in range(len(cuts) - 1):
        a, b = cuts[i], cuts[i + 1]
        t, v = _maxima(term[a:b], value[a:b])
        level.append(_Node(i * leaf, min((i + 1) * leaf, n_rows), t, v))
    while len(level) > 1:
        up = []
        for i in range(0, len(level), 2):
            pair = level[i : i + 2]
            if len(pair) == 1:
                up.append(pair[0])
                continue
            t, v = _maxima(np.r_[pair[0].terms, pair[1].terms], np.r_[pair[0].most, pair[1].most])
            up.append(_Node(pair[0].first, pair[1].last, t, v, tuple(pair)))
        level = up
    return level[0]


def _bound(items: _Node, docs: _Node) -> int:
    shared, a, b = np.intersect1d(items.terms, docs.terms, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0
    return int((items.most[a] * docs.most[b]).sum())


class _Lists:
    """The k best (score, doc_id) of every item so far, ties to the smaller doc_id."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(n_items)]

    def needed(self, first: int, last: int) -> int:
        """The least score that could still enter the list of some item of [first, last)."""
        least = None
        for heap in self.heaps[first:last]:
            need = heap[0][0] if len(heap) >= self.k else 1
            least = need if least is None else min(least, need)
        return least if least is not None else 1

    def offer(self, item: int, scores: np.ndarray, doc_ids: np.ndarray) -> None:
        heap = self.heaps[item]
        # Only scores that can enter: at least the weakest kept one (ties by doc_id), above 0.
        at = np.flatnonzero(scores >= (heap[0][0] if len(heap) >= self.k else 1))
        for score, doc in zip(scores[at].tolist(), doc_ids[at].tolist()):
            entry = (score, -doc)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)


def _search_block(docs: pa.Table, items: pa.Table, k: int) -> Iterator[tuple[int, int, int, int]]:
    item_terms = items.column("_terms").combine_chunks()
    vocabulary = pc.unique(item_terms.flatten())

    def code(terms: pa.Array) -> np.ndarray:
        """Place of every term in the vocabulary, -1 where it has none (Arrow, not Python)."""
        return pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    i_lengths = item_terms.value_lengths().to_numpy(zero_copy_only=False)
    i_row = np.repeat(np.arange(len(items)), i_lengths)
    i_term = code(item_terms.flatten())
    i_count = items.column("_counts").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    doc_terms = docs.column("_terms").combine_chunks()
    d_lengths = doc_terms.value_lengths().to_numpy(zero_copy_only=False)
    d_row = np.repeat(np.arange(len(docs)), d_lengths)
    d_term = code(doc_terms.flatten())
    d_value = docs.column("_contributions").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    known = d_term >= 0
    d_row, d_term, d_value = d_row[known], d_term[known], d_value[known]
    doc_ids = docs.column("doc_id").to_numpy()

    item_root = _tree(i_row, i_term, i_count, len(items), LEAF_ITEMS)
    doc_root = _tree(d_row, d_term, d_value, len(docs), LEAF_DOCS)
    if item_root is None or doc_root is None:
        return
    lists = _Lists(len(items), k)
    d_cut = np.searchsorted(d_row, np.arange(len(docs) + 1))
    i_cut = np.searchsorted(i_row, np.arange(len(items) + 1))

    own = []
    for item in range(len(items)):
        x, y = i_cut[item], i_cut[item + 1]
        order = np.argsort(i_term[x:y], kind="stable")
        own.append((i_term[x:y][order], i_count[x:y][order]))

    def exact(inode: _Node, dnode: _Node) -> None:
        a, b = d_cut[dnode.first], d_cut[dnode.last]
        rows, terms, values = d_row[a:b] - dnode.first, d_term[a:b], d_value[a:b]
        for item in range(inode.first, inode.last):
            codes, counts = own[item]
            if not len(codes):
                continue
            at = np.searchsorted(codes, terms).clip(max=len(codes) - 1)
            hit = codes[at] == terms
            scores = np.zeros(dnode.last - dnode.first, np.int64)
            np.add.at(scores, rows[hit], counts[at[hit]] * values[hit])
            lists.offer(item, scores, doc_ids[dnode.first : dnode.last])

    stack = [(item_root, doc_root)]
    while stack:
        inode, dnode = stack.pop()
        bound = _bound(inode, dnode)
        if bound < lists.needed(inode.first, inode.last):
            continue
        if not inode.children and not dnode.children:
            exact(inode, dnode)
            continue
        split_items = inode.children and (not dnode.children or inode.last - inode.first > (dnode.last - dnode.first) // 4)
        pairs = [(c, dnode) for c in inode.children] if split_items else [(inode, c) for c in dnode.children]
        # The stack pops the last first: the pair of the higher bound goes last.
        pairs.sort(key=lambda p: _bound(*p))
        stack.extend(pairs)

    item_keys = items.column("_item").to_numpy()
    item_ids = items.column("item_id").to_numpy()
    for item, heap in enumerate(lists.heaps):
        for score, doc in heap:
            yield int(item_keys[item]), int(item_ids[item]), -doc, score


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block, documents first, then the items that visit the block."""
    number = None
    docs: list[pa.RecordBatch] = []
    items: list[pa.RecordBatch] = []

    def finish():
        if docs and items:
            found = list(_search_block(pa.Table.from_batches(docs), pa.Table.from_batches(items), k))
            if found:
                yield pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*found)], schema=_OUT)

    for batch in batches:
        key = batch.column("_block").to_numpy(zero_copy_only=False)
        is_item = batch.column("_is_item").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(key) | np.diff(is_item.astype(np.int8))) + 1
        edges = [0, *cuts.tolist(), len(key)] if len(key) else []
        for a, b in zip(edges[:-1], edges[1:]):
            if key[a] != number:
                yield from finish()
                number, docs, items = key[a], [], []
            part = batch.slice(a, b - a)
            (items if is_item[a] else docs).append(part)
    yield from finish()


def lexical_search(documents: DataFrame, items: DataFrame, k: int = TOP, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Each item's k best documents by the contract's integer score, above 0, ties by doc_id.

    Terms, N, L, n, df and tf as in the contract; a term's weight is floor(1000 *
    ln((2N + 2) / (2 df + 1))), a document's m is 100 - B + (B * n * N) div L, and its score is
    the sum over the item's terms, repeats included, of w * ((10^9 * tf) div (K1 * tf + 12 m)).

    Defined cases: null texts have no terms; every row of `documents` is a document, so rows
    that repeat count twice in N, L and df and are ranked twice; documents with a null doc_id
    count in the statistics but are not ranked. Items with a null item_id or no terms give no
    rows; an item row that repeats exactly counts once. Texts are taken whole, however long.
    Columns of other names are never read. Empty tables give no rows. Returns item_id, rank
    (from 1), doc_id, score.
    """
    spark = documents.sparkSession
    asked = (
        items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("_text"))
        .where(F.col("item_id").isNotNull())
        .dropDuplicates(["item_id", "_text"])
        .select("item_id", F.xxhash64("item_id", "_text").alias("_item"), F.explode(terms_of(F.col("_text"))).alias("term"))
        .groupBy("item_id", "_item", "term")
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    wanted = broadcast_if_small(asked.select("term", F.lit(True).alias("_wanted")).distinct(), BROADCAST_TERMS)
    # One pass over the texts: every document gives one row of null term (its size rides on it)
    # and its occurrences of wanted terms; other terms fall into that null row.
    parsed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("_row"),
        terms_of(F.col("text").cast("string")).alias("_all"),
    )
    occurrences = parsed.select(
        "doc_id", "_row", F.size("_all").cast("long").alias("_n"),
        F.explode(F.concat(F.array(F.lit(None).cast("string")), "_all")).alias("term"),
    ).join(wanted, "term", "left")
    counted = stage(
        occurrences.groupBy("_row", "doc_id", "_n", F.when(F.col("_wanted"), F.col("term")).alias("term"))
        .agg(F.count(F.lit(1)).alias("_tf")),
        "lexical-occurrences",
    )
    n_docs, n_terms, n_rows = (
        counted.where(F.col("term").isNull())
        .agg(F.count(F.when(F.col("_n") > 0, 1)), F.sum("_n"), F.count(F.lit(1)))
        .first()
    )
    if not n_docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = counted.where(F.col("term").isNotNull())
    weights = found.groupBy("term").agg(F.count(F.lit(1)).alias("_df")).select(
        "term",
        F.floor(
            F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2.0)) / (F.lit(2.0) * F.col("_df").cast("double") + F.lit(1.0)))
        ).cast("long").alias("_w"),
    )
    m = F.lit(100 - B_PERCENT) + F.expr(f"({B_PERCENT} * _n * {n_docs}) div {n_terms}")
    share = F.expr(f"(1000000000 * _tf) div ({K1_MILLI} * _tf + 12 * _m)")
    contributions = (
        found.join(weights, "term")
        .withColumn("_m", m)
        .select("_row", "doc_id", "term", (F.col("_w") * share).alias("_c"))
        .where(F.col("doc_id").isNotNull())
        .groupBy("_row", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("term", "_c"))).alias("_p"))
    )
    n_blocks = max(1, -(-n_rows // block_docs))
    by_docs = contributions.select(
        F.pmod(F.xxhash64("_row"), F.lit(n_blocks)).cast("int").alias("_block"),
        F.lit(False).alias("_is_item"),
        "doc_id",
        F.col("_p.term").alias("_terms"),
        F.col("_p._c").alias("_contributions"),
    )
    by_items = (
        asked.groupBy("item_id", "_item")
        .agg(F.sort_array(F.collect_list(F.struct("term", "_count"))).alias("_p"))
        .select(
            F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_block"),
            F.lit(True).alias("_is_item"),
            "item_id",
            "_item",
            F.col("_p.term").alias("_terms"),
            F.col("_p._count").alias("_counts"),
        )
    )
    both = (
        by_docs.unionByName(by_items, allowMissingColumns=True)
        .repartition(n_blocks, "_block")
        .sortWithinPartitions("_block", "_is_item")
    )
    ranked = both.mapInArrow(released(lambda b: _search(b, k)), "_item long, item_id long, doc_id long, score long")
    best = Window.partitionBy("_item").orderBy(F.desc("score"), "doc_id")
    return (
        ranked.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("item_id", F.col("rank").cast("int"), "doc_id", "score")
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of all `documents` for every `benchmark` item."""
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
stats AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, sum(len(terms)) AS n_terms FROM d),
q AS (
  SELECT item_id, term, count(*) AS qtf
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL) b,
       unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t(term)
  GROUP BY 1, 2
),
occ AS (
  SELECT rid, doc_id, len(terms) AS n, term, count(*) AS tf
  FROM d, unnest(terms) AS t(term)
  WHERE term IN (SELECT term FROM q)
  GROUP BY 1, 2, 3, 4
),
w AS (
  SELECT term, CAST(floor(1000.0 * ln((2.0 * n_docs + 2.0) / (2.0 * count(*) + 1.0))) AS BIGINT) AS w
  FROM occ, stats GROUP BY term, n_docs
),
c AS (
  SELECT o.rid, o.doc_id, o.term,
         w.w * ((1000000000 * o.tf) // (1000 * o.tf + 12 * (75 + (25 * o.n * s.n_docs) // s.n_terms))) AS c
  FROM occ o JOIN w USING (term), stats s
  WHERE o.doc_id IS NOT NULL
),
scores AS (
  SELECT q.item_id, c.rid, c.doc_id, CAST(sum(q.qtf * c.c) AS BIGINT) AS score
  FROM q JOIN c USING (term) GROUP BY 1, 2, 3
),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
