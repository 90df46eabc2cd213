"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from folioflow.llm.common import table

#: Rows of one block of candidates. A task holds one block: its postings and one score array.
BLOCK_ROWS = 32_768
SCALE = 1024

_OUT = pa.schema(
    [("query_id", pa.int64()), ("_query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
)


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as long; null for vectors that take no part."""
    usable = vector.isNotNull() & ~F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


class _Block:
    """Postings of one block of candidates, by term (component number)."""

    def __init__(self, ids: list[np.ndarray], rows: list[pa.ListArray]) -> None:
        vec_id = np.concatenate(ids)
        weights = [r.flatten().to_numpy(zero_copy_only=False) for r in rows]
        sizes = np.concatenate([r.value_lengths().to_numpy(zero_copy_only=False) for r in rows])
        flat = np.concatenate(weights).astype(np.int64)
        order = np.lexsort((vec_id,))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.vec_id = vec_id[order]
        row = np.repeat(place, sizes)
        starts = np.cumsum(sizes) - sizes
        term = np.arange(len(flat)) - np.repeat(starts, sizes)
        held = flat != 0
        row, term, flat = row[held], term[held], flat[held]
        by_term = np.lexsort((row, term))
        row, term, flat = row[by_term], term[by_term], flat[by_term]
        n_terms = int(term[-1]) + 1 if len(term) else 0
        cut = np.searchsorted(term, np.arange(n_terms + 1))
        # A posting list that holds every row needs no row numbers.
        self.postings = [
            (slice(None) if b - a == len(vec_id) else row[a:b], flat[a:b])
            for a, b in zip(cut[:-1], cut[1:])
        ]

    def best(self, query_id: int, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows of the block other than the query's own, ties to the smaller id."""
        score = np.zeros(len(self.vec_id), np.int64)
        for t in np.flatnonzero(weights[: len(self.postings)]):
            rows, values = self.postings[t]
            score[rows] += weights[t] * values
        at = np.flatnonzero(self.vec_id != query_id)
        if len(at) > k:
            own = score[at]
            least = np.partition(own, len(own) - k)[len(own) - k]
            above = at[own > least]
            at = np.concatenate([above, at[own == least][: k - len(above)]])
        return self.vec_id[at], score[at]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block, candidates first: build the postings, then stream the queries."""
    number = block = None
    ids: list[np.ndarray] = []
    rows: list[pa.ListArray] = []
    for batch in batches:
        out: list[list[np.ndarray]] = [[], [], [], []]
        key = batch.column("_block").to_numpy(zero_copy_only=False)
        is_query = batch.column("_is_query").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(key) | np.diff(is_query.astype(np.int8))) + 1
        edges = [0, *cuts.tolist(), len(key)] if len(key) else []
        for a, b in zip(edges[:-1], edges[1:]):
            part = batch.slice(a, b - a)
            vec_id = part.column("vec_id").to_numpy(zero_copy_only=False)
            if key[a] != number:
                number, block, ids, rows = key[a], None, [], []
            if not is_query[a]:
                ids.append(vec_id)
                rows.append(part.column("_weights"))
                continue
            if not ids:
                continue
            if block is None:
                block = _Block(ids, rows)
            hashes = part.column("_query").to_numpy(zero_copy_only=False)
            for q, h, w in zip(vec_id, hashes, part.column("_weights")):
                found, score = block.best(int(q), w.values.to_numpy(zero_copy_only=False), k)
                for column, value in zip(out, (np.full(len(found), q), np.full(len(found), h), found, score)):
                    column.append(value)
        if out[0]:
            yield pa.record_batch(
                [pa.array(np.concatenate(c), pa.int64()) for c in out], schema=_OUT
            )


def exact_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Each query's k highest integer inner products over all vectors but those of its own id.

    Components become floor(scale * x). The vectors are cut into blocks by hash; every query
    visits every block once (the work is queries x vectors by definition, and runs in blocks).
    In a block a query row is a list of (term, weight): each term's posting list is scattered,
    weighted, into a dense array of scores; a partition selection leaves k rows per query and
    block, and these are merged. Nothing is broadcast or collected.

    Defined cases: vectors that are null or hold a null, NaN or infinite component take no part,
    nor do null ids. Rows that repeat exactly count once. An id with several vectors has several
    candidates, and each of its vectors is a query of its own. Vectors of other lengths count as
    zero beyond their end, empty ones score 0. Sums are 64-bit and wrap. An empty table or no
    query gives no rows. Returns query_id, rank from 1, vec_id, score.
    """

    def rows(df: DataFrame) -> DataFrame:
        return (
            df.select(
                F.col(id_column).cast("long").alias("vec_id"),
                quantized(F.col(vector_column), scale).alias("_weights"),
            )
            .where(F.col("vec_id").isNotNull() & F.col("_weights").isNotNull())
            .dropDuplicates(["vec_id", "_weights"])
        )

    held = rows(vectors)
    n_blocks = max(1, -(-vectors.count() // block_rows))
    identity = F.xxhash64("vec_id", "_weights")
    candidates = held.select(
        F.pmod(identity, F.lit(n_blocks)).cast("int").alias("_block"),
        F.lit(False).alias("_is_query"),
        "vec_id",
        identity.alias("_query"),
        "_weights",
    )
    asked = rows(queries).select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_block"),
        F.lit(True).alias("_is_query"),
        "vec_id",
        identity.alias("_query"),
        "_weights",
    )
    both = (
        candidates.unionByName(asked)
        .repartition("_block")
        .sortWithinPartitions("_block", "_is_query")
    )
    found = both.mapInArrow(
        lambda batches: _search(batches, k), "query_id long, _query long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id", "_query").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest of every row whose vec_id is divisible by 100, among all other rows."""
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.where(F.col("vec_id") % 100 == 0))


OP1_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
terms AS (
  SELECT vec_id, unnest(w) AS weight, generate_subscripts(w, 1) AS term FROM usable
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.weight * c.weight) AS BIGINT) AS score
  FROM terms q JOIN terms c ON q.term = c.term AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
  GROUP BY 1, 2
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
