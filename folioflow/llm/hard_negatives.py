"""Hard-negative mining by segment summary filtering.

Every vector is summarised segment by segment: the mean of its components and the norm of
what is left around that mean. For two vectors and a segment of length d the inner product is
d * mean_a * mean_b + <a - mean_a, b - mean_b>, and by Cauchy-Schwarz the second term lies
within plus or minus the product of the two norms. Summed over segments this bounds a score
from both sides without touching the components. The bounds are worked out level by level,
one segment, then 4, then 16, each level only for the rows the last one could not rule out;
the rows still left are scored exactly.

The work is anchors x rows by definition. Rows are cut into blocks by hash, every anchor visits
every block once (a stated set of anchors against all rows, in blocks), and the blocks' answers
are merged by windows. Mining takes two such passes: positives first, then negatives in the
score range their positives give.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from folioflow.llm.common import released, table
from folioflow.llm.exact_topk import quantized

#: Rows of one block of candidates: its components as 64-bit integers and its summaries.
BLOCK_ROWS = 8_192
SCALE = 256
#: Segments per level of the summaries; the exact score follows the last one.
LEVELS = (1, 4, 16)
#: Anchors, positives per anchor, negatives per positive, and the range of a negative's score
#: in hundredths of its positive's: LOW * p <= 100 * n <= HIGH * p.
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
#: Rows whose id is divisible by it have their label moved on by one, modulo LABELS.
RELABEL_EVERY = 7
LABELS = 10

_POSITIVES = pa.schema(
    [("anchor_id", pa.int64()), ("_anchor", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())]
)
_NEGATIVES = pa.schema(
    [
        ("anchor_id", pa.int64()),
        ("_anchor", pa.int64()),
        ("positive_id", pa.int64()),
        ("positive_score", pa.int64()),
        ("negative_id", pa.int64()),
        ("negative_score", pa.int64()),
    ]
)


class Summaries:
    """Means and centred norms of the segments of every level, for rows of integer components."""

    def __init__(self, weights: np.ndarray, levels: tuple[int, ...] = LEVELS) -> None:
        self.weights = weights
        values = weights.astype(np.float64)
        self.levels = []
        dims = weights.shape[1]
        for n_segments in levels:
            cuts = np.unique(np.linspace(0, dims, min(n_segments, max(dims, 1)) + 1).astype(np.int64))
            lengths = np.diff(cuts).astype(np.float64)
            if not len(lengths):
                means = norms = np.zeros((len(weights), 0))
            else:
                sums = np.add.reduceat(values, cuts[:-1], axis=1) if dims else np.zeros((len(values), 0))
                means = sums / lengths
                centred = values - np.repeat(means, np.diff(cuts), axis=1)
                norms = np.sqrt(np.add.reduceat(centred * centred, cuts[:-1], axis=1))
            self.levels.append((lengths, means, norms))

    def bounds(self, level: int, rows: np.ndarray, other: "Summaries", at: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of `rows` with row `at` of `other`, widened by a
        margin that covers rounding, so that they hold for the exact integer scores."""
        lengths, means, norms = self.levels[level]
        _, their_means, their_norms = other.levels[level]
        centre = (means[rows] * (lengths * their_means[at])).sum(axis=1)
        spread = (norms[rows] * their_norms[at]).sum(axis=1)
        margin = 1e-9 * (np.abs(means[rows]) * (lengths * np.abs(their_means[at]))).sum(axis=1) + 1e-9 * spread + 1e-6
        return centre - spread - margin, centre + spread + margin


def _filtered(summaries: Summaries, rows: np.ndarray, anchor: Summaries, at: int, keep) -> np.ndarray:
    """Rows that no level of bounds rules out; `keep(low, high)` says which may still count."""
    for level in range(len(summaries.levels)):
        if not len(rows):
            break
        low, high = summaries.bounds(level, rows, anchor, at)
        rows = rows[keep(low, high)]
    return rows


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, in that order."""
    order = np.lexsort((ids, -scores))
    return order[:k]


def _positives(block: Summaries, ids: np.ndarray, labels: np.ndarray, anchor: Summaries, at: int,
               anchor_id: int, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    rows = np.flatnonzero((labels == label) & (ids != anchor_id))
    if len(rows) > k:
        # The k-th highest lower bound: no row whose upper bound falls under it can be among
        # the k best (ties are kept: their exact scores decide).
        def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            if len(low) <= k:
                return np.ones(len(low), bool)
            floor = np.partition(low, len(low) - k)[len(low) - k]
            return high >= floor

        rows = _filtered(block, rows, anchor, at, keep)
    scores = block.weights[rows] @ anchor.weights[at]
    chosen = _best(ids[rows], scores, k)
    return ids[rows][chosen], scores[chosen]


def _negatives(block: Summaries, ids: np.ndarray, labels: np.ndarray, anchor: Summaries, at: int,
               label: int, positives: list[tuple[int, int]], k: int) -> Iterator[tuple[int, int, int, int]]:
    usable = [(p, s) for p, s in positives if LOW * s <= HIGH * s]
    if not usable:
        return
    least = min(LOW * s for _, s in usable)
    most = max(HIGH * s for _, s in usable)
    rows = np.flatnonzero(labels != label)

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (100 * high >= least) & (100 * low <= most)

    rows = _filtered(block, rows, anchor, at, keep)
    scores = block.weights[rows] @ anchor.weights[at]
    for positive_id, positive_score in usable:
        inside = (LOW * positive_score <= 100 * scores) & (100 * scores <= HIGH * positive_score)
        found, found_scores = ids[rows][inside], scores[inside]
        for place in _best(found, found_scores, k):
            yield positive_id, positive_score, int(found[place]), int(found_scores[place])


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of equal length as a matrix; shorter rows are padded with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(column), width), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    starts = np.cumsum(lengths) - lengths
    out[row, np.arange(len(flat)) - np.repeat(starts, lengths)] = flat
    return out


def _fitted(a: np.ndarray, width: int) -> np.ndarray:
    """Columns cut or padded with zeros to the width."""
    if a.shape[1] >= width:
        return a[:, :width]
    return np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _mine(batches: Iterator[pa.RecordBatch], negatives: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block, candidates first, then the anchors that visit the block."""
    number = None
    held: list[pa.RecordBatch] = []
    block = ids = labels = None
    for batch in batches:
        key = batch.column("_block").to_numpy(zero_copy_only=False)
        is_anchor = batch.column("_is_anchor").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(key) | np.diff(is_anchor.astype(np.int8))) + 1
        edges = [0, *cuts.tolist(), len(key)] if len(key) else []
        out: list[tuple] = []
        for a, b in zip(edges[:-1], edges[1:]):
            part = batch.slice(a, b - a)
            if key[a] != number:
                number, held, block = key[a], [], None
            if not is_anchor[a]:
                held.append(part)
                continue
            if not held:
                continue
            if block is None:
                rows = pa.Table.from_batches(held).combine_chunks()
                block = Summaries(_matrix(rows.column("_w").chunk(0)))
                ids = rows.column("vec_id").to_numpy()
                labels = rows.column("_label").to_numpy()
                held = []
            # Block rows are zero beyond their width, so components of an anchor there add nothing.
            mine = Summaries(_fitted(_matrix(part.column("_w")), block.weights.shape[1]))
            anchor_ids = part.column("vec_id").to_numpy(zero_copy_only=False)
            keys = part.column("_key").to_numpy(zero_copy_only=False)
            anchor_labels = part.column("_label").to_numpy(zero_copy_only=False)
            found = part.column("_found").to_pylist() if negatives else None
            for i in range(len(part)):
                if negatives:
                    pairs = [(f["positive_id"], f["positive_score"]) for f in found[i] or []]
                    for row in _negatives(block, ids, labels, mine, i, anchor_labels[i], pairs, NEGATIVES):
                        out.append((anchor_ids[i], keys[i], *row))
                else:
                    got, scores = _positives(block, ids, labels, mine, i, anchor_ids[i], anchor_labels[i], POSITIVES)
                    out += [(anchor_ids[i], keys[i], int(p), int(s)) for p, s in zip(got, scores)]
        schema = _NEGATIVES if negatives else _POSITIVES
        if out:
            yield pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*out)], schema=schema)


def usable_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, _label (moved on where the id asks for it), _w (integer components), _key.

    Rows with a null id, null label, null vector or a null or non-finite component take no
    part; rows that repeat exactly count once.
    """
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    rows = (
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            moved.alias("_label"),
            quantized(F.col("embedding"), scale).alias("_w"),
        )
        .where(F.col("vec_id").isNotNull() & F.col("_label").isNotNull() & F.col("_w").isNotNull())
        .dropDuplicates(["vec_id", "_label", "_w"])
    )
    return rows.withColumn("_key", F.xxhash64("vec_id", "_label", "_w"))


def hard_negatives(
    vectors: DataFrame,
    anchor_every: int = ANCHOR_EVERY,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per anchor its positives and, for each, the hardest negatives in the asked score range.

    Anchors are the rows whose vec_id is divisible by `anchor_every`. A row's score is its
    integer inner product with the anchor (components floor(scale * x)); higher scores come
    first, ties go to the smaller vec_id. Positives: the POSITIVES best other rows of the
    anchor's label (rows of the anchor's own id excluded). Negatives of a positive with score
    p: the NEGATIVES best rows of another label with LOW * p <= 100 * n <= HIGH * p; a positive
    with p < 0 has an empty range.

    Defined cases: rows with a null id, label or vector, or a null, NaN or infinite component
    take no part; rows that repeat exactly count once; an id with two vectors is two rows and
    two anchors; vectors of other lengths count as zero beyond their end, empty ones score 0;
    columns of other names are never read. An empty table, or one without anchors, gives no
    rows. Returns anchor_id, positive_id, rank (from 1 per anchor and positive), negative_id,
    positive_score, negative_score.
    """
    rows = usable_rows(vectors, scale)
    n_blocks = max(1, -(-vectors.count() // block_rows))
    candidates = rows.select(
        F.pmod("_key", F.lit(n_blocks)).cast("int").alias("_block"),
        F.lit(False).alias("_is_anchor"),
        "vec_id", "_key", "_label", "_w",
    )
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)

    def search(asked: DataFrame, negatives: bool, ddl: str) -> DataFrame:
        visiting = asked.select(
            F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_block"),
            F.lit(True).alias("_is_anchor"),
            *[c for c in asked.columns],
        )
        both = (
            candidates.unionByName(visiting, allowMissingColumns=True)
            .repartition(n_blocks, "_block")
            .sortWithinPartitions("_block", "_is_anchor")
        )
        return both.mapInArrow(released(lambda b: _mine(b, negatives)), ddl)

    found = search(anchors, False, "anchor_id long, _anchor long, positive_id long, positive_score long")
    best = Window.partitionBy("_anchor").orderBy(F.desc("positive_score"), "positive_id")
    positives = (
        found.withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") <= POSITIVES)
        .groupBy("_anchor")
        .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("_found"))
    )
    asked = anchors.join(positives, anchors["_key"] == positives["_anchor"]).drop("_anchor")
    mined = search(
        asked,
        True,
        "anchor_id long, _anchor long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    hardest = Window.partitionBy("_anchor", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        mined.withColumn("rank", F.row_number().over(hardest))
        .where(F.col("rank") <= NEGATIVES)
        .select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 50, among all rows."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH usable AS (
  SELECT vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
rows AS (SELECT DISTINCT vec_id, label, w FROM usable),
terms AS (SELECT vec_id, label, unnest(w) AS weight, generate_subscripts(w, 1) AS term FROM rows),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
         CAST(sum(a.weight * c.weight) AS BIGINT) AS score
  FROM terms a JOIN terms c ON a.term = c.term
  WHERE a.vec_id % 50 = 0
  GROUP BY 1, 2, 3, 4
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r
        FROM scores WHERE label = anchor_label AND vec_id <> anchor_id)
  WHERE r <= 5
),
negatives AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS r
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
  WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE r <= 3
"""
