"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioflow.llm.arrays import classes_of, mixed, run_starts, shingle_sets, spread
from folioflow.llm.common import ROW, KeyFilter, public_id, released, slices, stage, table, texts
from folioflow.llm.linking import (
    BLOCKS_DDL,
    candidate_edges,
    classes,
    components,
    groups_of,
    key_ranges,
    packed_postings,
    solve_groups,
)

#: Distinct sets, and shingles of them, that meet in one task.
GROUP_SETS = 4096
GROUP_SHINGLES = 2_000_000
#: Shingles are common if so many documents of a sample of about so many hold them; the list that
#: goes to the workers is bounded.
COMMON_TIMES = 3
SAMPLE_ROWS = 10_000
COMMON_MOST = 1 << 17
#: Rows of one block of the product, and blocks of columns between two looks at the bounds.
BLOCK_ROWS = 64
COLUMN_BLOCKS = 4
#: Products added up at once.
CELLS = 2_000_000
SLICE_BYTES = 4 << 20
#: Ratio of the sizes at the ends of a size band.
BAND = 1.6


@dataclass(frozen=True)
class Threshold:
    """Link when `whole` * intersection >= `part` * union, over sets of `words`-word shingles."""

    words: int = 5
    part: int = 80
    whole: int = 100

    def bound(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least overlap of two sets of sizes a and b that link."""
        return -(-self.part * (a + b) // (self.whole + self.part))

    def differences(self, size: np.ndarray) -> np.ndarray:
        """Most shingles by which a set of this size can differ from one as large or larger."""
        return (size + size * self.whole // self.part) * (self.whole - self.part) // (self.whole + self.part)


@lru_cache(16)
def band_starts(top: int) -> np.ndarray:
    """Smallest size of every band, up to one beyond `top`."""
    out = [1]
    while out[-1] <= top:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return np.array(out)


def column_blocks(rule: Threshold, band: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Into how many blocks the columns are cut for pairs whose smaller set is in the band.

    More than the shingles by which such a pair can differ; some more, since a set may have no
    shingle in some blocks.
    """
    most = rule.differences(starts[band + 1] - 1) + 1
    return most + most // 32 + 2


@dataclass(frozen=True)
class _Cells:
    """What some sets have in their blocks of columns."""

    owner: np.ndarray
    block: np.ndarray
    content: np.ndarray
    filled: np.ndarray

    def keys(self, band: np.ndarray, scheme: int) -> np.ndarray:
        name = (band[self.owner] << 32) + (self.block << 1) + scheme
        return mixed(self.content ^ mixed(name.astype(np.uint64)))


def _cells(shingle: np.ndarray, first: np.ndarray, n: np.ndarray, blocks: np.ndarray) -> _Cells:
    """Cut each set, a run of sorted shingles, into its number of blocks."""
    local = np.repeat(np.arange(len(n)), n)
    own = shingle[spread(first, n)]
    # The upper 32 bits of the hash choose the block; a block is a run.
    block = ((own >> np.uint64(32)) * blocks[local].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    fresh = np.ones(len(own), bool)
    fresh[1:] = (block[1:] != block[:-1]) | (local[1:] != local[:-1])
    heads = np.flatnonzero(fresh)
    content = np.add.reduceat(mixed(own), heads) if len(heads) else np.zeros(0, np.uint64)
    return _Cells(local[heads], block[heads], content, np.bincount(local[heads], minlength=len(n)))


def _empty_cells(cells: _Cells, blocks: np.ndarray, sets: np.ndarray) -> _Cells:
    """The blocks in which these sets have nothing."""
    base = run_starts(blocks)
    every = spread(base[sets], blocks[sets])
    owner = np.repeat(sets, blocks[sets])
    empty = ~np.isin(every, base[cells.owner] + cells.block)
    owner = owner[empty]
    return _Cells(owner, every[empty] - base[owner], np.zeros(len(owner), np.uint64), cells.filled)


def block_keys(
    shingle: np.ndarray, sizes: np.ndarray, rule: Threshold, common: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every set such that linked sets share one: (key, index of the set).

    The columns are cut by hash into more blocks than a linking pair has differences, so the
    pair agrees entirely in some block: the key is the hash of what the set has in the block.
    Leaving columns out does not add differences, so the keys are made without the `common`
    shingles (sorted), which many documents share and which would tie strangers together; which
    ones are left out changes the work, never the links.

    If one of the two has shingles in as many blocks as there may be differences and one more,
    the pair agrees in a block that is not empty. Sets of which too little is left for that also
    take part with keys of all their shingles, and those that fill too few blocks even so (by
    chance, hardly any) with their empty blocks. A pair belongs to the band of its smaller set;
    a set at the lower edge of its band joins the band below as well.
    """
    held = np.flatnonzero(sizes > 0)
    if not len(held):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts = band_starts(int(sizes.max()))
    top = np.searchsorted(starts, sizes, "right") - 1
    low = np.searchsorted(starts, np.maximum(-(-sizes * rule.part // rule.whole), 1), "right") - 1
    first = run_starts(sizes)
    rare, rare_sizes = shingle, sizes
    if common is not None and len(common):
        at = np.minimum(np.searchsorted(common, shingle), len(common) - 1)
        kept = common[at] != shingle
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rare, rare_sizes = shingle[kept], np.bincount(owner[kept], minlength=len(sizes))
    rare_first = run_starts(rare_sizes)
    keys, owners = [], []
    for step in range(int((top - low)[held].max()) + 1):
        sets = held[(top - step >= low)[held]]
        band = top[sets] - step
        blocks = column_blocks(rule, band, starts)
        # What the smaller set of a pair of this band can differ by, and one more.
        enough = rule.differences(np.minimum(sizes[sets], starts[band + 1] - 1)) + 1
        cells = _cells(rare, rare_first[sets], rare_sizes[sets], blocks)
        keys.append(cells.keys(band, 0))
        owners.append(sets[cells.owner])
        few = np.flatnonzero(cells.filled < enough)
        if not len(few):
            continue
        sets, band, blocks, enough = sets[few], band[few], blocks[few], enough[few]
        cells = _cells(shingle, first[sets], sizes[sets], blocks)
        empty = _empty_cells(cells, blocks, np.flatnonzero(cells.filled < enough))
        for part in (cells, empty):
            keys.append(part.keys(band, 1))
            owners.append(sets[part.owner])
    return np.concatenate(keys), np.concatenate(owners)


def common_shingles(rows: DataFrame, n_rows: int, words: int) -> np.ndarray:
    """Shingles that come in COMMON_TIMES documents or more of a sample, at most COMMON_MOST.

    The sample has about SAMPLE_ROWS documents, chosen by the hash of their texts.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, offsets in slices(batch, limit=SLICE_BYTES):
                found, _ = shingle_sets(raw, offsets, words)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["shingle"])

    share = max(1, n_rows // SAMPLE_ROWS)
    sample = rows.where(F.pmod(F.xxhash64("_text_hash"), F.lit(share)) == 0).select("text")
    counted = sample.mapInArrow(released(shingles), "shingle long").groupBy("shingle").count()
    often = counted.where(F.col("count") >= COMMON_TIMES).orderBy(F.desc("count"), "shingle").limit(COMMON_MOST)
    return np.sort(np.array([r["shingle"] for r in often.collect()], np.int64).view(np.uint64))


def set_ids(shingle: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit number per set, equal for equal sets."""
    ends = np.r_[0, np.cumsum(sizes)]
    total = np.r_[np.zeros(1, np.uint64), np.cumsum(mixed(shingle ^ np.uint64(0xD6E8FEB86659FD93)))]
    return mixed(total[ends[1:]] - total[ends[:-1]] + sizes.astype(np.uint64)).view(np.int64)


def product_classes(sets: list[np.ndarray], rule: Threshold) -> np.ndarray:
    """Smallest index each set is connected with through links, by the blocked product.

    Rows are multiplied block by block with the transposed incidence: the postings of a row's
    columns are counted into a dense row of overlaps. Columns come in blocks; after each, pairs
    that cannot reach the bound of their sizes any more are discarded, and a row with none left
    stops. Rows whose class already holds all others are skipped.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    root = np.arange(n)
    if n < 2:
        return root
    row = np.repeat(np.arange(n), sizes)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(column, minlength=len(values)) > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    n_columns = int(shared.sum())
    by_column = np.argsort(column, kind="stable")
    posting = row[by_column]
    count = np.bincount(column, minlength=n_columns)
    first = run_starts(count)
    part = column * COLUMN_BLOCKS // max(n_columns, 1)
    in_part = [np.flatnonzero(part == p) for p in range(COLUMN_BLOCKS)]
    cut = [np.searchsorted(row[p], np.arange(n + 1)) for p in in_part]
    left_over = np.zeros((COLUMN_BLOCKS + 1, n), np.int64)
    for p in range(COLUMN_BLOCKS - 1, -1, -1):
        left_over[p] = left_over[p + 1] + np.diff(cut[p])
    done = 0
    while done < n:
        # Only rows with others outside their class, a block at a time.
        ahead = np.arange(done, n)
        counts = np.bincount(root, minlength=n)
        open_rows = ahead[counts[root[ahead]] < n]
        if not len(open_rows):
            break
        block = open_rows[:BLOCK_ROWS]
        done = int(block[-1]) + 1
        bound = rule.bound(sizes[block][:, None], sizes[None, :])
        alive = (bound <= np.minimum(sizes[block][:, None], sizes[None, :])) & (
            root[block][:, None] != root[None, :]
        )
        overlap = np.zeros((len(block), n), np.int64)
        for p in range(COLUMN_BLOCKS):
            busy = np.flatnonzero(alive.any(axis=1))
            if not len(busy):
                break
            span = cut[p][block[busy] + 1] - cut[p][block[busy]]
            columns = column[in_part[p][spread(cut[p][block[busy]], span)]]
            owner = np.repeat(busy, span)
            # Postings are gathered CELLS at a time, whatever the rows and columns.
            reach = np.cumsum(count[columns])
            low = 0
            while low < len(columns):
                done_before = reach[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(reach, done_before + CELLS, "right")))
                own, n_own = columns[low:high], count[columns[low:high]]
                cells = np.repeat(owner[low:high] * n, n_own) + posting[spread(first[own], n_own)]
                overlap += np.bincount(cells, minlength=len(block) * n).reshape(len(block), n)
                low = high
            rest = np.minimum(left_over[p + 1][block][:, None], left_over[p + 1][None, :])
            alive &= overlap + rest >= bound
        a, b = np.nonzero(alive & (overlap >= bound))
        root = classes_of(n, block[a], b, root)
    return root


def _solve(payloads: list[bytes], rule: Threshold) -> np.ndarray:
    return product_classes([np.frombuffer(p, "<u8") for p in payloads], rule)


def jaccard_classes(docs: DataFrame, rule: Threshold) -> DataFrame:
    """Per document the size of its shingle set and the smallest doc_id reachable by links.

    Words are bytes between blanks, A-Z lower-cased. Equal sets are one item, so copies cost
    nothing. Items that agree in a block of columns are candidates; the exact product runs
    within connected candidates, see `linking`. Returns _id, _text_hash, doc_id, n_shingles,
    _component (that smallest id) and _class, which tells components apart whatever their ids;
    documents without shingles share a _class.

    Defined cases: null and empty texts, and texts of blanks, have size 0 and link with nothing,
    each its own component; rows that repeat are linked (equal sets), empty ones excepted; a null
    id is never a component's id: a row's _component is the smallest non-null id of its class
    (null if the class has none, and for a row of null id without shingles). Texts of any length are taken whole. Empty tables
    give no rows.
    """
    rows = texts(docs)
    n_rows, total = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    n_ranges = key_ranges(total or 0)
    common = common_shingles(rows, n_rows, rule.words)

    def ids_and_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, raw, offsets in slices(batch, limit=SLICE_BYTES):
                shingle, sizes = shingle_sets(raw, offsets, rule.words)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ROW], pa.array(sizes, pa.int64()), pa.array(set_ids(shingle, sizes))],
                    names=[*ROW, "n_shingles", "item"],
                )

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, offsets in slices(batch, limit=SLICE_BYTES):
                shingle, sizes = shingle_sets(raw, offsets, rule.words)
                key, owner = block_keys(shingle, sizes, rule, common)
                yield from packed_postings(key, set_ids(shingle, sizes)[owner], n_ranges)

    def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, offsets in slices(batch, limit=SLICE_BYTES):
                shingle, sizes = shingle_sets(raw, offsets, rule.words)
                ends = (np.r_[0, np.cumsum(sizes)] * 8).astype(np.int32)
                content = pa.BinaryArray.from_buffers(
                    pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(shingle.astype("<u8"))]
                )
                yield pa.RecordBatch.from_arrays([pa.array(set_ids(shingle, sizes)), content], names=["item", "payload"])

    sized = stage(
        rows.select(*ROW, "text").mapInArrow(released(ids_and_sizes), "_id long, _text_hash long, n_shingles long, item long"),
        "ngram-sizes",
    )
    edges = candidate_edges(rows.select("text").mapInArrow(released(postings), BLOCKS_DDL))
    members = components(edges, "ngram-candidates")
    chosen = (
        sized.where(F.col("n_shingles") > 0)
        .groupBy("item")
        .agg(F.min(F.struct(*ROW)).alias("_row"), F.first("n_shingles").alias("weight"))
        .join(members, "item")
    )
    chosen = stage(chosen.select("item", "_row.*", "weight", "component"), "ngram-members")
    met = groups_of(chosen, GROUP_SETS, GROUP_SHINGLES)
    # Texts are never shuffled: rows that hold no wanted set go before their sets are worked out,
    # the few others that pass meet no group.
    wanted = KeyFilter(chosen, F.xxhash64(*ROW))
    sets = (
        wanted.may_have(rows.select("text", F.xxhash64(*ROW).alias("_key")), "_key")
        .select("text")
        .mapInArrow(released(payloads), "item long, payload binary")
        .dropDuplicates(["item"])
    )
    links = solve_groups(met.join(sets, "item"), lambda p: _solve(p, rule))
    found = classes(links, "ngram-links")
    named = sized.join(found, "item", "left").withColumn("_class", F.coalesce("class", "item"))
    # Null ids are never a component's id: the smallest id of a class is taken over real ids.
    least = named.where(F.col("n_shingles") > 0).groupBy("_class").agg(F.min(public_id()).alias("_least"))
    return named.join(least, "_class", "left").select(
        *ROW,
        public_id().alias("doc_id"),
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("_least")).otherwise(public_id()).alias("_component"),
        "_class",
    )


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles have a Jaccard of 0.9 or more."""
    found = jaccard_classes(table(spark, sf_dir, "documents"), Threshold(words=3, part=90, whole=100))
    return found.select("doc_id", "n_shingles", F.col("_component").alias("component_id"))
