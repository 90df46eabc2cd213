"""MinHash near-duplicate detection with sequential Bayesian verification.

Every document's set of word shingles gets a MinHash signature. Signatures are cut into bands;
documents that agree in a whole band are candidates. Candidates meet as in `linking`: star
edges per band key, connected components, bounded groups within them. In a group every pair
that shares a band is verified step by step: signature positions are compared a batch at a
time, and after each batch the posterior of the similarity (uniform prior, Beta posterior of
the matches) is held against the threshold. A pair whose chance of a similarity at or above the
threshold falls under the chosen miss probability is dropped; the rest are confirmed on their
full sets. Pairs whose documents are linked already through others are not compared again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioflow.llm.arrays import mixed, shingle_sets, spread
from folioflow.llm.common import ROW, released, slices, stage, table, texts
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
from folioflow.llm.ngram_join import set_ids
from folioflow.operators.sizes import broadcast_if_small

#: Words per shingle and the threshold: link when 100 * intersection >= PERCENT * union.
WORDS = 4
PERCENT = 80
#: Signature positions, bands of ROWS positions each (so BANDS = HASHES / ROWS). A pair of
#: similarity 0.8 misses every band with chance (1 - 0.8**4)**32, about 5e-8.
HASHES = 128
ROWS = 4
#: Positions compared per step of the verification, and the chance, per step, of dropping a
#: pair whose similarity is at or above the threshold.
STEP = 16
MISS = 1e-7
SEED = 0x2545F4914F6CDD1D
#: Distinct sets, and their shingles, that meet in one task; sets below BROADCAST are broadcast.
GROUP_SETS = 4096
GROUP_SHINGLES = 2_000_000
BROADCAST_SETS = 500_000
SLICE_BYTES = 2 << 20


@lru_cache(1)
def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def signatures(shingle: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The MinHash signature (HASHES uint32) of every set; all ones for empty sets.

    Shingle hashes are mixed already; folded to 32 bits, the i-th hash of x is
    (x xor s_i) * a_i modulo 2**32 with odd a_i, one position at a time over the whole slice.
    """
    odd, salt = _family()
    out = np.full((len(sizes), HASHES), np.iinfo(np.uint32).max, np.uint32)
    held = np.flatnonzero(sizes)
    if not len(held):
        return out
    starts = (np.cumsum(sizes) - sizes)[held]
    folded = (shingle ^ (shingle >> np.uint64(32))).astype(np.uint32)
    for i in range(HASHES):
        values = folded ^ salt[i]
        values *= odd[i]
        out[held, i] = np.minimum.reduceat(values, starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One key per band of every signature (rows x bands)."""
    bands = HASHES // ROWS
    keys = np.empty((len(signature), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(ROWS):
            key = mixed(key ^ signature[:, band * ROWS + r].astype(np.uint64))
        keys[:, band] = key
    return keys


@lru_cache(None)
def least_matches() -> np.ndarray:
    """After n = STEP, 2 STEP, ... positions: the fewest matches that keep a pair.

    With a uniform prior, m matches of n give a Beta(m + 1, n - m + 1) posterior, and the chance
    that the similarity is at least t is P(Binomial(n + 1, t) <= m). A pair is dropped when that
    chance is below MISS.
    """
    t = PERCENT / 100
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, least = 0.0, n + 1
        for m in range(n + 1):
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= MISS:
                least = m
                break
        out.append(least)
    return np.array(out, np.int64)


#: Elements of the sets whose pairs are checked in one sort.
CHECK_ELEMENTS = 1 << 19


def exact_links(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs link on their full sets: the sets of all pairs at once, in slices of about
    CHECK_ELEMENTS elements, sorted by (pair, element); an element twice in a row is shared."""
    out = np.zeros(len(left), bool)
    weight = np.cumsum(sizes[left] + sizes[right])
    first = 0
    while first < len(left):
        last = max(first + 1, int(np.searchsorted(weight, weight[first] - sizes[left[first]] - sizes[right[first]] + CHECK_ELEMENTS)))
        l, r = left[first:last], right[first:last]
        pair = np.r_[np.repeat(np.arange(len(l)), sizes[l]), np.repeat(np.arange(len(l)), sizes[r])]
        at = np.r_[spread(starts[l], sizes[l]), spread(starts[r], sizes[r])]
        value = flat[at]
        order = np.lexsort((value, pair))
        pair, value = pair[order], value[order]
        twice = (pair[1:] == pair[:-1]) & (value[1:] == value[:-1])
        common = np.bincount(pair[1:][twice], minlength=len(l))
        out[first:last] = 100 * common >= PERCENT * (sizes[l] + sizes[r] - common)
        first = last
    return out


def verified(sig: np.ndarray, sets: tuple, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs link: the sequential test on signatures, then the exact test on full sets
    (`sets` is the flat elements, starts and sizes of all sets)."""
    alive = np.ones(len(left), bool)
    matches = np.zeros(len(left), np.int64)
    for step, least in enumerate(least_matches()):
        at = np.flatnonzero(alive)
        if not len(at):
            break
        cols = slice(step * STEP, (step + 1) * STEP)
        matches[at] += (sig[left[at], cols] == sig[right[at], cols]).sum(axis=1)
        alive[at] = matches[at] >= least
    at = np.flatnonzero(alive)
    alive[at] = exact_links(*sets, left[at], right[at])
    return alive


def linked_roots(sig: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """For each of the items, the smallest index it is connected with through links.

    Pairs are those that share a band key. Within a run of a key every item meets the later
    ones, but only those not linked to it already and not tested before in another band, so a
    pair is tested once at most.
    """
    n = len(sets)
    label = np.arange(n)
    sizes = np.array([len(s) for s in sets], np.int64)
    packed = (np.concatenate(sets) if n else np.zeros(0, np.uint64), np.cumsum(sizes) - sizes, sizes)
    tested = np.zeros((n, n), bool)
    keys = band_keys(sig)
    for band in range(keys.shape[1]):
        order = np.argsort(keys[:, band], kind="stable")
        key = keys[order, band]
        cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a < 2:
                continue
            run = order[a:b]
            for i in range(len(run) - 1):
                one, others = run[i], run[i + 1 :]
                others = others[(label[others] != label[one]) & ~tested[one, others]]
                if not len(others):
                    continue
                tested[one, others] = tested[others, one] = True
                ok = verified(sig, packed, np.full(len(others), one), others)
                for other in others[ok]:
                    low, high = sorted((label[one], label[other]))
                    if low != high:
                        label[label == high] = low
    return label


def _payload(signature: np.ndarray, shingle: np.ndarray) -> bytes:
    return signature.astype("<u4").tobytes() + shingle.astype("<u8").tobytes()


def _solve(payloads: list[bytes]) -> np.ndarray:
    cut = 4 * HASHES
    sig = np.stack([np.frombuffer(p[:cut], "<u4") for p in payloads]) if payloads else np.zeros((0, HASHES), np.uint32)
    return linked_roots(sig, [np.frombuffer(p[cut:], "<u8") for p in payloads])


def minhash_classes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per document its set size and the class of documents reachable by confirmed links.

    Words are bytes between blanks, A-Z lower-cased; a set holds the distinct `words`-word
    shingles, or the whole sequence of a shorter text. Equal sets are one item. Returns
    ROW, doc_id, n_shingles and _class (a number shared by the members of a class; items
    without a link are their own class).
    """
    rows = texts(docs)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    n_ranges = key_ranges(total or 0)

    def each_slice(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for first, last, raw, offsets in slices(batch, limit=SLICE_BYTES):
                shingle, sizes = shingle_sets(raw, offsets, words)
                yield batch.slice(first, last - first), shingle, sizes

    def ids_and_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, shingle, sizes in each_slice(batches):
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in ROW], pa.array(sizes, pa.int64()), pa.array(set_ids(shingle, sizes))],
                names=[*ROW, "n_shingles", "item"],
            )

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shingle, sizes in each_slice(batches):
            held = sizes > 0
            keys = band_keys(signatures(shingle, sizes)[held])
            items = set_ids(shingle, sizes)[held]
            yield from packed_postings(keys.reshape(-1), np.repeat(items, keys.shape[1]), n_ranges)

    def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, shingle, sizes in each_slice(batches):
            sig = signatures(shingle, sizes)
            ends = np.r_[0, np.cumsum(sizes)]
            content = [_payload(sig[i], shingle[ends[i] : ends[i + 1]]) for i in range(len(sizes))]
            yield pa.RecordBatch.from_arrays([part.column("item"), pa.array(content, pa.binary())], names=["item", "payload"])

    sized = stage(
        rows.select(*ROW, "text").mapInArrow(released(ids_and_sizes), "_id long, _text_hash long, n_shingles long, item long"),
        "minhash-sizes",
    )
    edges = candidate_edges(rows.select("text").mapInArrow(released(postings), BLOCKS_DDL))
    members = components(edges, "minhash-candidates")
    chosen = (
        sized.where(F.col("n_shingles") > 0)
        .groupBy("item")
        .agg(F.min(F.struct(*ROW)).alias("_row"), F.first("n_shingles").alias("weight"))
        .join(members, "item")
    )
    chosen = stage(chosen.select("item", "_row.*", "weight", "component"), "minhash-members")
    met = groups_of(chosen, GROUP_SETS, GROUP_SHINGLES)
    wanted = broadcast_if_small(chosen.select(*ROW, "item"), BROADCAST_SETS)
    sets = (
        rows.join(wanted, ROW)
        .select("item", "text")
        .mapInArrow(released(payloads), "item long, payload binary")
        .dropDuplicates(["item"])
    )
    links = solve_groups(met.join(sets, "item"), _solve)
    found = classes(links, "minhash-links")
    return sized.join(found, "item", "left").select(
        *ROW, "n_shingles", F.coalesce("class", "item").alias("_class")
    )


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included),
    kept (doc_id = component_id).

    Defined cases: null and empty texts, and texts of blanks, have no shingles and link with
    nothing: each is its own component and kept. Rows that repeat exactly are linked (equal
    sets) and give one row each; of them the row of the smallest doc_id is kept, so copies with
    one id are all kept. A null doc_id is never a component's id: its component_id is the
    smallest non-null id of its class (null if there is none) and it is not kept. Texts of any
    length are taken whole; columns of other names are never read; an empty table gives no rows.
    """
    found = minhash_classes(docs, words)
    least = (
        found.where((F.col("n_shingles") > 0) & (F.col("_id") != F.lit(-(1 << 63))))
        .groupBy("_class")
        .agg(F.min("_id").alias("_least"))
    )
    doc_id = F.when(F.col("_id") != F.lit(-(1 << 63)), F.col("_id"))
    component = F.when(F.col("n_shingles") > 0, F.col("_least")).otherwise(doc_id)
    return (
        found.join(least, "_class", "left")
        .select(doc_id.alias("doc_id"), "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a Jaccard of 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))
