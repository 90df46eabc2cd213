"""Removal of repeated byte windows: a depth-limited radix sort of suffixes.

Two suffixes count as equal when their first `depth` bytes are (400 in production). The sort
stops there: what it leaves as groups of two and more are exactly the repeated windows.

Most-significant digit first, the passes are:

1. *Bucket.* A suffix goes to the bucket of its anchor: the 128 bytes within its window whose hash
   is smallest (the leftmost if several). Equal windows have the same anchor at the same place,
   and neighbouring suffixes share theirs, so one row stands for a run of suffixes. Buckets with
   one run hold no repeat and end here; that is nearly all of them.
2. *Fragments.* The bytes that a run's windows cover. Runs with equal fragments are repeats as a
   whole, and one of them stands for all in what follows.
3. *Digits.* Within a bucket, suffixes that lie at the same distance from the anchor are refined
   by eight bytes after eight bytes, down to the depth; a group of one drops out at once.
   Buckets with very many different fragments are not gathered in one task: their suffixes are
   refined by one digit of the whole depth, counted by its 128-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioflow.llm.arrays import prefix_hash, run_starts, spread, substring_hash
from folioflow.llm.common import ROW, public_id, slices, stage, table, texts

DEPTH = 400
ANCHOR = 128
DIGIT = 8
#: Different fragments of one bucket that are sorted in one task; beyond, digests are counted.
LOCAL_FRAGMENTS = 2_000
#: Rows of one key that are gathered in one task to look the key up; beyond, they are dealt out one by one.
HOT_ROWS = 10_000
#: Suffixes that one call of the local sort takes at once.
LOCAL_SUFFIXES = 1_000_000
#: A text longer than this is cut into parts that overlap by the depth.
PART_BYTES = 4 << 20

_PLACE_BITS = 24


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values, in two passes."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchor_runs(raw: np.ndarray, offsets: np.ndarray, depth: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of suffixes with one anchor: (text number, start, suffixes, anchor's start, hash).

    Starts are relative to the text. Only suffixes with `depth` bytes before the end of their
    text count.
    """
    n_suffixes = len(raw) - depth + 1
    if n_suffixes <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    starts = np.arange(len(raw) - anchor + 1)
    hashed = substring_hash(prefix_hash(raw), starts, starts + anchor)
    place = (1 << _PLACE_BITS) - 1
    key = ((hashed >> np.uint64(1)).astype(np.int64) & ~np.int64(place)) | starts
    at = sliding_min(key, depth - anchor + 1) & place
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n_suffixes]
    whole = np.arange(n_suffixes) + depth <= offsets[1:][text]
    heads = np.flatnonzero(
        whole & np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])]
    )
    # A run ends where the next begins, at the latest with the last whole suffix of its text.
    last = offsets[1:][text[heads]] - depth + 1
    ends = np.minimum(np.r_[heads[1:], n_suffixes], last)
    base = offsets[:-1][text[heads]]
    return text[heads], heads - base, ends - heads, at[heads] - base, hashed[at[heads]].view(np.int64)


def parts(offsets: np.ndarray, first: int, last: int, depth: int) -> Iterator[tuple[int, int]]:
    """Cut one long text so that every suffix is whole in exactly one part."""
    start = int(offsets[first])
    stop = int(offsets[last])
    while True:
        end = min(start + PART_BYTES, stop)
        yield start, end
        if end == stop:
            return
        start = end - depth + 1


_RUNS = pa.schema(
    [
        ("_id", pa.int64()),
        ("_text_hash", pa.int64()),
        ("bucket", pa.int64()),
        ("start", pa.int64()),
        ("n", pa.int64()),
        ("anchor", pa.int64()),
    ]
)
_RUNS_DDL = "_id long, _text_hash long, bucket long, start long, n long, anchor long"


def runs_of(rows: DataFrame, depth: int, anchor: int) -> DataFrame:
    """One row per run of suffixes: its text, bucket, start, number and where its anchor is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in ROW]
            for first, last, raw, offsets in slices(batch):
                cuts = [(0, len(raw))] if last - first > 1 else parts(offsets, 0, 1, depth)
                for a, b in cuts:
                    inner = offsets if last - first > 1 else np.array([0, b - a])
                    text, start, n, at, bucket = anchor_runs(raw[a:b], inner, depth, anchor)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(c, pa.int64())
                            for c in (ids[0][first + text], ids[1][first + text], bucket, start + a, n, at + a)
                        ],
                        schema=_RUNS,
                    )

    return rows.select(*ROW, "text").mapInArrow(run, _RUNS_DDL)


def repeats(raw: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """For every suffix whether another of its group has the same first `depth` bytes.

    Most-significant digit first: each pass compares one digit of eight bytes. A group whose
    members all agree stays as it is; the others are sorted by the digit and split. Members of
    groups of one drop out.
    """
    wide = np.zeros(len(raw) + DIGIT, np.uint64)
    for i in range(DIGIT):
        wide[: len(raw) - i] |= raw[i:].astype(np.uint64) << np.uint64(8 * (DIGIT - 1 - i))
    order = np.argsort(group, kind="stable")
    active, group = order, group[order]

    def kept(active: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number the groups whose heads are marked and drop those of one member."""
        number = np.cumsum(fresh) - 1
        size = np.bincount(number)
        stays = size[number] > 1
        return active[stays], number[stays]

    active, group = kept(active, np.r_[True, group[1:] != group[:-1]][: len(active)])
    for place in range(0, depth, DIGIT):
        if not len(active):
            break
        digit = wide[at[active] + place]
        if depth - place < DIGIT:
            digit = digit >> np.uint64(8 * (DIGIT - depth + place))
        fresh = np.r_[True, group[1:] != group[:-1]]
        heads = np.flatnonzero(fresh)
        number = np.cumsum(fresh) - 1
        other = digit != digit[heads][number]
        if not other.any():
            continue
        mixed_groups = np.zeros(len(heads), bool)
        mixed_groups[number[other]] = True
        torn = np.flatnonzero(mixed_groups[number])
        by = torn[np.lexsort((digit[torn], number[torn]))]
        active[torn], digit[torn] = active[by], digit[by]
        fresh[1:] |= digit[1:] != digit[:-1]
        active, group = kept(active, fresh)
    found = np.zeros(len(at), bool)
    found[active] = True
    return found


def ranges(found: np.ndarray, owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of consecutive marked places of one owner: (owner, first place, number)."""
    at = np.flatnonzero(found)
    if not len(at):
        return at, at, at
    fresh = np.r_[True, (owner[at][1:] != owner[at][:-1]) | (place[at][1:] != place[at][:-1] + 1)]
    heads = np.flatnonzero(fresh)
    return owner[at][heads], place[at][heads], np.diff(np.r_[heads, len(at)])


_FOUND_DDL = "_id long, _text_hash long, start long, n long"


def _found(ids, hashes, starts, sizes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in (ids, hashes, starts, sizes)],
        names=["_id", "_text_hash", "start", "n"],
    )


def _sort_buckets(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Fragments come sorted by bucket. Whole buckets are gathered up to LOCAL_SUFFIXES."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        bucket, ids, hashes, start, n, anchor, content = (
            np.array(c) if i < 6 else c for i, c in enumerate(zip(*rows))
        )
        sizes = np.array([len(c) for c in content])
        raw = np.frombuffer(b"".join(content), np.uint8)
        owner = np.repeat(np.arange(len(rows)), n)
        place = spread(np.zeros(len(rows), np.int64), n)
        distance = (anchor - start)[owner] - place
        _, number = np.unique(bucket, return_inverse=True)
        group = number[owner] * np.int64(depth + 1) + distance
        marked = repeats(raw, run_starts(sizes)[owner] + place, group, depth)
        of, first, count = ranges(marked, owner, place)
        return _found(ids[of], hashes[of], start[of] + first, count)

    held: list[tuple] = []
    suffixes = 0
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
            if held and row[0] != held[-1][0] and suffixes > LOCAL_SUFFIXES:
                yield solve(held)
                held, suffixes = [], 0
            held.append(row)
            suffixes += row[4]
    if held:
        yield solve(held)


def _digests(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Every suffix of every fragment with the digest of its window."""
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
            bucket, id_, text_hash, start, n, anchor, content = row
            view = memoryview(content)
            digest = [hashlib.blake2b(view[i : i + depth], digest_size=16).digest() for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digest, pa.binary()),
                    pa.array([id_] * n, pa.int64()),
                    pa.array([text_hash] * n, pa.int64()),
                    pa.array(range(start, start + n), pa.int64()),
                ],
                names=["digest", "_id", "_text_hash", "start"],
            )


_FRAGMENT_DDL = (
    "bucket long, digest binary, _id long, _text_hash long, start long, n long, anchor long"
)


def _fragments(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """The digest of the bytes that each run covers."""
    for batch in batches:
        out: list[tuple] = []
        for id_, text_hash, text, runs in zip(*[batch.column(i) for i in range(4)]):
            raw = text.as_py().encode()
            for r in runs.as_py():
                cut = raw[r["start"] : r["start"] + r["n"] - 1 + depth]
                digest = hashlib.blake2b(cut, digest_size=16).digest()
                out.append((r["bucket"], digest, id_.as_py(), text_hash.as_py(), r["start"], r["n"], r["anchor"]))
        if out:
            kinds = [pa.int64(), pa.binary(), *[pa.int64()] * 5]
            names = ["bucket", "digest", "_id", "_text_hash", "start", "n", "anchor"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names
            )


_CONTENT_DDL = (
    "bucket long, _id long, _text_hash long, start long, n long, anchor long, content binary"
)


def _contents(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """The bytes that each asked-for run covers."""
    for batch in batches:
        out: list[tuple] = []
        for id_, text_hash, text, runs in zip(*[batch.column(i) for i in range(4)]):
            raw = text.as_py().encode()
            for r in runs.as_py():
                cut = raw[r["start"] : r["start"] + r["n"] - 1 + depth]
                out.append((r["bucket"], id_.as_py(), text_hash.as_py(), r["start"], r["n"], r["anchor"], cut))
        if out:
            kinds = [*[pa.int64()] * 6, pa.binary()]
            names = ["bucket", "_id", "_text_hash", "start", "n", "anchor", "content"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names
            )


def _cut_out(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Remove the bytes of the marked windows from each text."""
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            raw = text.as_py().encode()
            merged: list[list[int]] = []
            for s in sorted((s["start"], s["start"] + s["n"] - 1 + depth) for s in spans.as_py()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            digest, at = hashlib.sha256(), 0
            for a, b in merged:
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at:])
            removed = sum(b - a for a, b in merged)
            out.append((len(raw), removed, [{"start": a, "end": b} for a, b in merged], digest.hexdigest()))
        if out:
            n_bytes, removed, spans, digests = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(digests, pa.string()),
                ],
                names=["_id", "n_bytes", "n_removed", "spans", "kept_sha256"],
            )


_RESULT_DDL = (
    "_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"
)


def of_repeated(rows: DataFrame, counts: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """The rows whose key comes more than once. `counts` has one row per key and its number `_n`.

    Keys of more than `hot_rows` rows are known to repeat. They are few, at most one for so many
    rows, so every task is told them, and their rows are dealt out by the row instead of the key:
    a text that repeats one line very often has as many runs with one anchor. The first key is a
    long; a hot row that meets another key by its own hash is kept either way.
    """
    first, rest = keys[0], keys[1:]
    hot = counts.where(F.col("_n") > hot_rows).select(*keys, F.col("_n").alias("_hot"))
    by = F.when(F.col("_hot").isNotNull(), F.xxhash64(*ROW, "start")).otherwise(F.col(first))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("_dealt", by)
    shared = counts.where(F.col("_n") > 1).select(F.col(first).alias("_dealt"), *rest, "_n")
    return (
        dealt.join(shared, ["_dealt", *rest], "left")
        .where(F.col("_hot").isNotNull() | F.col("_n").isNotNull())
        .select(rows.columns)
    )


def remove_repeats(
    docs: DataFrame,
    depth: int = DEPTH,
    anchor: int = ANCHOR,
    local_fragments: int = LOCAL_FRAGMENTS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per document the bytes covered by a window of `depth` bytes that starts anywhere else too.

    Texts are UTF-8 bytes; windows never cross documents; windows are judged on the input.
    Returns doc_id, n_bytes, n_removed, spans (start and end of every maximal removed run) and
    kept_sha256 of the bytes that remain.

    Defined cases: a null text is the empty one; texts shorter than the depth lose nothing; rows
    that repeat are copies of each other, hence lose everything a window covers; null ids stay
    null. Very long texts go in overlapping parts. Empty tables give no rows.
    """
    if not 0 < anchor <= depth:
        raise ValueError("the anchor is part of the window")
    rows = texts(docs)
    runs = runs_of(rows, depth, anchor)
    per_anchor = runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
    # Copies of a row (same id and text) have the same runs: each is gathered once per row, so
    # the copies of a row do not multiply each other's work (small rows, combined map-side).
    by_text = (
        of_repeated(runs, per_anchor, ["bucket"], hot_rows)
        .groupBy(*ROW)
        .agg(F.collect_set(F.struct("bucket", "start", "n", "anchor")).alias("runs"))
    )
    some = F.col("runs").isNotNull()
    held = stage(
        rows.join(by_text, ROW, "left").select(
            *ROW,
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.when(~some, F.sha2(F.col("text").cast("binary"), 256)).alias("sha256"),
            F.when(some, F.col("text")).alias("text"),
            "runs",
        ),
        "suffix-texts",
    )
    candidates = held.where(some)
    fragments = stage(
        candidates.select(*ROW, "text", "runs").mapInArrow(lambda b: _fragments(b, depth), _FRAGMENT_DDL),
        "suffix-fragments",
    )
    different = fragments.groupBy("bucket", "digest").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct(*ROW, "start", "n", "anchor")).alias("first"),
    )
    per_bucket = different.groupBy("bucket").agg(F.count(F.lit(1)).alias("fragments"))
    contested = per_bucket.where(F.col("fragments") > 1)
    asked = (
        different.join(contested, "bucket")
        .select("first.*", "bucket", (F.col("fragments") <= local_fragments).alias("_local"))
        .groupBy(*ROW, "_local")
        .agg(F.collect_list(F.struct("bucket", "start", "n", "anchor")).alias("asked"))
    )
    asked = stage(
        candidates.select(*ROW, "text")
        .dropDuplicates(ROW)
        .join(asked, ROW)
        .select(*ROW, "text", "asked", "_local"),
        "suffix-contested",
    )

    def contents(local: bool) -> DataFrame:
        wanted = asked.where(F.col("_local") == F.lit(local)).drop("_local")
        return wanted.mapInArrow(lambda b: _contents(b, depth), _CONTENT_DDL)

    sorted_here = (
        contents(True)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(lambda b: _sort_buckets(b, depth), _FOUND_DDL)
    )
    digests = contents(False).mapInArrow(
        lambda b: _digests(b, depth), "digest binary, _id long, _text_hash long, start long"
    )
    twice = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    counted = digests.join(twice.select("digest"), "digest", "left_semi").select(
        *ROW, "start", F.lit(1).cast("long").alias("n")
    )
    per_fragment = different.select("bucket", "digest", F.col("copies").alias("_n"))
    copied = of_repeated(fragments, per_fragment, ["bucket", "digest"], hot_rows).select(*ROW, "start", "n")
    spans = (
        copied.unionByName(sorted_here)
        .unionByName(counted)
        .dropDuplicates([*ROW, "start", "n"])
        .groupBy(*ROW)
        .agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    )
    judged = candidates.join(spans, ROW, "left").select(
        "_id", "text", F.coalesce("spans", F.array().cast("array<struct<start:long,n:long>>")).alias("spans")
    )
    cut = judged.mapInArrow(lambda b: _cut_out(b, depth), _RESULT_DDL)
    whole = held.where(~some).select(
        "_id",
        "n_bytes",
        F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        F.col("sha256").alias("kept_sha256"),
    )
    return cut.unionByName(whole).select(
        public_id().alias("doc_id"), "n_bytes", "n_removed", "spans", "kept_sha256"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated windows of 400 bytes."""
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )
