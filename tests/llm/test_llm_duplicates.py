"""Suffix dedup, n-gram join and line dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus_cases import edited, frame, rows_of, texts, words
from pyspark.sql import functions as F

from folioflow.llm import line_dedup as L, linking, ngram_join as N
from folioflow.llm.suffix_dedup import of_repeated, remove_repeats, repeats


def cut_windows(rows, depth):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[j : j + depth] for _, b in raw for j in range(len(b) - depth + 1))
    out = []
    for i, b in raw:
        marked = bytearray(len(b))
        for j in range(len(b) - depth + 1):
            if seen[b[j : j + depth]] > 1:
                marked[j : j + depth] = b"\1" * depth
        spans = sum(1 for j in range(len(b)) if marked[j] and (j == 0 or not marked[j - 1]))
        kept = bytes(c for c, m in zip(b, marked) if not m)
        out.append((i, len(b), sum(marked), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("depth,anchor,local", [(400, 128, 2000), (100, 40, 1), (60, 60, 2000)])
def test_suffix_dedup_equals_brute_force(spark, depth, anchor, local):
    got = remove_repeats(frame(spark, texts()), depth, anchor, local)
    got = got.selectExpr("doc_id", "n_bytes", "n_removed", "size(spans) AS n", "kept_sha256")
    assert rows_of(got, *got.columns) == cut_windows(texts(), depth)


def test_suffix_dedup_of_long_parts_and_of_nothing(spark, monkeypatch):
    rng = random.Random(1)
    tail = words(rng, 300)
    rows = [(1, words(rng, 3000) + tail), (2, tail), (3, "ab" * 4000)]
    import folioflow.llm.suffix_dedup as S

    monkeypatch.setattr(S, "PART_BYTES", 1500)
    offsets = np.array([0, 8000])
    covered = [p for a, b in S.parts(offsets, 0, 1, 400) for p in range(a, b - 400 + 1)]
    assert covered == list(range(8000 - 400 + 1))
    got = remove_repeats(frame(spark, rows)).selectExpr("doc_id", "n_bytes", "n_removed", "size(spans) AS n", "kept_sha256")
    assert rows_of(got, *got.columns) == cut_windows(rows, 400)
    assert remove_repeats(frame(spark, [])).count() == 0


def test_suffix_dedup_of_many_copies(spark):
    """Copies of a row (null id too) are searched once and still lose all, and still take
    windows away from other texts; the answer comes back for every copy."""
    rng = random.Random(2)
    shared, alone = words(rng, 200), words(rng, 200)
    rows = [(None, shared)] * 80 + [(5, alone + shared)] + [(6, alone[:300])] * 3 + [(7, words(rng, 150))]
    got = remove_repeats(frame(spark, rows)).selectExpr("doc_id", "n_bytes", "n_removed", "size(spans) AS n", "kept_sha256")
    assert rows_of(got, *got.columns) == cut_windows(rows, 400)


def test_suffix_dedup_of_one_line_repeated_very_often(spark):
    """Anchors and fragments of more rows than one task shall get: dealt out, with the same result."""
    rng = random.Random(3)
    line = words(rng, 30) + "\n"
    rows = [(i, words(rng, 20 + i) + line * (9 + i) + words(rng, 90)) for i in range(8)]
    rows += [(i, rows[i - 20][1]) for i in range(20, 24)] + [(30, line * 2), (None, line * 12), (31, words(rng, 200))]
    for hot_rows in (1, 5, 10_000):
        got = remove_repeats(frame(spark, rows), hot_rows=hot_rows)
        got = got.selectExpr("doc_id", "n_bytes", "n_removed", "size(spans) AS n", "kept_sha256")
        assert rows_of(got, *got.columns) == cut_windows(rows, 400)


def test_rows_of_a_hot_key_are_not_looked_up_in_one_task(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        runs = spark.range(4_000).selectExpr(
            "id AS _id", "id AS _text_hash", "IF(id < 3000, -7, id DIV 2 + IF(id > 3900, id, 0)) AS bucket",
            "encode('x', 'utf-8') AS digest", "id * 5 AS start",
        )
        for keys in (["bucket"], ["bucket", "digest"]):
            counts = runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            got = of_repeated(runs, counts, keys, 100)
            assert got.columns == runs.columns
            want = runs.join(counts.where("_n > 1").select(*keys), keys, "left_semi").select(runs.columns)
            assert rows_of(got, "_id", "bucket", "start") == rows_of(want, "_id", "bucket", "start")
            dealt = got.groupBy(F.spark_partition_id()).count().collect()
            assert max(r[1] for r in dealt) < 2_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_digit_passes_find_exactly_the_repeats():
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 99, 4000).astype(np.uint8)
    at = np.arange(0, 3900)
    for depth in (3, 8, 13, 24):
        seen = Counter(raw[i : i + depth].tobytes() for i in at)
        want = [seen[raw[i : i + depth].tobytes()] > 1 for i in at]
        assert repeats(raw, at, np.zeros(len(at), np.int64), depth).tolist() == want


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))) if w else frozenset()


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def linked(rows, rule):
    sets = [shingles(t, rule.words) for _, t in rows]
    parent = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and rule.whole * both >= rule.part * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    # A null id is never a component's id: the smallest non-null id of the class, else null.
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            root = find(parent, k)
            least[root] = min(least.get(root, i), i)
    return sorted(
        ((i, len(sets[k]), least.get(find(parent, k)) if sets[k] else i) for k, (i, _) in enumerate(rows)),
        key=repr,
    )


def near_texts(seed):
    """Groups of near copies around the threshold, of sizes from one word up."""
    rng = random.Random(seed)
    rows = []
    for _ in range(25):
        base = words(rng, rng.choice([1, 2, 3, 4, 6, 9, 14, 30, 80, 200]), "abcdefgh").split()
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                i = rng.randrange(len(copy))
                if rng.random() < 0.6:
                    copy[i] = words(rng, 1)
                elif len(copy) > 1:
                    copy.pop(i)
            rows.append((len(rows), " ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy)))
    return rows


@pytest.mark.parametrize("rule", [N.Threshold(3, 90, 100), N.Threshold(5, 80, 100), N.Threshold(1, 60, 100)])
def test_ngram_join_equals_brute_force(spark, rule):
    rows = texts() + [(1000 + i, t) for i, t in near_texts(rule.words)]
    got = N.jaccard_classes(frame(spark, rows), rule)
    assert rows_of(got, "doc_id", "n_shingles", "_component") == linked(rows, rule)


def test_ngram_join_with_tiny_groups(spark, monkeypatch):
    """Components cut into pairs of blocks give the same classes."""
    monkeypatch.setattr(N, "GROUP_SETS", 3)
    rows = [(i, t) for i, t in near_texts(9)] + [(500 + i, "a b c d e f g h i j k l m n o p " * 3 + str(i)) for i in range(30)]
    rule = N.Threshold(3, 80, 100)
    got = N.jaccard_classes(frame(spark, rows), rule)
    assert rows_of(got, "doc_id", "n_shingles", "_component") == linked(rows, rule)
    assert N.jaccard_classes(frame(spark, []), rule).count() == 0


def test_every_linked_pair_shares_a_key():
    rng = np.random.default_rng(4)
    rule = N.Threshold(3, 90, 100)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        drop = int(rng.integers(0, max(1, n // 8)))
        b = np.unique(np.r_[a[rng.permutation(len(a))[drop:]], rng.integers(0, 1 << 63, int(rng.integers(0, max(1, n // 12)))).astype(np.uint64)])
        if not len(b) or 100 * len(np.intersect1d(a, b)) < 90 * len(np.union1d(a, b)):
            continue
        both = np.union1d(a, b)
        common = np.sort(rng.choice(both, int(rng.integers(0, len(both) + 1)), replace=False))
        key, owner = N.block_keys(np.r_[a, b], np.array([len(a), len(b)]), rule, common)
        assert set(key[owner == 0].tolist()) & set(key[owner == 1].tolist())


def test_components_of_paths_hubs_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 150)] + [(200, 201), (201, 202), (202, 200)] + [(7, 7)]
    df = spark.createDataFrame(edges, linking.EDGES_DDL)
    got = {r["item"]: r["component"] for r in linking.components(df).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)} | {i: 200 for i in range(200, 203)}
    assert got == want
    assert linking.components(df.limit(0)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def chars(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


@pytest.mark.parametrize("edits", [1, 2, 3, 5])
def test_banded_distance(edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(1500):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(1, 15)))
        b = edited(rng, a + "ccccccc", rng.randint(0, edits + 2))[: rng.randint(1, 20)] if rng.random() < 0.3 else edited(rng, a + "c", 1)
        pairs.append((a, b))
    got = L.within([chars(a) for a, _ in pairs], [chars(b) for _, b in pairs], edits)
    assert got.tolist() == [distance(a, b) <= edits for a, b in pairs]


def line_rows(seed=3):
    rng = random.Random(seed)
    base = [words(rng, rng.randint(4, 12)) for _ in range(15)]
    rows = []
    for i in range(40):
        lines = [rng.choice(base) for _ in range(rng.randint(1, 5))] + [words(rng, 8)]
        lines = [edited(rng, x, rng.randint(0, 4)) if rng.random() < 0.5 else x for x in lines]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines + rng.choice([[], [""], ["ok"], ["", ""]]))))
    return rows


def kept_lines(rows, edits, least):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    kinds = sorted({x for _, t in rows for x in (t or "").split("\n") if len(x) >= least})
    parent = {x: x for x in kinds}
    for a in kinds:
        for b in kinds:
            if a < b and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                x, y = find(parent, a), find(parent, b)
                parent[x] = y
    seen, out = set(), []
    for i, t in rows:
        kept, lost = [], 0
        for x in (t or "").split("\n"):
            root = find(parent, x) if x in parent else None
            if root is not None and root in seen:
                lost += 1
                continue
            if root is not None:
                seen.add(root)
            kept.append(x)
        out.append((i, t if t is None else "\n".join(kept), lost))
    return sorted(out, key=repr)


@pytest.mark.parametrize("edits,group", [(2, 4096), (1, 4096), (2, 3)])
def test_line_dedup_equals_brute_force(spark, monkeypatch, edits, group):
    monkeypatch.setattr(L, "GROUP_LINES", group)
    rows = line_rows() + [(100, None), (101, ""), (102, "\n"), (103, "x" * 20_000), (104, "x" * 19_999 + "\ré")]
    got = L.dedup_lines(frame(spark, rows), edits, 20)
    assert rows_of(got, "doc_id", "text", "n_lines_removed") == kept_lines(rows, edits, 20)
    assert set(frame(spark, []).columns) <= set(got.columns)


def test_line_dedup_of_repeated_rows_and_of_nothing(spark):
    line = "a line that comes several times"
    rows = [(None, line), (5, f"{line}\n{line}\nother words of the same length"), (5, f"{line}\n{line}\nother words of the same length")]
    got = rows_of(L.dedup_lines(frame(spark, rows)), "doc_id", "text")
    assert got == sorted([(None, line), (5, "other words of the same length"), (5, "other words of the same length")], key=repr)
    assert L.dedup_lines(frame(spark, [])).count() == 0


def test_null_ids_are_no_component(spark):
    """A null id neither names a component nor ties strangers together."""
    rule = N.Threshold(3, 90, 100)
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (None, "q r s t u"), (None, ""), (None, "q r s t u v w x y z")]
    got = rows_of(N.jaccard_classes(frame(spark, rows), rule), "doc_id", "n_shingles", "_component")
    assert got == sorted([(None, 4, 7), (7, 4, 7), (None, 3, None), (None, 0, None), (None, 8, None)], key=repr)
