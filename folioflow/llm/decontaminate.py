"""Benchmark decontamination: exact pieces of the items place windows, edit distance verifies them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioflow.llm.arrays import code_points, prefix_hash, spread, substring_hash
from folioflow.llm.common import ROW, public_id, released, slices, table, texts

#: A document holds an item if some stretch of it is within this share of the item's length in edits.
EDIT_SHARE = 0.1
#: Items that travel to the workers at once; more go in several passes.
ITEMS_PER_PASS = 20_000
#: Texts searched at once; few large slices keep the array calls long.
SLICE_BYTES = 4 << 20
#: Places hashed at once.
PLACES = 1 << 18


@lru_cache(1)
def _plain() -> np.ndarray:
    """ASCII letters in lower case and every ASCII blank as a space."""
    out = np.arange(128, dtype=np.uint32)
    out[65:91] += 32
    out[9:14] = 32
    return out


def plain(chars: np.ndarray) -> np.ndarray:
    small = chars < 128
    out = chars.copy()
    out[small] = _plain()[chars[small]]
    return out


def best_match(item: np.ndarray, stretch: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the item to any part of the stretch, and where that part ends.

    Myers' bit-parallel search with one wide integer; the first of several ends.
    """
    m = len(item)
    where: dict[int, int] = {}
    for i, c in enumerate(item.tolist()):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(stretch.tolist(), 1):
        eq = where.get(c, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = vn | ~(d0 | vp) & full
        hn = d0 & vp & full
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1 & full, hn << 1 & full
        vp = hn | ~(d0 | hp) & full
        vn = d0 & hp
        if score < best:
            best, end = score, j
    return best, end


def ends_within(where: dict[int, int], m: int, edits: int, stretch: list[int]) -> list[int]:
    """All ends in the stretch of parts within so many edits of a pattern of m characters.

    `where` has the pattern's places of every character as bits. The search of `best_match`.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    out = []
    for j, c in enumerate(stretch, 1):
        eq = where.get(c, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = vn | ~(d0 | vp) & full
        hn = d0 & vp & full
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1 & full, hn << 1 & full
        vp = hn | ~(d0 | hp) & full
        vn = d0 & hp
        if score <= edits:
            out.append(j)
    return out


class ItemIndex:
    """Some items cut into pieces, one more than the edits allowed, as leaves of a tree each.

    A node with n leaves below it is granted n - 1 edits. If a node stands in a text within its
    edits, then one of its two children does within its own (else the edits would be n at
    least), so from every occurrence of an item a chain of nodes that hold leads down to a piece
    that stands unchanged. The search takes the chain upwards and so loses none.
    """

    def __init__(self, items: list[tuple[int | None, str]], edit_share: float) -> None:
        if not 0 <= edit_share < 1:
            raise ValueError("the share of edits is at least 0 and less than 1")
        self.names = [i for i, _ in items]
        self.texts = [plain(np.frombuffer(t.encode("utf-32-le"), np.uint32)) for _, t in items]
        self.edits = [int(edit_share * len(t)) for t in self.texts]
        nodes: list[tuple[int, int, int, int, int]] = []
        leaves: dict[int, tuple[list[np.uint64], list[int]]] = {}
        for i, chars in enumerate(self.texts):
            if not len(chars):
                continue
            n = self.edits[i] + 1
            cuts = [p * len(chars) // n for p in range(n + 1)]
            prefix = prefix_hash(chars)
            todo = [(0, n, -1)]
            while todo:
                a, b, parent = todo.pop()
                me = len(nodes)
                nodes.append((i, cuts[a], cuts[b], b - a - 1, parent))
                if b - a > 1:
                    todo += [(a, (a + b) // 2, me), ((a + b) // 2, b, me)]
                    continue
                hashed = substring_hash(prefix, np.array([cuts[a]]), np.array([cuts[b]]))[0]
                of_length = leaves.setdefault(cuts[b] - cuts[a], ([], []))
                of_length[0].append(hashed)
                of_length[1].append(me)
        self.item, self.low, self.high, self.granted, self.parent = (
            np.array([n[c] for n in nodes], np.int64) for c in range(5)
        )
        self.pieces = []
        for length, (hashes, owners) in sorted(leaves.items()):
            order = np.argsort(np.array(hashes, np.uint64), kind="stable")
            held, first = np.unique(np.array(hashes, np.uint64)[order], return_index=True)
            maybe = np.zeros(1 << 20, bool)
            maybe[(held >> np.uint64(44)).astype(np.int64)] = True
            self.pieces.append((length, held, np.r_[first, len(order)], np.array(owners)[order], maybe))
        self._where: dict[int, dict[int, int]] = {}

    def _bits(self, node: int) -> dict[int, int]:
        if node not in self._where:
            where: dict[int, int] = {}
            for i, c in enumerate(self.texts[self.item[node]][self.low[node] : self.high[node]].tolist()):
                where[c] = where.get(c, 0) | 1 << i
            self._where[node] = where
        return self._where[node]

    def standing(self, chars: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every place where a piece stands unchanged within a text: leaf and end."""
        prefix = prefix_hash(chars)
        nodes, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length, held, first, owners, maybe in self.pieces:
            for a in range(0, len(chars) - length + 1, PLACES):
                start = np.arange(a, min(a + PLACES, len(chars) - length + 1))
                hashed = substring_hash(prefix, start, start + length)
                # Most places hold no piece; the upper 20 bits tell.
                hit = np.flatnonzero(maybe[(hashed >> np.uint64(44)).astype(np.int64)])
                at = np.minimum(np.searchsorted(held, hashed[hit]), len(held) - 1)
                same = held[at] == hashed[hit]
                end, at = start[hit[same]] + length, at[same]
                inside = edges[np.searchsorted(edges, end - 1, "right")] >= end
                inside &= edges[np.searchsorted(edges, end - 1, "right") - 1] <= end - length
                end, at = end[inside], at[inside]
                n = first[at + 1] - first[at]
                nodes.append(owners[spread(first[at], n)])
                ends.append(np.repeat(end, n))
        return np.concatenate(nodes), np.concatenate(ends)

    def stretches(self, node: np.ndarray, end: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Where the parents of nodes that end at these places can stand: parent, text, start and
        end, windows that meet as one. A root stands for itself."""
        up = np.where(self.parent[node] < 0, node, self.parent[node])
        k = self.granted[up]
        text = np.searchsorted(edges, end - 1, "right") - 1
        x = np.maximum(end - (self.high[node] - self.low[up]) - k, edges[text])
        y = np.minimum(end + (self.high[up] - self.high[node]) + k, edges[text + 1])
        order = np.lexsort((x, text, up))
        up, text, x, y = up[order], text[order], x[order], y[order]
        group = np.cumsum(np.r_[False, (up[1:] != up[:-1]) | (text[1:] != text[:-1])])
        # The furthest end so far in each group.
        far = np.maximum.accumulate(group * (edges[-1] + 1) + y) - group * (edges[-1] + 1)
        fresh = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (x[1:] > far[:-1])])
        last = np.r_[fresh[1:], len(x)] - 1
        return zip(up[fresh].tolist(), text[fresh].tolist(), x[fresh].tolist(), far[last].tolist())

    def search(self, chars: np.ndarray, edges: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Verified matches: (text number, item, distance, start and end within the text)."""
        chars, edges = plain(chars), np.asarray(edges, np.int64)
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        node, end = self.standing(chars, edges)
        while len(node):
            nodes: list[int] = []
            ends: list[int] = []
            for up, text, x, y in self.stretches(node, end, edges):
                if self.parent[up] >= 0:
                    size = int(self.high[up] - self.low[up])
                    held = ends_within(self._bits(up), size, int(self.granted[up]), chars[x:y].tolist())
                    nodes += [up] * len(held)
                    ends += [x + j for j in held]
                    continue
                i = int(self.item[up])
                distance, stop = best_match(self.texts[i], chars[x:y])
                if distance <= self.edits[i]:
                    _, length = best_match(self.texts[i][::-1], chars[x : x + stop][::-1])
                    base = int(edges[text])
                    match = (distance, x + stop - length - base, x + stop - base)
                    found[text, i] = min(found.get((text, i), match), match)
            node, end = np.array(nodes, np.int64), np.array(ends, np.int64)
        return [(t, i, *m) for (t, i), m in sorted(found.items())]


_MATCH_DDL = "_id long, _text_hash long, item_id long, distance int, start int, end int"


def find_leaks(docs: DataFrame, benchmark: DataFrame, edit_share: float = EDIT_SHARE) -> DataFrame:
    """One row per document and benchmark item that it holds, exactly or with edits.

    An item is cut into one piece more than the edits allowed, so one piece stands unchanged in
    every copy. Pieces are looked up at every place of a document; a window around a piece is
    verified by exact edit distance, for growing parts of the item first. Nothing is sampled, so
    no copy is lost. ASCII case and the kind of blank do not count. Returns _id, _text_hash, item_id, distance, start
    and end (characters of the best place in the document, the first of several).

    Documents stream through in one pass without a shuffle. Items go to the workers in blocks
    of ITEMS_PER_PASS, so what travels is bounded; each block is a pass over the documents.

    Defined cases: null and empty texts hold nothing; null and blank items are left out, a null
    item_id is reported as null; items that repeat are each reported; rows that repeat are
    answered one by one; an empty table on either side gives no rows.
    """
    rows = texts(docs).select(*ROW, "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where(F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) != "")
    n_blocks = max(1, -(-items.count() // ITEMS_PER_PASS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    out = None
    for number in range(n_blocks):
        held = [(r["item_id"], r["text"]) for r in items.where(block == number).collect()]
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(held, edit_share)
            for batch in batches:
                ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in ROW]
                for first, _, raw, offsets in slices(batch, limit=SLICE_BYTES):
                    chars, edges = code_points(raw, offsets)
                    found = index.search(chars, edges) if len(chars) else []
                    if not found:
                        continue
                    text, item, distance, start, end = zip(*found)
                    at = first + np.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[0][at], pa.int64()),
                            pa.array(ids[1][at], pa.int64()),
                            pa.array([index.names[i] for i in item], pa.int64()),
                            pa.array(distance, pa.int32()),
                            pa.array(start, pa.int32()),
                            pa.array(end, pa.int32()),
                        ],
                        names=[*ROW, "item_id", "distance", "start", "end"],
                    )

        part = rows.mapInArrow(released(run), _MATCH_DDL)
        out = part if out is None else out.unionByName(part)
    return out


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(public_id().alias("doc_id"), "item_id", "distance", "start", "end")
