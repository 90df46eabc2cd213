"""SentencePiece encoding and decoding with seeded merge-dropout."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from folioflow.llm.arrays import mixed, run_starts, spread
from folioflow.llm.common import free_name, released, short_batches, slices, table

MODEL = "piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 2024
#: Numbers that keys are made of where no place in a text draws them.
VARIANTS = 8
#: Longer units go through a heap one by one, shorter ones in lockstep.
LOCKSTEP_CHARS = 48
SLICE_BYTES = 1 << 20
#: Piece ids decoded at once, and words and segmentations that a worker keeps.
SLICE_IDS = 1 << 19
CACHE_WORDS = 200_000
CACHE_STATES = 400_000
#: Units up to this length have their segmentations stored; their merges fit as bits beside the
#: number of a segmentation.
STORED_CHARS = 32
_MERGE_BITS = STORED_CHARS - 1

_SPACE = "▁"
_NEVER = np.int64(np.iinfo(np.int64).max)
_PLACE_BITS = 21
#: No piece holds a space after another character or a line end beside one, so no merge reaches
#: over the borders of these units.
_UNIT = regex.compile(r" *[^ \n]+| +|\n+")


class Pieces:
    """The vocabulary of a model: characters, merges with their ranks, bytes of every piece."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        usual = [
            i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        ids = {names[i]: i for i in usual}
        self.size = n
        self.byte_id = np.full(256, -1, np.int64)
        content: list[bytes] = []
        for i, name in enumerate(names):
            if model.is_byte(i):
                value = int(name[1:-1], 16)
                self.byte_id[value] = i
                content.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                content.append(b"")
            else:
                content.append(name.replace(_SPACE, " ").encode())
        if (self.byte_id < 0).any():
            raise ValueError(f"{path} has no byte pieces, so it cannot be lossless")
        self.lengths = np.array([len(c) for c in content])
        self.starts = run_starts(self.lengths)
        self.content = np.frombuffer(b"".join(content), np.uint8)
        self.char_id = np.full(0x110000, -1, np.int32)
        for name, i in ids.items():
            if len(name) == 1:
                self.char_id[ord(name)] = i
        # A space in a text is the space piece; the mark itself goes by its bytes.
        self.char_id[ord(" ")] = self.char_id[ord(_SPACE)]
        self.char_id[ord(_SPACE)] = -1
        order = sorted(usual, key=lambda i: -model.get_score(i))
        rank = {i: r for r, i in enumerate(order)}
        pairs = {}
        for name, i in ids.items():
            for cut in range(1, len(name)):
                left, right = ids.get(name[:cut]), ids.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * n + right] = (rank[i], i)
        keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in keys.tolist()], np.int64)
        self.pair_id = np.array([pairs[k][1] for k in keys.tolist()], np.int64)
        self._slots = self._hashed(keys)
        self.pairs = pairs

    def _hashed(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """An open-addressed table of the pairs, probed as often as its longest chain."""
        bits = int(4 * max(1, len(keys))).bit_length()
        held = np.full(1 << bits, -1, np.int64)
        value = np.zeros(1 << bits, np.int64)
        left, probes = np.arange(len(keys)), 0
        home = (mixed(keys.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
        while len(left):
            slot = (home[left] + probes) & ((1 << bits) - 1)
            free = held[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            taken = left[free][first]
            at = slot[free][first]
            held[at], value[at] = keys[taken], taken
            left = np.setdiff1d(left, taken, assume_unique=True)
            probes += 1
        self.bits, self.probes = bits, probes
        return held, value, bits

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of the merge of each pair of pieces, -1 if there is none."""
        held, value, bits = self._slots
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, -2)
        home = (mixed(key.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
        found = np.full(len(key), -1, np.int64)
        open_ = np.arange(len(key))
        for probe in range(self.probes):
            slot = (home[open_] + probe) & ((1 << bits) - 1)
            hit = held[slot] == key[open_]
            found[open_[hit]] = value[slot[hit]]
            open_ = open_[~hit & (held[slot] >= 0)]
            if not len(open_):
                break
        return found


class MergeDropout:
    """Byte-pair segmentation whose candidate merges are skipped by a keyed hash.

    A candidate is a pair of adjacent symbols, known by its start, middle and end in its unit.
    The agenda takes candidates by rank, then from the left; a candidate whose keyed hash falls
    below the dropout rate is passed over for good. With a rate of 0 the result is the model's
    own; with a rate of 1 it is single characters. Characters without a piece become the pieces
    of their bytes, so every text comes back unchanged.
    """

    def __init__(
        self, pieces: Pieces, dropout: float = DROPOUT, seed: int = SEED, variants: int = VARIANTS
    ) -> None:
        if not 0 <= dropout <= 1:
            raise ValueError("the dropout rate is between 0 and 1")
        self.pieces = pieces
        self.variants = variants if 0 < dropout < 1 else 1
        self._forget()
        # Hashes below the limit are skipped; they are compared by their upper 53 bits.
        self.limit = np.uint64(int(dropout * (1 << 53)))
        self.seed = np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)

    def keys_of(self, variant: np.ndarray) -> np.ndarray:
        return mixed(variant.astype(np.uint64) + np.uint64(1) + self.seed)

    def skipped(self, key, start, middle, end) -> np.ndarray:
        place = (start.astype(np.uint64) << np.uint64(42)) ^ (middle.astype(np.uint64) << np.uint64(21))
        hashed = mixed(mixed(key ^ (place ^ end.astype(np.uint64))))
        return (hashed >> np.uint64(11)) < self.limit

    def segment(self, units: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of every unit, flat, and their counts; a negative symbol is a bare character."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        long = np.flatnonzero(sizes > LOCKSTEP_CHARS)
        short = np.flatnonzero(sizes <= LOCKSTEP_CHARS)
        few = keys[short]
        skip = (lambda owner, *place: self.skipped(few[owner], *place)) if self.limit else None
        parts = [self._lockstep([units[i] for i in short], sizes[short], skip, short)]
        for i in long.tolist():
            symbols = self._agenda(units[i], keys[i])
            parts.append((np.full(len(symbols), i), symbols))
        owner = np.concatenate([p[0] for p in parts])
        symbol = np.concatenate([p[1] for p in parts])
        order = np.argsort(owner, kind="stable")
        return symbol[order], np.bincount(owner, minlength=len(units))

    def _end(self, sizes, owner, start, i) -> np.ndarray:
        """Where symbols `i + 1` end in their units."""
        beyond = np.minimum(i + 2, len(owner) - 1)
        follows = (i + 2 < len(owner)) & (owner[beyond] == owner[i])
        return np.where(follows, start[beyond], sizes[owner[i]])

    def _candidates(self, units: tuple, symbol, owner, start, at) -> np.ndarray:
        """Rank and place of the merge of symbols `at` and `at + 1`; _NEVER if none or skipped."""
        sizes, skip = units
        merge = self.pieces.merge_of(symbol[at], symbol[at + 1])
        out = np.full(len(at), _NEVER)
        some = np.flatnonzero(merge >= 0)
        if len(some) and skip is not None:
            i = at[some]
            some = some[~skip(owner[i], start[i], start[i + 1], self._end(sizes, owner, start, i))]
        out[some] = (self.pieces.pair_rank[merge[some]] << _PLACE_BITS) | start[at[some]]
        return out

    def _lockstep(self, units, sizes, skip, names, taken: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All agendas at once: in every round each unit takes its best candidate. `taken` gets
        the merges of every round: their units and packed places."""
        char = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int32)
        symbol = self.pieces.char_id[char]
        symbol = np.where(symbol < 0, -1 - char, symbol).astype(np.int32)
        owner = np.repeat(np.arange(len(units), dtype=np.int32), sizes)
        start = (np.arange(len(char)) - np.repeat(run_starts(sizes), sizes)).astype(np.int32)
        done_owner, done_symbol = [], []
        best = np.full(len(symbol), _NEVER)
        pairs = np.flatnonzero(owner[1:] == owner[:-1])
        best[pairs] = self._candidates((sizes, skip), symbol, owner, start, pairs)
        while len(symbol):
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            counts = np.diff(np.r_[heads, len(owner)])
            least = np.minimum.reduceat(best, heads)
            live = least != _NEVER
            if not live.all():
                stays = np.repeat(live, counts)
                done_owner.append(owner[~stays])
                done_symbol.append(symbol[~stays])
                symbol, owner, start, best = symbol[stays], owner[stays], start[stays], best[stays]
                least, counts = least[live], counts[live]
                if not len(symbol):
                    break
            at = np.flatnonzero(best == np.repeat(least, counts))
            if taken is not None:
                taken.append((owner[at], start[at] << 12 | start[at + 1] << 6 | self._end(sizes, owner, start, at)))
            merge = self.pieces.merge_of(symbol[at], symbol[at + 1])
            symbol[at] = self.pieces.pair_id[merge]
            stays = np.ones(len(symbol), bool)
            stays[at + 1] = False
            at = at - np.arange(len(at))  # one symbol left before each earlier merge
            symbol, owner, start, best = symbol[stays], owner[stays], start[stays], best[stays]
            best[at] = _NEVER
            right = at[(at + 1 < len(owner))]
            right = right[owner[right] == owner[right + 1]]
            left = at[at > 0] - 1
            left = left[owner[left] == owner[left + 1]]
            changed = np.concatenate([left, right])
            best[changed] = self._candidates((sizes, skip), symbol, owner, start, changed)
        if not done_owner:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return names[np.concatenate(done_owner)], np.concatenate(done_symbol).astype(np.int64)

    def _agenda(self, unit: str, key: np.uint64) -> np.ndarray:
        """One unit of any length with a heap of candidates over a linked list of symbols."""
        char = np.frombuffer(unit.encode("utf-32-le"), np.uint32).astype(np.int64)
        ids = self.pieces.char_id[char]
        symbol = np.where(ids < 0, -1 - char, ids).tolist()
        n = len(symbol)
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        alive = [True] * n
        pairs, size = self.pieces.pairs, self.pieces.size
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left < 0 or right >= n or symbol[left] < 0 or symbol[right] < 0:
                return
            merge = pairs.get(symbol[left] * size + symbol[right])
            if merge:
                heapq.heappush(agenda, (merge[0], left, right, end[right], merge[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, stop, merged = heapq.heappop(agenda)
            if not alive[left] or not alive[right] or end[left] != right or end[right] != stop:
                continue
            if self.limit:
                place = [np.array([v]) for v in (left, right, stop)]
                if self.skipped(np.array([key], np.uint64), *place)[0]:
                    continue
            symbol[left], end[left], alive[right] = merged, stop, False
            if stop < n:
                before[stop] = left
            offer(before[left], left)
            offer(left, stop)
        return np.array([s for s, a in zip(symbol, alive) if a], np.int64)

    def _with_bytes(self, symbol: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace bare characters by the pieces of their UTF-8 bytes."""
        bare = symbol < 0
        if not bare.any():
            return symbol, counts
        kinds, which = np.unique(symbol[bare], return_inverse=True)
        encoded = [chr(-1 - int(k)).encode() for k in kinds]
        size = np.ones(len(symbol), np.int64)
        lengths = np.array([len(e) for e in encoded])
        size[bare] = lengths[which]
        out = np.repeat(symbol, size)
        flat = self.pieces.byte_id[np.frombuffer(b"".join(encoded), np.uint8)]
        places = spread(run_starts(size)[bare], size[bare])
        out[places] = flat[spread(run_starts(lengths)[which], size[bare])]
        owner = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(owner, weights=size, minlength=len(counts)).astype(np.int64)

    def _forget(self, keep: int = 0) -> None:
        """Start the store of segmented words anew, with the words that came most often."""
        kept: list[str] = []
        if keep and len(self.number) > keep:
            names = list(self.number)
            kept = [names[i] for i in np.argpartition(-self.uses[: len(names)], keep)[:keep].tolist()]
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        for name in kept:
            self.number[name]
        self.uses = np.zeros(1 << 12, np.int32)
        self.root = np.full(1 << 12, -1, np.int32)
        # A state is a word with the merges that its agenda skips: those of the state before it
        # and some that were taken there. Kept are the ids, and the merges taken.
        self.n_states = 0
        self.states = {k: np.zeros(1 << 12, np.int32) for k in ("at", "count", "merges_at", "n_merges", "before")}
        self.skips = np.zeros(1 << 12, np.int64)
        self.after: dict[int, int] = {}
        self.store, self.used = np.zeros(1 << 16, np.int32), 0
        self.merges, self.n_taken = np.zeros(1 << 16, np.int32), 0

    @staticmethod
    def _grown(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        return np.r_[array, np.zeros(size - len(array) + len(array) // 4, array.dtype)]

    def _add(self, symbol, counts, before=None, skips=None, taken=()) -> np.ndarray:
        """Store the symbols of units as new states and return their numbers."""
        ids, counts = self._with_bytes(symbol, counts)
        n = len(counts)
        new = np.arange(self.n_states, self.n_states + n)
        self.n_states += n
        for k, column in self.states.items():
            self.states[k] = self._grown(column, self.n_states)
        self.skips = self._grown(self.skips, self.n_states)
        self.store = self._grown(self.store, self.used + len(ids))
        self.store[self.used : self.used + len(ids)] = ids
        self.states["at"][new] = self.used + run_starts(counts)
        self.states["count"][new] = counts
        self.used += len(ids)
        owner = np.concatenate([np.zeros(0, np.int64), *[t[0] for t in taken]])
        place = np.concatenate([np.zeros(0, np.int64), *[t[1] for t in taken]])
        n_merges = np.bincount(owner, minlength=n)
        self.merges = self._grown(self.merges, self.n_taken + len(place))
        self.merges[self.n_taken : self.n_taken + len(place)] = place[np.argsort(owner, kind="stable")]
        self.states["merges_at"][new] = self.n_taken + run_starts(n_merges)
        self.states["n_merges"][new] = n_merges
        self.n_taken += len(place)
        self.states["before"][new] = -1 if before is None else before
        self.skips[new] = 0 if skips is None else skips
        return new

    def _learn(self, names: list[str], before: np.ndarray | None = None, skips: np.ndarray | None = None) -> np.ndarray:
        """New states: these words, skipping what the states before skip and the merges in
        `skips` (bits) that were taken there."""
        n = len(names)
        forced = [np.zeros(0, np.int64)]
        if before is not None:
            unit, state, bits = np.arange(n), before.astype(np.int64), skips
            while len(unit):
                size = self.states["n_merges"][state].astype(np.int64)
                which = np.repeat(np.arange(len(unit)), size)
                bit = spread(np.zeros(len(unit), np.int64), size)
                on = (bits[which] >> bit) & 1 == 1
                place = self.merges[spread(self.states["merges_at"][state].astype(np.int64), size)[on]]
                forced.append(unit[which[on]] << 18 | place)
                bits, state = self.skips[state], self.states["before"][state].astype(np.int64)
                unit, bits, state = unit[state >= 0], bits[state >= 0], state[state >= 0]
        held = np.sort(np.concatenate(forced))

        def skip(owner, start, middle, end):
            code = owner.astype(np.int64) << 18 | (start << 12 | middle << 6 | end)
            return held[np.minimum(np.searchsorted(held, code), len(held) - 1)] == code

        taken: list[tuple[np.ndarray, np.ndarray]] = []
        sizes = np.fromiter(map(len, names), np.int64, n)
        owner, symbol = self._lockstep(names, sizes, skip if len(held) else None, np.arange(n), taken)
        order = np.argsort(owner, kind="stable")
        return self._add(symbol[order], np.bincount(owner, minlength=n), before, skips, taken)

    def _skipped_merges(self, state: np.ndarray, key: np.ndarray) -> np.ndarray:
        """For every state the merges taken there that the key skips, as bits."""
        size = self.states["n_merges"][state].astype(np.int64)
        first = run_starts(size)
        place = self.merges[spread(self.states["merges_at"][state].astype(np.int64), size)]
        hit = np.flatnonzero(self.skipped(np.repeat(key, size), place >> 12, place >> 6 & 63, place & 63))
        out = np.zeros(len(state), np.int64)
        if len(hit):
            owner = np.searchsorted(first + size, hit, "right")
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            out[owner[heads]] = np.add.reduceat(np.int64(1) << (hit - first[owner]), heads)
        return out

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every text, flat, and their counts. A merge is skipped by a hash of the seed,
        the text's key, the place of the word in the text and the merge's span in the word.

        An agenda that skips some of these merges is that of the word, if it takes none of the
        others; so stored segmentations serve where the skipped merges are the same. What the
        store holds changes the work, never the result."""
        if len(self.number) > CACHE_WORDS or self.n_states > CACHE_STATES or self.used > 8 * CACHE_STATES:
            self._forget(CACHE_WORDS // 4)
        units = [_UNIT.findall(" " + text) if text else [] for text in texts]
        per_text = np.fromiter(map(len, units), np.int64, len(texts))
        total = int(per_text.sum())
        if not total:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        flat = list(chain.from_iterable(units))
        del units
        place = spread(np.zeros(len(texts), np.int64), per_text).astype(np.uint64)
        key = mixed(np.repeat(keys.astype(np.uint64), per_text) ^ mixed(place + self.seed))
        short = np.fromiter(map(len, flat), np.int64, total) <= STORED_CHARS
        state = np.full(total, -1, np.int64)
        if not short.all():
            long = np.flatnonzero(~short)
            state[long] = self._add(*self.segment([flat[i] for i in long.tolist()], key[long]))
        at = np.flatnonzero(short)
        unit = np.fromiter(map(self.number.__getitem__, flat if len(at) == total else [flat[i] for i in at.tolist()]), np.int64, len(at))
        self.uses = self._grown(self.uses, len(self.number))
        if len(self.root) < len(self.uses):
            self.root = np.r_[self.root, np.full(len(self.uses) - len(self.root), -1, np.int32)]
        self.uses += np.bincount(unit, minlength=len(self.uses)).astype(np.int32)
        new, first = np.unique(unit[self.root[unit] < 0], return_index=True)
        if len(new):
            first = at[np.flatnonzero(self.root[unit] < 0)[first]]
            self.root[new] = self._learn([flat[i] for i in first.tolist()])
        state[at] = self.root[unit]
        while len(at) and self.limit:
            skips = self._skipped_merges(state[at], key[at])
            at, skips = at[skips != 0], skips[skips != 0]
            if not len(at):
                break
            code, first, which = np.unique(state[at] << _MERGE_BITS | skips, return_index=True, return_inverse=True)
            known = np.array([self.after.get(c, -1) for c in code.tolist()], np.int64)
            new = np.flatnonzero(known < 0)
            if len(new):
                those = first[new]
                known[new] = self._learn([flat[i] for i in at[those].tolist()], state[at[those]], skips[those])
                self.after.update(zip(code[new].tolist(), known[new].tolist()))
            state[at] = known[which]
        sizes = self.states["count"][state].astype(np.int64)
        ids = self.store[spread(self.states["at"][state].astype(np.int64), sizes)]
        ends = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(per_text)]]
        return ids, np.diff(ends)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of every text, flat, and their counts; the leading space is taken off."""
        sizes = self.pieces.lengths[ids]
        content = self.pieces.content[spread(self.pieces.starts[ids], sizes)]
        ends = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)]]
        length = np.diff(ends)
        keep = np.ones(len(content), bool)
        keep[ends[:-1][length > 0]] = False
        return content[keep], np.maximum(length - 1, 0)


_loaded: dict[str, Pieces] = {}


def load_pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_pieces(
    docs: DataFrame,
    path: str,
    dropout: float = DROPOUT,
    seed: int = SEED,
    variants: int = VARIANTS,
    to: str = "piece_ids",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add the piece ids of `text` (array<int>) as column `to` (replaced if it is there) to the
    columns of `docs`, or to those in `keep`.

    A merge is skipped by a hash of the seed, the doc_id, the word's place in the text and the
    merge's span, so every word of every document draws for itself. Neither neighbours nor
    partitions nor attempts matter, and rows that repeat get the same ids. A null or
    empty text has no ids; a null doc_id counts as 0. One pass, no shuffle; a worker holds one
    slice of texts, and a text of any length is a slice of its own.
    """
    kept = [c for c in (keep or docs.columns) if c != to]
    text, key = free_name("_text", docs.columns), free_name("_key", docs.columns)
    rows = docs.select(
        *kept,
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias(text),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias(key),
    )
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = MergeDropout(load_pieces(path), dropout, seed, variants)
        for batch in batches:
            for first, last, raw, _ in slices(batch, text, SLICE_BYTES):
                part = batch.slice(first, last - first)
                ids, counts = encoder.encode(
                    part.column(text).to_pylist(),
                    part.column(key).to_numpy(zero_copy_only=False).astype(np.uint64),
                )
                offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], lists], names=[*batch.schema.names[:n], to]
                )

    ids_type = T.ArrayType(T.IntegerType())
    schema = T.StructType([*docs.select(*kept).schema, T.StructField(to, ids_type)])
    short_batches(docs.sparkSession)
    return rows.mapInArrow(released(run), schema)


def decode_pieces(encoded: DataFrame, path: str, ids: str = "piece_ids", to: str = "decoded") -> DataFrame:
    """Add the text of the piece ids as column `to` (replaced if it is there). Null ids are none."""
    kept = [c for c in encoded.columns if c != to]
    n = len(kept)
    held = free_name("_ids", encoded.columns)
    rows = encoded.select(*kept, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = MergeDropout(load_pieces(path), 0.0)
        for batch in batches:
            counts = batch.column(held).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(counts)
            first = 0
            while first < len(counts):
                # As many texts as have SLICE_IDS ids, one at least.
                limit = ends[first] - counts[first] + SLICE_IDS
                last = max(first + 1, int(np.searchsorted(ends, limit, "right")))
                part = batch.slice(first, last - first)
                content, sizes = decoder.decode(
                    part.column(held).flatten().to_numpy(zero_copy_only=False), counts[first:last]
                )
                offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                text = pa.StringArray.from_buffers(
                    len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(content))
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], text], names=[*batch.schema.names[:n], to]
                )
                first = last

    schema = T.StructType([*encoded.select(*kept).schema, T.StructField(to, T.StringType())])
    short_batches(encoded.sparkSession)
    return rows.mapInArrow(released(run), schema)


def op3_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole document with merge-dropout, decode it again, compare with its text."""
    path = model_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode_pieces(encode_pieces(docs, path), path)
    text = F.coalesce(F.col("text"), F.lit(""))
    return both.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.xxhash64("piece_ids").alias("ids_hash"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        (F.col("decoded") == text).alias("lossless"),
    )
