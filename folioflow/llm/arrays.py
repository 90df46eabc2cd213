"""Array helpers: hashes of bytes, words and shingles, runs of positions."""

from __future__ import annotations

from functools import lru_cache

import numpy as np


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit multiply and shift hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions starts[i], starts[i] + 1, ... of every run, one after the other."""
    total = int(counts.sum())
    return np.arange(total) + np.repeat(starts - run_starts(counts), counts)


#: An odd base, its inverse modulo 2**64, and one random 64-bit number for every byte value.
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(1)
def byte_codes() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@lru_cache(2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for a few sizes only."""
    size = 1 << max(12, int(n).bit_length())
    return _powers(_BASE, size), _powers(_INVERSE, size)


@lru_cache(1)
def _plane_codes() -> np.ndarray:
    return mixed(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def _char_codes(chars: np.ndarray) -> np.ndarray:
    """One random number per code point: looked up for the first plane, worked out beyond."""
    out = _plane_codes()[chars & 0xFFFF]
    beyond = np.flatnonzero(chars >> 16)
    if len(beyond):
        out[beyond] = mixed(chars[beyond].astype(np.uint64) + np.uint64(1))
    return out


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any substring follows: see `substring_hash`. Takes bytes or
    code points."""
    up, _ = powers(len(raw) + 1)
    codes = byte_codes()[raw] if raw.dtype == np.uint8 else _char_codes(raw)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(codes * up[: len(raw)], out=out[1:])
    return out


def code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 texts as code points, and the offsets of the texts among them."""
    chars = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    lead = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    return chars, lead[offsets]


def substring_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of raw[start:end]: equal bytes have equal hashes wherever they stand."""
    _, down = powers(len(prefix))
    return mixed((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


_BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


@lru_cache(1)
def _is_blank() -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(_BLANKS)] = True
    return out


@lru_cache(1)
def _lower() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word: bytes without blanks, never across texts."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    blank = _is_blank()[raw]
    before = np.r_[True, blank[:-1]]
    inner = offsets[:-1][offsets[:-1] < len(raw)]
    before[inner] = True
    after = np.r_[blank[1:], True]
    after[inner[inner > 0] - 1] = True
    start = np.flatnonzero(~blank & before)
    end = np.flatnonzero(~blank & after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, A-Z lower-cased."""
    start, end, text = word_spans(raw, offsets)
    return substring_hash(prefix_hash(_lower()[raw]), start, end), text


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of `size`-word shingles of every text as sorted hashes, flat, and the set sizes.

    A text of fewer words has one shingle, its whole sequence of words; one without words none.
    """
    words, text = word_hashes(raw, offsets)
    n_texts = len(offsets) - 1
    counts = np.bincount(text, minlength=n_texts)
    first = run_starts(counts)
    shingles = np.maximum(counts - size + 1, counts > 0).astype(np.int64)
    owner = np.repeat(np.arange(n_texts), shingles)
    at = spread(first, shingles)
    length = np.minimum(counts, size)[owner]
    hashed = length.astype(np.uint64)
    for i in range(size):
        inside = i < length
        word = words[np.minimum(at + i, max(len(words) - 1, 0))] if len(words) else words
        hashed = np.where(inside, mixed(hashed * np.uint64(0x9E3779B97F4A7C15) + word), hashed)
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    fresh = np.ones(len(hashed), bool)
    fresh[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    return hashed[fresh], np.bincount(owner[fresh], minlength=n_texts)


def classes_of(n: int, left: np.ndarray, right: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Smallest member of the class of each of 0..n-1 under the links left[i]-right[i]."""
    root = np.arange(n) if parent is None else parent.copy()
    while len(left):
        a, b = root[left], root[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        left, right, low, high = left[open_], right[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root
