"""Word shingles and MinHash values of many texts at a time, on byte arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

SHINGLE = 5  # words of a shingle
THRESHOLD = (4, 5)  # near duplicates share at least 4/5 of their shingles
FEW = 15  # sets that a shingle is in, up to which their pairs are counted one by one
CHUNK = 1 << 20  # bytes that are hashed together; a longer text is hashed on its own
_RATIO = 0x9E3779B97F4A7C15
_BASE, _INVERSE = 0x100000001B3, pow(0x100000001B3, -1, 1 << 64)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    code = np.arange(256)
    word = (code >= 128) | ((code >= 48) & (code < 58)) | ((code >= 65) & (code < 91)) | ((code >= 97) & (code < 123))
    lower = np.where((code >= 65) & (code < 91), code + 32, code)
    return word, (lower + 1).astype(np.uint64)


WORD, LOWERED = _tables()
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64, at least ``n`` of them; kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK + (1 << 16)), base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``CHUNK`` bytes (or characters)."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def word_edges(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word of a text, and the byte after its last."""
    inside = WORD[np.frombuffer(text, dtype=np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the number of its text. A word is a run of ASCII letters or digits and
    of bytes beyond ASCII; A-Z count as a-z."""
    data = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    inside = WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(LOWERED[data] * powers(_BASE, len(data))[: len(data)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * powers(_INVERSE, len(data))[starts])
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(bounds, starts, side="right")


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The different shingle hashes of each text, sorted.

    A text of fewer than ``SHINGLE`` words, but not none, is one shingle.
    """
    out: list[np.ndarray] = []
    for a, b in chunks(texts):
        hashes, owner = word_hashes(texts[a:b])
        first = np.searchsorted(owner, np.arange(b - a + 1)).tolist()
        out += shingles_of(hashes, list(zip(first, first[1:])))
    return out


def shingles_of(hashes: np.ndarray, runs: list[tuple[int, int]]) -> list[np.ndarray]:
    """The same for runs of hashed words, each given by its first word and the one after its last."""
    total = np.zeros(max(0, len(hashes) - SHINGLE + 1), dtype=np.uint64)
    for k in range(SHINGLE):
        total += hashes[k : k + len(total)] * np.uint64((_RATIO * (2 * k + 1) | 1) & (2**64 - 1))
    total = mixed(total)
    out = []
    for lo, hi in runs:
        if hi - lo >= SHINGLE:
            own = np.sort(total[lo : hi - SHINGLE + 1])
            new = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            out.append(own[new])
        elif hi > lo:
            weights = np.array([(_RATIO * (2 * k + 2) + 1) & (2**64 - 1) | 1 for k in range(hi - lo)], dtype=np.uint64)
            out.append(mixed((hashes[lo:hi] * weights).sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


class MinHash:
    """``n`` MinHash values: the least of ``a * x + b`` modulo 2^32 over the shingles x."""

    def __init__(self, n: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        best = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(x), 4096):
            np.minimum(best, (self.a * x[at : at + 4096] + self.b).min(axis=1), out=best)
        return best

    def many(self, sets: list[np.ndarray]) -> np.ndarray:
        """The values of each set, one row each; small sets are hashed together."""
        out = np.full((len(sets), len(self.a)), 0xFFFFFFFF, dtype=np.uint32)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        for k in np.flatnonzero(sizes > 4096).tolist():
            out[k] = self(sets[k])
        small = np.flatnonzero((sizes > 0) & (sizes <= 4096))
        ends = np.cumsum(sizes[small])
        first = 0
        while first < len(small):
            before = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + 4096, side="right")))
            own = small[first:last]
            x = (np.concatenate([sets[k] for k in own.tolist()]) >> np.uint64(32)).astype(np.uint32)
            out[own] = np.minimum.reduceat(self.a * x + self.b, ends[first:last] - sizes[own] - before, axis=1).T
            first = last
        return out


def set_id(shingles: np.ndarray) -> bytes:
    """16 bytes that stand for a set of shingles: texts with equal sets are of one class."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def similar_pairs(sets: list[np.ndarray], split: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sets reach the threshold with which others, and how similar they are: square tables.

    With ``split`` only pairs of one set before it and one from it on; others are left at zero. Shared shingles are
    counted exactly: those of many sets by products of 0/1 tables over runs of them, in large groups those of few by their pairs.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(n), sizes)
    values, where = np.unique(np.concatenate(sets) if n else np.empty(0, np.uint64), return_inverse=True)
    counts = np.bincount(where, minlength=len(values))
    few = FEW if n > 4 * FEW else 1
    order = np.argsort(where, kind="stable")
    owner, where = owner[order], where[order]
    times = counts[where]
    left, right = (slice(0, n), slice(0, n)) if split is None else (slice(0, split), slice(split, n))
    shape = len(range(n)[left]), len(range(n)[right])
    shared = np.zeros(shape, dtype=np.float64)
    width = 4096
    many = times > few
    own, column = owner[many], (np.cumsum(counts > few) - 1)[where[many]]
    total = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, total, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        table = np.zeros((n, min(width, total - at)), dtype=np.float32)
        table[own[lo:hi], column[lo:hi] - at] = 1
        shared += table[left] @ table[right].T
    for k in range(2, few + 1):
        # The sets of a shingle stand one after another, in their order.
        own = owner[times == k].reshape(-1, k)
        first, second = (own[:, i].ravel() for i in np.triu_indices(k, 1))
        if split is not None:
            across = (first < split) & (second >= split)
            first, second = first[across], second[across] - split
        pairs = np.bincount(first * shape[1] + second, minlength=shape[0] * shape[1]).reshape(shape)
        shared += pairs if split is not None else pairs + pairs.T
    part, whole = THRESHOLD
    union = sizes[left, None] + sizes[None, right] - shared
    linked = (whole * shared >= part * union) & (union > 0)
    similarity = shared / np.maximum(union, 1)
    if split is None:
        np.fill_diagonal(linked, False)
        return linked, similarity
    square = np.zeros((n, n), dtype=bool), np.zeros((n, n))
    for all_pairs, cross in zip(square, (linked, similarity)):
        all_pairs[left, right], all_pairs[right, left] = cross, cross.T
    return square


def component_labels(linked: np.ndarray) -> np.ndarray:
    """The least index reached from each row of a table of links."""
    labels = np.arange(len(linked))
    while True:
        near = np.where(linked, labels[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(labels, near)
        new = new[new]
        if np.array_equal(new, labels):
            return labels
        labels = new
