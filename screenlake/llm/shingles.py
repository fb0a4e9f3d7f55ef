"""Hashes of word shingles for whole batches of texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
# Bytes of text hashed together: bounds memory, no result depends on it.
SEGMENT = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_FACTORS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        inverse = pow(int(_BASE), -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", np.uint64(inverse))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every byte range: a polynomial from running sums, spread together with the length."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, first + SEGMENT, "right")))
        piece = data[first:ends[stop - 1]]
        up, down = _powers(max(SEGMENT + 1, len(piece) + 1))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: len(piece)], dtype=np.uint64, out=sums[1:])
        a, b = starts[at:stop] - first, ends[at:stop] - first
        out[at:stop] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
        at = stop
    return mix(out)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and how many each text has. Words are split at white space
    (space, U+0009 to U+000D); null is an empty text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    _, raw, values = texts.buffers()
    bounds = np.frombuffer(raw, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8)[bounds[0]:bounds[-1]] if values is not None and len(texts) else np.empty(0, np.uint8)
    bounds = bounds - bounds[0] if len(texts) else np.zeros(1, np.int64)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    if not word.any():
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = word[0], False
    edge[1:-1] = word[1:] & ~word[:-1]
    closing = np.empty(len(data) + 1, bool)
    closing[0], closing[-1] = False, word[-1]
    closing[1:-1] = ~word[1:] & word[:-1]
    # A word that runs over the border of two texts is two words.
    border = bounds[1:-1]
    border = border[(border > 0) & (border < len(data))]
    border = border[word[border] & word[border - 1]]
    edge[border] = True
    closing[border] = True
    starts, ends = np.flatnonzero(edge), np.flatnonzero(closing)
    counts = np.diff(np.searchsorted(starts, bounds, "left"))
    return _hash_words(data, starts, ends), counts


def shingle_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles in order, and how many each text has.

    A text of WORDS words or more has one shingle per run of WORDS words, repeats included; a
    shorter one has a single shingle of all its words, and none if it has no word.
    """
    words, counts = word_hashes(texts)
    n = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    first = np.cumsum(counts) - counts
    where = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    inside = np.repeat(first + counts, n)
    out = np.zeros(len(where), np.uint64)
    for k in range(WORDS):
        here = padded[where + k] * _FACTORS[k]
        short = where + k >= inside
        if short.any():
            here[short] = np.uint64(k + 1)
        out += here
    return mix(out), n


def batches(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes together; a longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)
