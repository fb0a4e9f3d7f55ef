"""Periodic runs of words, by internal pattern matching.

A run of period q repeats each of its blocks q words later. Blocks of dyadic length at dyadic places are
looked up in the window that follows them: the suffix array holds the occurrences of a block next to each
other, and a wavelet tree over it gives the first one after the block (range successor). Occurrences in a
window no longer than the block differ by one number, so the first difference is the candidate period;
the run around it is what the text repeats to the left and right at that distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import text_of

# Least words of a run, and least repeats of its period. The blocks below are chosen for these.
LENGTH, REPEATS = 24, 3
# Words indexed together; a longer text is indexed alone.
TOGETHER = 200_000
SCHEMA = "doc_id LONG, runs ARRAY<STRUCT<start: LONG, length: LONG, period: LONG>>, collapsed STRING"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Suffixes:
    """Suffix array of codes, with the ranks of all stretches of 2^k codes.

    `ranks[k][i]` is the number of suffixes below all that begin like suffix i for 2^k codes: stretches are
    equal where these are, and those that begin alike are the entries of the array from there on. Every text
    ends with a code of its own, so that no stretch over an end is met again.
    """

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        counts = np.bincount(codes)
        first = np.cumsum(counts) - counts
        self.order = np.argsort(codes, kind="stable").astype(np.int32)
        self.ranks = [first[codes].astype(np.int32)]
        # Only entries whose stretch occurs again have to be sorted further.
        open_ = np.flatnonzero(counts[codes[self.order]] > 1)
        while len(open_):
            rank, step = self.ranks[-1], 1 << (len(self.ranks) - 1)
            at = self.order[open_]
            key = rank[at].astype(np.int64) * n + rank[at + step]
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            self.order[open_] = at
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.append(starts, len(key)))
            finer = rank.copy()
            finer[at] = np.repeat(open_[starts], sizes)
            self.ranks.append(finer)
            open_ = open_[np.repeat(sizes > 1, sizes)]

    def range_of(self, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 of the entries that begin like the suffixes `at` for 2^k codes."""
        counts = np.bincount(self.ranks[k], minlength=len(self.order))
        low = self.ranks[k][at]
        return low.astype(np.int64), low + counts[low]

    def narrowed(self, low: np.ndarray, high: np.ndarray, at: np.ndarray, skip: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the entries low..high, equal for `skip` codes, those also equal to the suffixes `at` for 2^k codes more.

        They are sorted by what follows: two binary searches, for all ranges at once.
        """
        rank = self.ranks[k]
        wanted = rank[at + skip]
        ends = []
        for inclusive in (False, True):
            a, b = low.copy(), high.copy()
            while (searching := a < b).any():
                middle = (a + b) // 2
                value = rank[self.order[np.where(searching, middle, low)] + skip]
                right = searching & ((value < wanted) | (inclusive & (value == wanted)))
                a, b = np.where(right, middle + 1, a), np.where(searching & ~right, middle, b)
            ends.append(a)
        return ends[0], ends[1]

    def equal_ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal codes from i and j on."""
        done = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            same = self.ranks[k][i + done] == self.ranks[k][j + done]
            done += same.astype(np.int64) << k
        return done

    def equal_behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal codes before i and j."""
        done = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            a, b = i - done - (1 << k), j - done - (1 << k)
            fits = (a >= 0) & (b >= 0)
            same = fits & (self.ranks[k][np.where(fits, a, 0)] == self.ranks[k][np.where(fits, b, 0)])
            done += same.astype(np.int64) << k
        return done


class WaveletTree:
    """Wavelet tree of a permutation, level by level: per bit the zeros before each place of that level."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros = []
        for b in reversed(range(self.bits)):
            zero = (values >> b) & 1 == 0
            self.zeros.append(np.concatenate(([0], np.cumsum(zero))).astype(np.int32))
            values = np.concatenate((values[zero], values[~zero]))

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest value of at least `least` among the entries low..high, -1 where there is none."""
        a, b, below = low.astype(np.int64), high.astype(np.int64), np.zeros(len(low), np.int64)
        for level, zeros in zip(reversed(range(self.bits)), self.zeros):
            za, zb, ones = zeros[a], zeros[b], (least >> level) & 1 == 1
            below += np.where(ones, zb - za, 0)
            a, b = np.where(ones, zeros[-1] + a - za, za), np.where(ones, zeros[-1] + b - zb, zb)
        none = (below >= high - low) | (least >> self.bits > 0)
        a, b, rest, value = low.astype(np.int64), high.astype(np.int64), np.where(none, 0, below), np.zeros(len(low), np.int64)
        for level, zeros in zip(reversed(range(self.bits)), self.zeros):
            za, zb = zeros[a], zeros[b]
            ones = rest >= zb - za
            rest -= np.where(ones, zb - za, 0)
            value += ones.astype(np.int64) << level
            a, b = np.where(ones, zeros[-1] + a - za, za), np.where(ones, zeros[-1] + b - zb, zb)
        return np.where(none, -1, value)


def blocks(longest: int) -> Iterator[tuple[int, int, int, int]]:
    """(shortest, longest period, step, exponent): blocks that find every run of these periods.

    A block as long as the longest period, at one of every `step` places. A run of period q has at least
    max(24, 3q) words, so wherever it begins it holds such a block and, q words later, its next occurrence:
    step - 1 + block + q <= max(24, 3q). A block at least as long as q recurs there and not sooner, as the
    run would have a smaller period else. Exponent e: the block has 2^e words, -e: 3 * 2^(e - 2).
    """
    yield 1, 8, 8, 3
    e = 4
    while (1 << (e - 1)) < longest:
        quarter = 1 << (e - 2)
        yield 2 * quarter + 1, 3 * quarter, quarter, -e
        yield 3 * quarter + 1, 4 * quarter, 2 * quarter, e
        e += 1


def runs_of(codes: np.ndarray, longest: int) -> np.ndarray:
    """(start, length, period) of all runs, by start, then period; `longest`: codes of the longest text."""
    suffixes, tree = Suffixes(codes), None
    found = [np.zeros((0, 3), np.int64)]
    for shortest, block, step, exponent in blocks(longest // REPEATS):
        k = exponent if exponent > 0 else -exponent - 1
        if k >= len(suffixes.ranks):
            break
        at = np.arange(0, len(codes), step)
        low, high = suffixes.range_of(at, k)
        again = high - low > 1
        at, low, high = at[again], low[again], high[again]
        if exponent < 0:
            low, high = suffixes.narrowed(low, high, at, 1 << k, k - 1)
            again = high - low > 1
            at, low, high = at[again], low[again], high[again]
        if not len(at):
            continue
        tree = tree or WaveletTree(suffixes.order.astype(np.int64))
        period = tree.successor(low, high, at + 1) - at
        near = (period >= shortest) & (period <= block)
        at, period = at[near], period[near]
        start = at - suffixes.equal_behind(at, at + period)
        length = at + period + suffixes.equal_ahead(at, at + period) - start
        whole = length >= np.maximum(LENGTH, REPEATS * period)
        found.append(np.column_stack((start, length, period))[whole])
    return np.unique(np.concatenate(found), axis=0)


def runs_in(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each list of words, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    # One code behind every text that occurs nowhere else.
    codes, words = pd.factorize(np.array([w for t in texts for w in t], dtype=object))
    starts = np.cumsum(sizes + 1) - sizes - 1
    laid = np.full(int(sizes.sum()) + len(texts), -1, np.int64)
    ends = starts + sizes
    laid[ends] = len(words) + np.arange(len(texts))
    laid[laid < 0] = codes
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = runs_of(laid, int(sizes.max(initial=0)))
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    for text, (start, length, period) in zip(np.searchsorted(starts, found[:, 0], side="right") - 1, found.tolist()):
        out[text].append((start - int(starts[text]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by spaces."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of `docs`.

    Words are the runs of characters other than space and U+0009 to U+000D, numbered from 0. runs: array of
    (start, length, period) by start, then period: all maximal stretches in which words a period apart are
    equal, no smaller period will do, and length is at least max(24, 3 * period). collapsed: the words, without
    those that lie in a run behind its first period, joined by one space.

    Null text is empty, and an empty text has no runs and collapses to the empty text. Rows are handled
    without a shuffle: repeated rows, null ids and empty tables come out as they are. Columns other than doc_id
    and text are ignored. Texts are indexed together up to TOGETHER words, a longer one alone and whole; the
    index takes about 8 bytes a word for each doubling of the longest repeated stretch and of the words.
    """

    def handle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            runs = runs_in(texts)
            rows = [[dict(zip(("start", "length", "period"), r)) for r in some] for some in runs]
            out = [collapsed(*x).decode() for x in zip(texts, runs)]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows, pa.list_(RUN)), pa.array(out, pa.string())], ["doc_id", "runs", "collapsed"]
            )

        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                # Without an argument bytes are split at exactly that white space.
                words = text.as_py().encode().split()
                if ids and held + len(words) > TOGETHER:
                    yield done(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id.as_py())
                texts.append(words)
                held += len(words) + 1
            if ids:
                yield done(ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(handle, SCHEMA)
