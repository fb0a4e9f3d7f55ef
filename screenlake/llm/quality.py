"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import give_back, lean, text_of
from screenlake.llm.shingles import batches, mix, word_hashes
from screenlake.session import small_batches

STATISTICS = (
    "chars", "words", "word_length", "upper", "digits", "points", "symbols", "bangs", "bars",
    "lines", "distinct_words", "stutter", "repeated_pairs", "repeated_runs", "top_word", "sentence",
)
# Shrinkage of the class covariances to the pooled one, and of those to a multiple of the identity.
TO_POOLED, TO_IDENTITY = 0.5, 0.02
# Statistics depend on each other, so log-density differences overstate how sure they are.
TEMPERATURE = 4.0
# Words added to every text when shares of repeats are taken, so that few words say little.
PRIOR_WORDS = 6
THRESHOLD = 0.3
# Bytes of text whose statistics are taken together: bounds memory, no result depends on it.
AT_ONCE = 1 << 18
FOLDS = 5
_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _POINT, _BANG, _BAR, _SYMBOL, _OTHER = range(10)


def _classes() -> np.ndarray:
    of = np.full(256, _OTHER, np.int64)
    for c in range(33, 127):
        of[c] = _SYMBOL
    of[65:91], of[97:123], of[48:58] = _UPPER, _LOWER, _DIGIT
    for chars, kind in ((" \t\x0b\x0c\r", _SPACE), ("\n", _LINE), (".,;:?'\"()-", _POINT), ("!", _BANG), ("|", _BAR)):
        for c in chars:
            of[ord(c)] = kind
    return of


_CLASS = _classes()


def _distinct(docs: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document the number of distinct values and the count of the most frequent one.

    Sorted as one number each: the document above the high bits of the hash (n is below 2**20).
    """
    if not len(values):
        return np.zeros(n), np.zeros(n)
    keys = np.sort(docs.astype(np.uint64) << np.uint64(44) | values >> np.uint64(20))
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    owner = (keys[new] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, owner, np.diff(np.append(new, len(keys))).astype(float))
    return np.bincount(owner, minlength=n).astype(float), most


def _range_statistics(texts: pa.Array) -> np.ndarray:
    n = len(texts)
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    data = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    doc_of = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(doc_of * 10 + _CLASS[data], minlength=10 * n).reshape(n, 10).astype(float)
    total = np.maximum(sizes, 1)
    letters = np.maximum(kinds[:, _UPPER] + kinds[:, _LOWER], 1)
    words, counts = word_hashes(texts.cast(pa.large_string()))
    docs = np.repeat(np.arange(n), counts)
    some = np.maximum(counts, 1)
    length = (sizes - kinds[:, _SPACE] - kinds[:, _LINE]) / some
    same = docs[1:] == docs[:-1]
    stutter = np.bincount(docs[1:][same & (words[1:] == words[:-1])], minlength=n)
    pairs = mix(words[:-1] + mix(words[1:]))[same]
    runs_ok = docs[4:] == docs[:-4]
    runs = mix(words[:-4] + mix(words[1:-3] + mix(words[2:-2] + mix(words[3:-1] + mix(words[4:])))))[runs_ok] if len(words) > 4 else words[:0]
    distinct, most = _distinct(docs, words, n)
    two, _ = _distinct(docs[1:][same], pairs, n)
    five, _ = _distinct(docs[4:][runs_ok], runs, n)
    dots = kinds[:, _POINT] + kinds[:, _BANG]
    share = lambda x, of: np.sqrt(x / np.maximum(of, 1))
    return np.column_stack([
        np.log(sizes + 100), np.log(counts + 20), np.log1p(length),
        share(kinds[:, _UPPER], letters + 20), share(kinds[:, _DIGIT], total), share(kinds[:, _POINT], total + 20),
        share(kinds[:, _SYMBOL], total), share(kinds[:, _BANG], total), share(kinds[:, _BAR], total),
        share(kinds[:, _LINE], some), np.log1p(distinct + PRIOR_WORDS) / np.log1p(some + PRIOR_WORDS), share(stutter, some),
        share(np.maximum(some - 1 - two, 0), some + PRIOR_WORDS), share(np.maximum(some - 4 - five, 0), some + PRIOR_WORDS),
        share(most, some + PRIOR_WORDS), np.log1p(some / (dots + 1)),
    ])


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for every text; all whole texts, null as empty."""
    parts = [_range_statistics(texts[a:b]) for a, b in batches(texts, AT_ONCE)]
    return np.concatenate(parts) if parts else np.empty((0, len(STATISTICS)))


@dataclass
class Model:
    """Priors, means and lower Cholesky factors of both classes; None where labels show one class only."""

    priors: np.ndarray
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    scale: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        if self.means is None:
            return np.full(len(x), self.priors[1])
        densities = []
        for prior, mean, factor in zip(self.priors, self.means, self.factors):
            z = np.linalg.solve(factor, (x / self.scale - mean).T)
            densities.append(np.log(prior) - np.log(np.diag(factor)).sum() - 0.5 * (z**2).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip((densities[0] - densities[1]) / TEMPERATURE, -36, 500)))


def fit_moments(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Model:
    """The model from each class's number of rows, sums and sums of products."""
    total = counts.sum()
    if total == 0:
        return Model(np.array([0.5, 0.5]))
    if (counts == 0).any():
        return Model(counts / total)
    mean = sums.sum(axis=0) / total
    scale = np.sqrt(np.maximum(np.diag(squares.sum(axis=0)) / total - mean**2, 1e-8))
    means = sums / counts[:, None]
    raw = [squares[k] / counts[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    scaled = np.array([c / np.outer(scale, scale) for c in raw])
    pooled = (scaled * counts[:, None, None]).sum(axis=0) / total
    factors = []
    for cov in scaled:
        cov = (1 - TO_POOLED) * cov + TO_POOLED * pooled
        d = len(cov)
        cov = (1 - TO_IDENTITY) * cov + TO_IDENTITY * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        factors.append(np.linalg.cholesky(cov))
    return Model(counts / total, means / scale, np.array(factors), scale)


def fold_of(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo FOLDS: fold 0 is held out. A null id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS)), F.lit(1))


def _moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per class the number of rows, sums and sums of products of this task, one number a row."""
    d = len(STATISTICS) + 1
    held = np.zeros((2, d, d))
    for frame in frames:
        x = np.column_stack([np.ones(len(frame)), statistics(pa.array(frame["_text"].tolist(), pa.large_string()))])
        for k in (0, 1):
            own = x[frame["quality"].to_numpy() == k]
            held[k] += own.T @ own
    if held[:, 0, 0].any():
        yield pd.DataFrame({"cell": np.arange(held.size), "value": held.ravel()})


def fit(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> Model:
    """Fit on the labelled rows outside the held-out fold, at most `most` of them in a seeded order.

    `labels` has doc_id and quality (0 or 1; others and null are left out). Only ids of the chosen
    labels, at most `most`, are broadcast; moments are summed before anything reaches the driver.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & (fold_of() != 0))
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64(F.lit(29), "doc_id"), "doc_id", "quality").limit(most)
    )
    rows = docs.select("doc_id", text_of().alias("_text")).join(F.broadcast(chosen), "doc_id").select("_text", "quality")
    d = len(STATISTICS) + 1
    cells = np.zeros(2 * d * d)
    with small_batches(docs.sparkSession):
        moments = rows.mapInPandas(lean(_moments), "cell INT, value DOUBLE").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    for r in moments:
        cells[r["cell"]] = r["value"]
    both = cells.reshape(2, d, d)
    return fit_moments(both[:, 0, 0], both[:, 0, 1:], both[:, 1:, 1:])


def score_quality(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """Add the probability of good quality to every row of `docs`, from its whole text alone.

    Null text is empty; empty texts have a score too. Rows are scored one by one without a shuffle:
    repeated rows, null ids and empty tables come out as they are; other columns stay, a column named
    like the new one is replaced.
    """

    # Texts stay in the Arrow batch they come in; as Python strings they would be there three times.
    @F.arrow_udf("double")
    def score(batches_: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches_:
            yield pa.array(model.score(statistics(texts.cast(pa.large_string()))))
            del texts
            give_back()

    return docs.drop(out).withColumn(out, score(text_of()))
