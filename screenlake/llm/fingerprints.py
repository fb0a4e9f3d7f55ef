"""Document fingerprints: one-permutation MinHash, densified, packed as low-order bits."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import id_back, id_of, text_of
from screenlake.llm.shingles import batches, mix, shingle_hashes

BINS, BITS = 512, 4
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _probes() -> np.ndarray:
    """For every bin an order of all bins, the same everywhere: where an empty bin looks for a value."""
    n = np.arange(BINS, dtype=np.uint64)
    return np.argsort(mix((n[:, None] << np.uint64(32)) + n[None, :] + np.uint64(1)), axis=1).astype(np.int32)


PROBES = _probes()


def fingerprints(texts: pa.Array) -> list[np.ndarray]:
    """BINS low-order values of BITS bits for every text; an empty array for a text without words.

    Each shingle is hashed once; the top bits choose its bin, every bin keeps its least hash. An empty
    bin takes the value of the first filled one in its own random order of bins (optimal
    densification), so likeness stays an unbiased estimate for short texts.
    """
    out: list[np.ndarray] = []
    shift = np.uint64(64 - (BINS.bit_length() - 1))
    for start, stop in batches(texts, 1 << 20):
        hashes, counts = shingle_hashes(texts[start:stop])
        docs = np.repeat(np.arange(stop - start), counts)
        least = np.full((stop - start) * BINS, _EMPTY)
        np.minimum.at(least, docs * BINS + (hashes >> shift).astype(np.int64), hashes)
        least = least.reshape(-1, BINS)
        filled = least != _EMPTY
        some = filled.any(axis=1)
        doc, bin_ = np.nonzero(~filled & some[:, None])
        for turn in range(BINS):
            if not len(doc):
                break
            source = PROBES[bin_, turn]
            hit = filled[doc, source]
            least[doc[hit], bin_[hit]] = least[doc[hit], source[hit]]
            doc, bin_ = doc[~hit], bin_[~hit]
        low = (least & np.uint64((1 << BITS) - 1)).astype(np.uint8)
        out.extend(row if ok else row[:0] for row, ok in zip(low, some))
    return out


def pack(values: np.ndarray) -> str:
    """The low-order bits as hexadecimal text, one digit per bin; empty for a text without words."""
    return ((values[0::2] << 4) | values[1::2]).astype(np.uint8).tobytes().hex()


def unpack(packed: str) -> np.ndarray:
    both = np.frombuffer(bytes.fromhex(packed), np.uint8)
    return np.stack([both >> 4, both & 15], axis=1).ravel()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1.

    Bins agree by chance once in 2**BITS, so that share is taken off. Two texts without words are
    alike, one with and one without are not.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    chance = 1.0 / (1 << BITS)
    return float(min(1.0, max(0.0, (np.mean(a == b) - chance) / (1.0 - chance))))


def edited(text: str, after: str) -> str:
    """The text with its last half replaced by as many first code points of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


SCHEMA = (
    "doc_id LONG, n_chars LONG, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING, "
    "near_edited DOUBLE, near_next DOUBLE"
)


def _fingerprint_pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one task, sorted by chunk and order; each is met with the row after it in its chunk.

    The last row of a chunk is a guest: the first row of the next chunk, there only to be met.
    """
    held: pd.DataFrame | None = None
    for frame in frames:
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        held = frame.iloc[-1:]
        yield from _pairs_of(frame)


def _pairs_of(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    whole = pa.array(frame["_text"].tolist(), pa.large_string())
    for start, stop in batches(whole, 8 << 20):
        # One row more than the range: the last one is only met.
        part = frame.iloc[start:stop + 1]
        own = [not g and c == d for g, c, d in zip(part["_guest"].iloc[:-1], part["_chunk"].iloc[:-1], part["_chunk"].iloc[1:])]
        texts = part["_text"].tolist()
        changed = [edited(a, b) for a, b, ok in zip(texts, texts[1:], own) if ok]
        prints = fingerprints(pa.array(texts, pa.large_string()))
        new = iter(fingerprints(pa.array(changed, pa.large_string())))
        sums = iter(sha256(x.encode("utf-8")).hexdigest() for x in changed)
        rows = []
        for i, ok in enumerate(own):
            if ok:
                e = next(new)
                rows.append((part["doc_id"].iloc[i], len(texts[i]), next(sums), pack(prints[i]), pack(e),
                             likeness(prints[i], e), likeness(prints[i], prints[i + 1])))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])


class Chunks:
    """Cuts of the order by descending id, then descending tie (a hash of 63 bits): one before every quantile.

    An id that is several quantiles is cut before and, in as many equal parts, by its ties.
    """

    def __init__(self, quantiles: list[int]):
        self.ids, self.parts = np.unique(np.array(quantiles, np.int64), return_counts=True)
        # Cuts at the ids from one on, and none behind the last.
        self.above = np.append(np.cumsum(self.parts[::-1])[::-1], 0)
        self.count = int(self.above[0]) + 1

    def of(self, ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """The number of cuts before each row."""
        at = np.searchsorted(self.ids, ids, "left")
        chunk = self.above[at]
        for k in np.flatnonzero(self.parts > 1).tolist():
            own = (at == k) & (ids == self.ids[k])
            chunk[own] -= (ties[own] >> 31) * self.parts[k] >> 32
        return chunk


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprint every text, its edited text, and compare both and the next document.

    The next document is the one after it by descending doc_id (null ids last, repeated ids by the hash of
    their text, then the text), after the last one the first; a single document is its own next. Null
    text is empty: its fingerprint is the empty string. An empty table gives an empty table. Columns
    other than doc_id and text are ignored.

    The order is cut into chunks at quantiles of the ids, one task each; an id that several quantiles
    fall on, such as null, is cut by the hash of the text into as many chunks more. The first document of
    every chunk is also sent, as a guest, to the chunk before it; so one shuffle of the texts brings
    every document and its successor together, and nothing depends on how rows lie in the input. Rows
    that agree in id and text stay in one chunk. The driver holds two numbers per task.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    tie = F.shiftrightunsigned(F.xxhash64("_text"), 1)
    base = docs.select(id_of().alias("doc_id"), text_of().alias("_text"), key.alias("_id")).withColumn("_tie", tie)
    found: list[int] = []
    if tasks > 1:
        at = [i / tasks for i in range(1, tasks)]
        found = base.agg(F.percentile_approx("_id", at, 50 * tasks)).first()[0] or []
    chunks = Chunks(found)

    @F.pandas_udf("int")
    def chunk_of(ids: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series(chunks.of(ids.to_numpy(), ties.to_numpy())).astype("int32")

    firsts = base.select("_id", "_tie", chunk_of("_id", "_tie").alias("_chunk")).groupBy("_chunk").agg(F.max(F.struct("_id", "_tie")).alias("first"))
    heads = sorted((r["_chunk"], tuple(r["first"])) for r in firsts.collect())
    if not heads:
        return spark.createDataFrame([], SCHEMA)
    # A chunk's guest is the head of the next chunk that has rows; the last one's is the very first.
    guests = pd.MultiIndex.from_tuples([first for _, first in heads[1:] + heads[:1]])
    hosts = [c for c, _ in heads]

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series, ties: pd.Series) -> pd.Series:
        own = chunks.of(ids.to_numpy(), ties.to_numpy()).tolist()
        near = guests.get_indexer(pd.MultiIndex.from_arrays([ids, ties])).tolist()
        return pd.Series([[c] if g < 0 else [c, hosts[g]] for c, g in zip(own, near)])

    met = (
        base.withColumn("_places", places("_id", "_tie"))
        .select("doc_id", "_text", "_id", "_tie", F.posexplode("_places").alias("_guest", "_chunk"))
        .repartitionById(chunks.count, F.col("_chunk"))
        .sortWithinPartitions("_chunk", "_guest", F.desc("_id"), F.desc("_tie"), "_text")
        .select("doc_id", "_text", "_chunk", (F.col("_guest") > 0).alias("_guest"))
    )
    return met.mapInPandas(_fingerprint_pairs, SCHEMA).withColumn("doc_id", id_back("doc_id"))
