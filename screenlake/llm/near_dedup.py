"""Near-duplicate classes: consistent weighted sampling over TF-IDF shingles, banded and verified."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenlake.llm.common import id_back, id_of, lean, text_of, whole_row
from screenlake.llm.shingles import batches, mix, shingle_hashes, word_hashes
from screenlake.operators.joins import salted_join
from screenlake.session import small_batches, stable

SIMILARITY = 0.8
BANDS, ROWS = 20, 4
# Document frequencies are counted for this many groups of shingles by hash, each far rarer than
# COMMON unless it holds a common shingle.
GROUPS = 1 << 20
# Rows with whole texts that a Python worker gets at once.
TEXTS_AT_ONCE = 1000
SLICES = 128
# Shingles in at most this share of documents weigh 1; commoner ones less, never below FLOOR, so that
# a large family of near copies still shows as one.
COMMON, FLOOR = 0.01, 0.9
# Members of a bucket that are compared with each other or with another block in one task, and characters of their texts.
BLOCK, BLOCK_CHARS = 128, 8 << 20
# Shingles of a block pair that are counted at a time: bounds memory, no result depends on it.
COLUMNS = 4096
# Entries of the tables of random variates that sampling draws from.
DRAWS = 1 << 16


def _keyed(docs: DataFrame) -> DataFrame:
    """(_doc, _check, _text): the id, null last, and a hash of the text tell rows apart."""
    return docs.select(id_of().alias("_doc"), text_of().alias("_text")).withColumn("_check", F.xxhash64("_text"))


# --- weights ---------------------------------------------------------------------------------


def _count_groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many documents of this task hold a shingle of each group, in slices."""
    table = np.zeros(GROUPS, np.int64)
    for frame in frames:
        texts = pa.array(frame["_text"].tolist(), pa.large_string())
        for start, stop in batches(texts, 1 << 20):
            hashes, counts = shingle_hashes(texts[start:stop])
            docs = np.repeat(np.arange(stop - start, dtype=np.uint64), counts)
            held = np.unique(docs << np.uint64(20) | hashes >> np.uint64(44))
            np.add.at(table, (held & np.uint64(GROUPS - 1)).astype(np.int64), 1)
    parts = table.reshape(SLICES, -1)
    some = np.flatnonzero(parts.any(axis=1))
    yield pd.DataFrame({"slice": some, "counts": [parts[i].astype("<i8").tobytes() for i in some]})


def _sum_slices(frames: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for frame in frames:
        for i, counts in zip(frame["slice"], frame["counts"]):
            sums[i] = sums.get(i, 0) + np.frombuffer(counts, "<i8")
    for i, total in sums.items():
        at = np.flatnonzero(total > least)
        yield pd.DataFrame({"grp": i * (GROUPS // SLICES) + at, "df": total[at]})


@dataclass
class Weights:
    """Inverse document frequencies below 1: sorted groups of shingles and their weights."""

    groups: np.ndarray
    idf: np.ndarray

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = 1.0 + np.log(counts)
        if len(self.groups):
            group = (hashes >> np.uint64(44)).astype(np.int64)
            at = np.minimum(np.searchsorted(self.groups, group), len(self.groups) - 1)
            weights *= np.where(self.groups[at] == group, self.idf[at], 1.0)
        return weights


def shingle_weights(texts: DataFrame, rows: int) -> Weights:
    """Weights from document frequencies over all texts. The counters have a fixed size, and so has
    what reaches the driver: groups commoner than COMMON, at most GROUPS."""
    common = (
        texts.select("_text").mapInPandas(lean(_count_groups), "slice INT, counts BINARY")
        .repartition("slice")
        .mapInPandas(lean(_sum_slices, COMMON * rows), "grp LONG, df LONG")
        .sort("grp").collect()
    )
    df = np.array([r["df"] for r in common], float)
    idf = np.log(rows / np.minimum(df, rows)) / math.log(1 / COMMON) if len(df) else df
    return Weights(np.array([r["grp"] for r in common], np.int64), np.maximum(FLOOR, idf))


def vectors(texts: pa.Array, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text, sorted within it, their weights, and how many each text has."""
    hashes, counts = shingle_hashes(texts)
    docs = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((hashes, docs)) if len(texts) > 1 else np.argsort(hashes)
    docs, hashes = docs[order], hashes[order]
    new = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])])) if len(docs) else order
    times = np.diff(np.append(new, len(docs)))
    return hashes[new], weights.of(hashes[new], times), np.bincount(docs[new], minlength=len(texts))


def totals(weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the weights of every text."""
    return np.bincount(np.repeat(np.arange(len(counts)), counts), weights=weights, minlength=len(counts))


# --- sampling --------------------------------------------------------------------------------


def _variates() -> tuple[np.ndarray, ...]:
    rng = np.random.default_rng(7)
    r, c, beta = rng.gamma(2.0, 1.0, DRAWS), rng.gamma(2.0, 1.0, DRAWS), rng.random(DRAWS)
    factors = rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return r, np.log(c), beta, factors


_R, _LOG_C, _BETA, _FACTORS = _variates()


def _rank(log_a: np.ndarray) -> np.ndarray:
    """ln a as the high half of an integer that sorts alike."""
    return (np.clip((log_a + 64.0) * (1 << 24), 0, (1 << 31) - 1).astype(np.uint64)) << np.uint64(32)


_UNIT = _rank(_LOG_C - _R * (1.0 - _BETA))


def band_keys(hashes: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One key per band and text (texts without shingles have zeros).

    Improved consistent weighted sampling: an element of weight w draws r, c ~ Gamma(2, 1) and
    beta ~ U(0, 1) by its hash, t = floor(ln w / r + beta), ln a = ln c - r (t - beta + 1); the sample
    is the element, with its t, of least a. Texts agree on a sample with the probability of their
    weighted Jaccard similarity. A band is ROWS samples.
    """
    keys = np.zeros((len(counts), BANDS), np.uint64)
    some = counts > 0
    if not some.any():
        return keys
    starts = (np.cumsum(counts) - counts)[some]
    heavy = np.flatnonzero(weights != 1.0)
    log_w = np.log(weights[heavy])
    for band in range(BANDS):
        held = np.full(int(some.sum()), np.uint64(band + 1))
        for row in range(ROWS):
            v = hashes * _FACTORS[band * ROWS + row]
            draw = (v >> np.uint64(48)).astype(np.int64)
            low = (v >> np.uint64(16)) & np.uint64(0xFFFFFFFF)
            ranked = _UNIT[draw] | low
            if len(heavy):
                d = draw[heavy]
                t = np.floor(log_w / _R[d] + _BETA[d])
                moved = mix(low[heavy] + (t.astype(np.int64).astype(np.uint64) << np.uint64(32))) & np.uint64(0xFFFFFFFF)
                ranked[heavy] = _rank(_LOG_C[d] - _R[d] * (t - _BETA[d] + 1.0)) | np.where(t == 0, low[heavy], moved)
            least = np.minimum.reduceat(ranked, starts) & np.uint64(0xFFFFFFFF)
            held = mix(held * np.uint64(0x9E3779B97F4A7C15) + least)
        keys[some, band] = held
    return keys


SIGNATURES = "_doc LONG, _check LONG, d1 LONG, d2 LONG, keys ARRAY<LONG>, total DOUBLE"


def _sign(frames: Iterator[pd.DataFrame], weights: Weights) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = pa.array(frame["_text"].tolist(), pa.large_string())
        for start, stop in batches(texts, 1 << 19):
            part = texts[start:stop]
            words, n = word_hashes(part)
            place = np.arange(len(words), dtype=np.uint64) - np.repeat((np.cumsum(n) - n).astype(np.uint64), n)
            owner = np.repeat(np.arange(len(n)), n)
            digests = []
            for salt in (0x51ED270B7A6C35A1, 0xC2B2AE3D27D4EB4F):
                total = np.zeros(len(n), np.uint64)
                np.add.at(total, owner, mix(words + mix(place + np.uint64(salt))))
                digests.append(total.astype(np.int64))
            vector = vectors(part, weights)
            keys = band_keys(*vector).astype(np.int64)
            own = frame.iloc[start:stop]
            yield pd.DataFrame({
                "_doc": own["_doc"].to_numpy(), "_check": own["_check"].to_numpy(), "d1": digests[0], "d2": digests[1],
                "keys": [k if some else [] for k, some in zip(keys, n > 0)], "total": totals(*vector[1:]),
            })


# --- verification ----------------------------------------------------------------------------


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller over sum of larger weights; both sides are (sorted shingles, weights)."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    same = a[0][at] == b[0]
    low = np.minimum(a[1][at[same]], b[1][same]).sum()
    return float(low / (a[1].sum() + b[1].sum() - low))


def _split(texts: list[str], weights: Weights) -> list[tuple[np.ndarray, np.ndarray]]:
    hashes, w, n = vectors(pa.array(texts, pa.large_string()), weights)
    ends = np.cumsum(n)
    return [(hashes[e - k:e], w[e - k:e]) for e, k in zip(ends, n)]


def _verify(frames: Iterator[pd.DataFrame], weights: Weights) -> Iterator[pd.DataFrame]:
    """Similarity of every pair (a, b, text_a, text_b)."""
    for frame in frames:
        # About 4 MB of text at a time; a text that repeats on side `a` is cut into shingles once.
        lots = np.cumsum(frame["text_a"].str.len() + frame["text_b"].str.len()) // (4 << 20)
        for _, lot in frame.groupby(lots.to_numpy(), sort=False):
            firsts = lot.drop_duplicates("a")
            of_a = dict(zip(firsts["a"], _split(firsts["text_a"].tolist(), weights)))
            sims = [weighted_jaccard(of_a[a], b) for a, b in zip(lot["a"], _split(lot["text_b"].tolist(), weights))]
            yield lot[["a", "b"]].assign(sim=sims)


def _verified(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """`pairs` (a, b) with their similarities."""
    of_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("_text").alias("text_b")), "b")
    both = salted_join(of_b, texts.select(F.col("node").alias("a"), F.col("_text").alias("text_a")), ["a"], "inner", salts=2)
    return both.select("a", "b", "text_a", "text_b").mapInPandas(lean(_verify, weights), "a LONG, b LONG, sim DOUBLE")


def common_weights(vectors_: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sum of the smaller weights, for all pairs of texts.

    A smaller weight is the sum of the steps, between the weights a shingle has, that both texts reach: with
    one column per step the sums are a product of matrices. Shingles that one text holds alone have no part.
    """
    n = len(vectors_)
    docs = np.repeat(np.arange(n), [len(h) for h, _ in vectors_])
    hashes, weights = (np.concatenate([v[i] for v in vectors_]) if n else np.empty(0) for i in (0, 1))
    _, column, held = np.unique(hashes, return_inverse=True, return_counts=True)
    met = held[column] > 1
    docs, column, weights = docs[met], np.unique(column[met], return_inverse=True)[1], weights[met]
    out = np.zeros((n, n))
    # The steps of a column: its different weights, ascending.
    order = np.lexsort((weights, column))
    docs, column, weights = docs[order], column[order], weights[order]
    fresh = np.ones(len(column), bool)
    fresh[1:] = (column[1:] != column[:-1]) | (weights[1:] != weights[:-1])
    first = np.ones(len(column), bool)
    first[1:] = column[1:] != column[:-1]
    number = np.cumsum(fresh) - 1
    step = weights[fresh] - np.where(first[fresh], 0.0, np.append(0.0, weights[fresh][:-1]))
    lowest = number[first][column] if len(column) else number
    level = number - lowest
    for k in range(int(level.max(initial=-1)) + 1):
        reach = level >= k
        which, place = np.unique(lowest[reach] + k, return_inverse=True)
        for start in range(0, len(which), COLUMNS):
            here = (place >= start) & (place < start + COLUMNS)
            table = np.zeros((n, min(COLUMNS, len(which) - start)))
            table[docs[reach][here], place[here] - start] = 1.0
            out += (table * step[which[start:start + COLUMNS]]) @ table.T
    return out


LINKS = "a LONG, b LONG, la LONG, lb LONG"


def _links_of_blocks(frames: Iterator[pd.DataFrame], weights: Weights) -> Iterator[pd.DataFrame]:
    """Links between members of different labels, of block pairs (key, p, q) that come row after row."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        node, label, block = (rows[c].to_numpy() for c in ("node", "label", "block"))
        vector = _split(rows["_text"].tolist(), weights)
        total = np.array([w.sum() for _, w in vector])
        low = common_weights(vector)
        sim = low / np.maximum(total[:, None] + total[None, :] - low, 1e-300)
        asked = (label[:, None] != label[None, :]) & (node[:, None] < node[None, :])
        if rows["p"].iloc[0] != rows["q"].iloc[0]:
            asked &= block[:, None] != block[None, :]
        at, to = np.nonzero(asked & (sim >= SIMILARITY - 1e-6))
        # Sums in another order may differ in their last digits: those near the threshold are summed as elsewhere.
        sure = [sim[i, j] >= SIMILARITY + 1e-6 or weighted_jaccard(vector[i], vector[j]) >= SIMILARITY for i, j in zip(at, to)]
        at, to = at[sure], to[sure]
        return pd.DataFrame({"a": node[at], "b": node[to], "la": label[at], "lb": label[to]})

    held: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        for pair, rows in frame.groupby(["key", "p", "q"], sort=False):
            if pair != last and held:
                yield links(pd.concat(held))
                held = []
            held.append(rows)
            last = pair
    if held:
        yield links(pd.concat(held))


def _shingle_rows(frames: Iterator[pd.DataFrame], weights: Weights) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = pa.array(frame["_text"].tolist(), pa.large_string())
        for start, stop in batches(texts, 1 << 20):
            hashes, w, n = vectors(texts[start:stop], weights)
            yield pd.DataFrame({"node": np.repeat(frame["node"].to_numpy()[start:stop], n), "hash": hashes.astype(np.int64), "w": w})


def _mixed(cells: DataFrame) -> DataFrame:
    """Cells of buckets with members of several components."""
    several = cells.groupBy("key").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low < _high")
    return salted_join(cells, several.select("key"), ["key"], "left_semi")


def _hopeful(cells: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """Cells without those that no mate can be similar to.

    What a text shares with any other is at most its weight on shingles that some other text here holds. Similar
    texts share at least SIMILARITY / (1 + SIMILARITY) of both weights together; the lightest mate, and the mate
    that could share most, tell who has none. In a family of pages of one template, alike but not enough, that is
    everybody, so families cost their members and not their pairs.
    """
    nodes = cells.select("node").distinct()
    own = texts.join(nodes, "node").mapInPandas(lean(_shingle_rows, weights), "node LONG, hash LONG, w DOUBLE")
    alone = own.groupBy("hash").agg(F.min("node").alias("node"), F.max("node").alias("_last"), F.min("w").alias("w")).where("node = _last")
    unshared = alone.groupBy("node").agg(F.sum("w").alias("_alone"))
    of_node = texts.select("node", "total").join(nodes, "node").join(unshared, "node", "left")
    # The heaviest mate that is light enough, with a margin for sums in another order.
    most = (F.col("total") - F.coalesce("_alone", F.lit(0.0))) * ((1 + SIMILARITY) / SIMILARITY) - F.col("total") + 1e-6
    known = stable(cells.join(of_node.select("node", "total", most.alias("most")), "node"))
    bounds = known.groupBy("key").agg(F.min("total").alias("_lightest"), F.max("most").alias("_most"))
    met = salted_join(known, bounds, ["key"], "inner")
    return met.where("most >= _lightest AND total <= _most").select("key", "node", "label")


def _compared_in_blocks(cells: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """Links (a, b, la, lb) between bucket mates of different components.

    The members of a bucket's largest component are never compared with each other. They and the rest are dealt
    into blocks; a block pair is compared in one task, to which each of its texts is sent once.
    """
    sized = cells.join(texts.select("node", F.length("_text").alias("chars")), "node")
    per_label = sized.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    largest = F.max(F.struct("n", "label", "chars")).alias("_top")
    per_key = per_label.groupBy("key").agg(largest, F.sum("n").alias("_n"), F.sum("chars").alias("_chars"))
    parts = lambda n, chars: F.greatest(F.lit(1), F.ceil(n / BLOCK), F.ceil(chars / BLOCK_CHARS)).cast("long")
    plan = per_key.select(
        "key", F.col("_top.label").alias("_label"), parts(F.col("_top.n"), F.col("_top.chars")).alias("_tops"),
        parts(F.col("_n") - F.col("_top.n"), F.col("_chars") - F.col("_top.chars")).alias("_rests"),
    )
    met = salted_join(cells, plan, ["key"], "inner")
    place = F.xxhash64("node")
    is_top = F.col("label") == F.col("_label")
    block = F.when(is_top, F.col("_rests") + F.pmod(place, "_tops")).otherwise(F.pmod(place, "_rests"))
    mates = F.sequence(F.lit(0).cast("long"), F.when(is_top, F.col("_rests")).otherwise(F.col("_rests") + F.col("_tops")) - 1)
    dealt = met.withColumn("block", block).withColumn("mate", F.explode(mates)).select(
        "key", F.least("block", "mate").alias("p"), F.greatest("block", "mate").alias("q"), "node", "label", "block"
    )
    # A member that is left over from a large family meets all of its blocks.
    with_text = salted_join(dealt, texts.select("node", "_text").join(cells.select("node").distinct(), "node"), ["node"], "inner", salts=4)
    together = with_text.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return together.select("key", "p", "q", "node", "label", "block", "_text").mapInPandas(lean(_links_of_blocks, weights), LINKS).distinct()


def _link_buckets(cells: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """(node, label) of all nodes that are linked to another one; links are between bucket mates.

    First every member of a bucket is compared with its head, the least node, and components are merged: buckets of
    one component, such as families of copies, are done with one comparison a member. Of the others, members that may
    have a similar mate are compared, block by block. So no link between components is lost.
    """
    heads = cells.groupBy("key").agg(F.min("node").alias("head"))
    met = salted_join(cells, heads, ["key"], "inner").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    sims = _verified(met, texts, weights).where(F.col("sim") >= SIMILARITY)
    labels, _ = _merged_labels(None, stable(sims.select(F.col("a").alias("la"), F.col("b").alias("lb")).distinct()))
    own = cells.withColumn("label", F.col("node"))
    open_ = stable(_mixed(own if labels is None else _relabelled(own, labels)))
    if not open_.isEmpty():
        open_ = stable(_mixed(_hopeful(open_, texts, weights)))
        labels, _ = _merged_labels(labels, stable(_compared_in_blocks(open_, texts, weights)))
    if labels is None:
        return texts.sparkSession.createDataFrame([], "node LONG, label LONG")
    return labels


def _merged_labels(labels: DataFrame | None, new: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """Labels after the links `new` (la, lb), and how those change labels; None where nothing is linked."""
    found = new.select(F.col("la").alias("a"), F.col("lb").alias("b"))
    if found.isEmpty():
        return labels, None
    merged = components(found)
    if labels is None:
        return merged, merged
    fresh = merged.join(labels.select("node"), "node", "left_anti")
    return stable(_relabelled(labels, merged).unionAll(fresh)), merged


def _relabelled(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """`rows` with the labels that `merged` (node, label) maps replaced."""
    moved = merged.select(F.col("node").alias("label"), F.col("label").alias("_to"))
    return salted_join(rows, moved, ["label"]).withColumn("label", F.coalesce("_to", "label")).drop("_to").select(*rows.columns)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected component, for nodes that have links.

    Labels are lowered to the least one among neighbours, then to the label's own label, until
    nothing changes; every step is a join that is salted, as hubs have many neighbours and large
    components one label, and a combined minimum.
    """
    both = stable(links.union(links.select("b", "a")).toDF("node", "other").distinct())
    labels = stable(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")))
    while True:
        of_other = labels.select(F.col("node").alias("other"), F.col("label").alias("_theirs"))
        near = salted_join(both, of_other, ["other"], "inner").groupBy("node").agg(F.min("_theirs").alias("_near"))
        lower = labels.join(near, "node").withColumn("_low", F.least("label", "_near"))
        # The label of the label: paths shrink by half each time.
        jump = labels.select(F.col("node").alias("_low"), F.col("label").alias("_next"))
        after = stable(salted_join(lower, jump, ["_low"], "inner").select("node", F.least("_low", "_next").alias("label"), F.col("label").alias("_was")))
        if after.where("label < _was").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def _labelled(docs: DataFrame) -> DataFrame:
    """(_doc, _check, _class) for every row; _class is a number of the class."""
    # Everything that runs in Python is done before this returns; a worker holds few texts at once.
    with small_batches(docs.sparkSession, TEXTS_AT_ONCE):
        return _classes(docs)


def _classes(docs: DataFrame) -> DataFrame:
    keyed = _keyed(docs)
    weights = shingle_weights(keyed, docs.count())
    signed = stable(keyed.mapInPandas(lean(_sign, weights), SIGNATURES).withColumn("_row", F.monotonically_increasing_id()))
    copies = signed.groupBy("d1", "d2").agg(F.min("_row").alias("node"))
    members = stable(salted_join(signed, copies, ["d1", "d2"]).select("_doc", "_check", "_row", "node", "keys", "total"))
    nodes = members.where("_row = node")
    cells = nodes.select("node", F.explode("keys").alias("key"))
    shared = cells.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
    cells = stable(salted_join(cells, shared, ["key"], "left_semi"))
    involved = nodes.select("_doc", "_check", "node", "total").join(cells.select("node").distinct(), "node")
    # One row per node, though rows of the input may be repeated.
    texts = stable(keyed.join(involved, ["_doc", "_check"]).groupBy("node").agg(F.first("_text").alias("_text"), F.first("total").alias("total")))
    labels = _link_buckets(cells, texts, weights)
    labelled = salted_join(members.select("_doc", "_check", "node"), labels, ["node"])
    return labelled.select("_doc", "_check", F.coalesce("label", "node").alias("_class"))


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, check) for every row of `docs`: rows of one class are linked, directly or
    through others, by a weighted Jaccard similarity of SIMILARITY or more over TF-IDF shingles of
    five words. class_id is the least doc_id of the class (null ids last); check is a hash of the text.

    Texts of the same words are one node from the start, so copies are never paired; texts without
    words are copies of each other. Null text is empty. Repeated rows are copies of each other. An
    empty table gives an empty table. Columns other than doc_id and text are ignored.

    A term weighs 1 + ln(count) times its idf, which is 1 up to a document share of COMMON and falls
    to FLOOR. Two texts at the threshold share none of BANDS bands of ROWS samples, and are missed,
    with a probability below 3 in 100,000; bucket mates are compared exactly.
    """
    labelled = stable(_labelled(docs))
    least = labelled.groupBy("_class").agg(F.min("_doc").alias("_first"))
    return salted_join(labelled, least, ["_class"]).select(
        id_back("_doc").alias("doc_id"), id_back("_first").alias("class_id"),
        F.col("_check").alias("check"),
    )


def keep_first_of_classes(docs: DataFrame) -> DataFrame:
    """One row of `docs` for each class of near_duplicate_classes, all columns: the one of least doc_id
    (null last), of several by a hash of the text, of equal ones any."""
    first = _labelled(docs).groupBy("_class").agg(F.min(F.struct("_doc", "_check")).alias("_k")).select("_k._doc", "_k._check")
    same = Window.partitionBy("_doc", "_check").orderBy("_doc")
    return (
        docs.select(whole_row(docs).alias("_all"), id_of().alias("_doc"), F.xxhash64(text_of()).alias("_check"))
        .join(first, ["_doc", "_check"])
        .withColumn("_n", F.row_number().over(same)).where("_n = 1")
        .select("_all.*")
    )
