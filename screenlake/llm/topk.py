"""Exact top-k inner products over an impact-ordered index, score at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.session import stable

SCALE = 256
# Rows and components of one block of vectors or queries, queries searched together, tasks of the search:
# they bound memory and the plan, none changes results.
BLOCK, CELLS, TOGETHER, TASKS = 8192, 1 << 20, 256, 20_000
# Impacts are the means of magnitudes between these quantiles: 32 equal ones, the highest halved again and again.
QUANTILES = np.concatenate([np.arange(32) / 32, 1 - 0.5 ** np.arange(6, 13)])
# A proof is tried each time when this share of the postings is read.
STOPS = (1 / 32, 1 / 8, 1 / 2, 1)
# Whole numbers that floats and longs hold without rounding.
EXACT, LONG = float(1 << 53), float(1 << 62)
LARGEST = (1 << 63) - 1

INDEX = "_d INT, _block INT, ids BINARY, kind STRING, cells BINARY, rows BINARY, components BINARY, impacts BINARY, starts BINARY, stops BINARY, unread BINARY"


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): components as floor(256 x). Vectors that are null, empty of an id, or hold a null
    or non-finite component are left out."""
    v = F.transform(embedding, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & sound).select(
        F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")
    )


def _narrow(whole: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as they need."""
    low, high = int(whole.min(initial=0)), int(whole.max(initial=0))
    return whole.astype(next(t for t in ("int8", "int16", "int32", "int64") if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def build_block(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """One block of vectors as a row of the index.

    A segment is the postings of one component and one signed impact: the rows whose component has
    it. Segments stand by descending impact; components of zero are not posted. `unread` holds, for
    every stop and row, the norm of what the postings so far leave out of the vector.
    """
    vectors = np.stack(frame["v"].to_numpy()).astype("int64")
    exact = vectors.astype("float64")
    size = np.abs(exact)
    posted = size[size > 0]
    edges = np.unique(np.quantile(posted, QUANTILES)) if len(posted) else np.ones(1)
    bins = np.searchsorted(edges, size, side="right") - 1  # -1: zero
    count = np.bincount(bins[bins >= 0], minlength=len(edges))
    impact = np.rint(np.bincount(bins[bins >= 0], weights=posted, minlength=len(edges)) / np.maximum(count, 1))
    row, component = np.nonzero(bins >= 0)
    level, negative = bins[row, component], exact[row, component] < 0
    order = np.lexsort((row, negative, component, -level))
    row, component, level, negative = row[order], component[order], level[order], negative[order]
    new = np.ones(len(row), bool)
    new[1:] = (level[1:] != level[:-1]) | (component[1:] != component[:-1]) | (negative[1:] != negative[:-1])
    first = np.flatnonzero(new)
    # A stop is the least level that is read by then.
    read = np.cumsum(count[::-1]) / max(1, len(row))
    levels = sorted({len(edges) - 1 - int(np.searchsorted(read, s - 1e-12)) for s in STOPS} if len(row) else {0}, reverse=True)
    approx = np.where(exact < 0, -1.0, 1.0) * impact[np.maximum(bins, 0)]
    unread = [np.sqrt((np.where(bins >= least, exact - approx, exact) ** 2).sum(axis=1)) for least in levels]
    narrow = _narrow(vectors)
    return pd.DataFrame([{
        "_d": key[0], "_block": key[1], "ids": frame["vec_id"].to_numpy("int64").tobytes(),
        "kind": str(narrow.dtype), "cells": narrow.tobytes(), "rows": row.astype("uint32").tobytes(),
        "components": component[first].astype("int32").tobytes(),
        "impacts": (np.where(negative[first], -1.0, 1.0) * impact[level[first]]).tobytes(),
        "starts": np.append(first, len(row)).astype("int64").tobytes(),
        "stops": np.array([int((level[first] >= least).sum()) for least in levels], "int32").tobytes(),
        # Rounded up, so that the bound stays one.
        "unread": (np.stack(unread) * (1 + 1e-6)).astype("float32").tobytes(),
    }])


class ImpactBlock:
    """A row of the index, ready for search."""

    def __init__(self, stored: dict):
        def array(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(stored[name], kind)

        self.ids = array("ids", "int64")
        self.vectors = array("cells", stored["kind"]).reshape(len(self.ids), stored["_d"]).astype("int64")
        self.rows, self.starts = array("rows", "uint32"), array("starts", "int64")
        self.components, self.impacts = array("components", "int32"), array("impacts", "float64")
        self.stops = array("stops", "int32")
        self.unread = array("unread", "float32").reshape(len(self.stops), len(self.ids)).astype("float64")
        self.exact = self.vectors.astype("float64")
        self.norms = np.sqrt((self.exact**2).sum(axis=1))

    def _add(self, scores: np.ndarray, queries: np.ndarray, begin: int, end: int) -> None:
        """Add what the segments from begin to end give to the scores (one row per query)."""
        a, b = self.starts[begin], self.starts[end]
        if (b - a) * 16 <= self.exact.size:
            given = np.zeros(scores.shape[::-1])
            for s in range(begin, end):
                given[self.rows[self.starts[s]:self.starts[s + 1]]] += self.impacts[s] * queries[:, self.components[s]]
            scores += given.T
        else:  # many postings: all at once
            part, sizes = np.zeros(self.exact.shape), np.diff(self.starts[begin:end + 1])
            part[self.rows[a:b], np.repeat(self.components[begin:end], sizes)] = np.repeat(self.impacts[begin:end], sizes)
            scores += queries @ part.T

    def candidates(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all rows that may be among a query's k best.

        Segments are read by descending impact. A query stops at a proof: every row left out has an
        upper bound below the k-th lower bound, and few are left in. At the end all that no proof
        excludes are left in.
        """
        norms = np.sqrt((queries**2).sum(axis=1))
        rounding = 4e-16 * (queries.shape[1] + 16)
        scores, open_, begin, found = np.zeros((len(queries), len(self.ids))), np.arange(len(queries)), 0, []
        for stop, unread in zip(self.stops, self.unread):
            self._add(scores, queries[open_], begin, stop)
            begin, last = stop, stop == self.stops[-1]
            left = unread + rounding * self.norms
            # Where even the least slack covers all scores nothing can be excluded.
            if not last and (scores.max(axis=1) - scores.min(axis=1) <= 2 * left.min() * norms[open_]).all():
                continue
            slack = np.outer(norms[open_], left)
            own = ids[open_][:, None] == self.ids  # the query's own rows are no candidates
            sure = np.full(len(open_), -np.inf)
            if len(self.ids) > k:
                low = scores - slack
                low[own] = -np.inf
                sure = np.partition(low, -k, axis=1)[:, -k]
            slack += scores
            alive = (slack >= sure[:, None]) & ~own
            done = np.full(len(open_), True) if last else alive.sum(axis=1) <= max(4 * k, len(self.ids) // 64)
            q, rows = np.nonzero(alive & done[:, None])
            found.append((open_[q], rows))
            scores, open_ = scores[~done], open_[~done]
            if not len(open_):
                break
        return np.concatenate([q for q, _ in found]), np.concatenate([r for _, r in found])

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
        """(query_id, vec_id, score): the k best rows of this block for each query."""
        as_float = queries.astype("float64")
        q, rows = self.candidates(ids, as_float, k)
        bound = float(np.sqrt((as_float**2).sum(axis=1)).max(initial=0)) * float(self.norms.max(initial=0)) * 2
        if bound < EXACT and len(q) * 8 > len(ids) * len(self.ids):
            scores = (as_float @ self.exact.T)[q, rows].astype("int64")
        elif bound < LONG:
            step = max(1, CELLS // self.vectors.shape[1])
            parts = [(queries[q[i:i + step]] * self.vectors[rows[i:i + step]]).sum(axis=1) for i in range(0, len(q), step)]
            scores = np.concatenate(parts) if parts else np.zeros(0, "int64")
        else:  # Python integers
            said = [sum(int(a) * int(b) for a, b in zip(queries[i], self.vectors[j])) for i, j in zip(q, rows)]
            scores = np.array([max(-LARGEST, min(LARGEST, s)) for s in said], "int64")
        order = np.lexsort((self.ids[rows], -scores, q))
        q, rows, scores = q[order], rows[order], scores[order]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < k
        return pd.DataFrame({"query_id": ids[q[kept]], "vec_id": self.ids[rows[kept]], "score": scores[kept]})


def _search_pair(frame: pd.DataFrame, index: pd.DataFrame, k: int) -> pd.DataFrame:
    """A block of queries against a block of the index."""
    none = pd.DataFrame({c: np.zeros(0, "int64") for c in ("query_id", "vec_id", "score")})
    if not len(frame) or not len(index):
        return none
    block, ids = ImpactBlock(index.iloc[0].to_dict()), frame["vec_id"].to_numpy("int64")
    queries = np.stack(frame["v"].to_numpy()).astype("int64")
    return pd.concat([none, *(block.search(ids[i:i + TOGETHER], queries[i:i + TOGETHER], k) for i in range(0, len(ids), TOGETHER))])


def _blocks(vectors: DataFrame) -> int:
    """How many blocks the vectors make."""
    n, cells = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("v")), F.lit(0))).first()
    return max(-(-n // BLOCK), -(-cells // CELLS))


def _dealt(n: int) -> Column:
    """A block for every row, by its place: copies of one row are spread too. The rows have to be stable()."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")


def impact_index(vectors: DataFrame, n: int) -> DataFrame:
    """The index of (vec_id, v) in n blocks for each length of vectors: INDEX, one row per block, written once."""
    dealt = vectors.select(F.size("v").alias("_d"), _dealt(n).alias("_block"), "vec_id", "v")
    return stable(dealt.groupBy("_d", "_block").applyInPandas(build_block, INDEX))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products, ties to smaller ids.

    Both inputs are (vec_id, v) of integer components; other columns are ignored. A query is never its
    own answer, nor is a row of its id. Vectors of another length than the query have no score with it,
    those without components none at all; an empty side gives an empty result; fewer than k others give
    fewer rows. Repeated vectors count once each, repeated queries are asked once; different queries of
    one id share its k answers. A score beyond a long counts as the nearest long.

    Vectors are dealt into blocks, each of which is indexed once; queries are dealt into blocks too, and every
    pair of blocks is searched by itself, so that no task holds more than two blocks and the driver sees
    two counts. k rows per query and block go on. What is shuffled are the blocks, once per block of the
    other side: with 8192 rows a block that is about a byte for 20 multiplications.
    """
    spark = vectors.sparkSession
    full = F.size("v") > 0
    vectors = stable(vectors.select("vec_id", "v").where(full))
    queries = stable(queries.select("vec_id", "v").where(full).dropDuplicates())
    n, m = _blocks(vectors), _blocks(queries)
    if not n or not m:
        return spark.createDataFrame([], "query_id LONG, rank INT, vec_id LONG, score LONG")
    pair, tasks = ["_d", "_block", "_queries"], min(n * m, TASKS)
    index = impact_index(vectors, n).withColumn("_queries", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    asked = queries.select(
        F.size("v").alias("_d"), _dealt(m).alias("_queries"), "vec_id", "v"
    ).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    found = (
        asked.repartition(tasks, *pair).groupBy(*pair)
        .cogroup(index.repartition(tasks, *pair).groupBy(*pair))
        .applyInPandas(lambda x, y: _search_pair(x, y, k), "query_id LONG, vec_id LONG, score LONG")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
