"""What Python workers of the document pipeline hold."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from screenlake.llm import common, packing, quality, shingles
from screenlake.session import BATCH_SETTING, TEXTS_AT_ONCE

TEXTS = [f"word{i} and {'some more ' * (i % 40)}|! {i}" for i in range(20_000)]


def test_statistics_need_little_beside_the_texts(monkeypatch):
    texts = pa.array(TEXTS, pa.large_string())
    small = quality.statistics(texts[:200])
    tracemalloc.start()
    got = quality.statistics(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
    assert np.array_equal(got[:200], small)


def test_hashes_do_not_depend_on_the_segment(monkeypatch):
    texts = pa.array([*TEXTS[:300], "x" * 5000, None], pa.large_string())
    want = shingles.word_hashes(texts)
    monkeypatch.setattr(shingles, "SEGMENT", 64)
    got = shingles.word_hashes(texts)
    assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])


def test_a_worker_gives_back_at_the_end_of_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append("end"))

    def work(frames, most):
        for frame in frames:
            calls.append(len(frame))
            yield frame.head(most)

    frames = [pd.DataFrame({"x": range(n)}) for n in (3, 1)]
    assert [len(f) for f in common.lean(work, 2)(iter(frames))] == [2, 1]
    assert calls == [3, 1, "end"]


def test_texts_are_tokenised_a_few_at_once(spark, monkeypatch):
    rows, kept, before = [], packing.stable, spark.conf.get(BATCH_SETTING)

    def watched(df):
        rows.append(int(spark.conf.get(BATCH_SETTING)))
        return kept(df)

    monkeypatch.setattr(packing, "stable", watched)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id LONG, text STRING")
    assert sum(r["length"] for r in packing.pack(docs).collect()) == 4
    assert rows[0] <= TEXTS_AT_ONCE and spark.conf.get(BATCH_SETTING) == before


def test_scores_of_every_row_and_empty_texts(spark):
    """Scored in Arrow batches, without Python strings: the same as of each text alone."""
    rng = np.random.default_rng(3)
    x = quality.statistics(pa.array(TEXTS[:400], pa.large_string())) + rng.normal(0, 0.01, (400, len(quality.STATISTICS)))
    halves = [x[::2], x[1::2]]
    model = quality.fit_moments(np.array([200, 200]), np.array([h.sum(axis=0) for h in halves]), np.array([h.T @ h for h in halves]))
    docs = spark.createDataFrame([*enumerate(TEXTS[:50]), (50, None), (51, "")], "doc_id LONG, text STRING")
    scored = quality.score_quality(docs, model)
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    want = model.score(quality.statistics(pa.array([*TEXTS[:50], "", ""], pa.large_string())))
    assert np.allclose([got[i] for i in range(52)], want)
    assert "pandas_udf" not in scored._jdf.queryExecution().toString() and len(got) == 52
