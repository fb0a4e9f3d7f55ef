"""Queries of the document operators: against SQL, against brute force, and on odd tables."""

import re
import zlib
from hashlib import sha256

import brute
import corpus_pipeline
import duckdb
import numpy as np
import pandas as pd
import pytest
from compare import compare
from conftest import DOCS

from screenlake.llm.oracles import ORACLES
from screenlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    ok, note = compare(spark, con, name, SF_DIR)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op10_exact_top_k", "op1_pack_sequences", "op12_url_filter"}))
def test_one_row_per_row(spark, edge_dirs, rows, name):
    got = QUERIES[name](spark, edge_dirs["rows"]).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert QUERIES[name](spark, edge_dirs["empty"]).collect() == []


def check_packing(df, ids_of):
    """Every id in exactly one piece, checksums right, sequences gapless and full."""
    tokens = 0
    for doc_id, pieces in df.groupby(df["doc_id"].map(str)):
        ids = ids_of[doc_id]
        at = 0
        copies = sorted(pieces.itertuples(), key=lambda r: (r.start, r.sequence_id, r.offset))
        times = sum(r.start == 0 for r in copies)
        # Copies of a document may be cut differently; each start and length occurs as a chain.
        assert sum(r.length for r in copies) == times * len(ids)
        for r in copies:
            assert r.doc_tokens == len(ids)
            assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
            at += r.length
        tokens += at
    for _, pieces in df.groupby("sequence_id"):
        at = 0
        for r in sorted(pieces.itertuples(), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)
    return tokens


def ids_by_doc(pairs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {str(i): np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for i, x in pairs}


def test_packing_is_a_round_trip_without_padding(spark, docs):
    got = QUERIES["op1_pack_sequences"](spark, SF_DIR).toPandas()
    ids = ids_by_doc(zip(docs.doc_id, docs.text))
    assert set(got["doc_id"].map(str)) == set(ids)
    assert check_packing(got, ids) == sum(map(len, ids.values()))


def test_packing_of_odd_rows(spark, edge_dirs, rows):
    got = QUERIES["op1_pack_sequences"](spark, edge_dirs["rows"]).collect()
    frame = pd.DataFrame([r.asDict() for r in got])
    frame["doc_id"] = pd.Series([str(r.doc_id) for r in got], dtype=object)
    ids = ids_by_doc((r[0], r[1]) for r in rows)
    check_packing(frame, ids)
    assert frame["length"].sum() == sum(len(ids[str(r[0])]) for r in rows)
    assert QUERIES["op1_pack_sequences"](spark, edge_dirs["empty"]).count() == 0


def test_special_tokens_and_rare_characters_have_the_reference_ids(spark):
    texts = ["a<|endoftext|>b", "naïve Ωmega​漢字", "tab\x85next\xa0line", "x" * 5000, "🙂 smile"]
    got = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    from screenlake.llm.packing import pack

    assert check_packing(pack(got).toPandas(), ids_by_doc(enumerate(texts))) > 0


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op2_quality_classifier"](spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()
    held = got[got["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() >= 0.97


def test_quality_model_by_the_textbook(spark):
    """Moments, shrunk covariances and log-densities against numpy's own, on the rows that the fit takes."""
    import pyarrow as pa

    from screenlake.llm import quality

    sf = "/root/testdata/sf0.01"
    frame, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit(frame, labels)
    both = pd.read_parquet(f"{sf}/documents.parquet").merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    own = both[both["quality"].isin([0, 1]) & both["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 != 0)]
    assert 0 < len(own) < 20_000
    x = quality.statistics(pa.array(own["text"].fillna("").tolist(), pa.large_string()))
    y = own["quality"].to_numpy().astype(int)
    scale = np.sqrt(np.maximum(x.var(axis=0), 1e-8))
    z = x / scale
    covs = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum(c * (y == k).mean() for k, c in enumerate(covs))
    some = both["text"].fillna("").tolist()[:300]
    points = quality.statistics(pa.array(some, pa.large_string())) / scale
    density = []
    for k, cov in enumerate(covs):
        cov = (1 - quality.TO_POOLED) * cov + quality.TO_POOLED * pooled
        cov = (1 - quality.TO_IDENTITY) * cov + quality.TO_IDENTITY * np.trace(cov) / len(cov) * np.eye(len(cov))
        away = points - z[y == k].mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)
        density.append(-0.5 * (distance + np.linalg.slogdet(cov)[1]))
    apart = density[1] - density[0] + np.log((y == 1).mean() / (y == 0).mean())
    want = 1 / (1 + np.exp(-np.clip(apart / quality.TEMPERATURE, -500, 36)))
    got = model.score(quality.statistics(pa.array(some, pa.large_string())))
    assert np.abs(got - want).max() < 1e-6 and 0.05 < (got > 0.5).mean() < 0.999


def test_fingerprints_estimate_likeness(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op5_document_fingerprints"](spark, SF_DIR).collect()}
    order = docs.sort_values("doc_id", ascending=False)
    texts = order.text.fillna("").tolist()
    errors = []
    for k, (i, text) in enumerate(zip(order.doc_id, texts)):
        after, half = texts[(k + 1) % len(texts)], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].edited_sha256 == sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text)
        own = brute.shingles(text)
        errors += [got[i].near_edited - brute.jaccard(own, brute.shingles(edited)), got[i].near_next - brute.jaccard(own, brute.shingles(after))]
    assert abs(np.mean(errors)) < 0.01 and np.sqrt(np.mean(np.square(errors))) < 0.05
    by_text = {}
    for i, text in zip(order.doc_id, texts):
        assert by_text.setdefault(text, got[i].fingerprint) == got[i].fingerprint


def test_fingerprints_of_hot_ids(spark):
    """Null and repeated ids that hold most rows are cut over tasks; everyone still meets the row behind."""
    from screenlake.llm.fingerprints import Chunks, fingerprint_documents

    rows = [(None, f"text number {i} of those without an id {i * i}") for i in range(60)]
    rows += [(7, f"another one {i % 25} with an id") for i in range(50)] + [(i, f"own id {i}") for i in range(20)]
    got = fingerprint_documents(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    # Each id's rows are followed by one another, and its last by a row of the next id: every text follows exactly one.
    ends = {}
    for i, text in rows:
        ends.setdefault(i, set()).add(text)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == sorted((i is None, i or 0, len(t)) for i, t in rows)
    halves = {}
    for i, text in rows:
        for j, after in {*rows}:
            half = len(text) // 2
            halves.setdefault((i, len(text), sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()), set()).add(j)
    following = [halves[r.doc_id, r.n_chars, r.edited_sha256] for r in got]
    order = [*sorted((i for i in ends if i is not None), reverse=True), None]
    for r, met in zip(got, following):
        k = order.index(r.doc_id)
        assert met & {r.doc_id, order[(k + 1) % len(order)]}
    chunks = Chunks([-5, -5, -5, 7, 9, 9])
    ids, ties = np.repeat(np.array([12, 9, 8, 7, -5, -6]), 400), np.tile(np.linspace((1 << 63) - 1024, 0, 400).astype(np.int64), 6)
    found = chunks.of(ids, ties)
    assert chunks.count == 7 and (np.diff(found) >= 0).all() and set(found) == set(range(7))
    assert np.bincount(found[ids == -5]).max() <= 134


def test_line_dedup_of_odd_rows(spark, edge_dirs):
    got = {r.doc_id: r for r in QUERIES["op6_line_dedup"](spark, edge_dirs["rows"]).collect()}
    assert (got[1].n_dropped, got[4].n_dropped, got[None].n_dropped, got[2].n_lines, got[6].n_lines) == (0, 2, 2, 1, 4)
    assert got[4].kept_sha256 == sha256(b"short").hexdigest()


def test_line_threshold_counts_documents(spark):
    from screenlake.llm.line_dedup import dedup_lines

    docs = spark.createDataFrame([(i, "a line of text\nanother line\na line of text" if i < 2 else "A LINE OF TEXT ") for i in range(3)], "doc_id LONG, text STRING")
    got = {r.doc_id: r.kept_text for r in dedup_lines(docs, min_docs=3).collect()}
    assert got == {0: "a line of text\nanother line\na line of text", 1: "another line", 2: ""}


def near_duplicates_by_brute_force(pairs):
    """Classes by the operator's own weights, over all pairs that share a shingle."""
    from collections import defaultdict

    import pyarrow as pa

    from screenlake.llm.near_dedup import Weights, vectors, weighted_jaccard

    ids = [i for i, _ in pairs]
    hashes, weights, counts = vectors(pa.array([t or "" for _, t in pairs]), Weights(np.array([], np.int64), np.array([])))
    first = np.cumsum(counts) - counts
    vec = [(hashes[a:a + n], weights[a:a + n]) for a, n in zip(first, counts)]
    met, empty = defaultdict(list), []
    for k, (h, _) in enumerate(vec):
        for x in h.tolist():
            met[x].append(k)
        if not len(h):
            empty.append(k)
    candidates = {(a, b) for held in met.values() for n, b in enumerate(held) for a in held[:n]}
    links = [(ids[a], ids[b]) for a, b in candidates if weighted_jaccard(vec[a], vec[b]) >= 0.8]
    return brute.classes([*links, *((ids[empty[0]], ids[k]) for k in empty)], ids)


def test_near_duplicates_equal_brute_force(spark, docs, monkeypatch):
    from screenlake.llm import near_dedup

    monkeypatch.setattr(near_dedup, "COMMON", 1.0)  # no shingle is common: plain weights
    monkeypatch.setattr(near_dedup, "shingle_weights", lambda *a: near_dedup.Weights(np.array([], np.int64), np.array([])))
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicate_classes(frame).collect()}
    assert got == near_duplicates_by_brute_force(list(zip(docs.doc_id, docs.text)))


def test_chain_of_edits_is_one_class(spark):
    """Neighbours are alike, ends are not; one large family, no pair of which may be lost."""
    from screenlake.llm.near_dedup import near_duplicate_classes

    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(120):
        text = list(base)
        text[k] = f"edit{k}"
        text[(k + 60) % 200] = f"more{k}"
        texts.append((k, " ".join(text)))
    far = [(1000 + k, " ".join(f"z{k}_{i}" for i in range(50))) for k in range(5)]
    docs = spark.createDataFrame([*texts, *far], "doc_id LONG, text STRING")
    got = {r.doc_id: r.class_id for r in near_duplicate_classes(docs).collect()}
    assert all(got[k] == 0 for k in range(120)) and all(got[1000 + k] == 1000 + k for k in range(5))


def test_block_sums_equal_pair_by_pair():
    """Sums of smaller weights as products of matrices, with weights that differ between texts, and empty texts."""
    import random

    from screenlake.llm import near_dedup

    rng = random.Random(3)
    words = [rng.getrandbits(63) for _ in range(400)]
    texts = [{w: rng.choice((0.9, 1.0, 1.0, 1.7, 1 + np.log(3))) for w in rng.sample(words, rng.randrange(0, 200))} for _ in range(60)]
    vecs = [(np.array(sorted(t), np.uint64), np.array([t[k] for k in sorted(t)])) for t in texts]
    near_dedup.COLUMNS, before = 37, near_dedup.COLUMNS
    try:
        low = near_dedup.common_weights(vecs)
    finally:
        near_dedup.COLUMNS = before
    for i, a in enumerate(vecs):
        for j, b in enumerate(vecs[:i]):
            total = a[1].sum() + b[1].sum()
            if len(a[0]) and len(b[0]):
                assert abs(low[i, j] / (total - low[i, j]) - near_dedup.weighted_jaccard(a, b)) < 1e-9
            else:
                assert low[i, j] == 0


def weighted_classes(pairs):
    """Classes over all pairs, from the words of the docstring: shingles, 1 + ln(count) times idf, weighted Jaccard."""
    import math

    counts = [brute.shingles(t) for _, t in pairs]
    df = {}
    for c in counts:
        for x in c:
            df[x] = df.get(x, 0) + 1
    idf = lambda x: max(0.9, min(1.0, math.log(len(pairs) / df[x]) / math.log(100))) if df[x] > 0.01 * len(pairs) else 1.0
    vec = [{x: (1 + math.log(n)) * idf(x) for x, n in c.items()} for c in counts]
    total, holders = [sum(v.values()) for v in vec], {}
    for k, v in enumerate(vec):
        for x in v:
            holders.setdefault(x, []).append(k)
    common = {}
    for x, held in holders.items():
        for n, b in enumerate(held):
            for a in held[:n]:
                common[a, b] = common.get((a, b), 0.0) + min(vec[a][x], vec[b][x])
    ids = [i for i, _ in pairs]
    links = [(ids[a], ids[b]) for (a, b), low in common.items() if low / (total[a] + total[b] - low) >= 0.8]
    empty = [i for i, v in zip(ids, vec) if not v]
    return brute.classes([*links, *((empty[0], i) for i in empty)], ids)


def test_near_duplicates_with_weights_equal_brute_force(spark, docs, monkeypatch):
    """The query as it is; then families of several templates, in blocks of a few documents."""
    from screenlake.llm import near_dedup

    got = {r.doc_id: r.class_id for r in QUERIES["op7_near_duplicates"](spark, SF_DIR).collect()}
    assert got == weighted_classes(list(zip(docs.doc_id.tolist(), docs.text.tolist())))
    rng = np.random.default_rng(4)
    texts = []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(120)]
        for _ in range(25):
            words = list(base)
            for at in rng.choice(120, rng.integers(0, 5), replace=False):
                words[at] = f"x{rng.integers(0, 6)}"
            texts.append(" ".join(words + base[: rng.integers(0, 30)]))
    pairs = list(enumerate(texts))
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    found = near_dedup.near_duplicate_classes(spark.createDataFrame(pairs, "doc_id LONG, text STRING").repartition(3))
    # Pairs at the threshold meet in no bucket with a probability of some in 100,000.
    assert {r.doc_id: r.class_id for r in found.collect()} == weighted_classes(pairs)


def template_family(spark, n):
    """Pages of one template: 300 shingles that all share, 36 of their own; alike, but below the threshold."""
    shared = [f"t{i}" for i in range(304)]
    return spark.createDataFrame([(i, " ".join([*shared, *(f"d{i}x{k}" for k in range(36))])) for i in range(n)], "doc_id LONG, text STRING").repartition(8)


def test_template_families_cost_their_members_and_not_their_pairs(spark, monkeypatch):
    from screenlake.llm import near_dedup

    left = []
    real = near_dedup._compared_in_blocks
    monkeypatch.setattr(near_dedup, "_compared_in_blocks", lambda cells, *a: left.append(cells.count()) or real(cells, *a))
    got = near_dedup.near_duplicate_classes(template_family(spark, 900)).collect()
    assert all(r.class_id == r.doc_id for r in got) and left == [0]


def test_common_groups_are_counted_over_all_documents(spark):
    from pyspark.sql import functions as F

    from screenlake.llm.near_dedup import shingle_weights

    docs = spark.createDataFrame([(f"one two three four five tail{i}",) for i in range(300)], "_text STRING")
    found = shingle_weights(docs.withColumn("_text", F.col("_text")).repartition(7), 300)
    assert len(found.groups) == 1 and found.idf[0] == 0.9


def test_mixing_meets_targets(spark):
    got = QUERIES["op8_source_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    assert dict(zip(got.doc_id, got["size"])) == {i: len(brute.words(t)) for i, t in zip(docs.doc_id, docs.text)}
    assert (got["taken"] <= 3 * got["size"]).all()
    by = got.groupby("source").agg(size=("size", "sum"), said=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (by["size"] == by["said"]).all() and abs(by["target"].sum() - by["size"].sum()) < 1e-3
    assert ((by["taken"] - by["target"]).abs() <= 2).all()
    level = {w: by.iloc[[i for i in range(len(by)) if (5, 2, 1)[i % 3] == w]] for w in (5, 2, 1)}
    open_ = [set((x["target"] / w).round(6)[x["target"] < 3 * x["size"] - 1e-6]) for w, x in level.items()]
    assert len(set.union(*open_)) <= 1
    again = QUERIES["op8_source_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    assert dict(zip(got.doc_id, got.taken)) == dict(zip(again.doc_id, again.taken))


def test_subsets_come_as_near_as_any(spark):
    """Against all subsets, budgets below the limit of the dynamic program; above it the sum is met as well."""
    import random

    from screenlake.llm.mixing import fit_subset

    rng = random.Random(5)
    for _ in range(400):
        lengths = rng.sample(range(0, 60), rng.randint(1, 6))
        counts = [rng.randint(1, 4) for _ in lengths]
        sums = {0}
        for x, n in zip(lengths, counts):
            sums = {s + x * k for s in sums for k in range(n + 1)}
        budget = rng.randint(0, max(sums))
        taken = fit_subset(lengths, counts, budget)
        assert all(0 <= k <= n for k, n in zip(taken, counts))
        best = min(abs(s - budget) for s in sums)
        assert abs(sum(x * k for x, k in zip(lengths, taken)) - budget) == best, (lengths, counts, budget, taken)
    for _ in range(50):
        lengths = rng.sample(range(1, 3000), 200)
        counts = [rng.randint(1, 30) for _ in lengths]
        total = sum(x * n for x, n in zip(lengths, counts))
        budget = rng.randint(20_000, total)
        taken = fit_subset(lengths, counts, budget)
        assert sum(x * k for x, k in zip(lengths, taken)) == budget and all(0 <= k <= n for k, n in zip(taken, counts))
        # Above what the program fits, every length gives the same share.
        share = max(0, budget - 16_384) / total
        assert all(k >= int(n * share) for k, n in zip(taken, counts))


def test_mixing_of_odd_rows(spark, edge_dirs):
    got = {(r.doc_id, r.source): r for r in QUERIES["op8_source_mixing"](spark, edge_dirs["rows"]).collect()}
    assert got[2, None].source_size == 15 and got[None, None]["size"] == 15 and got[3, "s1"].taken == 0


def test_top_k_by_brute_force(spark):
    from screenlake.llm.topk import top_k

    rng = np.random.default_rng(5)
    v = rng.integers(-300, 300, (400, 8))
    v[50:60] = v[0]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id LONG, v ARRAY<LONG>").repartition(5)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in top_k(df, df.where("vec_id % 20 = 0"), 7).collect()]
    want = []
    for q in range(0, 400, 20):
        best = sorted((-int(v[q] @ v[c]), c) for c in range(400) if c != q)[:7]
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    assert sorted(got) == want


def test_top_k_in_many_blocks(spark, monkeypatch):
    """Several blocks on both sides; ties, repeated rows and ids, outliers, several lengths, products beyond 2^53 and 2^63."""
    from screenlake.llm import topk

    monkeypatch.setattr(topk, "BLOCK", 100)
    rng = np.random.default_rng(6)
    v = rng.normal(0, 40, (700, 12)).astype(int)
    v[100:260] = v[0]
    v[300, 3], v[301, 5], v[302] = 10**6, -(10**9), 0
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(700 + i, x[:3].tolist()) for i, x in enumerate(v[300:350])]
    rows += [(7, v[7].tolist())] * 30 + [(7, v[8].tolist()), (0, v[0].tolist())]
    rows += [(900 + i, [int(x) << 45 for x in y[:2]]) for i, y in enumerate(v[:20])] + [(950, [])]
    df = spark.createDataFrame(rows, "vec_id LONG, v ARRAY<LONG>").repartition(6)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id % 3 = 0"), 5).collect())
    want, most = [], (1 << 63) - 1
    for q in sorted({i for i, x in rows if i % 3 == 0 and x}):
        asked = next(x for i, x in rows if i == q)
        scored = [(-max(-most, min(most, sum(a * b for a, b in zip(asked, x)))), i) for i, x in rows if i != q and len(x) == len(asked)]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:5])]
    assert got == want


def test_top_k_segments_and_proof():
    """Postings descend by impact and give back the vectors; a proof spares what it excludes, and nothing else."""
    from screenlake.llm.topk import ImpactBlock, build_block

    rng = np.random.default_rng(7)
    v = (rng.normal(0, 1, (3000, 24)) ** 3 * 50).astype("int64")
    block = ImpactBlock(build_block((24, 0), pd.DataFrame({"vec_id": np.arange(3000), "v": list(v)})).iloc[0].to_dict())
    assert (np.diff(np.abs(block.impacts)) <= 0).all() and len(block.rows) == (v != 0).sum()
    assert (np.diff(block.unread.max(axis=1)) <= 0).all() and len(block.stops) > 2
    queries = v[::100].astype("float64")
    q, rows = block.candidates(np.arange(0, 3000, 100), queries, 5)
    score = queries @ v.T
    for i in range(len(queries)):
        best = [r for r in np.lexsort((np.arange(3000), -score[i])) if r != 100 * i][:5]
        mine = rows[q == i]
        assert set(best) <= set(mine) and len(mine) < 300


def test_top_k_of_odd_rows(spark, edge_dirs):
    got = [tuple(r) for r in QUERIES["op10_exact_top_k"](spark, edge_dirs["rows"]).collect()]
    assert sorted(got) == sorted([(0, 1, 3, 3226), (0, 2, 3, 3226), (0, 3, 100, -5980), (100, 1, 0, -5980), (100, 2, 3, -5980), (100, 3, 3, -5980)])
    assert QUERIES["op10_exact_top_k"](spark, edge_dirs["empty"]).collect() == []


def test_secret_spans(spark):
    from screenlake.llm.secrets import ASSIGN, ACCESS, base_spans, spans_of

    named = lambda t: [t[a:b] for a, k, b in spans_of(t) if k == "named"]
    assert named('A1 = "zX81kQpp"\nB2 = "77Lmno-x"\nmy_auth_token = A1 + B2\n') == ["zX81kQpp", "77Lmno-x"]
    assert named('x = T1\nT1 = "aB3dE5fG7"\nauth_token=x') == ["aB3dE5fG7"]
    assert named('{"apiKey": "abcDEF123456", "user": "joe"}') == ["abcDEF123456"]
    assert named('secret_key: str = "Zq81mmKq0s"\n') == ["Zq81mmKq0s"]
    assert named("export DB_PASS=Sup3rS3cr3t!\n") == ["Sup3rS3cr3t!"]
    assert named('password_file = "/etc/xx12AAbb"\nThe key: value and pass: something else') == []
    for text in ("password: abc token=abcdefgh", "secret=token: abcdef123", "AKIAAKIA AKIA" + "B2" * 9, "TOKEN='" + "f" * 30 + "'", "Key tokſen api-key apikey=123456"):
        want = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        want += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        want += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
        assert sorted(base_spans(text)) == sorted(want)


def test_personal_data_by_brute_force(spark):
    from screenlake.llm.pii import find_personal_data

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(int(c) * 2, 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(d := re.sub("[^0-9]", "", s)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15),
    }
    texts = [
        "a@b.c_x@y.org, é.f@g-h.io; 1.2.3.4.5 and 999.1.1.1 or 000.00255.1.2",
        "4111 1111 1111 1111, 4111-1111-1111-1112 +1 (555) 555-7713x +49 30 1234567 8 9 +12",
        "12345678901234567890123456789012 4111111111111111 4111111111111111",
        "漢字 x@y.zz 🙂 10.0.0.1 iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, GB83WEST12345698765432; ssn 123-45-6789, 123-45-6789",
    ]
    got = {r.doc_id: r.spans for r in find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")).collect()}
    for i, text in enumerate(texts):
        want = [(k, m.start(), m.end()) for k, (p, ok) in checks.items() for m in re.finditer(p, text) if ok(m[0])]
        assert [(s.name, s.start, s.end) for s in got[i] if s.name in checks] == want
    assert [texts[3][s.start:s.end] for s in got[3] if s.name == "iban"] == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    assert [s.score for s in got[3] if s.name == "ssn"] == [0.8, 0.8]


def test_personal_data_context_equals_sql(spark, tmp_path):
    """Several numbers under one heading, words after a span, words just inside and outside of the window."""
    ssn = "123-45-6789"
    texts = [
        f"SSN list: {ssn}, 234-56-7890, 345-67-8901", f"{ssn} (ssn) and 234-56-7890", f"ssn{' ' * 37}{ssn}", f"ssn{' ' * 38}{ssn}",
        f"{ssn}{' ' * 38}ssn", f"{ssn}{' ' * 37}ssn", f"é🙂 bank {ssn}\ntaxpayer\n{ssn} 漢字 mail a@b.com c@d.org phone 1.2.3.4", "", None,
    ]
    spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    ok, note = compare(spark, con, "op9_personal_data", str(tmp_path))
    assert ok, note
    got = {r.doc_id: r.spans for r in QUERIES["op9_personal_data"](spark, str(tmp_path)).collect()}
    assert [got[i].count("ssn") for i in range(7)] == [3, 2, 1, 0, 0, 1, 2]


def test_personal_data_context_in_four_languages(spark, tmp_path):
    """Words of the texts' languages, accents and upper case too, count alike in operator and SQL."""
    from screenlake.llm.pii import find_personal_data

    said = ["Sozialversicherungsnummer", "SÉCURITÉ", "sécurité", "securite", "Seguridad", "steuernummer", "CONTRIBUYENTE", "nothing", "insecurity", "socially"]
    phones = ["Téléphone", "TÉLÉPHONE", "teléfono", "Rufnummer", "móvil", "telefonica"]
    texts = [f"{w}: 123-45-6789" for w in said] + [f"{w} +49 30 1234567" for w in phones] + [f"{w}, DE89 3704 0044 0532 0130 00" for w in ("Überweisung", "virement", "cuenta", "x")]
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    frame.to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    ok, note = compare(spark, con, "op9_personal_data", str(tmp_path))
    assert ok, note
    got = [[(s.name, s.score) for s in r.spans] for r in find_personal_data(spark.createDataFrame(frame)).sort("doc_id").collect()]
    assert got[:10] == [[("ssn", 0.8)]] * 7 + [[]] * 3
    assert got[10:16] == [[("phone", 0.9)]] * 5 + [[("phone", 0.6)]]
    assert [[x for x in g if x[0] == "iban"] for g in got[16:]] == [[("iban", 1.0)]] * 3 + [[("iban", 0.8)]]


def test_license_of_whole_text_and_lines(spark):
    from screenlake.llm.licenses import scan_licenses

    texts = ["Copyright (c) 2020 Someone\nRELEASED under   the MIT Licence!", "prose\nLicensed under CC-BY-NC 4.0\nprose", "not the MIT License", None]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")).collect()}
    assert (got[0].text_license, got[0].n_notices) == ("MIT", 1)
    assert (got[1].text_license, got[1].notice_licenses) == (None, "CC-BY-NC-4.0")
    assert (got[2].n_notices, got[3].text_license) == (0, None)
    known = spark.createDataFrame([("X", "not the mit licence"), ("A", "Not the MIT license"), ("E", "")], "license STRING, text STRING")
    again = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING"), known).collect()}
    assert again[2].text_license == "A" and again[0].text_license is None and again[3].text_license is None


def test_license_texts_equal_sql(spark, tmp_path):
    """Complete texts and headers: alone, wrapped anew, commented out, under copyright lines, inside prose, next to each other, and changed."""
    import textwrap

    from screenlake.llm.licenses import known_texts

    # Of the long ones those whose copyright lines are paragraphs: one that is wrapped into a sentence is not found, by SQL nor operator.
    short = [x for x in known_texts() if len(x[1]) < 2000]
    known = short[::2] + [next(x for x in known_texts() if x[0] == license and len(x[1]) > 2000) for license in ("Artistic-1.0", "Apache-2.0", "MPL-2.0", "CC0-1.0")]
    texts = ["", "Copyright (c) 2001 A\n", "copyright notice of the licence\nlicense\n"]
    for k, (_, text) in enumerate(known):
        wrapped = "\n\n".join(textwrap.fill(x, 30 + 17 * (k % 4), break_long_words=False) for x in text.split("\n\n"))
        commented = "".join(f" * {x}\n" for x in text.split("\n"))
        texts += [
            text, f"Copyright 2020 Some Body\n(c) 2021 others\n\n{wrapped}", f"Some prose before.\n{commented}and after it\n{text.upper()}",
            f"{wrapped}\n{known[k - 1][1]}\nCopyright holder and licence", text.replace("license", "licence").replace("the", "a", 1), f"same line {text}",
        ]
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    frame.to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    ok, note = compare(spark, con, "op3_license_scan", str(tmp_path))
    assert ok, note
    got = [r for r in QUERIES["op3_license_scan"](spark, str(tmp_path)).sort("doc_id").collect()]
    for k, (license, _) in enumerate(known):
        alone, wrapped, inside, pair, changed, shared = got[3 + 6 * k:9 + 6 * k]
        assert alone.text_license == wrapped.text_license is not None and inside.text_license is None
        assert inside.n_notices >= 2 and pair.n_notices >= 2 and alone.text_license in inside.notice_licenses.split(",")


def test_pipeline_stages(spark, docs, tmp_path):
    """Each stage on what the one before wrote, against plain Python."""
    frame, seen = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = frame.toPandas()
        if name != "packing":
            assert frame.columns == columns
    scores = QUERIES["op2_quality_classifier"](spark, SF_DIR).toPandas()
    good = set(scores[scores.predicted == 1].doc_id)
    assert set(seen["quality_classifier"].doc_id) == good
    lines = brute.kept_lines([(i, t) for i, t in zip(docs.doc_id, docs.text) if i in good])
    assert {i: t for i, t in zip(seen["line_dedup"].doc_id, seen["line_dedup"].text)} == {i: x[2] for i, x in lines.items()}
    assert (seen["line_dedup"].n_chars == seen["line_dedup"].text.str.len()).all()
    near = near_duplicates_by_brute_force(list(zip(seen["line_dedup"].doc_id, seen["line_dedup"].text)))
    kept = set(seen["near_dedup"].doc_id)
    assert len(kept) == len(seen["near_dedup"]) and {near[i] for i in kept} == set(near.values())
    mixed = seen["mixing"].doc_id.value_counts()
    assert set(mixed.index) <= kept and mixed.max() <= 3
    ids = ids_by_doc(zip(seen["mixing"].doc_id, seen["mixing"].text))
    assert check_packing(seen["packing"], ids) == sum(len(ids[str(i)]) * n for i, n in mixed.items())


def test_stages_keep_columns_named_like_their_own(spark, edge_dirs):
    """Types and values of columns that operators use the names of, and the text and number of characters as changed."""
    rows = [(i, f"a line that repeats\nand one of its own {i}\nx", 77 + i, f"d{i}", None if i % 2 else "kept", i / 2, f"doc{i}", "s", 0) for i in range(6)]
    schema = "doc_id LONG, text STRING, n_lines INT, N_Dropped STRING, kept_text STRING, _quality DOUBLE, _doc STRING, source STRING, n_chars INT"
    docs = spark.createDataFrame(rows, schema)
    stages = dict(corpus_pipeline.STAGES)
    out = stages["line_dedup"](spark, docs, edge_dirs["rows"])
    assert out.dtypes == docs.dtypes
    want = []
    for i, text, *rest, _ in rows:
        kept = text if i == 0 else text.split("\n", 1)[1]
        want.append((i, kept, *rest, len(kept)))
    assert sorted(map(tuple, out.collect())) == want
    for name in ("quality_classifier", "near_dedup", "mixing"):
        got = stages[name](spark, docs, edge_dirs["rows"])
        assert got.dtypes == docs.dtypes
        assert set(map(tuple, got.collect())) <= set(rows), name


def test_pipeline_of_odd_rows(spark, edge_dirs):
    assert corpus_pipeline.run(spark, edge_dirs["rows"]).count() > 0
    assert corpus_pipeline.run(spark, edge_dirs["empty"]).count() == 0
    assert DOCS.startswith("doc_id")


def base_spans_by_the_contract(text):
    """Written from the words of the contract, not from the operator's patterns."""
    import regex

    def found(pattern, holds, flags=0):
        return [(m.start(), m.end()) for m in regex.compile(pattern, flags | regex.ASCII).finditer(text) if holds(m)]

    word = "(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else "_?" if c == "?" else c for c in w) for w in ("password", "passwd", "secret", "token", "api?key")) + ")"
    spans = [(s, 0, "assign", e) for s, e in found(word + "[\"']?[ ]*[:=][ ]*[\"']?([A-Za-z0-9+/_.=\\-]+)", lambda m: len(m[1]) >= 6)]
    spans += [(s, 1, "access", e) for s, e in found("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20)]
    spans += [(s, 2, "hex", e) for s, e in found("[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    return [(s, k, e) for s, _, k, e in sorted(spans)]


def test_secret_query_equals_the_contract(spark, docs, edge_dirs, rows):
    for d, pairs in ((SF_DIR, list(zip(docs.doc_id, docs.text))), (edge_dirs["rows"], [r[:2] for r in rows])):
        got = QUERIES["op4_secret_scan"](spark, d).collect()
        want = []
        for i, text in pairs:
            base = base_spans_by_the_contract(text or "")
            said = ",".join(f"{k}:{s}:{e}" for s, k, e in base)
            want.append((i, *(sum(k == x for _, k, _ in base) for x in ("assign", "access", "hex")), sha256(said.encode()).hexdigest()))
        assert sorted(map(str, ((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got))) == sorted(map(str, want))
        for r in got:
            # The method adds spans, base ones stay.
            assert sha256(",".join(x for x in r.spans.split(",") if not x.startswith("named:")).encode()).hexdigest() == r.base_sha256


def test_secrets_over_several_lines():
    from screenlake.llm.secrets import spans_of

    named = lambda t: [t[a:b] for a, k, b in spans_of(t) if k == "named"]
    assert named('token = """abC\ndef123"""\n') == ["abC\ndef123"] and named("token = '''Zq81\n'mm'Kq0s'''") == ["Zq81\n'mm'Kq0s"]
    assert named("private_key: |\n  -----BEGIN RSA PRIVATE KEY-----\n  abc\n\n  def\nother: 1") == ["-----BEGIN RSA PRIVATE KEY-----\n  abc\n\n  def"]
    assert named("a:\n  token: >-\n    Zq81mm\n    Kq0s77\n  user: joe\n") == ["Zq81mm\n    Kq0s77"]
    assert named('<add key="db_password" value="Xy81kk-Qp0"/>') == ["Xy81kk-Qp0"]
    assert named('{"name": "API_TOKEN", "value": "a8sd7f6A8s7d6f"}, {"name": "title", "value": "Zq81mmKq0s"}') == ["a8sd7f6A8s7d6f"]
    assert named('k = "Zq81mmKq0s"; auth_token = k; k = ""') == ["Zq81mmKq0s"]
    # Circles end; what builds on itself is judged by its shares of characters.
    assert named("a = b\nb = a + 'x1Y2z3'\npassword = a") == ["x1Y2z3"]
    assert named("t0 = 'aB3dE5'\n" + "".join(f"t{i} = t{i - 1} + t{i - 1}\n" for i in range(1, 3000)) + "token = t2999") == ["aB3dE5"]


def test_secret_scan_is_linear():
    """Texts of a megabyte that used to take the square of their length."""
    import time

    from screenlake.llm.secrets import spans_of

    n = 1 << 20
    texts = [
        "token=" + "a=" * (n // 2), "token = " + "+".join("a" * (n // 2)), "token = " + "'" * n, "token = " + '"""' * (n // 3) + "\n", "token\n" * (n // 6),
        'token_0="aB3dE5fG7"\n' + "".join(f"token_{i} = token_{i - 1}\n" for i in range(1, n // 26)),
        "token_0='aB3dE5fG7'\n" + "".join(f"token_{i} = token_{i - 1} + token_{i - 1}\n" for i in range(1, n // 40)),
        "token = token\n" * (n // 14), "x=1\n" * (n // 8) + "token = x\n" * (n // 20), "".join(f"token{i}: |\n  aB3dE5f{i}\n" for i in range(n // 28)),
    ]
    for text in texts:
        start = time.perf_counter()
        spans_of(text)
        assert time.perf_counter() - start < 10, text[:60]
