"""Merkle manifest, URL filters and periodic runs: against brute force, on odd rows and on large groups."""

import random
import re
import zlib
from fractions import Fraction
from hashlib import sha256

import brute
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from screenlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


# -- Merkle manifest ---------------------------------------------------------------------


def merkle(rows):
    """Rows of the manifest query: (doc_id, text, lang, source, n_chars) in, sorted lists per source, nothing else."""
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(doc_id, text, lang, source, n_chars):
        return hashed(*map(field, (doc_id, source, lang, n_chars, text)))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([hashed(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def way(levels, at):
        for nodes in levels[:-1]:
            first = at // 3 * 3
            yield nodes[first:at], nodes[at + 1:first + 3]
            at //= 3

    by_source = {}
    for row in rows:
        doc_id, text, lang, source, n_chars = row
        odd = doc_id is None or text is None or zlib.crc32(str(doc_id).encode()) % 2
        checked = leaf(*row) if odd else leaf(doc_id, text.replace("\n", ""), lang, source, n_chars)
        by_source.setdefault(source, []).append((doc_id, leaf(*row), checked))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in by_source[s]])
    top = tree([trees[s][-1][0] for s in sources]) if sources else []
    out = []
    for n, s in enumerate(sources):
        for at, (doc_id, own, checked) in enumerate(by_source[s]):
            siblings, h = "", checked
            for left, right in [*way(trees[s], at), *way(top, n)]:
                siblings += "".join(left + right)
                h = hashed(*left, h, *right)
            out.append((doc_id, own, trees[s][-1][0], top[-1][0], hashed(siblings), h, h == top[-1][0]))
    return out


def manifest_rows(spark, d):
    got = QUERIES["op11_merkle_manifest"](spark, d)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(str, (tuple(r) for r in got.collect())))


def documents(spark, path, rows, schema=DOCS):
    spark.createDataFrame(rows, schema).repartition(7).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_manifest_of_odd_rows(spark, edge_dirs, rows):
    want = merkle([r[:5] for r in rows])
    assert manifest_rows(spark, edge_dirs["rows"]) == sorted(map(str, want))
    assert manifest_rows(spark, edge_dirs["empty"]) == []


def test_manifest_equals_brute_force(spark, tmp_path):
    """Ids of all signs and sizes, ids repeated and missing, one source with most rows, many with one."""
    rng = random.Random(5)
    pick = (lambda: rng.randrange(-50, 50), lambda: rng.randrange(-(1 << 63), 1 << 63), lambda: rng.randrange(0, 1 << 20), lambda: None)
    rows = []
    for i in range(2500):
        doc_id = pick[rng.choice((0, 1, 1, 2, 2, 2, 2, 3))]()
        source = rng.choice(["big"] * 8 + [None, "", "-", "+", "é", "z", f"s{i}"])
        rows.append((doc_id, rng.choice([None, "", "a\nb", f"text {i}", "é\n🙂"]), rng.choice(["en", None, ""]), source, rng.choice([None, i])))
    rows += [(7, "same\nrow", "en", "big", 1)] * 900 + [(None, f"t{i % 40}", "en", "big", 1) for i in range(900)]
    assert manifest_rows(spark, documents(spark, tmp_path, rows)) == sorted(map(str, merkle(rows)))


def test_one_leaf_is_the_root(spark, tmp_path):
    want = merkle([(5, "x\ny", "en", None, 3)])
    assert want[0][1] == want[0][2] == want[0][3] and want[0][4] == hashed("")
    assert manifest_rows(spark, documents(spark, tmp_path, [(5, "x\ny", "en", None, 3)])) == sorted(map(str, want))


def test_changed_text_is_found_and_nothing_else(spark):
    got = QUERIES["op11_merkle_manifest"](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id")
    changed = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.col("text").contains("\n")
    assert got.where(F.col("verified") == changed).count() == 0 and got.where(changed).count() > 0


def test_directory_blocks_are_bounded(spark):
    """No window over a group whole: ids spread over all of 64 bits and dense ones give the ranks of a sort."""
    from screenlake.llm.merkle import bitmaps, directory

    rng = np.random.default_rng(2)
    ids = np.unique(np.concatenate((rng.integers(-(1 << 62), 1 << 62, 3000), np.arange(200_000, 203_000))))
    frame = spark.createDataFrame(pd.DataFrame({"doc_id": rng.permutation(ids)})).withColumn("group", F.lit("g"))
    words = directory(bitmaps(frame))
    assert "Window" in words._jdf.queryExecution().executedPlan().toString()
    got = {r.word: (r.before, r.size) for r in words.collect()}
    first = {}
    for rank, i in enumerate(ids.tolist()):
        first.setdefault(i >> 6, (rank, len(ids)))
    assert got == first


# -- URL filters -------------------------------------------------------------------------

URLS = [
    None, "", "no url", "http://example.org/es/1", "HTTP://Sub.EXAMPLE.org/es/", "http://example.org/ES/1", "http://badexample.org/es/1", "http://example.org/en/12?x#y",
    "http://example.org", "http://example.org?es=/", "http://x.com/fr/", "http://com/fr/1", "http://com/de/1", "http://x.com/de", "http://org/", "https://casino.org/",
    "https://www.cheap-pills.net/a", "http://a.net/casino-win.html", "http://a.net/xcasinox", "http://a.net/?next=http://example.org/es/", "://example.org/es/",
    "http://user@example.org:80/es/", "http://bücher.org/es/", "http://a.net/CASINO/", "http://a.net/é\ncasino", "http://spam-farm.example.com/fr/9", "mailto:a@b.org://c.com/de/x",
]
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def judged_by_brute_force(url, rules, patterns):
    after = (url or "").split("://", 1)
    rest = after[1] if len(after) > 1 else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    text, host = rest[len(host):], host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    top = max(((n, b) for n, b, *_ in fits), default=None)
    won = min(((name, v) for n, b, name, v in fits if (n, b) == top), default=(None, None))
    met = [p for p in patterns if re.search("".join({"*": "(?s:.*)", "^": "(?:^|$|[^0-9A-Za-z])"}.get(c) or re.escape(c) for c in p), host + text, re.I | re.A)]
    return host, path, won[0], won[1] or ("block" if met else "allow"), min((-len(p), p) for p in met)[1] if met else None


def test_urls_equal_brute_force(spark, tmp_path):
    from screenlake.llm.urls import UNWANTED

    rows = [(i if i % 5 else None, u, "x") for i, u in enumerate([*URLS, *URLS[:5]])]
    spark.createDataFrame(rows, "page_id LONG, url STRING, token STRING").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op12_url_filter"](spark, str(tmp_path))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "pattern"]
    want = [(i, *judged_by_brute_force(u, RULES, UNWANTED)) for i, u, _ in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert spark.createDataFrame([], "page_id LONG, url STRING").write.parquet(f"{tmp_path}/none/pages.parquet") is None
    assert QUERIES["op12_url_filter"](spark, f"{tmp_path}/none").collect() == []


@pytest.mark.parametrize("broadcast_rows", [50_000, 0])
def test_rules_are_run_on_candidates_only(spark, monkeypatch, broadcast_rows):
    """Both joins give the same; a rule is kept under its rarest token, one without tokens meets every URL."""
    from screenlake.llm import urls

    monkeypatch.setattr(urls, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(4)
    words = ["a", "bb", "example", "org", "net", "shop", "x1", "pills"]
    pages = [(i, f"http://{rng.choice(words)}.{rng.choice(words)}.example.org/{rng.choice(words)}/{rng.choice(words)}?{rng.choice(words)}={i}") for i in range(300)]
    patterns = ["^shop^x1^", "pill", "^example^pills^", "^bb/*/a^", "*", "/x1?", "^example.org/net/", "^nowhere^"]
    listed = [("allow", "a.example.org", "/"), ("block", "example.org", "/b"), ("allow", "example.org", "/b"), ("block", "org", ""), ("block", "rg", "/")]
    table = urls.rules_table(spark, [*(urls.host_rule(*r) for r in listed), *(urls.pattern_rule("block", p) for p in patterns)])
    frame = spark.createDataFrame(pages, "page_id LONG, url STRING")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict, r.pattern) for r in urls.filter_urls(frame, table).collect()]
    assert sorted(map(str, got)) == sorted(str((i, *judged_by_brute_force(u, listed, patterns))) for i, u in pages)
    cut = frame.select(urls.tokens_of(F.lower("url")).alias("tokens"))
    token = {r.rule: r.token for r in urls.rarest_tokens(cut, table).collect()}
    assert token["*"] == token["pill"] == urls.ANY and token["^nowhere^"] == "nowhere" and token["^example^pills^"] == "pills"


# -- Periodic runs -----------------------------------------------------------------------


def runs_by_brute_force(w):
    out = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q) and not any(all(w[x] == w[x + p] for x in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, j - i + q, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    from screenlake.llm.runs import runs_in

    rng, seen = random.Random(6), 0
    for _ in range(250):
        texts = []
        for _ in range(rng.randint(1, 5)):
            n, letters, kind = rng.randint(0, 150), rng.choice([1, 2, 3, 40]), rng.random()
            w = [b"%d" % rng.randrange(letters) for _ in range(n)]
            if kind < 0.6 and n:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            if kind < 0.2:
                w = w[: n // 2] + w
            if kind > 0.9:
                a, b = ["a"], ["a", "b"]
                while len(b) < n:
                    a, b = b, b + a
                w = [c.encode() for c in b] * rng.randint(1, 4)
            texts.append(w)
        for w, got in zip(texts, runs_in(texts)):
            assert got == runs_by_brute_force(w)
            seen += len(got)
    assert seen > 1000


def test_long_periods_and_long_runs():
    from screenlake.llm.runs import runs_in

    rng = random.Random(8)
    w = [b"%d" % rng.randrange(10**6) for _ in range(60_000)]
    for p in (1, 8, 9, 12, 13, 1000, 1023, 1024, 1025, 9999):
        n = max(24, 3 * p)
        assert runs_in([w[:501] + [w[501 + i % p] for i in range(n)] + [b"end"]]) == [[(501, n, p)]]
        assert runs_in([w[:501] + [w[501 + i % p] for i in range(n - 1)] + [b"end"]]) == [[]]
    assert runs_in([[b"x"] * 100_000, [], w, [b"x"] * 23]) == [[(0, 100_000, 1)], [], [], []]


def periodic_rows(rows):
    out = []
    for doc_id, text in rows:
        w = brute.words(text)
        n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = runs_by_brute_force(w) if n < 3000 else None
        if runs is None:
            continue
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        out.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                    hashed(*(f"{s},{n},{q}\n" for s, n, q in runs)), hashed(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def test_run_query_equals_brute_force(spark, edge_dirs, rows):
    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    want = {r[0]: r for r in periodic_rows(zip(docs.doc_id.tolist(), docs.text.tolist()))}
    got = QUERIES["op13_periodic_runs"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    found = {r.doc_id: tuple(r) for r in got.collect()}
    assert len(found) == len(docs) and {i: found[i] for i in want} == want and len(want) > 150
    odd = [(r[0], r[1]) for r in rows if len(brute.words(r[1])) < 3000]
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, edge_dirs["rows"]).collect()]
    for row in periodic_rows(odd):
        got.remove(row)
    assert len(got) == len(rows) - len(odd)
