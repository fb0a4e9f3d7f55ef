import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, _text STRING, _doc LONG, key STRING, n_lines INT, _all INT"
LINE = "a b c d e f g h i j.\nLine two here is it"
MANY = 3000


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and long texts, repeated rows, copies, columns named like working ones."""
    rest = (5, "x", 1, "k", 1, 1)
    return [
        (1, f"{LINE}\nshort", "en", "s1", *rest),
        (2, None, None, None, *[None] * 6),
        (3, "", "en", "s1", *rest),
        (None, LINE, "en", None, *rest),
        (4, f"{LINE}\nshort", "en", "s1", *rest),
        (4, f"{LINE}\nshort", "en", "s1", *rest),
        (5, " ".join(f"word{i} foo" for i in range(MANY)), "en", "s2", *rest),
        (6, "\n\n\n", "en", "s2", *rest),
        ((1 << 62) + 1, " ".join(f"a{i}@b.com" for i in range(MANY)), "de", "s3", *rest),
    ]


@pytest.fixture(scope="session")
def edge_dirs(spark, rows, tmp_path_factory):
    """Folders of small tables: with those rows, and with no rows at all."""
    out = {}
    for name, some in (("rows", True), ("empty", False)):
        d = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame(rows if some else [], DOCS).write.parquet(f"{d}/documents.parquet")
        labels = [(1, 1, 0), (2, None, None), (None, 1, 0), (3, 0, 0), (4, 1, 0)]
        spark.createDataFrame(labels if some else [], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{d}/labels.parquet")
        vectors = [(0, [0.1, 0.2], 1), (50, None, 1), (1, [0.1, None], 1), (2, [float("nan"), 1.0], 2), (3, [0.1, 0.2], 2),
                   (None, [0.1, 0.2], 2), (4, [0.1], 2), (100, [0.5, -0.7], 1), (3, [0.1, 0.2], 2)]
        spark.createDataFrame(vectors if some else [], "vec_id LONG, embedding ARRAY<FLOAT>, label INT").write.parquet(f"{d}/embeddings.parquet")
        out[name] = d
    return out
