"""Plain Python versions of what the operators compute."""

import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\f\r"


def words(text):
    return [w for w in re.split(f"[{SPACE}]+", text or "") if w]


def shingles(text):
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def classes(pairs, ids):
    """id -> least id of its component."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in ids}


def kept_lines(docs):
    """doc_id -> (lines, dropped, text) of line dedup."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    lines = {i: (t or "").split("\n") for i, t in docs}
    key = lambda x: x.strip(SPACE).translate(lower)
    held = defaultdict(set)
    for i, ls in lines.items():
        for x in ls:
            if len(key(x)) >= 10:
                held[key(x)].add(i)
    out = {}
    for i, ls in lines.items():
        kept = [x for x in ls if len(held[key(x)]) < 2 or min(held[key(x)]) == i]
        out[i] = (len(ls), len(ls) - len(kept), "\n".join(kept))
    return out
