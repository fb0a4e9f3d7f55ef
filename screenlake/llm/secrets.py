"""Secret scans: token patterns, and literals judged by the names they are assigned to."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from screenlake.llm.common import id_back, id_of, text_of

# The kinds in report order and the three base patterns.
KINDS = ("assign", "access", "hex", "named")
BASE_KINDS = KINDS[:3]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# Words of names that hold secrets, with their weight, and words that make them harmless.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "private": 0.5, "signing": 0.5, "encryption": 0.5,
    "access": 0.4, "api": 0.4, "key": 0.4, "pass": 0.7, "salt": 0.6, "dsn": 0.6,
    "passwort": 1.0, "kennwort": 1.0, "geheimnis": 0.9, "contrasena": 1.0, "secreto": 1.0, "clave": 0.6, "mdp": 0.9, "jeton": 0.8,
}
HARMLESS = {"file", "path", "url", "name", "length", "count", "type", "id", "policy", "field", "header", "public", "example", "hint", "expires", "ttl", "limit", "max", "min"}
PLACEHOLDERS = {"changeme", "change_me", "placeholder", "redacted", "undefined", "password", "example", "your_password", "none", "null", "true", "false"}
# Attributes that say a name, and those that say its value.
SAYS_NAME, SAYS_VALUE = {"key", "name", "id"}, {"value", "content"}
# A literal is reported from this score on.
THRESHOLD = 0.5
# The begin of a key that is not public, and a URL with user and password.
KEY_BLOCK = re.compile(r"-----BEGIN (?!PUBLIC )(?:[A-Z0-9]+ )*KEY\b")
USER_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/?#@:]*:([^\s/?#]+)@")

_NAME = r"[A-Za-z_][A-Za-z0-9_]*(?:[.\-][A-Za-z0-9_]+)*"
# One token of source or configuration: literal, name, operator or line end; comments and the rest are skipped.
TOKEN = re.compile(
    r"""(?P<long>\"{3}(?:[^"\\]|\\.|"(?!""))*\"{3}|'{3}(?:[^'\\]|\\.|'(?!''))*'{3})"""
    r"""|(?P<block>[|>][+-]?[ \t]*\n(?=[ \t]))"""
    r"""|(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
    rf"""|(?P<name>{_NAME})|(?P<op>:=|=>|==|!=|<=|>=|=|:|\+|\(|\)|,|;|\[|\]|\{{|\}})|(?P<end>\n)|(?P<bare>[^\s"'`=:+(),;\[\]{{}}]+)""",
)
# The lines of a block begin with blanks; blank lines may come first.
BLOCK_INDENT = re.compile(r"(?:[ \t]*\n)*([ \t]*)")
BARE = re.compile(r"""[^\s"'`,;()\[\]{}]+""")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


@dataclass
class Value:
    """A literal or a name on the right side: its text without quotes, and where it stands."""

    text: str
    start: int
    end: int
    is_name: bool = False


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the pattern kinds, leftmost and non-overlapping within each kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


def name_score(name: str) -> float:
    """How sensitive a target name is: the sum of its words' weights, 0 if a word makes it harmless."""
    words = [w.lower() for w in _PARTS.findall(name)]
    if any(w in HARMLESS for w in words):
        return 0.0
    return sum(SENSITIVE.get(w, 0.0) for w in dict.fromkeys(words))


class Said:
    """What has to be known of a text to judge it: its length and how often it has each character, its two ends,
    and whether it holds a key block or a URL with a password.

    Texts are joined without being written out, so constants that build on each other cost no more than their lines.
    """

    __slots__ = ("length", "counts", "head", "tail", "is_key")
    # Key blocks and URLs are found across a joint if they lie within so many characters on each side.
    ENDS = 256

    def __init__(self, text: str):
        self.length, self.counts = float(len(text)), {c: float(n) for c, n in Counter(text).items()}
        self.head, self.tail = text[: self.ENDS], text[-self.ENDS:]
        self.is_key = holds_key(text)

    def __add__(self, other: Said) -> Said:
        if not other.length or not self.length:
            return self if self.length else other
        out = Said("")
        out.length = self.length + other.length
        out.counts = dict(self.counts)
        for c, n in other.counts.items():
            out.counts[c] = out.counts.get(c, 0.0) + n
        if out.length > 1e200:
            # Only shares of characters count in a text of such a length.
            out.length, out.counts = out.length / 1e100, {c: n / 1e100 for c, n in out.counts.items()}
        out.head = self.head if len(self.head) >= self.ENDS else (self.head + other.head)[: self.ENDS]
        out.tail = other.tail if len(other.tail) >= self.ENDS else (self.tail + other.tail)[-self.ENDS:]
        out.is_key = self.is_key or other.is_key or holds_key(self.tail + other.head)
        return out


def holds_key(text: str) -> bool:
    """A key block, or a URL with a user and a password."""
    if "-----BEGIN" in text and KEY_BLOCK.search(text):
        return True
    url = USER_URL.search(text) if "://" in text else None
    return bool(url) and url[1].lower() not in PLACEHOLDERS and not re.match(r"[$<{%]", url[1])


def said_score(said: Said) -> float:
    """How much a text looks like a secret: 0 for short ones, placeholders and plain words.

    Key blocks and URLs with a password are secrets whatever else they hold.
    """
    if said.length < 8 or said.length <= Said.ENDS and said.head.lower() in PLACEHOLDERS:
        return 0.0
    if said.is_key:
        return 1.0
    if re.match(r"[$<{%]|https?://|/[^/]*/|-----BEGIN PUBLIC KEY", said.head) or len(said.counts) < 5:
        return 0.0
    bits = -sum(n / said.length * math.log2(n / said.length) for n in said.counts.values())
    every = "".join(said.counts)
    mixed = sum(bool(re.search(c, every)) for c in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]"))
    return 0.0 if mixed < 2 else min(1.0, bits / 4 + 0.15 * (mixed - 2))


def literal_score(text: str) -> float:
    return said_score(Said(text))


def _block(text: str, start: int) -> tuple[int, int]:
    """Where the lines of a YAML block begin and end, which starts behind its `|` or `>` line: those indented like the first."""
    first = BLOCK_INDENT.match(text, start)
    at = start
    while first[1] and at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        if not text.startswith(first[1], at) and text[at:end].strip():
            break
        at = end + 1
    return min(start + len(first[0]), len(text)), min(at, len(text))


def assignments(text: str) -> Iterator[tuple[str, list[Value]]]:
    """(name, parts) of every `name = ...` or `name: ...`: parts are literals and names joined by +.

    Names may be quoted (JSON), typed (`name: str = ...`) or dotted; a value without quotes runs to the
    next blank, quote, bracket, comma or semicolon. Literals may run over lines: in triple quotes, or as an
    indented block behind `name: |` or `name: >`. A part ends at the line, a comma, a semicolon or a
    bracket; anything but joined literals and names ends it too.
    """
    target: str | None = None
    parts: list[Value] = []
    last: str | None = None
    # A run without quotes is measured once, wherever in it a value is looked for.
    joined, skip, run = False, 0, 0
    for m in TOKEN.finditer(text):
        if m.start() < skip:
            continue
        kind, said = m.lastgroup, m[0]
        if kind == "op" and said in ("=", ":=", ":", "=>"):
            if target is not None and said in ("=", ":=") and len(parts) == 1 and parts[0].is_name and last == parts[0].text:
                parts = []  # name: type = value
            else:
                if target is not None and len(parts) > 1 and parts[-1].text == last:
                    yield target, parts[:-1]
                target, parts = last, []
            last, joined = None, target is not None or bool(parts)
        elif kind == "block" and target is not None and joined and not parts:
            start, skip = _block(text, m.end())
            inner = text[start:skip].rstrip()
            yield target, [Value(inner, start, start + len(inner))]
            target, parts, last, joined = None, [], None, False
        elif kind in ("long", "string", "name", "bare"):
            quotes = 3 if kind == "long" else 1 if kind == "string" else 0
            start, end = m.start() + quotes, m.end() - quotes
            if target is not None and joined:
                if not quotes:
                    if m.start() >= run:
                        run = BARE.match(text, m.start()).end()
                    if run > m.end() and text[m.end()] not in ":=+":
                        kind, skip, end = "bare", run, run
                parts.append(Value(text[start:end], start, end, kind == "name"))
                joined = False
            elif target is not None:
                if parts:
                    yield target, parts
                target, parts = None, []
            last = text[start:end] if kind != "bare" else None
        elif kind == "op" and said == "+" and parts:
            joined = True
        else:
            if parts and target is not None:
                yield target, parts
            target, parts, last, joined = None, [], None, False
    if parts and target is not None:
        yield target, parts


def attribute_pairs(pairs: list[tuple[str, list[Value]]]) -> Iterator[tuple[str, list[Value]]]:
    """`key="name" value="literal"` and `"name": "...", "value": "..."` as assignments to the name said."""
    for (name, said), (after, parts) in zip(pairs, pairs[1:]):
        if name.lower() in SAYS_NAME and after.lower() in SAYS_VALUE and len(said) == 1 and not said[0].is_name:
            yield said[0].text, parts


@dataclass
class Folded:
    """An assignment, or a circle of them, with the constants in their places.

    values: number of literals and of names that stand for nothing known, up to 2; only: the one there is;
    text: the literals joined.
    """

    text: Said
    values: int
    only: Value | None


class Constants:
    """The assignments of a text as a graph: a name in a value leads to the assignments of that name.

    The last one stands where the name is used; earlier ones are values of their own. Circles, and whatever
    builds on them, are folded once: work grows with the assignments, not with the ways through them.
    """

    def __init__(self, pairs: list[tuple[str, list[Value]]]):
        self.pairs = pairs
        self.given: dict[str, list[int]] = {}
        for k, (name, _) in enumerate(pairs):
            self.given.setdefault(name, []).append(k)
        self.folded: list[Folded | None] = [None] * len(pairs)
        for circle in self._circles():
            self._fold(circle)

    def used(self, k: int) -> list[int]:
        """The assignments that stand in the value of k."""
        return [self.given[v.text][-1] for v in self.pairs[k][1] if v.is_name and v.text in self.given]

    def names(self, k: int) -> list[str]:
        """The names in the value of k that are assigned somewhere."""
        return [v.text for v in self.pairs[k][1] if v.is_name and v.text in self.given]

    def _circles(self) -> Iterator[list[int]]:
        """Strongly connected assignments, those that are used before those that use them."""
        order, low, held, number = {}, {}, set(), 0
        stack: list[int] = []
        for root in range(len(self.pairs)):
            if root in order:
                continue
            order[root] = low[root] = number
            number += 1
            stack.append(root)
            held.add(root)
            work = [(root, iter(self.used(root)))]
            while work:
                k, uses = work[-1]
                for other in uses:
                    if other not in order:
                        order[other] = low[other] = number
                        number += 1
                        stack.append(other)
                        held.add(other)
                        work.append((other, iter(self.used(other))))
                        break
                    if other in held:
                        low[k] = min(low[k], order[other])
                else:
                    work.pop()
                    if work:
                        low[work[-1][0]] = min(low[work[-1][0]], low[k])
                    if low[k] == order[k]:
                        circle = []
                        while not circle or circle[-1] != k:
                            circle.append(stack.pop())
                            held.discard(circle[-1])
                        yield circle

    def _fold(self, circle: list[int]) -> None:
        inside, text, values, only = set(circle), Said(""), 0, None
        turns = len(circle) > 1 or circle[0] in self.used(circle[0])
        for k in sorted(circle):
            for v in self.pairs[k][1]:
                last = self.given[v.text][-1] if v.is_name and v.text in self.given else None
                if last in inside:
                    continue
                part = self.folded[last] if last is not None else Folded(Said("" if v.is_name else v.text), 1, v)
                text, values, only = text + part.text, min(2, values + part.values), part.only if values == 0 else None
        # What comes round again is longer than it is written.
        whole = Folded(text + text if turns else text, values, only)
        for k in circle:
            self.folded[k] = whole

    def weights(self) -> list[float]:
        """Per assignment the weight of the most sensitive name that its value reaches."""
        own = [name_score(name) for name, _ in self.pairs]
        best, met = [0.0] * len(own), set()
        for k in sorted((k for k, w in enumerate(own) if w > 0.0), key=lambda k: -own[k]):
            left = [k]
            while left:
                j = left.pop()
                if best[j]:
                    continue
                best[j] = own[k]
                for name in self.names(j):
                    # Names are followed once, the most sensitive way first.
                    if name not in met:
                        met.add(name)
                        left += self.given[name]
        return best

    def literals(self, heads: list[int]) -> Iterator[Value]:
        """The literals in the values of these assignments, constants followed, each assignment once."""
        seen, left = set(heads), list(heads)
        while left:
            k = left.pop()
            yield from (v for v in self.pairs[k][1] if not v.is_name)
            for other in self.used(k):
                if other not in seen:
                    seen.add(other)
                    left.append(other)


def named_spans(text: str) -> list[tuple[int, str, int]]:
    """Spans of literals that reach a sensitive name, directly or through constants, whatever the order of the lines."""
    pairs = list(assignments(text))
    pairs += attribute_pairs(pairs)
    constants = Constants(pairs)
    heads, found = [], []
    # Judged are values of sensitive names, and earlier values of the constants they use.
    weights = constants.weights()
    judged = {k for k, (name, _) in enumerate(pairs) if name_score(name) > 0.0}
    used = {name for k, w in enumerate(weights) if w for name in constants.names(k)}
    judged.update(k for name in used for k in constants.given[name][:-1])
    for k in judged:
        value = constants.folded[k]
        # A name that stands for nothing known is a literal without quotes, if it is all there is.
        alone = value.values == 1 and value.only is not None and value.only.is_name
        if weights[k] * said_score(Said(value.only.text) if alone else value.text) >= THRESHOLD:
            heads.append(k)
            if alone:
                found.append(value.only)
    found += constants.literals(heads)
    return sorted({(v.start, "named", v.end) for v in found if v.end > v.start})


def spans_of(text: str) -> list[tuple[int, str, int]]:
    """All spans of a text by start, then kind. The lexer only runs where a sensitive name occurs."""
    found = base_spans(text)
    low = text.lower()
    if ("=" in text or ":" in text) and any(w in low for w in SENSITIVE):
        found += named_spans(text)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = [[(k, a, b) for a, k, b in spans_of(t)] for t in frame["_text"]]
        yield pd.DataFrame({"doc_id": frame["doc_id"], "spans": out})


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for every row of `docs`: array of (kind, start, end) by start, then kind.

    Kinds assign, access and hex are all matches of their pattern; named are literals of a text read
    as source or configuration that reach a sensitive name, by assignment or through constants, and
    look like a secret. Positions are code points, ends exclusive.

    Null text is empty and has no spans. Rows are handled one by one without a shuffle: repeated
    rows, null ids and empty tables come out as they are. Columns other than doc_id and text are
    ignored.
    """
    schema = "doc_id LONG, spans ARRAY<STRUCT<kind: STRING, start: INT, end: INT>>"
    found = docs.select(id_of().alias("doc_id"), text_of().alias("_text")).mapInPandas(_scan, schema)
    return found.withColumn("doc_id", id_back("doc_id"))
