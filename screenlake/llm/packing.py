"""Packing documents into windows of tokens: length combinations weighed by non-negative least squares."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import id_back, id_of, lean, rank_in_group, text_of
from screenlake.operators.ordering import PART, part_offsets
from screenlake.session import small_batches, stable

WINDOW = 1024
# How often one length may be repeated in a combination.
DEPTH = 4
# Rounds of the solver; the histogram and the combinations have a fixed size, so this is a fixed cost.
ROUNDS = 3000
# Id that ends every document.
END_ID = 0


@cache
def _tokenizer(name: str):
    """Encoder of texts to arrays of ids, in this worker.

    The vocabulary as byte ranks gives the same ids several times faster. Texts with code points
    beyond Latin letters, or that spell a special token, take the reference encoder, so that
    differences in Unicode tables cannot matter.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        plain = text.isascii() or max(text) < "ɐ"
        if plain and "\x85" not in text and "\xa0" not in text and not any(s in text for s in special):
            return np.array(fast.encode_ordinary(text), np.uint32)
        return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def crc_of(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


TOKENS = "doc_id LONG, doc_tokens LONG, n_full LONG, full_crcs ARRAY<LONG>, rest INT, rest_ids BINARY"


def _tokenise(frames: Iterator[pd.DataFrame], tokenizer: str, window: int) -> Iterator[pd.DataFrame]:
    encode = _tokenizer(tokenizer)
    for frame in frames:
        rows = []
        for doc_id, text in zip(frame["doc_id"].tolist(), frame["_text"].tolist()):
            ids = np.append(encode(text), np.uint32(END_ID))
            full = len(ids) // window
            crcs = [crc_of(ids[i * window:(i + 1) * window]) for i in range(full)]
            rest = ids[full * window:]
            rows.append((doc_id, len(ids), full, crcs, len(rest), rest.astype("<u4").tobytes()))
        out = pd.DataFrame(rows, columns=["doc_id", "doc_tokens", "n_full", "full_crcs", "rest", "rest_ids"])
        yield out


def combinations(window: int = WINDOW, depth: int = DEPTH) -> list[tuple[tuple[int, int], ...]]:
    """Shallow combinations that fill the window exactly: one length up to `depth` times plus another.

    Each is a tuple of (length, times).
    """
    found = set()
    for times in range(1, depth + 1):
        for length in range(1, window // times + 1):
            other = window - times * length
            if other == length:
                found.add(((length, times + 1),))
            elif other == 0 and times > 1:
                found.add(((length, times),))
            elif other > 0:
                found.add(tuple(sorted({length: times, other: 1}.items())))
    return sorted(found)


def solve_counts(histogram: np.ndarray, combos: list[tuple[tuple[int, int], ...]], rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that bring A x nearest to the histogram in the least-squares sense.

    Accelerated projected gradient; A has at most two entries a column.
    """
    length = np.array([[c[0][0], c[-1][0]] for c in combos])
    times = np.array([[c[0][1], c[-1][1] if len(c) > 1 else 0] for c in combos], float)
    size = len(histogram)

    def apply(x: np.ndarray) -> np.ndarray:
        return np.bincount(length.ravel(), weights=(times * x[:, None]).ravel(), minlength=size)

    def back(y: np.ndarray) -> np.ndarray:
        return (y[length] * times).sum(axis=1)

    bound = float(back(apply(np.ones(len(combos)))).max())
    x = momentum = np.zeros(len(combos))
    pace = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, momentum - back(apply(momentum) - histogram) / bound)
        quicker = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        momentum = new + (pace - 1) / quicker * (new - x)
        x, pace = new, quicker
    return x


@dataclass
class Plan:
    """Where the document remainder number `rank` of each length goes."""

    window: int
    #: Per length and block of ranks: length << 44 | first rank, first sequence, repeats in it, offset.
    blocks: list[tuple[int, int, int, int]] = field(default_factory=list)
    #: Remainders of each length that a combination takes; the rest are laid end to end.
    planned: np.ndarray | None = None
    #: Where the first left-over remainder of each length starts on that line, and the line's length.
    line_start: np.ndarray | None = None
    line: int = 0
    sequences: int = 0


def make_plan(histogram: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> Plan:
    """Round the solved counts down to what the histogram holds, fill up greedily, lay out the rest."""
    combos = combinations(window, depth)
    left = histogram.astype(np.int64).copy()
    solved = solve_counts(histogram.astype(float), combos)
    plan, used = Plan(window), np.zeros(window + 1, np.int64)
    order = sorted(range(len(combos)), key=lambda i: (-solved[i], combos[i]))
    wanted = [(i, int(solved[i])) for i in order] + [(i, None) for i in order]
    for i, most in wanted:
        times = min(int(left[n]) // k for n, k in combos[i])
        times = times if most is None else min(times, most)
        if times <= 0:
            continue
        offset = 0
        for n, k in combos[i]:
            plan.blocks.append((n << 44 | int(used[n]), plan.sequences, k, offset))
            used[n] += times * k
            left[n] -= times * k
            offset += n * k
        plan.sequences += times
    plan.planned = used
    sizes = left * np.arange(window + 1)
    plan.line_start = np.cumsum(sizes) - sizes
    plan.line = int(sizes.sum())
    plan.blocks.sort()
    return plan


def line_cuts(line: int, window: int) -> list[int]:
    """Ends of the sequences in the last, partly filled window: powers of two, which need no padding."""
    whole, cuts = line - line % window, []
    for bit in reversed(range(window.bit_length())):
        if (line - whole) >> bit & 1:
            cuts.append((cuts[-1] if cuts else whole) + (1 << bit))
    return cuts


PIECES = "doc_id LONG, start LONG, length LONG, ids_crc32 LONG, doc_tokens LONG, sequence_id LONG, offset LONG"
_COLUMNS = [c.split()[0] for c in PIECES.split(", ")]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_COLUMNS)


def _place_rests(frames: Iterator[pd.DataFrame], plan: Plan) -> Iterator[pd.DataFrame]:
    starts = np.array([b[0] for b in plan.blocks], np.int64)
    cuts = line_cuts(plan.line, plan.window)
    whole = plan.line - plan.line % plan.window
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            n, rank, done = int(r.rest), int(r.rank), int(r.doc_tokens - r.rest)
            if rank < plan.planned[n]:
                key, first, times, offset = plan.blocks[int(np.searchsorted(starts, n << 44 | rank, "right")) - 1]
                turn, slot = divmod((n << 44 | rank) - key, times)
                crc = zlib.crc32(r.rest_ids)
                rows.append((r.doc_id, done, n, crc, r.doc_tokens, first + turn, offset + slot * n))
                continue
            at = int(plan.line_start[n]) + (rank - int(plan.planned[n])) * n
            ids, taken = np.frombuffer(r.rest_ids, "<u4"), 0
            while taken < n:
                pos = at + taken
                if pos < whole:
                    sequence, base = pos // plan.window, pos - pos % plan.window
                    stop = base + plan.window
                else:
                    k = int(np.searchsorted(cuts, pos, "right"))
                    sequence, base, stop = whole // plan.window + k, cuts[k - 1] if k else whole, cuts[k]
                size = min(n - taken, stop - pos)
                piece = ids[taken:taken + size]
                rows.append((r.doc_id, done + taken, size, crc_of(piece), r.doc_tokens, plan.sequences + sequence, pos - base))
                taken += size
        yield _frame(rows)


def _place_full(frames: Iterator[pd.DataFrame], first: int, window: int) -> Iterator[pd.DataFrame]:
    """Whole windows, numbered through: `_before` full windows lie in earlier partitions."""
    seen: dict[int, int] = {}
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            at = first + int(r.before) + seen.get(r.part, 0)
            rows.extend((r.doc_id, i * window, window, int(crc), r.doc_tokens, at + i, 0) for i, crc in enumerate(r.full_crcs))
            seen[r.part] = seen.get(r.part, 0) + int(r.n_full)
        yield _frame(rows)


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str = "byte_bpe_50k", depth: int = DEPTH) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents.

    Every document becomes its ids and END_ID. Whole windows are cut off its front. The remainders are
    counted by length; repeat counts of combinations that fill a window are solved against that
    histogram, rounded down and filled up greedily. What is left is laid end to end and cut at the
    window; the last part of the line is cut into powers of two. So no sequence needs padding.

    Null text is empty: one id. Repeated rows are packed once each, null ids too; an empty table gives
    an empty table. Columns other than doc_id and text are ignored. A long text needs memory for its
    own ids only.

    Texts are tokenised once; remainders (shorter than the window) are kept with their ids, whole
    windows with checksums only. The driver sees one number per length and one per partition. Documents
    of one length are ranked in about sqrt(rows) buckets, so a length that a third of all documents
    share is no hot group.
    """
    texts = docs.select(id_of().alias("doc_id"), text_of().alias("_text"))
    with small_batches(docs.sparkSession):
        tokens = stable(
            texts.mapInPandas(lean(_tokenise, tokenizer, window), TOKENS)
            .withColumn("_row", F.monotonically_increasing_id())
            .withColumn(PART, F.shiftright("_row", 33).cast("int"))
        )
    counts = {r["rest"]: r["count"] for r in tokens.groupBy("rest").count().collect()}
    histogram = np.zeros(window + 1, np.int64)
    for n, k in counts.items():
        histogram[n] = k
    histogram[0] = 0
    plan = make_plan(histogram, window, depth)
    rests = tokens.where("rest > 0").select("doc_id", "doc_tokens", "rest", "rest_ids", "_row")
    ranked = rank_in_group(rests, ["rest"], ["doc_id", "_row"], int(histogram.sum()))
    of_rests = ranked.select("doc_id", "doc_tokens", "rest", "rest_ids", "rank").mapInPandas(
        lean(_place_rests, plan), PIECES
    )
    first = plan.sequences + plan.line // window + len(line_cuts(plan.line, window))
    full = tokens.where("n_full > 0").select("doc_id", "doc_tokens", "n_full", "full_crcs", PART)
    offsets = part_offsets(full, {"before": F.sum("n_full")})
    of_full = full.join(offsets, PART).withColumnRenamed(PART, "part").mapInPandas(
        lean(_place_full, first, window), PIECES
    )
    return of_rests.unionAll(of_full).withColumn("doc_id", id_back("doc_id"))
