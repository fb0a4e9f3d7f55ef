"""Mixing sources to target weights by fitting sums of document lengths to each source's budget."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenlake.llm.common import WORD, group_key, id_of, rank_in_group, text_of, whole_row
from screenlake.operators.ordering import number_rows
from screenlake.session import stable

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# Budget left to the dynamic program, in words.
DP_WORDS = 16_384


def fit_subset(lengths: Sequence[int], counts: Sequence[int], budget: int, dp_words: int = DP_WORDS) -> list[int]:
    """How many documents of each length to take, so that their lengths sum to `budget`, or as near as they can.

    Of a budget above `dp_words` the same share of every length is taken first, then long documents, until about
    `dp_words` are left. A bounded knapsack over the reachable sums (one bit per sum, counts split into powers of
    two) fits the rest with the documents that are left: a smaller budget is fitted whole. Of two sums that are
    equally near the smaller one is taken.
    """
    total = sum(x * n for x, n in zip(lengths, counts))
    if budget <= 0 or total == 0:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    taken = [n * max(0, budget - dp_words) // total for n in counts]
    left = budget - sum(x * k for x, k in zip(lengths, taken))
    downward = sorted((i for i in range(len(lengths)) if lengths[i] > 0), key=lambda i: -lengths[i])
    for i in downward:
        more = min(counts[i] - taken[i], max(0, left - dp_words) // lengths[i])
        taken[i] += more
        left -= more * lengths[i]
    # Sums up to twice what is left: 0 is a sum, so the nearest one lies there.
    reach, mask, steps = 1, (1 << (2 * left + 1)) - 1, []
    for i in downward:
        rest, lot = counts[i] - taken[i], 1
        while rest > 0 and lengths[i] <= 2 * left and not reach >> left & 1:
            k = min(lot, rest)
            steps.append((i, k, reach))
            reach |= reach << (k * lengths[i]) & mask
            rest, lot = rest - k, lot * 2
    below = (reach & ((1 << (left + 1)) - 1)).bit_length() - 1
    higher = reach >> (left + 1)
    above = left + 1 + (higher & -higher).bit_length() - 1 if higher else None
    at = above if above is not None and above - left < left - below else below
    for i, k, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += k
            at -= k * lengths[i]
    return taken


def _plan_source(pdf: pd.DataFrame) -> pd.DataFrame:
    """Whole passes over the source and, per length, the documents that get one pass more."""
    pdf = pdf.sort_values("size")
    target, whole = float(pdf["target"].iloc[0]), int(pdf["source_size"].iloc[0])
    epochs = min(int(target // whole), int(pdf["max_epochs"].iloc[0])) if whole else 0
    rest = round(target - epochs * whole) if epochs < pdf["max_epochs"].iloc[0] else 0
    taken = fit_subset(pdf["size"].tolist(), pdf["n"].tolist(), rest)
    return pd.DataFrame({"_key": pdf["_key"], "size": pdf["size"], "_epochs": epochs, "_more": taken})


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add target to (source, source_size): shares by weight, none above max_epochs times the size.

    Weights repeat over the sources in code point order, null last. What a source cannot take is
    shared again by weight among those below their limit. Only sums reach the driver.
    """
    nth = F.array(*(F.lit(float(w)) for w in weights))
    ranked = stable(
        number_rows(sources, [F.asc_nulls_last("source")], "_nth", start=0).select(
            "source", "source_size",
            F.element_at(nth, (F.pmod("_nth", F.lit(len(weights))) + 1).cast("int")).alias("_weight"),
            (F.col("source_size") * float(max_epochs)).alias("_limit"),
        )
    )
    level, full_before = 0.0, -1
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    while True:
        full = (F.col("_weight") * level >= F.col("_limit")) if full_before >= 0 else F.col("source_size") == 0
        row = ranked.agg(
            F.count_if(full).alias("n"),
            F.sum(F.when(full, F.col("_limit")).otherwise(0.0)).alias("given"),
            F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        if row["n"] == full_before or not row["weight"]:
            break
        level, full_before = (total - row["given"]) / row["weight"], row["n"]
    share = F.least(F.col("_weight") * F.lit(level), F.col("_limit"))
    return ranked.select("source", "source_size", share.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """Add size, source_size, target, copies and taken (words the mix takes) to (doc_id, source, text).

    Each source's budget is met with whole passes over it plus a subset of its documents: how many
    of each exact length comes from fit_subset, which ones from a seeded order. A document gets at
    most `max_epochs` copies, so taken is at most that many times its size.

    Null text has size 0; null sources are one source, last in order; documents of size 0 get the
    whole passes of their source. Repeated rows and ties in the order are told apart by a row
    number. An empty table gives an empty table. Other columns are left out.

    A source of any share of the table is spread: sizes are counted per (source, length) before
    the shuffle and documents of one length are ranked in about sqrt(rows) buckets.
    """
    return _allocated(docs, weights, max_epochs, seed).drop("_check", "_key")


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """The rows of `docs`, all columns, each as often as mix() takes it.

    Rows that agree in doc_id, source and text share what was allotted to them together.
    """
    allotted = (
        _allocated(docs, weights, max_epochs, seed)
        .withColumn("_doc", id_of())
        .groupBy("_doc", "_check", "_key").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
        .where("_copies > 0")
    )
    same = Window.partitionBy("_doc", "_check", "_key").orderBy("_doc")
    copies = F.floor(F.col("_copies") / F.col("_rows")) + (F.col("_nth") <= F.pmod("_copies", "_rows")).cast("long")
    return (
        docs.select(whole_row(docs).alias("_all"), id_of().alias("_doc"), F.xxhash64(text_of()).alias("_check"), group_key("source").alias("_key"))
        .join(allotted, ["_doc", "_check", "_key"])
        .withColumn("_nth", F.row_number().over(same))
        .withColumn("_times", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
        .select("_all.*")
    )


def _allocated(docs: DataFrame, weights: Sequence[int], max_epochs: int, seed: int) -> DataFrame:
    """mix() with the keys that lead back to a row's text."""
    sized = stable(
        docs.select("doc_id", "source", F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text_of()).alias("_check"))
        .withColumn("_key", group_key("source"))
        .withColumn("_row", F.monotonically_increasing_id())
    )
    hist = stable(sized.groupBy("_key", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    rows = hist.agg(F.sum("n")).first()[0] or 0
    sources = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stable(source_targets(sources, weights, max_epochs).withColumn("_key", group_key("source")).drop("source"))
    plan = (
        hist.drop("source").join(targets, "_key")
        .withColumn("max_epochs", F.lit(max_epochs))
        .groupBy("_key").applyInPandas(_plan_source, "_key STRING, size LONG, _epochs LONG, _more LONG")
        .join(targets, "_key")
    )
    ranked = rank_in_group(sized.withColumn("_seed", F.lit(seed)), ["_key", "size"], ["_seed", "doc_id", "_row"], rows)
    salt = F.pmod(F.col("rank"), F.lit(16))
    return (
        ranked.withColumn("_salt", salt)
        .join(plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(15)))), ["_key", "size", "_salt"])
        .withColumn("copies", F.col("_epochs") + (F.col("rank") < F.col("_more")).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "_check", "_key")
    )
