"""Merkle manifest of a dataset: leaves ranked by bitmaps of their ids, levels reduced in keyed slot arrays.

Each group (source) has a bitmap of its ids, kept as its non-empty 64-bit words, and a directory of
popcounts over words and, above them, over blocks of 2^16, 2^32 and 2^48 ids. The number of smaller ids
is a sum of one count per level and the set bits below the id's own: no row is sorted by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.llm.common import group_key
from screenlake.operators.joins import salted_join
from screenlake.operators.ordering import number_rows
from screenlake.session import stable

# Children of a node, and levels that are reduced in one row.
FANOUT = 3
LEVELS = 6
SLOTS = FANOUT**LEVELS
# Bits of an id inside a word, then those each level of the directory adds.
WORD_BITS = 6
DIRECTORY_BITS = (10, 16, 16)
# The word of ids that are null: before all others, and no id's own.
NULL_WORD = -(1 << (63 - WORD_BITS)) - 1
PATH = "ARRAY<STRUCT<before: STRING, after: STRING>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*fields: Column) -> Column:
    """Hash of a row: every field with its length in front, null as `-`."""
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields)), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """(group, doc_id, leaf, changed): the hash of each row, and of the row as it is checked.

    Rows whose id has an even crc32 are checked with the line feeds of their text deleted.
    """
    row = {name: F.col(name).cast("string") for name in FIELDS}
    stripped = row | {"text": F.replace(row["text"], F.lit("\n"), F.lit(""))}
    tampered = (F.crc32(row["doc_id"]) % 2 == 0) & row["text"].contains("\n")
    leaf = digest(*(row[n] for n in FIELDS))
    return docs.select(
        group_key("source").alias("group"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"),
        F.when(tampered, digest(*(stripped[n] for n in FIELDS))).alias("changed"),
    )


def _word(doc_id: str) -> Column:
    return F.coalesce(F.shiftright(doc_id, WORD_BITS), F.lit(NULL_WORD))


def _bit(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).bitwiseAND(F.lit((1 << WORD_BITS) - 1)), F.lit(0).cast("long")).cast("int")


def bitmaps(rows: DataFrame, group: str = "group", doc_id: str = "doc_id") -> DataFrame:
    """(group, word, bits, n): the non-empty words of each group's bitmap and the rows that set them.

    Each task makes the words of its own rows; they are merged by bitwise or.
    """
    one = F.call_function("shiftleft", F.lit(1).cast("long"), _bit(doc_id))
    return rows.groupBy(group, _word(doc_id).alias("word")).agg(F.bit_or(one).alias("bits"), F.count(F.lit(1)).alias("n"))


def directory(words: DataFrame, group: str = "group") -> DataFrame:
    """Add to every word `before`, the rows of the group in smaller words, and `size`, its rows in all.

    Counts are summed inside blocks of at most 2^16 nodes, level over level, so no window sees a group whole.
    """
    levels = [words.withColumnRenamed("word", "node")]
    for bits in DIRECTORY_BITS:
        levels.append(levels[-1].groupBy(group, F.shiftright("node", bits).alias("node")).agg(F.sum("n").alias("n")))
    nothing = F.lit(0).cast("long")
    inside = Window.partitionBy(group, "up").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    above = levels[-1].groupBy(group).agg(F.sum("n").alias("size")).withColumns({"up": nothing, "before": nothing})
    parents = [F.shiftright("node", bits) for bits in DIRECTORY_BITS] + [nothing]
    for level, parent in zip(reversed(levels), reversed(parents)):
        summed = level.withColumn("up", parent).withColumn("_inside", F.coalesce(F.sum("n").over(inside), nothing))
        kept = [c for c in level.columns if c not in (group, "node")]
        below = summed.join(above, [group, "up"]).select(
            group, "node", (F.col("before") + F.col("_inside")).alias("before"), "size", *kept
        )
        above = below.select(group, F.col("node").alias("up"), "before", "size")
    return below.withColumnRenamed("node", "word")


def ranked(rows: DataFrame) -> DataFrame:
    """Add `at`, the position of the row in its group by id (null first, equal ids by their hashes), and `size`.

    rows: group, doc_id, leaf, changed. Words in which an id is repeated have more rows than bits; the rows
    of these are counted id by id, and those of one id are numbered in buckets of its hashes.
    """
    words = stable(directory(bitmaps(rows)))
    once = F.col("n") == F.bit_count("bits")
    # The null word is met by every row without an id, and a repeated id may be most of the table.
    met = salted_join(rows.withColumn("word", _word("doc_id")), words.withColumn("once", once), ["group", "word"], "inner")
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), _bit("doc_id")))
    plain = met.where("once").select(
        "group", "doc_id", "leaf", "changed", (F.col("before") + F.bit_count(F.col("bits").bitwiseAND(below))).alias("at"), "size"
    )
    # Equal rows are folded to one with a count, and dealt out again in blocks.
    again = met.where(~F.col("once")).groupBy("group", "doc_id", "leaf", "changed", "word", "before", "size").agg(F.count(F.lit(1)).alias("n"))
    ids = again.groupBy("group", "word", _bit("doc_id").alias("bit")).agg(F.sum("n").alias("n"))
    in_word = Window.partitionBy("group", "word").orderBy("bit").rowsBetween(Window.unboundedPreceding, -1)
    ids = ids.select("group", "word", "bit", F.coalesce(F.sum("n").over(in_word), F.lit(0)).alias("smaller"))
    bucket = F.conv(F.substring("leaf", 1, 4), 16, 10).cast("int")
    tied = again.withColumns({"bit": _bit("doc_id"), "bucket": bucket})
    counts = tied.groupBy("group", "word", "bit", "bucket").agg(F.sum("n").alias("n"))
    by_bucket = Window.partitionBy("group", "word", "bit").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("group", "word", "bit", "bucket", F.coalesce(F.sum("n").over(by_bucket), F.lit(0)).alias("ahead"))
    in_bucket = Window.partitionBy("group", "word", "bit", "bucket").orderBy("leaf", "changed").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        salted_join(tied, ids, ["group", "word", "bit"], "inner").join(counts, ["group", "word", "bit", "bucket"])
        .withColumn("at", F.col("before") + F.col("smaller") + F.col("ahead") + F.coalesce(F.sum("n").over(in_bucket), F.lit(0)))
    )
    blocks = first.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / SLOTS))))
    dealt = blocks.repartition("group", "word", "bit", "leaf", "block").withColumn(
        "copy", F.explode(F.sequence(F.col("block") * SLOTS, F.least(F.col("n"), (F.col("block") + 1) * SLOTS) - 1))
    )
    return plain.unionByName(dealt.select("group", "doc_id", "leaf", "changed", (F.col("at") + F.col("copy")).alias("at"), "size"))


def _depth(size: Column) -> Column:
    """Levels above the leaves until one node is left."""
    return sum((F.when(size > FANOUT**k, 1).otherwise(0) for k in range(1, 40)), F.when(size > 1, 1).otherwise(0))


def _reduced(nodes: DataFrame, round_: int, *carried: str) -> DataFrame:
    """One row per SLOTS nodes: `tree`, the hashes of each level up to `top`, and the carried columns by slot.

    nodes: group, at, hash, size. A slot array has its key and its place from `at` alone.
    """
    grouped = nodes.groupBy("group", F.floor(F.col("at") / SLOTS).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("at", "hash", *carried))).alias("slots"), F.max("size").alias("size")
    )
    levels = F.least(F.greatest(_depth(F.col("size")) - round_ * LEVELS, F.lit(0)), F.lit(LEVELS))

    def above(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.size(level) / FANOUT).cast("int") - 1)
        return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(level, i * FANOUT + 1, F.lit(FANOUT)), ""), 256))

    start = F.array(F.transform("slots", lambda x: x["hash"]))
    grown = F.aggregate(F.sequence(F.lit(0), F.col("levels")), start, lambda tree, i: F.when(i == 0, tree).otherwise(F.concat(tree, F.array(above(F.element_at(tree, -1))))))
    return (
        grouped.withColumn("levels", levels).withColumn("tree", grown)
        .withColumn("top", F.element_at(F.element_at("tree", -1), 1))
    )


def _path(slot: Column) -> Column:
    """(before, after) per level: the siblings left and right of the way up from a slot, joined."""

    def beside(level: Column) -> Column:
        at = F.floor(slot / F.pow(F.lit(FANOUT), level)).cast("int")
        nodes, first = F.get("tree", level), at - at % FANOUT
        return F.struct(
            F.array_join(F.slice(nodes, first + 1, at - first), "").alias("before"),
            F.array_join(F.slice(nodes, at + 2, F.lit(FANOUT - 1) - (at - first)), "").alias("after"),
        )

    levels = F.filter(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda i: i < F.col("levels"))
    return F.transform(levels, beside).cast(PATH)


def _rounds(nodes: DataFrame, *carried: str) -> list[DataFrame]:
    """Rounds of slot arrays from the leaves up, until one node is left in every group; `top` is its hash."""
    rounds = [stable(_reduced(nodes, 0, *carried))]
    deepest = rounds[0].agg(F.max(_depth(F.col("size")))).first()[0] or 0
    while len(rounds) * LEVELS < deepest:
        up = rounds[-1].select("group", F.col("block").alias("at"), F.col("top").alias("hash"), "size")
        rounds.append(stable(_reduced(up, len(rounds))))
    return rounds


def _unfolded(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """One row per leaf: the slot's columns, its way to the root as `above`, and what else `above` has per group.

    The way is handed down from round to round, once per slot array.
    """
    rest = [c for c in above.columns if c not in ("group", "above")]
    way = F.concat(_path(F.pmod(F.col("slot")["at"], F.lit(SLOTS)).cast("int")), F.col("above"))
    upper = above.withColumn("block", F.lit(0).cast("long"))
    for r in reversed(rounds):
        met = r.join(upper, ["group", "block"]).withColumn("slot", F.explode("slots"))
        upper = met.select("group", F.col("slot")["at"].alias("block"), way.alias("above"), *rest, "slot")
        below, upper = upper, upper.drop("slot")
    return below.select("group", "above", *rest, "slot.*")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(path, leaf, lambda h, x: F.sha2(F.concat(x["before"], h, x["after"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, source, leaf, subroot, root, proof, folded_root, verified.

    leaf: hash of the row. Leaves of a source ascend by doc_id; every three nodes become one, until one is
    left, the subroot; subroots ascend by source and become the root alike. proof: (before, after) per
    level, the joined siblings on the way up. folded_root: the root recomputed from the row as it is
    checked (see `leaves_of`); verified: it equals the root.

    Null ids come first within a source, the null source first of all; rows without an id are never
    changed. Rows with the same id stand in the order of their hashes, equal rows next to each other. A
    null text is not an empty one. An empty table has no rows. Columns besides FIELDS are ignored.

    A source of any size is spread over tasks: slot arrays hold SLOTS nodes, directory blocks 2^16. Only
    the number of levels, the number of sources and the root reach the driver.
    """
    rows = stable(leaves_of(docs))
    leaves = _rounds(ranked(rows).withColumnRenamed("leaf", "hash"), "doc_id", "changed")
    subroots = stable(leaves[-1].select("group", F.col("top").alias("hash")))
    # Keys of sources begin with "+", but for the null one's: order them by what follows, null first.
    source = F.when(F.col("group").startswith("+"), F.substr("group", F.lit(2)))
    heads = number_rows(subroots.withColumn("source", source), "source", "at", start=0).select(
        F.lit("").alias("group"), "at", "hash", F.lit(subroots.count()).cast("long").alias("size"), F.col("group").alias("of"))
    sources = _rounds(heads, "of")
    root = sources[-1].select("top").first()
    start = sources[-1].select("group", F.expr(f"CAST(array() AS {PATH})").alias("above"))
    ends = _unfolded(sources, start).select(F.col("of").alias("group"), F.col("hash").alias("subroot"), "above")
    return (
        _unfolded(leaves, ends)
        .select("doc_id", source.alias("source"), F.col("hash").alias("leaf"), "subroot", F.lit(root[0] if root else None).cast("string").alias("root"),
                F.col("above").alias("proof"), fold(F.coalesce("changed", "hash"), F.col("above")).alias("folded_root"))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


def proof_digest(proof: Column) -> Column:
    """Hash of the siblings of a proof, joined from the leaf up and left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.concat(x["before"], x["after"])), ""), 256)
