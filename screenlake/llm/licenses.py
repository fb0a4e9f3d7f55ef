"""License scans: canonical texts looked up by digest in a table of known license texts."""

from __future__ import annotations

from functools import reduce
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm.common import text_of
from screenlake.operators.joins import salted_join
from screenlake.session import stable

# Complete texts and the headers of files, as published; a file is named by its license, then its variant.
TEXTS = Path(__file__).parent / "license_texts"
# Titles that a short text may carry above its first paragraph.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "BSD License"),
    "Zlib": ("zlib License", "The zlib License"), "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
}
# License notices and the identifiers they stand for.
KNOWN_NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# Equivalent spellings, word for word, applied to canonical text in this order.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("v 2 0", "version 2 0"), ("v 2", "version 2"), ("v 3", "version 3"), ("v2", "version 2"), ("v3", "version 3"),
    ("copyright holder", "copyright owner"), ("copyright holders", "copyright owners"),
    ("noncommercial", "non commercial"), ("organisation", "organization"), ("acknowledgement", "acknowledgment"),
    ("per cent", "percent"), ("whilst", "while"), ("fulfil", "fulfill"),
]
# d: only \n ends a line.
COPYRIGHT_LINE = r"(?md)^[ \t\r*#/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
# In runs of lines a line is only a copyright line if it does not go on with a sentence; upper and lower case tell too.
NOTICE_LINE = (
    r"(?md)^[ \t\r*#/;-]*((?i:copyright[ \t]*(\(c\)|©|[0-9:])|\(c\)[ \t]*(copyright|©|[0-9]{4})|©|all rights reserved)"
    r"|(Copyright|COPYRIGHT)[ \t]+(?i:(?!holder|owner|notice|licen|law|statement|interest|treat|disclaimer|doctrine"
    r"|material|permission|protection|right|status|and\b|or\b|in\b|on\b|to\b|is\b)[^ \t\n]))[^\n]*$"
)
# Spellings of several words, word by word: with them and without blanks, spelled lines add up to a spelled text.
LOOSE = {a: b for said, meant in SPELLINGS if len(said.split()) == len(meant.split()) > 1 for a, b in zip(said.split(), meant.split()) if a != b}
# Letters of a run's beginning that a line is first judged by; no result depends on it.
LEAD = 16


def known_texts() -> list[tuple[str, str]]:
    """(license, text): the notices, and the complete texts and headers with and without their titles."""
    said = list(KNOWN_NOTICES)
    for path in sorted(TEXTS.glob("*.txt")):
        license, text = path.stem.split("--")[0], path.read_text(encoding="utf-8")
        said += [(license, text), *((license, f"{title}\n\n{text}") for title in TITLES.get(license, ()))]
    return said


def _spell(words: Column) -> Column:
    """Equivalent spellings made one. Words stand between two spaces each, so neighbours both match."""
    for said, meant in SPELLINGS:
        words = F.replace(words, F.lit(f" {said} ".replace(" ", "  ")[1:-1]), F.lit(f" {meant} ".replace(" ", "  ")[1:-1]))
    return F.btrim(F.regexp_replace(words, " +", " "))


def _plain(text: Column, copyright: str | None = COPYRIGHT_LINE) -> Column:
    """Lower case, no copyright lines, punctuation and blanks as two spaces; lines stay apart."""
    bare = F.regexp_replace(F.lower(text), copyright, "") if copyright else F.lower(text)
    return F.concat(F.lit("  "), F.regexp_replace(bare, r"[^0-9a-z\n\x{80}-\x{10FFFF}]+", "  "), F.lit("  "))


def canonical(text: Column) -> Column:
    """A whole text in canonical form, on one line."""
    return _spell(F.replace(_plain(text), F.lit("\n"), F.lit("  ")))


def run_lines(text: Column) -> Column:
    """The canonical forms of a text's lines that are not empty; lines that go on about copyright stay."""
    spaced = _spell(F.replace(_plain(F.regexp_replace(text, NOTICE_LINE, ""), None), F.lit("\n"), F.lit("  \n  ")))
    return F.filter(F.split(spaced, " *\n *", -1), lambda x: x != "")


def _joined(lines: Column) -> Column:
    """The canonical form of adjacent lines as one text: spellings also across their ends."""
    return _spell(F.concat(F.lit("  "), F.replace(F.array_join(lines, " "), F.lit(" "), F.lit("  ")), F.lit("  ")))


def _letters(lines: Column) -> Column:
    """Lines without blanks, loosely spelled: equal texts have equal letters, however they are wrapped."""
    text = F.array_join(lines, "\n")
    for a, b in LOOSE.items():
        text = F.regexp_replace(text, rf"(?<![^ \n]){a}(?![^ \n])", b)
    return F.split(F.replace(text, F.lit(" "), F.lit("")), "\n", -1)


def _needles(texts: list[str]) -> list[str] | None:
    """Strings one of which is in every known text, however spelled or wrapped; None if there are none."""
    odd = {w for said, meant in SPELLINGS if " " in said + meant for w in (said + " " + meant).split()} - {"license"}
    spelled: dict[str, set[str]] = {}
    for said, meant in SPELLINGS:
        if " " not in said + meant:
            spelled.setdefault(meant, set()).add(said)
    words = [{w for w in t.split() if w not in odd and w not in LOOSE} for t in texts]
    found: list[str] = []
    while words:
        if not all(words):
            return None
        often: dict[str, int] = {}
        for w in (w for ws in words for w in ws):
            often[w] = often.get(w, 0) + 1
        best = max(often, key=lambda w: (len(w) > 6, often[w], len(w), w))
        found += [best, *sorted(spelled.get(best, ()))]
        words = [ws for ws in words if best not in ws]
    return found


def _forms(known: DataFrame) -> DataFrame:
    """(license, whole, run, letters, d1, d2) of known texts: canonical as a whole and as a run of lines, with digests."""
    text, lines = F.col("_text"), F.col("_lines")
    return (
        known.select("license", text_of().alias("_text"))
        .select("license", canonical(text).alias("whole"), run_lines(text).alias("_lines"))
        .select("license", "whole", _joined(lines).alias("run"), F.array_join(_letters(lines), "").alias("letters"))
        .withColumns({"d1": F.sha2("whole", 256), "d2": F.sha2("run", 256)})
    )


def _starts(letters: Column, lead: int) -> Column:
    """(i, lead) for every line: the letters that the text goes on with from there."""
    return F.transform(letters, lambda _, i: F.struct(i.alias("i"), F.left(F.array_join(F.slice(letters, i + 1, F.lit(lead)), ""), F.lit(lead)).alias("lead")))


def _runs(letters: Column, lead: int, leads: Column, heads: Column) -> Column:
    """(i, n) of the runs of n lines from i on that begin and are as long as a known text.

    `leads` holds the beginnings of known texts, `heads` their (lead, sizes).
    """

    def ends(i: Column, own: Column) -> Column:
        """How many lines from i on make up as many letters as a known text of the same beginning has."""
        step = lambda s, y: F.struct(
            (s["at"] + F.length(y)).alias("at"), (s["n"] + 1).alias("n"),
            F.when(F.array_contains(own, s["at"] + F.length(y)), F.concat(s["hit"], F.array(s["n"] + 1))).otherwise(s["hit"]).alias("hit"),
        )
        begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.expr("CAST(array() AS ARRAY<INT>)").alias("hit"))
        return F.aggregate(F.slice(letters, i + 1, F.array_max(own)), begin, step, lambda s: s["hit"])

    heard = F.filter(_starts(letters, lead), lambda s: F.array_contains(leads, s["lead"]))
    sized = F.transform(heard, lambda s: F.struct(s["i"].alias("i"), ends(s["i"], F.filter(heads, lambda h: h["lead"] == s["lead"])[0]["sizes"]).alias("n")))
    return F.flatten(F.transform(sized, lambda s: F.transform(s["n"], lambda n: F.struct(s["i"].alias("i"), n.alias("n")))))


def _digested(rows: DataFrame, *keys: str) -> DataFrame:
    """One row (keys, i, n, all, digest) for the whole text (i = -1) and for each of its `_runs`."""
    lines = F.col("_lines")
    whole = F.array(F.struct(F.lit(-1).alias("i"), F.lit(0).alias("n"), F.lit(False).alias("all"), F.sha2("_canon", 256).alias("digest")))
    found = F.transform("_runs", lambda r: F.struct(
        r["i"].alias("i"), r["n"].alias("n"), (r["n"] == F.size(lines)).alias("all"), F.sha2(_joined(F.slice(lines, r["i"] + 1, r["n"])), 256).alias("digest")))
    parts = F.explode(F.when(F.size("_runs") > 0, F.concat(whole, found)).otherwise(whole))
    return rows.select(*keys, parts.alias("_part")).select(*keys, "_part.*")


def _reported(met: DataFrame, *keys: str) -> DataFrame:
    """The licenses of each text, from its digested parts and the licenses that they met."""
    hit = F.when((F.col("i") >= 0) & F.col("license").isNotNull(), F.struct("i", (-F.col("n")).alias("less"), "license"))
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"), F.expr("CAST(array() AS ARRAY<STRING>)").alias("names"))
    # By start, longest first: a run inside one before it is part of that one.
    outer = F.aggregate(F.array_sort("_hits"), begin, lambda s, x: F.when(
        x["i"] - x["less"] > s["end"],
        F.struct((x["i"] - x["less"]).alias("end"), (s["n"] + 1).alias("n"), F.array_union(s["names"], F.array(x["license"])).alias("names")),
    ).otherwise(s))
    return (
        met.groupBy(*keys)
        .agg(
            F.max(F.when(F.col("i") < 0, F.col("digest"))).alias("text_digest"),
            F.max(F.when(F.col("i") < 0, F.col("license"))).alias("_whole"),
            F.max(F.when(F.col("all"), F.col("license"))).alias("_all"),
            F.collect_list(hit).alias("_hits"),
        )
        .withColumn("_outer", outer)
        .select(
            *keys, "text_digest", F.coalesce("_whole", "_all").alias("text_license"),
            F.col("_outer.n").alias("n_notices"), F.array_join(F.array_sort("_outer.names"), ",").alias("notice_licenses"),
        )
    )


def _scan_list(docs: DataFrame, known: list[tuple[str, str]]) -> DataFrame:
    """scan_licenses() for a list of known texts: the driver holds their digests, lengths and first letters."""
    spark, text = docs.sparkSession, F.col("_text")
    forms = _forms(spark.createDataFrame(known, "license STRING, text STRING")).collect()
    named: dict[str, str] = {}
    for r in forms:
        for digest in [r["d1"]] * (r["whole"] != "") + [r["d2"]] * (r["run"] != ""):
            named[digest] = min(r["license"], named.get(digest, r["license"]))
    letters = {r["letters"] for r in forms if r["run"]}
    lead = min([LEAD, *map(len, letters)])
    starts: dict[str, set[int]] = {}
    for x in letters:
        starts.setdefault(x[:lead], set()).add(len(x))
    needles = _needles([r["run"] for r in forms if r["run"]])
    suspect = F.lit(True) if needles is None else reduce(or_, (F.contains(F.lower(text), F.lit(n)) for n in needles), F.lit(False))
    heads = F.array(*(F.struct(F.lit(k).alias("lead"), F.array(*map(F.lit, sorted(v))).alias("sizes")) for k, v in sorted(starts.items())))
    runs = _runs(_letters(F.col("_lines")), lead, F.array(*map(F.lit, sorted(starts))), heads)
    # Only texts that may hold a known text are read line by line, and only runs that may be one are digested.
    rows = (
        docs.select("doc_id", text_of().alias("_text"))
        .select("doc_id", F.monotonically_increasing_id().alias("_row"), canonical(text).alias("_canon"), F.when(suspect, run_lines(text)).alias("_lines"))
        .withColumn("_runs", F.when(F.size("_lines") > 0, runs))
    )
    wanted = spark.createDataFrame(sorted(named.items()), "digest STRING, license STRING")
    return _reported(_digested(rows, "_row", "doc_id").join(F.broadcast(wanted), "digest", "left"), "_row", "doc_id").drop("_row")


def _scan_table(docs: DataFrame, known: DataFrame) -> DataFrame:
    """scan_licenses() for a table of known texts of any size: beginnings and digests are met by salted joins.

    Each different text is scanned once and its result handed to all rows that hold it.
    """
    forms = stable(_forms(known))
    shortest = forms.where("run != ''").agg(F.min(F.length("letters"))).first()[0]
    lead = min(LEAD, shortest or LEAD)
    digests = F.explode(F.filter(F.array(F.when(F.col("whole") != "", F.col("d1")), F.when(F.col("run") != "", F.col("d2"))), F.isnotnull))
    wanted = forms.select("license", digests.alias("digest")).groupBy("digest").agg(F.min("license").alias("license"))
    starts = forms.where("run != ''").groupBy(F.left("letters", F.lit(lead)).alias("lead")).agg(F.collect_set(F.length("letters")).alias("sizes"))
    texts = docs.select("doc_id", text_of().alias("_text")).withColumn("_key", F.sha2("_text", 256))
    once = stable(
        texts.select("_key", "_text").dropDuplicates(["_key"])
        .select("_key", canonical(F.col("_text")).alias("_canon"), run_lines(F.col("_text")).alias("_lines"))
        .withColumn("_letters", _letters(F.col("_lines")))
    )
    begun = once.select("_key", F.explode(F.array_distinct(_starts(F.col("_letters"), lead)["lead"])).alias("lead"))
    heads = salted_join(begun, starts, ["lead"], "inner").groupBy("_key").agg(F.collect_list(F.struct("lead", "sizes")).alias("_heads"))
    runs = _runs(F.col("_letters"), lead, F.col("_heads")["lead"], F.col("_heads"))
    rows = once.join(heads, "_key", "left").withColumn("_runs", F.when(F.size("_heads") > 0, runs))
    reported = _reported(salted_join(_digested(rows, "_key"), wanted, ["digest"]), "_key")
    return salted_join(texts.select("doc_id", "_key"), reported, ["_key"]).drop("_key")


def scan_licenses(docs: DataFrame, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(doc_id, text_digest, text_license, n_notices, notice_licenses) for every row of `docs`.

    text_license is the known license whose canonical text the whole document is; n_notices counts
    its runs of adjacent lines, single ones too, that as a whole are a known text and do not lie
    inside a longer one; notice_licenses names those licenses in order. Without `known` the known
    texts are known_texts(); a list and a table (license, text) give the same rows.

    Null text is empty; an empty canonical text matches nothing. Repeated rows are reported once
    each, null ids too; an empty table gives an empty table. Columns other than doc_id and text are
    ignored. SQL expressions only: only runs that begin and are as long as a known text are digested,
    and met with the known digests by a hash join; rows of one document are combined afterwards. A list
    of known texts, which the driver holds already, is broadcast, and texts stay where they lie. A
    table may be of any size: it is joined by salted beginnings and digests, and each different text
    is shuffled once.
    """
    if isinstance(known, DataFrame):
        return _scan_table(docs, known)
    return _scan_list(docs, known_texts() if known is None else known)
