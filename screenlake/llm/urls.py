"""URL filters: pattern rules, each indexed by its rarest literal token.

A rule can only match a URL that holds all of its literal tokens. It is therefore kept under the one of
them that the fewest URLs hold; the tokens of a URL fetch the rules kept under them, and only those rules
run their regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.operators.joins import salted_join
from screenlake.session import stable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[0-9a-z]+"
# Every URL has this one; rules without a literal token are kept under it.
ANY = ""
# Up to so many index rows the index is sent to every executor; beyond, both sides are shuffled.
BROADCAST_ROWS = 50_000
ALLOW, BLOCK = "allow", "block"
RULES = "rule STRING, regex STRING, tokens ARRAY<STRING>, verdict STRING, listed BOOLEAN, weight INT"


class Rule(NamedTuple):
    """A rule: what it is called, its regular expression over host and rest of a URL, and its literal tokens.

    Listed rules decide before the others; among them the greatest weight wins, then `block`, then the name.
    """

    rule: str
    regex: str
    tokens: list[str]
    verdict: str
    listed: bool
    weight: int


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A listed rule for a host, its subdomains and all paths that begin with `path`; the longest wins."""
    low = str.maketrans(UPPER, LOWER)
    regex = rf"^(?:[^/?#]*\.)?{re.escape(host.translate(low))}(?:$|(?=[/?#])){re.escape(path)}"
    # What ends the path may go on in a URL, so it is no whole token.
    tokens = re.findall(TOKEN, host.translate(low)) + re.findall(f"{TOKEN}(?![0-9a-z]|$)", path.translate(low))
    return Rule(host + path, regex, sorted(set(tokens)), verdict, True, len(host + path))


def pattern_rule(verdict: str, pattern: str) -> Rule:
    """An unlisted rule. In `pattern` `*` is any text, `^` an end of the URL or a character that is neither
    letter nor digit; everything else is literal, in either case of A-Z. It may match anywhere.

    Runs of letters and digits between two characters that are neither `*` nor the pattern's end are tokens.
    """
    said = {"*": ".*", "^": r"(?:^|$|[^0-9A-Za-z])"}
    regex = "(?is)" + "".join(said.get(c) or re.escape(c) for c in pattern)
    tokens = re.findall(rf"(?<![0-9a-z*]){TOKEN}(?![0-9a-z*])", f"*{pattern.translate(str.maketrans(UPPER, LOWER))}*")
    return Rule(pattern, regex, sorted(set(tokens)), verdict, False, len(pattern))


# Verdict, host and path of the listed rules.
LISTED = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
# Words that sites for betting, pills and link farms carry in their names.
UNWANTED = (
    "^casino^", "^casinos^", "^poker^", "^slots^", "^jackpot^", "^bets^", "^betting^", "^pills^", "^viagra^", "^cialis^", "^payday-loans^",
    "^spam^", "^spam-farm.", "^link-farm.", "^linkfarm^", "^cheap-pills.", "^casino-win.", "^free-bets.", "^free-money^", "^porn^", "^xxx^", "^warez^",
    "^replica-watches^",
)


def rules_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], RULES)


def host_of(url: str | Column = "url") -> Column:
    """Between the first `://` and `/`, `?`, `#` or the end, A-Z as a-z; empty without `://` and for null."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: str | Column = "url") -> Column:
    """What follows the host, up to `?`, `#` or the end; empty without `://` and for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(text: Column) -> Column:
    """The distinct runs of letters and digits, A-Z as a-z, and the token that all texts have."""
    return F.array_distinct(F.concat(F.array(F.lit(ANY)), F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TOKEN), F.lit(0))))


def rarest_tokens(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules with `token`: of a rule's literal tokens the one that the fewest rows of `urls` hold.

    Counted over all URLs; a token that none holds counts 0, and its rules are never fetched.
    """
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    seen = urls.select(F.explode("tokens").alias("token"))
    counts = _joined(seen, wanted, "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    each = rules.withColumn("token", F.explode_outer("tokens")).join(counts, "token", "left")
    rare = each.groupBy("rule", "regex", "verdict", "listed", "weight").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("token", F.lit(ANY)).alias("token"))).alias("least")
    )
    return rare.select("rule", "regex", "verdict", "listed", "weight", F.col("least.token").alias("token"))


def _joined(urls: DataFrame, lookup: DataFrame, how: str) -> DataFrame:
    """Join by token to a table with one row per token: sent around if small, else with hot tokens salted."""
    if lookup.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return urls.join(F.broadcast(lookup), "token", how)
    return salted_join(urls, lookup, ["token"], how)


def judge_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, pattern, verdict) for every row of `urls` (url, distinct) that a rule matches.

    rule: the listed rule that wins, null if none matches; pattern: the unlisted one; verdict: of the former,
    else of the latter. Blocking patterns win over allowing ones, then the longest, then the first by name.
    """
    cut = stable(urls.select("url", F.concat(host_of(), F.regexp_extract("url", r"(?s)^.*?://[^/?#]*(.*)", 1)).alias("text"))
                 .withColumn("tokens", tokens_of(F.col("text"))))
    kept = stable(rarest_tokens(cut, rules))
    # One row per token; the rules of a token are few, as it is the rarest of each.
    index = kept.groupBy("token").agg(F.collect_list(F.struct("rule", "regex", "verdict", "listed", "weight")).alias("rules"))
    fetched = _joined(cut.select("url", "text", F.explode("tokens").alias("token")), index, "inner")
    hits = fetched.withColumn("r", F.explode("rules")).where(F.regexp_like("text", F.col("r.regex")))
    blocks = (F.col("r.verdict") == BLOCK).cast("int")

    named = F.struct(F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"))
    # The least name among equals first, then the greatest of what tells rules apart.
    top = hits.groupBy("url", F.col("r.listed").alias("listed"), F.col("r.weight").alias("weight"), blocks.alias("blocks")).agg(F.min(named).alias("named"))
    win = top.groupBy("url").agg(
        F.max_by("named", F.when(F.col("listed"), F.struct("weight", "blocks"))).alias("of_list"),
        F.max_by("named", F.when(~F.col("listed"), F.struct("blocks", "weight"))).alias("of_pattern"),
    )
    return win.select(
        "url", F.col("of_list.rule").alias("rule"), F.col("of_pattern.rule").alias("pattern"),
        F.coalesce("of_list.verdict", "of_pattern.verdict").alias("verdict"),
    )


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, pattern, verdict.

    rule: the listed rule that decides, pattern: the unlisted one that would; both null where none matches, and
    the verdict is then allow. A URL of null or without `://` has an empty host and path and is allowed, unless a
    rule without host matches the empty text. Each different URL is judged once, so a URL that most rows have is no
    hot group; its rows fetch the verdict over several tasks. Repeated rows and null ids come out as they are,
    an empty table gives no rows, other columns are ignored. SQL expressions only.
    """
    own = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    judged = judge_urls(own.select("url").distinct(), rules)
    return salted_join(own, judged, ["url"]).select(
        "page_id", host_of().alias("host"), path_of().alias("path"), "rule", "pattern", F.coalesce("verdict", F.lit(ALLOW)).alias("verdict")
    )
