"""One query per operator over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm.common import WORD, table, text_of
from screenlake.llm.fingerprints import fingerprint_documents
from screenlake.llm.licenses import scan_licenses
from screenlake.llm.line_dedup import dedup_lines
from screenlake.llm.merkle import manifest, proof_digest
from screenlake.llm.mixing import mix
from screenlake.llm.near_dedup import near_duplicate_classes
from screenlake.llm.oracles import ORACLES
from screenlake.llm.packing import pack
from screenlake.llm.pii import BASE_KINDS, find_personal_data, spans_text
from screenlake.llm.quality import THRESHOLD, fit, fold_of, score_quality
from screenlake.llm.runs import find_runs
from screenlake.llm.secrets import find_secrets
from screenlake.llm.topk import integer_vectors, top_k
from screenlake.llm.urls import LISTED, UNWANTED, filter_urls, host_rule, pattern_rule, rules_table

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", (fold_of() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        one = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
        return F.array_join(one, ",")

    base = F.filter("spans", lambda x: x["kind"] != "named")
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"), number("named"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["name"].isin(*BASE_KINDS))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["name"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, BASE_KINDS),
        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda x: x["score"])), F.lit(0.0)).alias("max_score"),
    )


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified"
    )


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [host_rule(*r) for r in LISTED] + [pattern_rule("block", p) for p in UNWANTED]
    judged = filter_urls(table(spark, sf_dir, "pages"), rules_table(spark, rules))
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one text of ten, by the crc32 of its id, the words from one on repeat a stretch of them."""
    h = F.crc32(F.col("doc_id").cast("string"))

    def changed(words: Column) -> Column:
        n, g = F.size(words), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
        # A stretch is more than a tenth of the tail.
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.lit(10)))
        return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " ")

    words = F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0))
    # An array of one, so that the words are cut once and not wherever they are used.
    text = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, changed(w))), 1)
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(text, F.lit(""))).otherwise(text_of()).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(repeated_tails(table(spark, sf_dir, "documents")))
    none = F.expr("CAST(null AS STRUCT<start: LONG, length: LONG, period: LONG>)")
    # Runs come by start, then period: of equal exponents the first stays.
    greater = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    best = F.aggregate("runs", none, lambda best, x: F.when(greater(best, x), x).otherwise(best))
    line = F.transform("runs", lambda x: F.concat(F.concat_ws(",", *(x[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_pack_sequences": op1_pack_sequences,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_license_scan": op3_license_scan,
    "op4_secret_scan": op4_secret_scan,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_line_dedup": op6_line_dedup,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_source_mixing": op8_source_mixing,
    "op9_personal_data": op9_personal_data,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_url_filter": op12_url_filter,
    "op13_periodic_runs": op13_periodic_runs,
}
