"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import licenses, mixing, near, pieces, private, quality, ranked, repeats, spelling, substrings, topk, toxicity, urls
from postmill.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
    )


def op2_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", F.xxhash64("text").alias("_text")).join(private.find_private(docs), F.col("doc_id").eqNullSafe(F.col("_key")) & (F.col("_text") == F.col("_part")), "left")
    base, terms = (F.coalesce(c, F.lit("")) for c in ("base", "terms"))
    counts = [F.size(F.filter(F.split(base, ","), lambda x: F.substring_index(x, ":", 1) == kind)).cast("long").alias(f"n_{kind}") for kind in private.KINDS[:4]]
    spans = F.array_join(F.filter(F.array(base, terms), lambda x: x != ""), ",")
    return rows.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"), F.coalesce("removed", F.lit("")).alias("removed"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select("page_id", "host", "path", "rule", "verdict", "pattern")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = taken.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).drop("text")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_texts(docs, pieces.PieceModel.load()).drop("text")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_private_data": op2_private_data,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_url_filter": op4_url_filter,
    "op5_source_mix": op5_source_mix,
    "op6_quality": op6_quality,
    "op7_repeats": op7_repeats,
    "op8_toxicity": op8_toxicity,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_ranked_search": op13_ranked_search,
}
