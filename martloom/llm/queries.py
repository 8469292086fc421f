"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, clustering, decontam, html_text, langid, language_model, pii, preference, simhash, sketch, toxicity, url_filter, whitening
from martloom.llm.common import fold, held_out, ship
from martloom.llm.stages import PSEUDONYM_KEY, RANK_FILE


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out("doc_id")))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        "n_sentences",
        F.size("offending").cast("long").alias("n_offending"),
    )


def op2_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = preference.format_replies(read(spark, sf_dir, "conversations"))

    def shown(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        F.col("pair_id").alias("conv_id"),
        F.col("n_shared").cast("long").alias("n_shared"),
        "prompt",
        "chosen",
        shown("chosen_spans").alias("chosen_spans"),
        "rejected",
        shown("rejected_spans").alias("rejected_spans"),
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), RANK_FILE, public_tokenizers.PATTERN)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    profiles = langid.fit(docs.where(~held_out("doc_id")))
    found = langid.identify(docs, profiles)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.pseudonymize(docs, PSEUDONYM_KEY, kinds="kinds")
    return found.select("doc_id", "text", F.size("kinds").cast("long").alias("n_values"), F.array_join("kinds", ",").alias("kinds"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontam.is_contaminated().alias("contaminated"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited_pairs(read(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(read(spark, sf_dir, "embeddings"))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = F.coalesce(fold("doc_id", 5) == 1, F.lit(False))
    return language_model.score(docs, ~held).withColumn("held_out", held)


QUERIES = {
    q.__name__: q
    for q in (
        op1_toxicity,
        op2_preference,
        op3_byte_bpe,
        op4_html_text,
        op5_url_filter,
        op6_language_id,
        op7_pii,
        op8_simhash,
        op9_decontamination,
        op10_fingerprints,
        op11_whitening,
        op12_clustering,
        op13_language_model,
    )
}
ORACLES: dict[str, str] = {}
