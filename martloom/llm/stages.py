"""The operators as stages of a pipeline over documents. A stage decides for
every row it gets, drops what its operator rejects and keeps the columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, decontam, langid, pii, simhash
from martloom.llm.common import held_out, ship, stored

# A text is in no learnt language if its score is so many standard deviations
# below the mean of those learnt from.
DEVIATIONS = 6.0

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
# No secret here: a real run passes its own key.
PSEUDONYM_KEY = "query key"


def least_score(learnt: DataFrame) -> float:
    """What a text must score to be in a learnt language: by the scores of
    all rows learnt from, as ``found``. 0 if no row of them has a language."""
    row = (
        learnt.where(F.col("found.lang_pred") != langid.UNDETERMINED)
        .agg(F.avg("found.score").alias("mean"), F.stddev_pop("found.score").alias("spread"))
        .first()
    )
    return 0.0 if row["mean"] is None else row["mean"] - DEVIATIONS * row["spread"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those no learnt profile fits. Profiles
    are learnt from the stage's own rows, as the operator's query does, and so
    is the least score of a text that fits. Repeated rows are judged alike;
    without rows to learn from, nothing fits. Each row is scored once: the
    scored rows are stored, read for the least score and read again."""
    ship(spark)
    profiles = langid.fit(docs.where(~held_out("doc_id") & F.col("lang").isNotNull()))
    predict = langid.predict_udf(profiles)
    judged = stored(docs.select(F.struct(*docs.columns).alias("row"), predict(F.col("text")).alias("found")))
    learnt = judged.where(~held_out("row.doc_id") & F.col("row.lang").isNotNull())
    kept = (F.col("found.lang_pred") != langid.UNDETERMINED) & (F.col("found.score") >= least_score(learnt))
    return judged.where(kept).select(*(F.col("row")[c].alias(c) for c in docs.columns))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays."""
    ship(spark)
    return simhash.keep_one(docs, simhash.near_duplicates(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that ``benchmark`` contaminates."""
    ship(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.without_contaminated(docs, decontam.find(docs, items))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; ``n_chars`` follows a changed
    text. Every row stays: NULL and empty texts, texts without values, repeated
    rows; an empty table stays empty."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    out = pii.pseudonymize(rows, PSEUDONYM_KEY)
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed = F.col("text") != F.col("row.text")
        made["n_chars"] = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return out.select(*(made.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes the texts that are left, a row for each: NULL and
    empty texts have no ids, repeated rows equal ones; an empty table has no
    rows. Other columns are left aside."""
    ship(spark)
    return bpe.round_trip(docs, RANK_FILE, public_tokenizers.PATTERN)
