"""The corpus pipeline: documents in, encoded clean documents out.

``STAGES`` lists the steps in order.  Each takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next step's ``docs``; all but the last return the
columns of ``docs``, in their order and whatever else they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm import decontaminate, language_id, minhash_dedup, pii, scratch, sentencepiece_codec


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter (null and empty texts too), or that no learned language explains;
    a missing ``lang`` is filled with the one found.

    Nothing to learn from (an empty table, or no text with a language) keeps every row.  Rows that
    repeat an id are judged one by one, very long texts whole.
    """
    return language_id.keep_identified(docs, language_id.fit_documents(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near duplicates, and one row of those that repeat id and text.

    Rows without an id are told by their text and placed behind all ids.  Texts without words are near
    nothing and stay, once for each id; an empty table stays empty.
    """
    return minhash_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of a benchmark item occurs.

    Rows are told by their text, so null and repeated ids do not matter; null and empty texts stay.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars, if there is such a column, follows the new text.

    Every row stays; null and empty texts stay as they are; rows that repeat id and text are masked alike.
    """
    masked = pii.redact(docs, pii.find(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text, one row for each row; a null or empty text has no ids."""
    return sentencepiece_codec.digests(sentencepiece_codec.encode_documents(docs, sentencepiece_codec.default_model()))


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pii", mask_personal_data),
    ("sentencepiece", encode),
]

#: No SQL form: language ID is a fitted model and the encoder a library's.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.store(docs, name)
    return docs
