"""The corpus pipeline: five stages, each of which works on all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written
as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``. Missing ids, repeated rows, empty and NULL texts and
further columns pass through; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telltale.llm import bpe, compression_quality, decontaminate, simhash, substrings
from telltale.llm.queries import MIN_SCORE, TOKENIZER, quality_model, table
from telltale.llm.tasks import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    score = "__quality_score"
    scored = compression_quality.score_texts(docs, quality_model(docs, sf_dir), into=score)
    return scored.where(F.col(score) >= MIN_SCORE).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near copies, the one with the smallest id."""
    return simhash.first_of_each(docs, shingle=3, distance=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out passages of 20 words or more that also start earlier in the corpus."""
    cut = substrings.cut_repeats(docs, window=20).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether decoding gives the text back."""
    texts = docs.select("doc_id", "text")
    return bpe.encode_texts(texts, TOKENIZER, decoded="decoded").select(
        "doc_id",
        "ids",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Neither the classifier nor byte-pair encoding can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
