"""The operators with production parameters over whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telltale.llm import (
    bpe,
    compression_quality,
    decontaminate,
    kneser_ney,
    merkle,
    mixing,
    prefix_trie,
    quality_rules,
    sequence_files,
    simhash,
    substrings,
    token_counts,
    url_reputation,
)
from telltale.llm.tasks import only, stored
from telltale.session import run_dir

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

URL_RULES = tuple(
    url_reputation.parse_rule(line)
    for line in (
        "allow com/",
        "block example.com/en/",
        "allow www.example.com/en/",
        "block net/es/",
        "block net/fr/",
    )
)

# A document with a lower score is rejected.
MIN_SCORE = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components_of(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = compression_quality.held_out(parts=7, part=2)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_ney.train(docs.where(~held_out), run_dir(spark, "language-model"))
    return kneser_ney.score_texts(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_texts(docs, TOKENIZER, decoded="decoded").select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    histogram = stored(token_counts.length_histogram(docs, TOKENIZER), "lengths")
    return token_counts.length_sums(histogram)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.cut_repeats(docs, window=20).select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(substrings.plain_words(), 256).alias("kept_sha256"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op8_sequence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = run_dir(spark, "sequences")
    files = stored(sequence_files.write_sequences(docs, folder, TOKENIZER), "sequence-files")
    places = sequence_files.read_places(files, folder).select(
        "doc_id", "file", "at", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    return sequence_files.with_starts(places, files).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are those of the document with the number of the page."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.col("quality").alias("good")
    )
    return url_reputation.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, outcomes)


def quality_model(docs: DataFrame, sf_dir: str) -> compression_quality.QualityModel:
    """Labels of held-out documents are not learnt."""
    labels = table(docs.sparkSession, sf_dir, "labels").where(~compression_quality.held_out())
    return compression_quality.fit(docs, labels, "quality")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = compression_quality.score_texts(docs, quality_model(docs, sf_dir))
    return scored.select(
        "doc_id",
        compression_quality.held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= MIN_SCORE, 1).otherwise(0).alias("predicted"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.shared_heads(turns))


def manifest_rows(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, folded from a lower-cased text for a fifth of them."""
    docs = only(docs, "doc_id", "source", "lang", "n_chars", "text")
    small = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    before = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    # Texts are read once; from here on there are digests only.
    leaves = docs.select(
        "doc_id",
        "source",
        merkle.row_digest([*before, F.col("text")]).alias("leaf"),
        F.when(tampered, merkle.row_digest([*before, small])).alias("claimed"),
    )
    proofs = merkle.manifest(leaves, group="source", order="doc_id", leaf="leaf").proofs
    claimed = F.coalesce("claimed", "leaf")
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("steps")).alias("proof_sha256"),
        merkle.folded(claimed, F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_rows(table(spark, sf_dir, "documents"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


_QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_bpe": op3_bpe,
    "op4_decontamination": op4_decontamination,
    "op5_token_counts": op5_token_counts,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_sequence_files": op8_sequence_files,
    "op9_url_filters": op9_url_filters,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_source_mixing": op13_source_mixing,
}


def registered() -> dict[str, Query]:
    return dict(_QUERIES)
