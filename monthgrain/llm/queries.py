"""The numbered queries, their production parameters and, where SQL can say it, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontamination, language, line_chunks, mixing, pseudonyms, quality, quality_votes, simhash, spelling, toxicity, winnowing
from .common import documents, remainder
from .token_records import token_records


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_fingerprints(documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def scored(scores: DataFrame, modulus: int, held: int, threshold: float) -> DataFrame:
    """doc_id and score, with what is held out and what is predicted."""
    held_out = F.coalesce(remainder("doc_id", modulus) == held, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(toxicity.scores(docs, toxicity.fit(docs, labels(spark, sf_dir))), 3, 1, toxicity.THRESHOLD)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = mixing.decide(documents(spark, sf_dir), mixing.word_count(F.col("text")))
    return decided.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), (F.col("size") * F.col("copies")).alias("taken"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(quality.scores(docs, quality.fit(docs, labels(spark, sf_dir))), 5, 0, quality.THRESHOLD)


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records(documents(spark, sf_dir), tokenizer_path(), end_id=2).select("doc_id", "start", "n_tokens", "ids_crc32", "file_no", "offset", "length")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return language.predictions(docs, language.fit(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


#: Stands in for the key of an installation, which belongs in its secret store.
EXAMPLE_KEY = b"an example key, not a secret one"


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonyms.pseudonyms(documents(spark, sf_dir), EXAMPLE_KEY)
    counts = [F.col(f"pii.{k}").cast("long").alias(f"n_{k}") for k in pseudonyms.KINDS]
    return done.select("doc_id", "text", *counts)


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(spelling.damaged(documents(spark, sf_dir))))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_votes.judged(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("probability", 6).alias("probability"))


QUERIES = {
    "op1_winnowing": op1_winnowing,
    "op2_simhash": op2_simhash,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_token_records": op6_token_records,
    "op7_decontamination": op7_decontamination,
    "op8_language": op8_language,
    "op9_pseudonyms": op9_pseudonyms,
    "op10_line_chunks": op10_line_chunks,
    "op11_spelling": op11_spelling,
    "op12_conversations": op12_conversations,
    "op13_quality_votes": op13_quality_votes,
}

ORACLES: dict[str, str] = {
    "op4_mixing": mixing.SQL,
    "op10_line_chunks": line_chunks.SQL,
    "op11_spelling": spelling.SQL,
    "op12_conversations": conversations.SQL,
    "op13_quality_votes": quality_votes.SQL,
}
