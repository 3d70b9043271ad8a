"""The registered queries of the training-data operators, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.bpe import with_bpe
from candlewick.llm.embedding_dedup import embedding_components
from candlewick.llm.fim import fill_in_middle, restore_text
from candlewick.llm.importance import importance_sample
from candlewick.llm.langid import Profiles, learn_profiles, with_language
from candlewick.llm.lm import score_texts
from candlewick.llm.mixing import mix_sources
from candlewick.llm.quality_rules import judge_quality
from candlewick.llm.secrets import BASE_RULES, scan_history, span_list
from candlewick.llm.shared import crc_remainder, table
from candlewick.llm.simhash import simhash_components
from candlewick.llm.toxicity import THRESHOLD, ToxicityModel, learn_toxicity, with_toxicity
from candlewick.llm.url_filter import judge_urls
from candlewick.llm.wordpiece import with_piece_counts

#: File of the public byte-level tokenizer in the package that holds the vocabularies.
TOKENIZER_FILE = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def toxicity_model(spark: SparkSession, sf_dir: str) -> ToxicityModel:
    """Learned from the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents").where(crc_remainder("doc_id", 4) != 2)
    return learn_toxicity(docs, table(spark, sf_dir, "labels"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_toxicity(docs, toxicity_model(spark, sf_dir), into="score")
    return scored.select("doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_piece_counts(docs, tokenizer_path()).select("doc_id", "__cw_pieces.*")


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_remainder("doc_id", 10) == 0
    scored = score_texts(docs, ~held_out, extra={"held_out": held_out})
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def language_profiles(docs: DataFrame) -> Profiles:
    """Learned from the documents that are not held out."""
    return learn_profiles(docs.where(crc_remainder("doc_id", 5) != 0))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = with_language(docs.select("doc_id", "text"), language_profiles(docs), into="r")
    return judged.select("doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "r.lang_pred", "r.score")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_bpe(docs, tokenizer_path(), digest=True).select("doc_id", "__cw_bpe.*")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rewritten = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "__cw_fim.*")
    return rewritten.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore_text(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_history(table(spark, sf_dir, "documents"), ["doc_id"])
    spans, kinds = F.col("spans"), [r.kind for r in BASE_RULES]
    counts = [F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}") for kind in kinds]
    return found.select("doc_id", *counts, F.sha2(span_list(spans, kinds), 256).alias("base_sha256"), span_list(spans).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_lm_scores": op4_lm_scores,
    "op5_language_id": op5_language_id,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filters": op8_url_filters,
    "op9_bpe": op9_bpe,
    "op10_source_mix": op10_source_mix,
    "op11_importance": op11_importance,
    "op12_fim": op12_fim,
    "op13_secrets": op13_secrets,
}
