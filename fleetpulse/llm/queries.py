"""The registered queries: each operator over its whole table, with its contract's result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import temporary_folder
from . import (decontamination, html_text, katz, licenses, line_quality, metric_codes, packing, pii_crf, quality_svm, simhash, spelling, sql,
               token_files, toxicity_gru)
from .common import fold, table


#: Scores from these on are predicted as label 1.
QUALITY_LIMIT, TOXIC_LIMIT = 0.3, 0.7
#: Consecutive tokens of a benchmark item that are a leak by themselves.
QUOTED_TOKENS = 13


def tokenizer_path(name: str) -> str:
    """Where the installed public vocabulary file ``name`` is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), keep=("page_id", "url"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 5) == 0
    model = quality_svm.train(docs, table(spark, sf_dir, "labels"), "quality", usable=~held_out)
    scored = quality_svm.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_LIMIT).cast("int").alias("predicted"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii_crf.find(docs, pii_crf.train(docs))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 3) == 1
    net = toxicity_gru.train(docs, table(spark, sf_dir, "labels"), "toxic", usable=~held_out)
    scored = toxicity_gru.score(docs, net)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_LIMIT).cast("int").alias("predicted"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{temporary_folder(spark, 'token-ids')}/files"
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return token_files.read(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), verbatim=QUOTED_TOKENS)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = line_quality.line_rules(table(spark, sf_dir, "documents"))
    return ruled.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2, with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2, order=2)[0]


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_codes.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_token_ids": op5_token_ids,
    "op6_decontamination": op6_decontamination,
    "op7_simhash": op7_simhash,
    "op8_license_scan": op8_license_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_vector_codes": op13_vector_codes,
}

SQL: dict[str, str] = dict(sql.SQL)
