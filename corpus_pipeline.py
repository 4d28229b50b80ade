"""A training-data pipeline: toxicity, near-duplicates, decontamination, personal data, packing.

Each stage reads what the stage before it kept, from Parquet, and returns the
documents that it keeps (the last: packed sequences).  ``run`` writes every
stage under the checkpoint folder.

Nulls and odd rows: a null text counts as empty in every stage and stays null
up to packing, where it is a document of its end id alone; null ids are an id
of their own; repeated rows are near-duplicates, so one of them stays; an empty
table gives empty stages; extra columns pass through to packing, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import decontamination, packing, pii_crf, simhash, toxicity_gru
from fleetpulse.llm.common import fold, stage, table
from fleetpulse.llm.queries import QUOTED_TOKENS, TOXIC_LIMIT, tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the limit."""
    net = toxicity_gru.train(docs, table(spark, sf_dir, "labels"), "toxic", usable=fold("doc_id", 3) != 1)
    score = "score"
    while score in docs.columns:
        score += "_"
    scored = toxicity_gru.score(docs, net, keep=tuple(docs.columns), score_col=score)
    return scored.where(F.col(score) < TOXIC_LIMIT).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints (3-word shingles, at most 3 bits)."""
    return simhash.deduplicated(docs, shingle_words=3, max_distance=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"), verbatim=QUOTED_TOKENS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars follows the text."""
    clean = pii_crf.redact(docs, pii_crf.train(docs))
    if "n_chars" in docs.columns:
        size = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
        clean = clean.withColumn("n_chars", size)
    return clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of all documents, a row per piece."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", pii),
    ("packing", pack),
]

#: Trained models and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed sequences."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
