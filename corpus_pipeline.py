"""The corpus pipeline: documents through quality rules, a quality classifier, near-dedup, a source mix, and SentencePiece."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import mixing, near_dedup, piece_bpe, quality_rules, quality_trees
from palimpsest.llm.common import table, working, written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no quality rule rejects."""
    return quality_rules.kept(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier scores at its threshold or more; it learns from the labels of all documents."""
    trees = quality_trees.learned(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_trees.kept(docs, trees)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.kept(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, in training order."""
    return mixing.dealt(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document of the mix with its token ids in place of its text, and a digest of the text that they decode to."""
    coded = piece_bpe.encoded(docs, piece_bpe.model_path(), digest="decoded_sha256")
    return coded.select("doc_id", "lang", "source", "n_chars", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids", "decoded_sha256")


STAGES = [("quality_rules", rules), ("quality_classifier", classifier), ("near_dedup", near_duplicates), ("source_mix", mix), ("sentencepiece", encode)]

#: The classifier and the encoder are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with working(spark):
            docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
