"""Training corpus: toxicity, line dedup, near-duplicates, benchmark passages, SentencePiece ids.

``run`` applies the stages of ``STAGES`` to the table ``documents``, each to
what its predecessor kept; a stage's result is written as Parquet to the shared
scratch folder and read again. All stages but the last return the columns of
``documents``; columns that a stage adds for its own use are dropped, and
n_chars follows the text. Stages that refit or recount (labels, line counts,
passages) do so on their own input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.llm import decontaminate, line_dedup, near_dups, pieces, toxicity

TOXIC_FROM = 0.7
LINE_DOCUMENTS = 10
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from all labels, does not call toxic."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score(docs, model, to="_score").where(F.col("_score") < TOXIC_FROM).select(*docs.columns)


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten of them or more have; one that had no other lines is left empty."""
    out = line_dedup.drop(docs, line_dedup.build(docs, LINE_DOCUMENTS))
    chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id; rows of null id stay."""
    gone = near_dups.link(docs, NEAR_PERCENT).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item is found."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and n_tokens of each document, and whether the ids decode to its text."""
    return pieces.encode(docs, pieces.read()).select("doc_id", "lang", "source", "ids", "n_tokens", "lossless")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_frequent_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


# Classifier, alignment and encoding cannot be said in SQL; tests hold run() against plain versions.
ORACLE_SQL: str | None = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
