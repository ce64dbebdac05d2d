"""The corpus pipeline: documents through operators of the llm subpackage.

Stages, each on all rows that the one before kept:
1. quality rules: documents that the rules reject go;
2. near duplicates: of each group the document with the smallest id stays;
3. decontamination: documents with a benchmark passage go;
4. personal data: entities in the texts are replaced by surrogates;
5. SentencePiece: the texts' piece ids, and whether they decode to the text, are added.

All but the last return the columns of ``documents``, whatever these are.  Nulls, empty
texts, ties and repeated rows are treated as each operator says: a null or empty text
fails the quality rules; of repeated documents one stays.  Every stage is written as
Parquet below the session's checkpoint folder and read again, so a lost executor
repeats part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackside.llm.decontaminate import decontaminate
from trackside.llm.near_dedup import drop_near_duplicates
from trackside.llm.pii import replace_entities
from trackside.llm.quality_rules import keep_good
from trackside.llm.queries import PIECE_MODEL, SURROGATE_KEY, table
from trackside.llm.sentencepiece_viterbi import encode, read_model
from trackside.session import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return replace_entities(docs, SURROGATE_KEY).select(docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, read_model(spark, PIECE_MODEL), round_trip="round_trip")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("sentencepiece", pieces),
]

#: Quality rules and the Viterbi search are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that all stages leave of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = f"{scratch_dir(spark, f'pipeline-{k}')}/rows"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
