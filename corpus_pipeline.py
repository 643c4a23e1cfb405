"""From raw documents to packed training sequences: five stages, each one of the operators of ``lamina.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.

For all stages: other columns than doc_id and text pass through unread, whatever their names; an empty table gives an empty
one; texts are read whole, however long; rows with a null doc_id are documents like all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamina.llm.common import materialize, table
from lamina.llm.decontaminate import without_leaks
from lamina.llm.neardup import keep_first
from lamina.llm.packing import pack_documents
from lamina.llm.quality import fit_quality, keep_good
from lamina.llm.queries import BYTE_BPE, tokenizer_path
from lamina.llm.toxicity import fit_toxicity, keep_harmless


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject. Null and empty texts are scored as such; equal rows get equal
    scores, so all or none stay. Without labelled documents nothing is rejected."""
    return keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject. Null and empty texts have no toxic terms; equal rows get equal
    scores, so all or none stay. Without labelled documents nothing is rejected."""
    return keep_harmless(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near-duplicates; of repeated rows one. Texts without words
    (null, empty, blank) are copies of nothing and all stay."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark. Null and blank texts contain nothing and stay; of repeated rows all
    stay or none; an empty benchmark leaves all."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens. Null and empty texts are the end's id alone; repeated rows are
    packed once each; a document longer than a sequence is cut."""
    # workers also hold what the stages before left: a smaller cache than op6's costs time, not results
    return pack_documents(docs, tokenizer_path(BYTE_BPE), cache=300_000)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Trained models can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
