"""Bounded samples of labelled documents, on which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import crc_mod, lean

#: Labelled rows that a classifier is fitted on, about; with fewer labelled rows, all.
SAMPLE = 20_000


def held_out() -> Column:
    """Rows whose labels no classifier may see."""
    return crc_mod("doc_id", 4) == 2


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int = SAMPLE) -> DataFrame:
    """text and y (0 or 1) of about ``size`` labelled documents that aren't held out, chosen by a hash of doc_id.

    Null doc_ids or labels take no part; a label over 0 counts as 1, any other as 0, and where a document's label
    rows disagree, 1 counts. A document takes part once, however often its row is repeated; of different texts
    with its doc_id the one with the least hash does.
    """
    own = (
        labels.select(F.col("doc_id"), (F.col(label) > 0).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    )
    n = own.count()
    if n > size:
        own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * size / n))
    # at most about ``size`` rows of two numbers: small enough for every executor at any input
    rows = lean(docs).select("doc_id", "text").join(F.broadcast(own), "doc_id")
    return rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("y").alias("y")).select("text", "y")
