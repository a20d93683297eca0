"""Corpus pipeline: documents -> quality rules -> toxicity -> near-dedup -> packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
The first three return the kept rows with the columns they came with; the last
returns one row per packed piece.

Defined results: null and empty texts are too short for the quality rules and go
there; texts of any length are taken whole; rows without doc_id pass like others;
of repeated rows one stays; an empty table gives no pieces; columns of any name
pass through the first three stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewh.llm import packing, quality, simhash, toxicity
from tradewh.llm.common import table
from tradewh.operators.materialize import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the quality rules accept; texts stay as they are."""
    return quality.keep_good(docs)


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below 0.5 by a model fitted on labelled rows of ``docs``
    outside the held-out fold."""
    labels = toxicity.training_rows(table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, toxicity.fit_toxicity(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("toxicity", toxic_out), ("SimHash near-dedup", near_dedup),
          ("best-fit packing", pack)]

#: Fitting a model and tokenising are beyond SQL; the stages are tested against
#: brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return docs
