"""A corpus pipeline of five of the operators: quality rules, near-dedup, decontamination, secrets, pieces.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of documents, but
the last, which returns doc_id and ids. run() writes each result to the shared folder and reads it again.

Nulls, blank texts: rejected by the quality rules (no words). Of rows that repeat a doc_id one stays for each group of
near-duplicates that they lead.
A null doc_id is no document that could be grouped; such a row is judged by all other stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flamequarry.llm import decontaminate, minhash, pieces, quality, secrets
from flamequarry.llm.common import materialize, shared_folder, table

#: Percent of shingles that near-duplicates share.
SIMILAR = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; frequent lines are removed from the others."""
    return quality.cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group stays, one row of it."""
    return minhash.one_of_each(docs, SIMILAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secrets.redacted(docs)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and ids of the texts."""
    return pieces.encoded(docs, pieces.read_model(pieces.MODEL)).select("doc_id", "ids")


STAGES = [("quality rules", quality_rules), ("minhash near-dedup", near_dedup), ("decontamination", decontamination), ("secret scan", secret_scan), ("sentencepiece", sentence_pieces)]
#: SQL cannot encode pieces or run the Markov models; tests/llm/test_pipeline_whole.py takes the same steps in plain Python, over whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), folder, name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
