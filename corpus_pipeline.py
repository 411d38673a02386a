"""The corpus pipeline: documents to packed sequences, one written table after another.

Stages, in order: quality classifier, line deduplication, SimHash near-deduplication,
benchmark decontamination, best-fit packing.  Each function takes (spark, docs, sf_dir),
works on all rows of docs and returns the table that the next stage reads.

Every stage takes null and repeated doc_ids, null, empty and very long texts, repeated rows, empty
tables and further columns of any name; all but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.llm.common import materialize, table
from touchline.llm.decontaminate import decontaminate
from touchline.llm.line_dedup import drop_repeated_lines
from touchline.llm.packing import pack
from touchline.llm.simhash import keep_one
from touchline.llm.weak_quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained scorer takes for good; those with a null or empty text go.

    The verdict is the text's alone, so repeated rows stay or go together.
    """
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has, or nearly; those of which nothing is left go.

    "Earlier" is by doc_id (null first) and text; rows alike in both are one document and stay or go together.
    """
    return drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id (null: largest) of each group of near-duplicates; repeated rows become one."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; null and empty texts have none."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each token piece of the documents lies in which sequence; null and repeated doc_ids are kept, row by row."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: No stage but decontamination can be put in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
