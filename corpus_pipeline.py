"""From documents to packed training sequences: quality rules, near-dedup, decontamination, packing.

Edge cases: rows with null text, source or language go through the rules with empty text and their own groups; null ids are kept as documents
of their own; of repeated rows one stays; texts of any length are read whole; ties between copies go to the smallest
doc_id, then to table order; other columns pass through every stage but the last, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellarium.llm import decontam, dedup, packing, quality
from cellarium.llm.common import stored, table

#: (name, function of (spark, docs, sf_dir)); all but the last return the columns of documents.
STAGES = [
    ("quality_rules", quality.stage),
    ("near_dedup", dedup.stage),
    ("decontamination", decontam.stage),
    ("packing", packing.stage),
]
#: SQL expresses neither the components nor the packing; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each on what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
