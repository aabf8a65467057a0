"""A training-data pipeline over ``documents``: language, quality,
near-duplicates, packing. Each stage's result is written as Parquet and read
again as the next stage's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recprep.llm.common import staged, table
from recprep.llm.queries import language_stage, pack_stage, quality_stage, simhash_stage

STAGES = [("language", language_stage), ("quality", quality_stage),
          ("simhash", simhash_stage), ("packing", pack_stage)]

#: SQL expresses none of the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
