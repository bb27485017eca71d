"""The corpus pipeline: stages over ``documents``, each one an operator of ``starload.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.llm import stages
from starload.llm.common import ready, table
from starload.session import materialize

STAGES = stages.STAGES

#: Language ID and MinHash banding have no SQL form: tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table; every stage but the last is written to the shared checkpoint folder."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
