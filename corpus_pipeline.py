"""The corpus pipeline: from documents to packed token sequences.

Every stage works on all that the stage before kept, is written to the shared
folder and read again. The stages are MinHash links, sampling keys and token
packing over each other's results, which SQL cannot state, so there is no
``ORACLE_SQL``; the tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnguard.llm.common import table
from txnguard.llm.stages import language_stage, line_stage, mixing_stage, near_dup_stage, packing_stage
from txnguard.session import materialize

STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_dup_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
