"""The corpus pipeline: stages over `documents`, each one operator of gaugeline.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. `run` writes it as Parquet to the
shared folder and hands the reread rows to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm import stages
from gaugeline.llm.common import settled, table

STAGES = [
    ("language_id", stages.language_id),
    ("line_dedup", stages.line_dedup),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("source_mixing", stages.source_mixing),
]

#: Viterbi labels, edit distances and block permutations are not expressible in SQL; the stages
#: are tested against brute force in tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir))
    return docs
