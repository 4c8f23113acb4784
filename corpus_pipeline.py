"""The corpus pipeline: quality rules, language ID, n-gram Jaccard join, PII surrogates, best-fit packing.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltarc.llm.langid import keep_known
from voltarc.llm.packing import pack_stage
from voltarc.llm.pii import mask_stage
from voltarc.llm.quality import keep_good
from voltarc.llm.setjoin import keep_one
from voltarc.session import scope, settle, unsettle

STAGES = [
    ("quality rules", keep_good),
    ("language ID", keep_known),
    ("n-gram Jaccard join", keep_one),
    ("PII surrogates", mask_stage),
    ("best-fit packing", pack_stage),
]

#: SQL can't express these stages; tests/llm/test_pipeline.py holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        with scope() as kept:  # nothing of a stage stays but its result
            replaced, docs = docs, settle(stage(spark, docs, sf_dir), f"stage-{k}")
            kept.append(docs)
        unsettle(replaced)  # the next stage reads what this one has written
    return docs
