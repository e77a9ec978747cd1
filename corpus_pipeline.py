"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next.

Quality classifier, near-duplicate removal, benchmark decontamination, secret redaction, and
the mix of sources. SQL can't express the stages (a fitted model, sketches, alignment), so
tests/llm holds them against brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from svloom.llm.common import shared_folder
from svloom.llm.decontaminate import decontaminate_stage
from svloom.llm.mixing import mix_stage
from svloom.llm.near_dups import near_dup_stage
from svloom.llm.quality import quality_stage
from svloom.llm.secrets import redact_stage

STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_dup_stage),
    ("decontamination", decontaminate_stage),
    ("secrets", redact_stage),
    ("mixing", mix_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; what each keeps is written under the cluster's checkpoint folder."""
    out = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
    return docs
