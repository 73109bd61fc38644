"""Documents to packed sequences: quality rules, exact dedup, near-dedup, secret scan, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm.common import scratch
from folioscope.llm.exact_dedup import drop_copies
from folioscope.llm.minhash import drop_near_copies
from folioscope.llm.packing import pack_documents
from folioscope.llm.quality_rules import drop_rejected
from folioscope.llm.secret_scan import mask_secrets

#: (name, function of (spark, docs, sf_dir)); each result is written as Parquet and read back as the next one's docs.
STAGES = [
    ("quality_rules", drop_rejected),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack_documents),
]

#: Learned rules, signatures and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
