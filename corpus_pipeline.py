"""The training-data pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Every stage works on all that its predecessor kept. All but the last return the
columns of ``documents`` as they are; the last adds each row's shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm.common import stored
from eventloom.llm.decontaminate import decontaminate_rows
from eventloom.llm.mixing import mix_documents
from eventloom.llm.quality import keep_good
from eventloom.llm.sharding import place, shard_names
from eventloom.llm.simhash import drop_near_copies
from eventloom.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate_rows(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return place(docs, shard_names())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Votes fitted by expectation-maximisation, XXH64 and graph components have no SQL form; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return stored(stage(spark, docs, sf_dir), name)
