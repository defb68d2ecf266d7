"""The registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import decontaminate, divergence, html, language, licenses, mixing, perplexity, quality, secrets, sharding, simhash, vectors, warc
from eventloom.session import scratch_path
from eventloom.sources.tables import read_table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(read_table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.page_digest(read_table(spark, sf_dir, "pages"))


def op3_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(read_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(read_table(spark, sf_dir, "documents"))


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read_table(spark, sf_dir, "documents"), sharding.shard_names())


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(read_table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_digest(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_digest(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.code_digest(read_table(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_html": op2_html,
    "op3_perplexity": op3_perplexity,
    "op4_mix": op4_mix,
    "op5_quality": op5_quality,
    "op6_decontaminate": op6_decontaminate,
    "op7_licenses": op7_licenses,
    "op8_shard": op8_shard,
    "op9_simhash": op9_simhash,
    "op10_language": op10_language,
    "op11_warc": op11_warc,
    "op12_codes": op12_codes,
    "op13_divergence": op13_divergence,
}
ORACLES = {
    "op1_secrets": secrets.ORACLE,
    "op4_mix": mixing.ORACLE,
    "op6_decontaminate": decontaminate.ORACLE,
    "op7_licenses": licenses.ORACLE,
    "op11_warc": warc.ORACLE,
    "op12_codes": vectors.ORACLE,
    "op13_divergence": divergence.ORACLE,
}
