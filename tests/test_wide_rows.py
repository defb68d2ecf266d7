"""Destinations of few wide rows are cut by bytes, without being asked to."""

import pytest
from pyspark.sql import functions as F

from eventloom.operators.prefix import exchange_on
from eventloom.plans import catalog
from eventloom.plans.ship import ship


@pytest.fixture(scope="module")
def wide_documents(spark, tmp_path_factory):
    """A few documents of more bytes than one task should hold, far fewer than the rows that are cut."""
    d = str(tmp_path_factory.mktemp("wide"))
    spark.range(700).select(F.col("id").alias("doc_id"), F.expr("repeat('x', 100000)").alias("text"), F.lit("en").alias("lang"),
                            F.lit("web").alias("source"), F.lit(100000).alias("n_chars")).write.parquet(f"{d}/documents.parquet")
    return d


def _cut_into(df) -> int:
    """The segments' bases that the plan adds to the running sum; none where one task sums it all."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("_sz_0_base")


def test_few_wide_rows_are_cut_by_default(spark, wide_documents, monkeypatch):
    taken = []
    monkeypatch.setattr(catalog, "ship", lambda payloads, **how: taken.append(payloads) or ship(payloads, **how))
    letters = catalog.q_dead_letters(spark, wide_documents)
    assert _cut_into(taken[0]) > 0
    size, want = len('|doc_id="0"|lang="en"|source="web"|text=""') + 100_001, {}
    end = 0
    for k in range(700):
        end += size + len(str(k)) - 1
        want.setdefault((end - 1) // catalog.SMALL_BLOCK, []).append(k)
    assert {r.batch_id: r.n_events for r in letters.drop("dead_letter").collect()} == {b: len(v) for b, v in want.items()}
    one = spark.range(10).withColumn("k", F.lit(1))
    assert exchange_on(one, "k", 100).rdd.getNumPartitions() == 25  # more tasks than the session's eight


def test_oversize_batches_of_wide_rows_are_cut(spark, wide_documents):
    batches = catalog.q_oversize_batches(spark, wide_documents)
    assert _cut_into(batches) > 0
    assert batches.agg(F.sum("n_events"), F.count_if("rejected")).first() == (700, 700)


def test_repacked_batches_of_wide_rows_are_cut(spark, wide_documents):
    from eventloom.plans.shipping_queries import q_oversize_repacked

    parts = q_oversize_repacked(spark, wide_documents)
    assert _cut_into(parts) > 0
    assert parts.agg(F.sum("n_events"), F.count_if("rejected")).first() == (700, 700)


def test_normalized_payloads_of_wide_rows_are_cut(spark, wide_documents):
    payloads = catalog.q_batch_payload_normalized(spark, wide_documents)
    assert _cut_into(payloads) > 0
    assert payloads.agg(F.sum("n_events"), F.sum("n_bytes"), F.sum(F.length("payload"))).first() == (700, 70_000_700, 70_000_700)
