"""The pipeline's stages and run() against plain Python over the smallest documents."""

from collections import Counter

import pytest

import corpus_pipeline
from eventloom.llm import mixing, quality, sharding
from eventloom.llm.common import stored

from test_decontaminate import brute as brute_pairs
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).collect()]
    items = [(r.item_id, r.text, None) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    return docs, items


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mixing", "sharding"]


def test_run_matches_plain_python(spark, tables):
    docs, items = tables
    counts = [quality.counts_of(d[1]) for d in docs]
    patterns = {r.doc_id: r.votes for r in quality.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    posterior = quality.fit(Counter(patterns.values()))[0]
    good = [d for d, c in zip(docs, counts) if c[0] >= 50 and 100 * c[4] <= 50 * c[0] and posterior[patterns[d[0]]] >= 0.5]
    comps = brute_components([(d[0], brute_fingerprint(d[1])) for d in good])
    single = [d for d, c in zip(good, comps) if d[0] == c]
    bad = {p[0] for p in brute_pairs(single, items)}
    clean = [d for d in single if d[0] not in bad]
    mixed = mixing.mix(spark.createDataFrame(clean, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    copies = {r.doc_id: r.copies for r in mixed}
    table = sharding.lookup_table(sharding.shard_names())
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in got) == Counter({k: v for k, v in copies.items() if v})
    assert 0 < len(clean) < len(single) < len(good) < len(docs)
    by = {d[0]: d for d in docs}
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == by[r.doc_id]
        assert r.shard == sharding.shard_names()[table[r.shard_slot]]


def test_stages_take_awkward_rows(spark, tables):
    """Nulls everywhere, empty texts, repeated rows, other columns with the names the stages use."""
    docs, _ = tables
    rows = [(*d, "x", 1, 2.0) for d in docs[:60]] + [(None, None, None, None, None, None, None, None)] * 2 + [(7, "", "en", None, 0, "x", 1, 2.0)]
    rows += [(*docs[0], "x", 1, 2.0)] * 3
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, size long, `key` double"
    frame = spark.createDataFrame(rows, schema)
    for table in (frame, frame.limit(0)):
        out = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stored(stage(spark, out, SF), name)
            assert out.columns == table.columns, name
        last = corpus_pipeline.STAGES[-1][1](spark, out, SF)
        assert set(table.columns) < set(last.columns)
        assert last.count() == out.count()
    assert corpus_pipeline.STAGES[1][1](spark, frame, SF).where("doc_id = 0").count() == 1
