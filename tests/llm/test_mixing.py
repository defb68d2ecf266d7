import random
import re
from collections import defaultdict

import duckdb
import pytest

from eventloom.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, size int, rank string, seg long, target string"


def rows(n=400, seed=3):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        source = rnd.choice(["a", "a", "a", "b", "c", "é", "Z", None, "d"])
        text = rnd.choice(["", None]) if k % 37 == 0 else " ".join("w%d" % rnd.randint(0, 99) for _ in range(rnd.randint(1, 40)))
        out.append((k if k % 91 else None, text, "en", source, 1, "x", 2, "y"))
    return out + out[5:9]


def targets(sizes, turn=(5, 2, 1), share=1.5, most=2):
    """Shares by weight, the excess of full sources shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: turn[k % 3] for k, s in enumerate(order)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        level = left / total if total else 0
        over = {s for s in order if s not in full and level * weight[s] > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in full else level * weight[s] for s in order}
        full |= over


@pytest.fixture(scope="module")
def data():
    return rows()


def test_targets_and_taken_words(spark, data):
    got = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, largest = defaultdict(int), defaultdict(int)
    for r in data:
        sizes[r[3]] += count(r[1])
        largest[r[3]] = max(largest[r[3]], count(r[1]))
    want = targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-9
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_and_partitioning_agree(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    a, b = (sorted(map(tuple, mixing.mix(x).select("doc_id", "size", "source", "target", "taken").collect()), key=repr) for x in (df, df.repartition(7, "text")))
    assert a == b


def test_oracle(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    want = con.sql(mixing.ORACLE).fetchall()
    got = mixing.mix(df).select("doc_id", "size", "source_size", "target", "taken").collect()
    key = lambda r: (r[0], r[1], r[2], round(r[3], 6), r[4])
    assert sorted(map(key, got), key=repr) == sorted(map(key, want), key=repr)


def test_complete_epochs_come_first(spark, data):
    got = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    for mixed in by.values():
        epochs = int(mixed[0].target // mixed[0].source_size) if mixed[0].source_size else 0
        assert {r.copies - epochs for r in mixed} <= {0, 1}
        last = max((r.key for r in mixed if r.copies > epochs), default=None)
        if last is not None:
            assert all(r.copies > epochs or r.key >= last for r in mixed)


def test_weights_favour_documents(spark):
    from pyspark.sql import functions as F
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") < 1000, "a").otherwise("b").alias("source"))
    mixed = mixing.mix(df, F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)).where("source = 'b' AND copies > epochs")
    even, odd = (mixed.where(f"doc_id % 2 = {k}").count() for k in (0, 1))
    assert even > 1.15 * odd


def test_documents_are_repeated(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    want = defaultdict(int)
    for r in mixing.mix(df).collect():
        want[r.doc_id] += max(r.copies, 1) if r.size == 0 else r.copies
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert {k: v for k, v in want.items() if v} == dict(got)


def test_null_ids_and_equal_rows_are_drawn_by_themselves(spark):
    """A third of the rows has a null id, another third is one row: sizes of the first and numbers of the second say nothing about being taken."""
    rnd = random.Random(8)
    rows = [(None, " ".join(f"w{k}x{j}" for j in range(rnd.randint(10, 16)))) for k in range(300)] + [(7, "a b c d e f g h i j")] * 300
    rows += [(k + 10, f"t{k} " * 12) for k in range(300)]
    df = spark.createDataFrame([(i, t, "en", "b" if n % 4 else "a", n, "x", 2, "y") for n, (i, t) in enumerate(rows)], SCHEMA)
    got = mixing.mix(df).where("source = 'b'").collect()
    keys = [r.key for r in got]
    assert len(set(keys)) == len(keys)
    for part in ([r for r in got if r.doc_id is None], [r for r in got if r.doc_id == 7]):
        share = sum(r.copies > r.epochs for r in part) / len(part)
        all_share = sum(r.copies > r.epochs for r in got) / len(got)
        assert 0 < all_share < 1 and abs(share - all_share) < 0.12
    sizes = [[r.size for r in got if r.doc_id is None and (r.copies > r.epochs) == taken] for taken in (True, False)]
    assert all(sizes) and abs(sum(sizes[0]) / len(sizes[0]) - sum(sizes[1]) / len(sizes[1])) < 1
    # The mix itself takes as many words as the digest says, also of rows that are equal.
    out = mixing.mix_documents(df)
    words = out.where("source = 'b'").selectExpr("sum(size(split(trim(text), ' ')))").first()[0]
    assert words == sum(r.taken for r in got)
    assert out.where("doc_id = 7 AND source = 'b'").count() == sum(r.copies for r in got if r.doc_id == 7)


def test_empty_and_wordless(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mix_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    only = mixing.mix(spark.createDataFrame([(1, None, "en", None, 1, "x", 2, "y")], SCHEMA)).collect()
    assert [(r.size, r.source_size, r.taken) for r in only] == [(0, 0, 0)]
