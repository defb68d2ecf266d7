from collections import Counter

import pytest

from eventloom.llm import sharding


def test_table_is_by_turns():
    """Against the plain procedure with whole permutations."""
    shards, slots = sharding.shard_names(5), 31
    orders = [[(sharding._number(s, "offset") % slots + j * (sharding._number(s, "step") % (slots - 1) + 1)) % slots for j in range(slots)] for s in shards]
    assert all(sorted(o) == list(range(slots)) for o in orders)
    want, turn = {}, 0
    while len(want) < slots:
        slot = next(s for s in orders[turn % 5] if s not in want)
        want[slot] = turn % 5
        turn += 1
    assert sharding.lookup_table(shards, slots) == [want[k] for k in range(slots)]


def test_shares_are_even_and_moves_few():
    table = sharding.lookup_table(sharding.shard_names(64))
    n = Counter(table)
    assert max(n.values()) - min(n.values()) <= 1
    fewer = sharding.lookup_table(sharding.shard_names(63))
    moved = sum(a != b for a, b in zip(table, fewer) if a != 63)
    assert moved < 0.03 * len(table)


@pytest.mark.parametrize("slots, n", [(10, 3), (7, 8), (7, 0), (1, 1)])
def test_bad_tables(slots, n):
    with pytest.raises(ValueError):
        sharding.lookup_table(sharding.shard_names(n), slots)


def test_rows_keep_columns(spark, tmp_path):
    rows = [(k if k % 10 else None, "x", "t") for k in range(500)] + [(3, "x", "t")] * 2
    df = spark.createDataFrame(rows, "doc_id long, shard string, table_slot string")
    got = sharding.place(df, sharding.shard_names(4), out="bin")
    assert got.columns[:3] == df.columns
    assert got.count() == len(rows)
    for r in got.collect():
        assert r.bin == sharding.shard_names(4)[sharding.lookup_table(sharding.shard_names(4))[r.bin_slot]]
    assert got.where("doc_id = 3").select("bin").distinct().count() == 1
    assert got.where("doc_id IS NULL").select("bin").distinct().count() == 1
    clash = sharding.place(df, sharding.shard_names(4))
    assert set(df.columns) < set(clash.columns) and clash.where("shard = 'x'").count() == len(rows)
    sharding.write_shards(got, f"{tmp_path}/out", "bin", rows_per_file=50)
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(rows)
    assert sharding.place(df.limit(0), sharding.shard_names(4)).count() == 0


def test_query_shards_whole_rows(spark):
    from eventloom.llm.queries import op8_shard
    sf = "/root/testdata/sf0.001"
    documents, got = spark.read.parquet(f"{sf}/documents.parquet"), op8_shard(spark, sf)
    assert got.columns[: len(documents.columns)] == documents.columns
    assert documents.exceptAll(got.select(*documents.columns)).count() == 0 and got.count() == documents.count()
