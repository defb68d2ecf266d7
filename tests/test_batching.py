"""Batching against a model of line end offsets, plus the scale paths."""

import hypothesis.strategies as st
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from eventloom.operators.batching import assign_batches, batch_events, ship_totals, split_oversize
from eventloom.operators.prefix import quantile_segments, running_sum


def offset_batches(text: str, block: int) -> list[str]:
    """Payloads by line end offsets: a line belongs to the block that its LF's offset falls in."""
    batches: dict[int, str] = {}
    end = -1
    for line in text.split("\n")[:-1]:
        end += len(line) + 1
        batches[end // block] = batches.get(end // block, "") + line + "\n"
    return [batches[b] for b in sorted(batches)]


def _lines_df(spark, lines, dest=None):
    rows = [(i, line, dest[i] if dest else None) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "k long, raw string, sourcetype string")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    lines=st.lists(st.text(alphabet="abcxyz ", min_size=0, max_size=10), min_size=1, max_size=80),
    block=st.sampled_from([32, 48, 64]),
)
def test_payloads_equal_offset_batches(spark, lines, block):
    text = "".join(line + "\n" for line in lines)
    df = _lines_df(spark, lines)
    got = batch_events(df, ["k"], block, destination=[], unit="chars").orderBy("batch_id").collect()
    assert [r.payload for r in got] == offset_batches(text, block)
    assert sum(r.n_events for r in got) == len(lines)
    assert "".join(r.payload for r in got) == text


def test_two_level_equals_global_window_with_hot_destination(spark):
    n = 3000
    dest = ["hot" if i % 3 else f"d{i % 7}" for i in range(n)]  # two thirds in one destination
    lines = [("x" * (i % 37)) for i in range(n)]
    df = _lines_df(spark, lines, dest)
    # the same running sum written as one window per destination
    from pyspark.sql import Window
    w = Window.partitionBy("sourcetype").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("k", F.floor((F.sum(F.length("raw") + 1).over(w) - 1) / 256).alias("b")).collect()
    want = {r.k: r.b for r in ref}
    for split_rows in (500, 10**9, None):  # hot destination cut / nothing cut / not even counted
        a = assign_batches(df, ["k"], 256, n_segments=40, split_rows=split_rows)
        got = {r.k: r.batch_id for r in a.select("k", "batch_id").collect()}
        assert got == want
    segs = a = assign_batches(df, ["k"], 256, n_segments=40, split_rows=500)
    per = {(r.sourcetype, r._seg) for r in segs.select("sourcetype", "_seg").distinct().collect()}
    assert len([p for p in per if p[0] == "hot"]) > 20 and all(s == 0 for d, s in per if d != "hot")


def test_single_destination_cut_when_large(spark):
    lines = ["y" * (i % 11) for i in range(2500)]
    df = _lines_df(spark, lines)
    text = "".join(line + "\n" for line in lines)
    for split_rows in (100, 10**9):
        got = batch_events(df, ["k"], 64, destination=[], unit="chars", split_rows=split_rows).orderBy("batch_id")
        assert [r.payload for r in got.collect()] == offset_batches(text, 64)


def test_quantile_segments_are_balanced_and_ordered(spark):
    keys = [i * i for i in range(2000)]  # clustered near zero
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    segs = quantile_segments(df, "k", 10).collect()
    by_seg = {}
    for r in segs:
        by_seg.setdefault(r._seg, []).append(r.k)
    assert max(len(v) for v in by_seg.values()) < 400  # ~200 each, none holds most rows
    ordered = sorted(by_seg)
    for a, b in zip(ordered, ordered[1:]):
        assert max(by_seg[a]) < min(by_seg[b])


def test_long_line_kept_whole(spark):
    lines = ["a" * 30, "b", "c" * 5]
    got = batch_events(_lines_df(spark, lines), ["k"], 8, destination=[], unit="chars").orderBy("batch_id").collect()
    assert "".join(r.payload for r in got) == "a" * 30 + "\nb\n" + "c" * 5 + "\n"
    assert all(r.payload.count("\n") == r.n_events for r in got)


def test_running_sum_explicit_segments_and_bytes(spark):
    df = spark.createDataFrame([("f1", 0, 0, "€"), ("f1", 0, 1, "a"), ("f1", 9, 0, "bb"), ("f2", 0, 0, "c")],
                               "f string, b long, i long, raw string")
    out = running_sum(df, F.octet_length("raw") + 1, ["f", "b", "i"], segment=["f", "b"], out="c")
    assert [r.c for r in out.orderBy("f", "b", "i").collect()] == [4, 6, 9, 11]


def test_oversize_and_totals(spark):
    lines = ["x" * 20, "y", "z" * 3]
    payloads = batch_events(_lines_df(spark, lines, ["d"] * 3), ["k"], 8, unit="chars")
    ok, bad = split_oversize(payloads, 10)
    # "x"*20 ends at offset 20 and "y" at 22: both in block 2; "zzz" ends at 26: block 3
    assert [(r.batch_id, r.n_bytes) for r in bad.collect()] == [(2, 23)]
    assert [(r.batch_id, r.n_bytes) for r in ok.collect()] == [(3, 4)]
    t = ship_totals(payloads, 10).first()
    assert (t.read_bytes, t.sent_bytes, t.calls, t.rejected, t.n_events) == (27, 4, 1, 1, 3)


def test_broadcast_only_within_measured_bytes(spark):
    from eventloom.operators.prefix import _null_safe_join, table_size

    small = spark.createDataFrame([("x" * 100, 1), ("y" * 50, 2), (None, 3)], "k string, v long")
    assert table_size(small) == (3, 150 + 3 * 8)
    big = spark.createDataFrame([("x" * 100,), (None,)], "k string")
    for limit, broadcast in ((10_000, True), (100, False)):
        joined = _null_safe_join(big, small, ["k"], "inner", 1_000_000, broadcast_bytes=limit)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastExchange" in plan) == broadcast
        assert sorted(r.v for r in joined.collect()) == [1, 3]


def test_segments_with_constant_or_null_keys(spark):
    from pyspark.sql import Window

    from eventloom.operators.prefix import running_sum
    for make in (lambda i: 7 if i % 2 else None, lambda i: i if i % 3 else None, lambda i: 5):
        df = spark.createDataFrame([(i, make(i), "a" * (i % 4)) for i in range(300)], "i long, k long, raw string")
        out = running_sum(df, F.length("raw") + 1, ["k", "i"], split_rows=10, n_segments=8, out="c")
        w = Window.orderBy("k", "i").rowsBetween(Window.unboundedPreceding, 0)
        want = {r.i: r.c for r in df.select("i", F.sum(F.length("raw") + 1).over(w).alias("c")).collect()}
        assert {r.i: r.c for r in out.collect()} == want


def test_heavy_leading_order_value_is_cut_by_next_column(spark):
    """One value of the first order column holds a third of the rows."""
    from pyspark.sql import Window

    from eventloom.operators.prefix import running_sum
    rows = [(7 if i % 3 == 0 else i, i, "x" * (i % 5)) for i in range(6000)]
    for dest in (None, "d"):
        df = spark.createDataFrame([(g, i, r, dest) for g, i, r in rows],
                                   "g long, i long, raw string, sourcetype string")
        part = ["sourcetype"] if dest else []
        out = running_sum(df, F.length("raw") + 1, ["g", "i"], partition_by=part, n_segments=20,
                          split_rows=100, out="c")
        w = Window.partitionBy(*part).orderBy("g", "i").rowsBetween(Window.unboundedPreceding, 0)
        want = {r.i: r.c for r in df.select("i", F.sum(F.length("raw") + 1).over(w).alias("c")).collect()}
        got = out.select("i", "c", "_seg", "g").collect()
        assert {r.i: r.c for r in got} == want
        heavy_segments = {r._seg for r in got if r.g == 7}
        assert len(heavy_segments) >= 4, heavy_segments


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    lines=st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.text(alphabet="xyz", max_size=12)),
                   min_size=1, max_size=300),
    block=st.sampled_from([16, 40]),
    split_rows=st.sampled_from([0, 5, 50, 10**9]),
)
def test_payloads_per_destination_equal_offset_batches(spark, lines, block, split_rows):
    rows = [(i, text, dest) for i, (dest, text) in enumerate(lines)]
    df = spark.createDataFrame(rows, "k long, raw string, sourcetype string")
    got = batch_events(df, ["k"], block, unit="chars", split_rows=split_rows).collect()
    by_dest = {}
    for r in got:
        by_dest.setdefault(r.sourcetype, []).append((r.batch_id, r.payload))
    for dest in {d for _, _, d in rows}:
        text = "".join(t + "\n" for _, t, d in rows if d == dest)
        assert [p for _, p in sorted(by_dest[dest])] == offset_batches(text, block)


def test_offsets_too_big_to_broadcast_share_the_window_exchange(spark):
    from pyspark.sql import Window

    from eventloom.operators.prefix import running_sums
    rows = [(i, f"d{i % 4}" if i % 5 else None, "q" * (i % 9)) for i in range(4000)]
    df = spark.createDataFrame(rows, "i long, sourcetype string, raw string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = running_sums(df, {"c": F.length("raw") + 1}, ["i"], ["sourcetype"], n_segments=16,
                           split_rows=100, broadcast_bytes=0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.i: r.c for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1  # only the bounded hot list
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert all("_pkey" in x or "__r_pkey" in x for x in exchanges[-2:]), exchanges
    w = Window.partitionBy("sourcetype").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.i: r.c for r in df.select("i", F.sum(F.length("raw") + 1).over(w).alias("c")).collect()}
    assert got == want


def test_batches_spanning_many_segments_merge_at_their_owner(spark):
    lines = [f"l{i}" for i in range(1500)]
    df = _lines_df(spark, lines, ["d"] * len(lines))
    text = "".join(line + "\n" for line in lines)
    for bytes_limit in (64 * 1024 * 1024, 0):  # offsets broadcast / joined on the hash key
        from eventloom.operators import prefix
        old = prefix.DEFAULT_BROADCAST_BYTES
        prefix.DEFAULT_BROADCAST_BYTES = bytes_limit
        try:
            got = batch_events(df, ["k"], 2000, unit="chars", split_rows=10).orderBy("batch_id").collect()
        finally:
            prefix.DEFAULT_BROADCAST_BYTES = old
        assert [r.payload for r in got] == offset_batches(text, 2000)  # ~300 lines per batch, ~23 per segment
    plan = batch_events(df, ["k"], 2000, unit="chars", split_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "_tkey" in plan


def _one_window(df, order, part):
    from pyspark.sql import Window
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return {r.i: r.c for r in df.select("i", F.sum(F.length("raw") + 1).over(w).alias("c")).collect()}


KEYS = {
    "bigint": lambda i, s: F.lit(1 << 60) + (i * s) % 700,
    "decimal(38,0)": lambda i, s: F.lit("123456789012345678901234567890").cast("decimal(38,0)") + (i * s) % 700,
    "timestamp": lambda i, s: F.timestamp_micros(F.lit(1700000000000000) + (i * s) % 700),
    "timestamp_ntz": lambda i, s: F.timestamp_micros(F.lit(1700000000000000) + (i * s) % 700).cast("timestamp_ntz"),
    "date": lambda i, s: F.date_from_unix_date(((i * s) % 50).cast("int")),
    "string": lambda i, s: F.concat(F.lit("folder/with/a/long/prefix-"), ((i * s) % 700).cast("string")),
    "double": lambda i, s: F.when(i % 11 == 0, F.lit(float("nan"))).otherwise(((i * s) % 700) / 7),
    "binary": lambda i, s: F.concat(F.lit("k"), ((i * s) % 700).cast("string")).cast("binary"),
    "null": lambda i, s: F.when(i % 3 == 0, i),
}


@settings(max_examples=14, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(kind=st.sampled_from(sorted(KEYS)), step=st.sampled_from([1, 7, 350, 699]), split=st.sampled_from([20, 150]),
       part=st.booleans())
def test_running_sums_of_any_key_type(spark, kind, step, split, part):
    """Keys that repeat, that doubles cannot tell apart, and that are no numbers, against one global window."""
    i = F.col("id")
    df = spark.range(900).select(
        i.alias("i"), KEYS[kind](i, F.lit(step)).alias("k"), F.repeat(F.lit("x"), (i % 6).cast("int")).alias("raw"),
        F.when(i % 4 != 0, F.lit("hot")).alias("d"))
    by = ["d"] if part else []
    out = running_sum(df, F.length("raw") + 1, ["k", "i"], partition_by=by, split_rows=split, out="c")
    got = out.collect()
    assert {r.i: r.c for r in got} == _one_window(df, ["k", "i"], by)
    assert len({r._seg for r in got}) > 3


def test_string_keys_are_not_one_task(spark):
    df = spark.range(3000).select(F.concat(F.lit("a/long/prefix/"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"),
                                  F.lit("line").alias("raw"))
    out = assign_batches(df, ["k"], 500, destination=[], split_rows=200)
    per = [r["count"] for r in out.groupBy("_seg").count().collect()]
    assert len(per) > 20 and max(per) < 400
    main = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x]
    assert not any("SinglePartition" in x for x in main)


def test_null_events_are_sent_as_null(spark):
    df = _lines_df(spark, [None, "a", None, "b"])
    got = batch_events(df, ["k"], 1000, destination=[]).collect()
    assert [(r.batch_id, r.n_events, r.n_bytes, r.payload) for r in got] == [(0, 4, 14, "null\na\nnull\nb\n")]
    given_size = assign_batches(df, ["k"], 1000, destination=[], size=F.octet_length("raw"))
    assert [r._size for r in given_size.orderBy("k").collect()] == [5, 2, 5, 2]


def test_line_ends_are_sent_as_lf(spark):
    lines = ["x\r\ny", "p\rq", "end\r", "end\r\n", "lf\n", "", "\r"]
    df = _lines_df(spark, lines)
    r = batch_events(df, ["k"], 1000, destination=[]).first()
    want = "".join(line + "\n" for line in lines).replace("\r\n", "\n").replace("\r", "\n")
    assert r.payload == want and r.n_bytes == len(want) and r.n_events == len(lines)
    kept = batch_events(df, ["k"], 1000, destination=[], normalize=False).first()
    assert kept.payload == "".join(line + "\n" for line in lines)


def test_sizes_given_for_formatted_rows_follow_line_ends(spark):
    from eventloom.plans.ship import table_batches
    df = spark.createDataFrame([(i, "a\r\nb\rc" * (i % 3)) for i in range(50)], "k long, text string")
    for r in table_batches(df, ["k"], ["k", "text"], ts=False, block_size=64).collect():
        assert r.n_bytes == len(r.payload.encode()) and "\r" not in r.payload
