"""Bucketed sinks, page tokens, the token index, discovered fields, and exports of any text."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.extract import discover_fields, extract_discovered, extract_fields
from eventloom.operators.search import page
from eventloom.operators.seek import next_page
from eventloom.operators.tokens import build_token_index, candidate_files, search_tokens
from eventloom.plans.search import search_bucketed_events
from eventloom.sinks.export import export_results, read_export
from eventloom.sinks.partitioned import bucket_range, read_events, write_bucketed_events


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _stamped(spark, n=200):
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=k), "a" if k % 3 else "b") for k in range(n)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, sourcetype string").withColumn("index", F.lit("main"))
    return df.withColumn("raw", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSZ"), F.lit('|k="'), "k", F.lit('"')))


@pytest.mark.parametrize("unit", ["day", "hour"])
def test_a_window_reads_its_buckets(spark, tmp_path, unit):
    path = f"{tmp_path}/sink"
    df = _stamped(spark)
    write_bucketed_events(df, path, unit=unit)
    got = search_bucketed_events(spark, path, ["k"], None, "2024-01-03T05:00:00", "2024-01-05", unit=unit)
    assert sorted(int(r.k) for r in got.collect()) == list(range(53, 96))
    assert "PartitionFilters: [isnotnull(bucket" in _plan(got) and "bucket" in _plan(got).split("PartitionFilters")[1][:200]
    # files of other days are gone; only a scan of them would see it
    for d in os.listdir(path):
        if d.startswith("bucket=") and not "bucket=2024-01-03" <= d <= "bucket=2024-01-04-23":
            for base, _, names in os.walk(f"{path}/{d}"):
                for f in names:
                    with open(f"{base}/{f}", "w") as out:
                        out.write("broken\n")
    assert got.count() == 43
    # the bucket of the upper bound itself holds nothing below it
    assert len(bucket_range(None, dt.datetime(2024, 1, 5), unit)) == 1 and not bucket_range(None, None, unit)


def test_a_day_written_again_replaces_itself(spark, tmp_path):
    path = f"{tmp_path}/sink"
    df = _stamped(spark, 72).union(_stamped(spark, 1).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    write_bucketed_events(df, path)
    write_bucketed_events(df.where("date_format(ts, 'yyyy-MM-dd') = '2024-01-02'").limit(5), path)
    back = read_events(spark, path, partition_by=("bucket", "index", "sourcetype")).groupBy("bucket").count().collect()
    assert {r.bucket: r["count"] for r in back} == {"2024-01-01": 24, "2024-01-02": 5, "2024-01-03": 24, None: 1}


@pytest.mark.parametrize("count", [1, 7, 50])
def test_chained_pages_are_the_sorted_rows(spark, count):
    rng = random.Random(count)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, float("nan"), 0.1, -0.0, 2.5]), rng.choice([None, "", "a|b", 'q"']), rng.choice([None, dt.datetime(2024, 1, 1, 0, 0, 0, 5)])) for _ in range(40)]
    df = spark.createDataFrame(rows + rows[:6] * 3, "a int, `b c` double, s string, t timestamp_ntz")
    want = page(df, ["s", "a"]).collect()
    got, token, n = [], None, 0
    while True:
        p = next_page(df, ["s", "a"], count, token)
        got += p.rows.collect()
        n += 1
        if p.token is None:
            break
        token = p.token
        if n > 5 and count == 1:
            break
    assert list(map(str, got)) == list(map(str, want[: len(got)])) and (count == 1 or len(got) == len(want))


def test_pages_seek_in_the_scan(spark, tmp_path):
    spark.range(1000).withColumn("v", F.col("id") % 7).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    first = next_page(df, ["id"], 10)
    second = next_page(df, ["id"], 10, first.token)
    assert "GreaterThanOrEqual(id,9)" in _plan(second.rows).split("PushedFilters")[1] and [r.id for r in second.rows.collect()] == list(range(10, 20))
    assert next_page(df, ["id"], 1000).token is not None and next_page(df, ["id"], 1001).token is None
    assert next_page(df.limit(0), ["id"], 5).token is None
    for bad in (lambda: next_page(df, ["id"], 0), lambda: next_page(df, ["v"], 5, first.token), lambda: next_page(df.select(F.array("id").alias("x")), ["x"], 5)):
        with pytest.raises(ValueError):
            bad()


def test_token_index_gives_the_rows_of_a_scan(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, f"2024-01-{1 + k // 100:02d}T00:00:00.000+0000|m=\"{' '.join(rng.sample(words, 5))} id{k} É\"" if k % 50 else f"no stamp ID{k}") for k in range(1000)]
    df = spark.createDataFrame(rows, "k long, raw string")
    df.repartitionByRange(12, "k").select("raw").write.text(f"{tmp_path}/in")
    open(f"{tmp_path}/in/empty.txt", "w").close()
    build_token_index(spark, f"{tmp_path}/in", f"{tmp_path}/ix")
    for tokens, window in ((["id777"], (None, None)), (["ID50", "stamp"], (None, None)), (["w3"], ("2024-01-04", "2024-01-06")), (["none_such"], (None, None)), ([], ("2024-01-09", None)), (["w1", "w2"], (None, None))):
        plain = search_tokens(spark, f"{tmp_path}/in", tokens, None, *window)
        quick = search_tokens(spark, f"{tmp_path}/in", tokens, f"{tmp_path}/ix", *window)
        assert sorted(map(str, plain.collect())) == sorted(map(str, quick.collect()))
    assert candidate_files(spark, f"{tmp_path}/ix", ["id777"]).count() <= 3
    assert candidate_files(spark, f"{tmp_path}/ix", ["none_such"]).count() <= 2
    assert candidate_files(spark, f"{tmp_path}/ix", [], dt.datetime(2024, 1, 9)).count() <= 3
    quick = search_tokens(spark, f"{tmp_path}/in", ["id777"], f"{tmp_path}/ix")
    metric = quick._jdf.queryExecution().executedPlan()
    quick.collect()
    assert "file_path" in metric.toString()


def test_discovered_types(spark):
    lines = ['t|a="1"|b="1.5"|c="true"|d="x"|e="null"|a="2"', 't|a="null"|b="2.0"|c="false"|d="1"|f="007"', "no fields", None, 't|g="\\"|h=\\"9"|a="9223372036854775808"']
    df = spark.createDataFrame([(x,) for x in lines], "raw string")
    got = {r.name: (r.n_events, r.type) for r in discover_fields(df).collect()}
    assert got == {"a": (3, "string"), "b": (2, "double"), "c": (2, "boolean"), "d": (2, "string"), "e": (1, "string"), "f": (1, "string"), "g": (1, "string")}
    rows = extract_discovered(df, time_out=None)
    assert rows.columns == list("abcdefg") and dict(rows.dtypes)["b"] == "double"
    assert rows.count() == 5 and sorted(str(r.b) for r in rows.collect()) == ["1.5", "2.0", "None", "None", "None"]
    assert discover_fields(df.limit(0)).count() == 0


def test_named_fields_of_any_shape(spark):
    df = spark.createDataFrame([('t|a="1"|user id="x|y"|2nd="z"|p($)="a|2nd"|é="q"',)], "raw string")
    got = extract_fields(df, ["a", "user id", "2nd", "p($)", "é"], time_out=None).first()
    assert tuple(got) == ("1", "x|y", "z", "a|2nd", "q")


HOSTILE = [None, "", "\\N", "\\\\N", "\\\\\\N", "N", "\\n", "\\", "\x00", "\x01", "a\x0bb", "\r", "a\r\nb\rc\n", "\t x ", " ", "\u007f\u0085\u2028", "\ufffe\uffff", "\U0001f600", "\\u0041", "\\u005cN",
           "\\u", "\\u12", "\\\\u0001\x01", "<a>&amp;]]>", '"', '""', "'", ",", "null", "é" * 5, "\\N\x01"]


@pytest.mark.parametrize("mode", ["csv", "json", "xml"])
def test_exports_keep_every_text(spark, tmp_path, mode):
    df = spark.createDataFrame([(k, t, t) for k, t in enumerate(HOSTILE)], "k int, a string, `b c` string" if mode != "xml" else "k int, a string, b string")
    export_results(df, f"{tmp_path}/x", mode)
    got = {r[0]: (r[1], r[2]) for r in read_export(spark, f"{tmp_path}/x", mode, df.schema).collect()}
    assert got == {k: (t, t) for k, t in enumerate(HOSTILE)}


@pytest.mark.parametrize("topk_rows", [10_000, 40])
def test_runs_of_pages_are_the_pages(spark, monkeypatch, topk_rows):
    from eventloom.operators import seek

    monkeypatch.setattr(seek, "RUN_TOPK_ROWS", topk_rows)
    rows = [(k % 5 if k % 7 else None, "same" if k % 3 else "other") for k in range(400)]
    df = spark.createDataFrame(rows, "a int, b string")
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got, token, taken = [], None, 0
    for pages in (1, 2, 4, 8, 16, 32):
        run = next_page(df, ["a"], 7, token, pages=pages, number="page")
        got += [(r.page + taken, r.a, r.b) for r in run.rows.collect()]
        taken, token = taken + pages, run.token
    assert token is None
    assert got == [(n // 7, *r) for n, r in enumerate(want)]


def test_a_long_search_is_paged_in_few_calls(spark, monkeypatch):
    from eventloom.plans import search_queries

    calls = []
    monkeypatch.setattr(search_queries, "next_page", lambda *a, **k: calls.append(a) or next_page(*a, **k))
    hits = search_queries.q_search_page_next(spark, "/root/testdata/sf0.1")
    assert hits.agg(F.max("page")).first()[0] >= 25
    assert len(calls) <= 5


def test_discovery_reads_the_text_once(spark):
    values = ["1", "-0", "007", "+1", " 1", "1\n", "9223372036854775807", "9223372036854775808", "1.5", "1e5", "1.0E10", "-1.0E-5", ".5", "NaN",
              "Infinity", "-Infinity", "inf", "1.50", "1d", "true", "TRUE", "t", "yes", "false", "", "null", "Null", "٣", "1.0E400"]
    df = spark.createDataFrame([(f't|f{k}="{v}"|same="x"|same="y"',) for k, v in enumerate(values)], "raw string")
    found = discover_fields(df)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Join" not in plan and plan.count("regexp_extract_all") == 1
    v = F.col("v")
    fits = lambda t: F.coalesce(v.try_cast(t).cast("string") == v, F.lit(False))
    kind = F.when(v == "null", "string").when(fits("bigint"), "bigint").when(fits("double"), "double").when(fits("boolean"), "boolean").otherwise("string")
    want = {r.k: r.t for r in spark.createDataFrame([(f"f{k}", x) for k, x in enumerate(values)], "k string, v string").select("k", kind.alias("t")).collect()}
    got = {r.name: (r.n_events, r.type) for r in found.collect()}
    assert got.pop("same") == (len(values), "string")
    assert got == {k: (1, t) for k, t in want.items()}
