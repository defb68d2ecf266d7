import glob
import os

from pyspark.sql import functions as F

from eventloom.sinks.partitioned import read_events, write_events


def test_partitioned_sink_spreads_hot_destination(spark, tmp_path):
    rows = [("main", "hot" if i % 4 else f"st{i % 3}", f"e{i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "index string, sourcetype string, raw string")
    path = str(tmp_path / "sink")
    write_events(df, path, rows_per_file=500)
    hot_files = glob.glob(os.path.join(path, "index=main", "sourcetype=hot", "*.txt"))
    cold_files = glob.glob(os.path.join(path, "index=main", "sourcetype=st0", "*.txt"))
    assert len(hot_files) >= 6 and len(cold_files) == 1  # 3000 hot rows -> 6 groups; 333 rows -> 1
    back = read_events(spark, path)
    assert back.count() == 4000
    assert back.where(F.col("sourcetype") == "hot").count() == 3000
    assert sorted(r.raw for r in back.collect()) == sorted(r[2] for r in rows)


def test_partitioned_sink_null_destination(spark, tmp_path):
    df = spark.createDataFrame([(None, "a", "x"), ("i", "a", "y")], "index string, sourcetype string, raw string")
    path = str(tmp_path / "sink")
    write_events(df, path)
    assert read_events(spark, path).count() == 2


def test_partition_values_stay_strings(spark, tmp_path):
    df = spark.createDataFrame([("007", "1.50", "a"), ("10", "x", "b")], "index string, sourcetype string, raw string")
    path = str(tmp_path / "sink")
    write_events(df, path)
    back = {(r["index"], r.sourcetype, r.raw) for r in read_events(spark, path).collect()}
    assert back == {("007", "1.50", "a"), ("10", "x", "b")}


def test_sink_caps_write_tasks_for_many_small_destinations(spark, tmp_path):
    rows = [("main", f"st{i % 300}", f"e{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "index string, sourcetype string, raw string")
    path = str(tmp_path / "sink")
    write_events(df, path, rows_per_file=1000, max_tasks=16)
    back = read_events(spark, path)
    assert back.count() == 3000 and back.select("sourcetype").distinct().count() == 300


def test_exports_round_trip_multiline_text(spark):
    from conftest import SF_SMALL
    from eventloom.session import scratch_path
    from eventloom.sinks.export import export_results, read_export
    from eventloom.sources.tables import read_table
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    want = sorted(map(tuple, docs.collect()))
    assert any("\n" in t for _, t in want) and any('"' in t for _, t in want)
    for mode in ("csv", "json", "xml"):
        path = export_results(docs, scratch_path(spark, f"docs-{mode}"), mode)
        got = sorted(map(tuple, read_export(spark, path, mode, docs.schema).collect()), key=repr)
        assert got == sorted(want, key=repr), mode


def test_equal_lines_are_split(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(20_000).selectExpr("'main' AS index", "'hot' AS sourcetype", "'same' AS raw").write.parquet(src)
    path = str(tmp_path / "sink")
    write_events(spark.read.parquet(src), path, rows_per_file=1000)
    files = glob.glob(os.path.join(path, "index=main", "sourcetype=hot", "*.txt"))
    assert len(files) >= 10  # 20 groups, some of which share a task
    assert read_events(spark, path).count() == 20_000


def test_exports_keep_every_value(spark):
    from eventloom.session import scratch_path
    from eventloom.sinks.export import export_results, read_export
    values = ["", None, " pad ", "null", "a,b", 'say "hi"', "\\", "tab\there", "é😀", "NULL", "  "]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v string")
    for mode in ("csv", "json", "xml"):
        path = export_results(df, scratch_path(spark, f"values-{mode}"), mode)
        got = [r.v for r in read_export(spark, path, mode, df.schema).orderBy("id").collect()]
        assert got == values, mode


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import types

    import pytest
    from eventloom.session import checkpoint_root
    context = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = types.SimpleNamespace(sparkContext=context, conf=types.SimpleNamespace(get=lambda k, d=None: None))
    with pytest.raises(RuntimeError):
        checkpoint_root(session)


def test_a_destination_of_few_wide_rows_is_several_files(spark, tmp_path):
    df = spark.range(0, 400, 1, 4).select(F.lit("main").alias("index"), F.when(F.col("id") % 4 > 0, "wide").otherwise("thin").alias("sourcetype"),
                                          F.when(F.col("id") % 4 > 0, F.expr("repeat('x', 1000)")).otherwise("x").alias("raw"))
    write_events(df, f"{tmp_path}/s", bytes_per_file=30_000)
    files = lambda d: glob.glob(f"{tmp_path}/s/index=main/sourcetype={d}/*.txt")
    assert len(files("thin")) == 1 and len(files("wide")) > 1
    assert read_events(spark, f"{tmp_path}/s").exceptAll(df.select("raw", "index", "sourcetype")).isEmpty()
    assert read_events(spark, f"{tmp_path}/s").count() == 400
