import datetime as dt

from pyspark.sql import functions as F

from eventloom.functions import event_text, event_timestamp, map_event_text
from eventloom.operators.format import destination_query_string, format_events, with_destination


def _one(spark, rows, schema, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_timestamp_default_and_compat(spark):
    rows = [(dt.datetime(2024, 1, 2, 3, 4, 5, 7000),), (dt.datetime(2024, 1, 2, 3, 4, 5, 45000),),
            (dt.datetime(2024, 1, 2, 3, 4, 5, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = df.select(event_timestamp("ts").alias("a"), event_timestamp("ts", compat=True).alias("b")).collect()
    assert [r.a for r in got] == ["2024-01-02T03:04:05.007+0000", "2024-01-02T03:04:05.045+0000",
                                  "2024-01-02T03:04:05.000+0000"]
    assert [r.b for r in got] == ["2024-01-02T03:04:05.7+0000", "2024-01-02T03:04:05.45+0000",
                                  "2024-01-02T03:04:05.0+0000"]


def test_fields_null_duplicates_and_quotes(spark):
    df = spark.createDataFrame([("x\"y", None)], "a string, b string")
    got = df.select(event_text([("a", "a"), ("b", "b"), ("a", F.lit("2"))], with_timestamp=False)).first()[0]
    assert got == '|a="x"y"|b="null"|a="2"'
    esc = df.select(event_text(["a", "b"], escape="backslash", with_timestamp=False)).first()[0]
    assert esc == '|a="x\\"y"|b="null"'


def test_custom_delimiter_and_timestamp_prefix(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 6, 7, 8, 9), 1)], "ts timestamp_ntz, n int")
    assert df.select(event_text(["n"], "ts", delim=" ")).first()[0] == '2024-05-06T07:08:09.000+0000 n="1"'


def test_map_keeps_entry_order(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 6),)], "ts timestamp_ntz")
    m = F.create_map(F.lit("z"), F.lit("1"), F.lit("a"), F.lit(None).cast("string"))
    assert df.select(map_event_text(m, "ts")).first()[0] == '2024-05-06T00:00:00.000+0000|z="1"|a="null"'


def test_format_events_default_fields_and_no_stamp(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 6), 1, "v")], "ts timestamp_ntz, n int, s string")
    assert format_events(df).select("raw").first()[0] == '2024-05-06T00:00:00.000+0000|n="1"|s="v"'
    assert format_events(df, ["s"], ts=False).select("raw").first()[0] == '|s="v"'


def test_destination_overrides_and_query_string(spark):
    df = spark.createDataFrame([("a", ""), ("b", None), ("c", "web")], "k string, st string")
    out = with_destination(df, index="main", source="", sourcetype=F.col("st"),
                           defaults={"source": "app"}).select("k", "index", "source", "sourcetype",
                                                              destination_query_string().alias("q"))
    got = {r.k: (r["index"], r.source, r.sourcetype, r.q) for r in out.collect()}
    assert got["a"] == ("main", "app", None, "?source=app&index=main")
    assert got["b"] == ("main", "app", None, "?source=app&index=main")
    assert got["c"] == ("main", "app", "web", "?source=app&sourcetype=web&index=main")
    none = with_destination(df).select(destination_query_string().alias("q")).first()[0]
    assert none == ""


def test_event_size_equals_text_size(spark):
    from eventloom.functions.fields import event_size
    rows = [
        (dt.datetime(2024, 1, 2, 3, 4, 5, 7000), 1.5, 'a"b\\c', None),
        (dt.datetime(999, 1, 2), None, "€𝄞 unicode", 7),
        (None, 2.0, "", -1),
        (dt.datetime(2024, 12, 31, 23, 59, 59, 999999), 1e-7, "x" * 300, 0),
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, d double, s string, n int")
    fields = ["d", "s", ("n", "n"), ("d", "d")]
    for kw in [{}, {"escape": "backslash"}, {"compat": True}, {"delim": " || "}]:
        for unit, fn in (("bytes", F.octet_length), ("chars", F.length)):
            got = df.select(fn(event_text(fields, "ts", **kw)).alias("a"),
                            event_size(fields, "ts", unit=unit, **kw).alias("b")).collect()
            assert all(r.a == r.b for r in got), (kw, unit, got)
    nostamp = df.select(F.octet_length(event_text(fields, with_timestamp=False)).alias("a"),
                        event_size(fields, with_timestamp=False).alias("b")).collect()
    assert all(r.a == r.b for r in nostamp)
    assert df.where("ts is null").select(event_text(["n"], "ts")).first()[0] == 'null|n="-1"'


def test_format_replaces_an_existing_raw_column(spark):
    df = spark.createDataFrame([("old", 1)], "raw string, n int")
    out = format_events(df, ["n"], ts=False)
    assert out.columns == ["n", "raw"] and out.first().raw == '|n="1"'
