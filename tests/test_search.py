import datetime as dt

import pytest
from pyspark.errors import AnalysisException, ParseException

from eventloom.functions.timerange import resolve_time
from eventloom.operators.search import dequote_columns, page, search, search_stats, time_range
from eventloom.sinks.export import export_results
from eventloom.session import scratch_path
from eventloom.sources.tables import read_table

from conftest import SF_SMALL

NOW = dt.datetime(2024, 1, 16, 9, 30, 15)


@pytest.mark.parametrize("spec,want", [
    ("-1d@d", dt.datetime(2024, 1, 15)),
    ("@d", dt.datetime(2024, 1, 16)),
    ("-15m", dt.datetime(2024, 1, 16, 9, 15, 15)),
    ("-2h@h", dt.datetime(2024, 1, 16, 7)),
    ("@mon", dt.datetime(2024, 1, 1)),
    ("-1mon@mon", dt.datetime(2023, 12, 1)),
    ("+1y", dt.datetime(2025, 1, 16, 9, 30, 15)),
    ("now", NOW),
    ("2024-01-10", dt.datetime(2024, 1, 10)),
    ("2024-01-10T05:06:07", dt.datetime(2024, 1, 10, 5, 6, 7)),
    ("1705312800", dt.datetime(2024, 1, 15, 10)),
    ("", None),
    (None, None),
])
def test_resolve_time(spec, want):
    assert resolve_time(spec, NOW) == want


def test_zones_and_offsets():
    assert resolve_time("2024-01-10T05:00:00+02:00", NOW) == dt.datetime(2024, 1, 10, 3)
    assert resolve_time("2024-01-10T05:00:00+02:00", NOW, "America/New_York") == dt.datetime(2024, 1, 9, 22)
    assert resolve_time("1705312800", NOW, "Asia/Tokyo") == dt.datetime(2024, 1, 15, 19)
    aware_now = dt.datetime(2024, 1, 16, 1, 0, tzinfo=dt.timezone.utc)
    assert resolve_time("@d", aware_now, "America/Los_Angeles") == dt.datetime(2024, 1, 15)


def test_bad_time_modifier():
    with pytest.raises(ValueError):
        resolve_time("-1fortnight", NOW)


def test_time_range_pushed_to_scan(spark):
    df = time_range(read_table(spark, SF_SMALL, "events"), "-1d@d", "@d", NOW)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_search_stats_and_page(spark):
    ev = read_table(spark, SF_SMALL, "events")
    pred = "event_type = 'error'"
    hits = search(ev, pred, "-7d@d", "@d", NOW)
    n = hits.count()
    stats = search_stats(ev, pred, "-7d@d", "@d", NOW, offset=5, count=10).first()
    assert stats.event_count == n and stats.result_count == min(10, n - 5)
    assert stats.scan_count == time_range(ev, "-7d@d", "@d", NOW).count()
    ids = [r.event_id for r in page(hits, ["event_id"], 5, 10).collect()]
    assert ids == sorted(r.event_id for r in hits.collect())[5:15]
    unbounded = search_stats(ev, None, None, None, NOW).first()
    assert unbounded.scan_count == ev.count() == unbounded.event_count


def test_bad_predicate_fails_before_a_job(spark):
    ev = read_table(spark, SF_SMALL, "events")
    with pytest.raises(ParseException):
        search(ev, "event_type = = 'x'", None, None, NOW)
    with pytest.raises(AnalysisException):
        search(ev, "no_such_column > 1", None, None, NOW)


def test_empty_result_writes_nothing(spark, tmp_path):
    ev = read_table(spark, SF_SMALL, "events")
    empty = search(ev, "event_type = 'nope'", None, None, NOW)
    target = str(tmp_path / "out")
    assert export_results(empty, target, "csv") is None
    assert not (tmp_path / "out").exists()


def test_dequote_columns_only_strings(spark):
    df = spark.createDataFrame([('"a"', 1, '"b"')], "x string, n int, y string")
    r = dequote_columns(df).first()
    assert (r.x, r.n, r.y) == ("a", 1, "b")
    assert dequote_columns(df, ["y"]).first().x == '"a"'


def test_scratch_paths_unique(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_page_large_offsets_are_numbered_not_collected(spark):
    ev = read_table(spark, SF_SMALL, "events")
    want = [r.event_id for r in ev.orderBy("ts", "event_id").collect()]
    got = page(ev, ["ts", "event_id"], 9_000, 0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CollectLimit" not in plan and "TakeOrdered" not in plan
    assert [r.event_id for r in got.collect()] == want[9_000:]
    mid = page(ev, ["ts", "event_id"], 100, 50, topk_rows=10)
    assert [r.event_id for r in mid.collect()] == want[100:150]
    small = page(ev, ["ts", "event_id"], 100, 50)
    assert [r.event_id for r in small.collect()] == want[100:150]


def test_pages_of_ties_neither_skip_nor_repeat(spark):
    df = spark.range(600).selectExpr("id % 3 AS k", "id AS v", "map('a', 1) AS m").repartition(7)
    for topk in (10_000, 10):
        rows = [r.v for at in range(0, 600, 150) for r in page(df, ["k"], at, 150, topk_rows=topk).collect()]
        assert rows == sorted(range(600), key=lambda v: (v % 3, v))
    numbered = page(df, ["k"], 590, 5, number="no").collect()
    assert [r.no for r in numbered] == list(range(591, 596))


def test_hours_are_elapsed_time_across_a_clock_change():
    import datetime as dt
    from eventloom.functions.timerange import resolve_time
    # 2024-03-31: 02:00 becomes 03:00 in this zone
    assert resolve_time("-2h", "2024-03-31T04:30:00", "Europe/Berlin") == dt.datetime(2024, 3, 31, 1, 30)
    assert resolve_time("-1d", "2024-03-31T04:30:00", "Europe/Berlin") == dt.datetime(2024, 3, 30, 4, 30)
