import datetime as dt

from eventloom.plans.search import run_search
from eventloom.plans.ship import file_batches, ship, table_batches
from eventloom.sinks.export import read_export
from eventloom.sources.tables import read_table

from conftest import SF_SMALL
from test_batching import offset_batches


def test_file_batches_match_offset_batches(spark, tmp_path):
    lines = [f"line {i} " + "z" * (i % 17) for i in range(3000)]
    text = "".join(line + "\n" for line in lines)
    (tmp_path / "f.txt").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = file_batches(spark, str(tmp_path / "f.txt"), block_size=1024).orderBy("batch_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.payload for r in got] == offset_batches(text, 1024)


def test_table_batches_then_ship(spark, tmp_path):
    ev = read_table(spark, SF_SMALL, "events")
    payloads = table_batches(ev, ["event_id"], ["event_id", "event_type"], "ts", block_size=4096)
    receipts, rejected, totals = ship(payloads, receipts_path=str(tmp_path / "receipts"))
    assert rejected.count() == 0
    assert receipts.agg({"n_events": "sum"}).first()[0] == ev.count()
    t = totals.first()
    assert t.calls == receipts.count() and t.read_bytes == t.sent_bytes


def test_run_search_counts_exports_and_empty_rule(spark, tmp_path):
    ev = read_table(spark, SF_SMALL, "events")
    now = dt.datetime(2024, 1, 16, 9, 30)
    res = run_search(ev, "event_type = 'error'", str(tmp_path / "out"), "json", "-7d@d", "@d", now,
                     order_by=["event_id"], offset=3, count=20)
    assert res.result_count == 20 and res.event_count >= 23 and res.scan_count >= res.event_count
    back = read_export(spark, res.path, "json", ev.schema)
    assert back.count() == 20
    none = run_search(ev, "event_type = 'nope'", str(tmp_path / "none"), "csv", None, None, now)
    assert none.path is None and none.result_count == 0 and none.scan_count == ev.count()
    assert not (tmp_path / "none").exists()


import pytest  # noqa: E402


@pytest.mark.parametrize("content,lines", [
    (b"aa\nbb", ["aa", "bb"]),                    # unterminated tail is kept
    (b"aabb", ["aabb"]),                          # no LF: no padding, one event
    (b"\nabc", ["", "abc"]),                      # LF only at index 0
    (b"aa\nbbbbb", ["aa", "bbbbb"]),              # length a multiple of B, unterminated
    (b"aaaaaaaaaa\nb\n", ["aaaaaaaaaa", "b"]),    # line longer than B stays whole
    (b"a\r\nb\rc\n\nlast", ["a", "b", "c", "", "last"]),
])
def test_file_edge_cases_block_8(spark, tmp_path, content, lines):
    p = tmp_path / "f.txt"
    p.write_bytes(content)
    got = file_batches(spark, str(p), block_size=8).orderBy("batch_id").collect()
    assert "".join(r.payload for r in got) == "".join(line + "\n" for line in lines)
    assert sum(r.n_events for r in got) == len(lines)
    ends, off = [], 0
    for line in lines:
        off += len(line) + 1
        ends.append((off - 1) // 8)
    assert [r.batch_id for r in got] == sorted(set(ends))


def test_files_are_not_mixed_in_a_payload(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.log").write_text("".join(f"{name}{i}\n" for i in range(300)))
    got = file_batches(spark, str(tmp_path), block_size=256).collect()
    by_file = {}
    for r in sorted(got, key=lambda r: (r.file_path, r.batch_id)):
        by_file.setdefault(r.file_path[-5], []).append(r.payload)
    assert by_file == {n: offset_batches("".join(f"{n}{i}\n" for i in range(300)), 256) for n in "ab"}
    mixed = file_batches(spark, str(tmp_path), block_size=256, per_file=False).orderBy("batch_id").collect()
    assert [r.payload for r in mixed] == offset_batches("".join(f"{n}{i}\n" for n in "ab" for i in range(300)), 256)


def test_sink_search_prunes_folders(spark, tmp_path):
    from eventloom.operators.format import format_events, with_destination
    from eventloom.plans.search import search_event_files
    from eventloom.sinks.partitioned import write_events
    ev = read_table(spark, SF_SMALL, "events")
    routed = with_destination(ev, index="main", sourcetype=ev.event_type)
    write_events(format_events(routed, ["event_id"], "ts"), str(tmp_path / "sink"))
    hits = search_event_files(spark, str(tmp_path / "sink"), ["event_id"], "sourcetype = 'error'", None, None,
                              now="2024-01-16", partitions=("index", "sourcetype"))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "sourcetype" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert hits.count() == ev.where("event_type = 'error'").count()
