"""Repacked, answered, resumed, continued and in-place shipments."""

import collections
import datetime as dt
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventloom.operators.batching import batch_events, repack_oversize
from eventloom.plans.files import file_blocks, ship_files, split_starts
from eventloom.plans.ship import file_batches, ship, ship_resumable
from eventloom.sinks.resume import LOG_ROWS, _Log, read_log
from eventloom.sinks.retry import Retry, http_outcome, redelivery_queue
from eventloom.streaming.continued import finish_delivery, start_continued_delivery
from eventloom.streaming.delivery import read_event_stream, read_stream_receipts

ANY = Retry(attempts=1, outcome=lambda status: "sent")


def next_fit(lines, limit):
    parts, fill = [], 0
    for line in lines:
        size = len(line.encode()) + 1
        if not parts or fill and fill + size > limit:
            parts.append([])
            fill = 0
        parts[-1].append(line)
        fill += size
    return parts


def test_repack_is_next_fit(spark):
    rng = random.Random(1)
    rows = []
    for k in range(60):
        lines = ["é" * rng.choice([0, 1, 5, 20, 60, 101, 300]) for _ in range(rng.randrange(1, 30))]
        text = "".join(x + "\n" for x in lines)
        rows.append((k, "d", len(lines), len(text.encode()), text))
    df = spark.createDataFrame(rows, "batch_id long, sourcetype string, n_events long, n_bytes long, payload string")
    got = collections.defaultdict(list)
    for r in repack_oversize(df, 200).orderBy("batch_id", "part").collect():
        got[r.batch_id].append(r)
        assert r.n_bytes == len(r.payload.encode()) and (r.n_bytes <= 200 or r.n_events == 1)
    for k, _, n, size, text in rows:
        lines = text[:-1].split("\n")
        want = next_fit(lines, 200) if size > 200 else [lines]
        assert [(r.part, r.n_events, r.payload) for r in got[k]] == [(i, len(p), "".join(x + "\n" for x in p)) for i, p in enumerate(want)]
    assert repack_oversize(df.limit(0), 200).count() == 0


def test_only_lines_over_the_limit_are_dead_letters(spark):
    rows = [(k, "x" * (30_000 if k == 7 else 1_000)) for k in range(20)]
    payloads = batch_events(spark.createDataFrame(rows, "k long, raw string"), ["k"], 16_384, destination=[])
    receipts, rejected, totals = ship(payloads, limit=16_384, repack=True)
    dead = rejected.collect()
    assert [r.dead_letter for r in dead] == ["x" * 30_000 + "\n"]
    assert receipts.agg(F.sum("n_events")).first()[0] == 19
    assert receipts.select("batch_key").distinct().count() == receipts.count()
    assert totals.first().rejected == 1


def _payloads(spark, n=300):
    rows = [(i, f"event {i}", "hot" if i % 4 else "cold") for i in range(n)]
    return batch_events(spark.createDataFrame(rows, "k long, raw string, sourcetype string"), ["k"], 100)


def test_http_outcomes():
    assert [http_outcome(s) for s in ("200 OK", "204", "503 x", "429 y", "408", "400", "301 z")] == ["sent", "sent", "retry", "retry", "retry", "refused", "refused"]
    with pytest.raises(ValueError):
        Retry(attempts=0)


def test_retry_waits_and_gives_up(monkeypatch):
    waits = []
    monkeypatch.setattr("eventloom.sinks.retry.time.sleep", waits.append)
    answers = iter(["503 a", "503 b", "503 c", "200 OK"])
    assert Retry(attempts=5, wait=1, factor=3, longest=5).send(lambda p, d: next(answers), "x", {}) == ("200 OK", 4, "sent")
    assert waits == [1, 3, 5]

    def broken(payload, destination):
        raise OSError("down")

    assert Retry(attempts=2, wait=0).send(broken, "x", {}) == ("OSError: down", 2, "refused")
    assert Retry().send(lambda p, d: "400 Bad", "x", {}) == ("400 Bad", 1, "refused")


def test_refused_batches_are_not_sent_and_can_be_redelivered(spark):
    p = _payloads(spark)
    receipts, rejected, totals = ship(p, lambda text, dest: "503 later" if "7" in text else "200 OK", retry=Retry(attempts=2, wait=0))
    refused = p.where(F.col("payload").contains("7"))
    assert rejected.count() == refused.count() > 0 and receipts.count() == p.count() - refused.count()
    t = {r.sourcetype: r for r in totals.collect()}
    assert sum(r.refused for r in t.values()) == refused.count()
    assert sum(r.sent_bytes for r in t.values()) == receipts.agg(F.sum("n_bytes")).first()[0]
    assert sum(r.calls for r in t.values()) == receipts.count() + 2 * refused.count()
    again, none, _ = ship(redelivery_queue(rejected), lambda text, dest: "200 OK", retry=Retry())
    assert again.count() == refused.count() and none.count() == 0


def _recording(folder, fails=None):
    def send(payload, destination):
        if fails and fails in payload:
            raise ConnectionError("gone")
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(f"{destination['sourcetype']}\n{payload}")
        return "200 OK"

    return send


def test_a_failed_shipment_goes_on_where_it_was(spark, tmp_path):
    p = _payloads(spark).repartition(4, "sourcetype", "batch_id")
    sent, log = tmp_path / "sent", f"{tmp_path}/log"
    sent.mkdir()
    # without a retry policy the sender's error fails the task, and the job
    from eventloom.sinks.resume import send_logged

    class Fatal(Retry):
        def send(self, send, payload, destination):
            return send(payload, destination), 1, "sent"

    with pytest.raises(PySparkException):
        send_logged(p, "s", log, _recording(sent, "event 150\n"), None, None, "none", Fatal())
    first = len(os.listdir(sent))
    assert 0 < first < p.count()
    receipts, rejected, totals = ship_resumable(p, "s", log, _recording(sent))
    assert receipts.count() == p.count() == receipts.select("batch_key").distinct().count() and rejected.count() == 0
    # every batch was sent once over both runs
    texts = [open(sent / f).read() for f in os.listdir(sent)]
    assert sorted(texts) == sorted(f"{r.sourcetype}\n{r.payload}" for r in p.collect())
    assert totals.agg(F.sum("n_events")).first()[0] == 300
    # a third run has nothing to do
    ship_resumable(p, "s", log, _recording(sent))
    assert len(os.listdir(sent)) == len(texts)


def test_refused_batches_are_sent_by_the_next_run(spark, tmp_path):
    p, log = _payloads(spark, 100), f"{tmp_path}/log"
    _, rejected, _ = ship_resumable(p, "s", log, lambda t, d: "500 no" if "9" in t else "200 OK", retry=Retry(attempts=1))
    assert rejected.count() > 0
    receipts, rejected, _ = ship_resumable(p, "s", log, lambda t, d: "200 OK", retry=Retry(attempts=1))
    assert rejected.count() == 0 and receipts.count() == p.count()


def test_an_attempt_reads_what_earlier_ones_of_its_task_did(spark, tmp_path):
    folder = f"file://{tmp_path}/log/run/000000"
    one = _Log(folder)
    rows = [{"batch_key": str(k), "outcome": "refused" if k == 3 else "sent", "batch_id": k, "n_events": 1, "n_bytes": 2, "status": "s", "attempts": 1, "rejected": False} for k in range(LOG_ROWS + 5)]
    for r in rows:
        one.add(r)
    assert len(_Log(folder).earlier()) == LOG_ROWS - 1  # the open file isn't there yet
    one.close()
    assert _Log(folder).earlier() == {str(k) for k in range(LOG_ROWS + 5)} - {"3"}
    with open(f"{tmp_path}/log/run/000000/part.json", "w") as f:
        f.write('{"batch_key": "x", "outc')  # a process was lost here
    ledger = read_log(spark, f"file://{tmp_path}/log", spark.createDataFrame([], "batch_id long, n_events long, n_bytes long, payload string"))
    assert ledger.count() == LOG_ROWS + 5
    assert read_log(spark, f"{tmp_path}/none", ledger) is None


@pytest.mark.parametrize("dest, split_rows", [(["sourcetype"], None), (["sourcetype"], 40), ([], 60)])
def test_continued_blocks_equal_the_batch_job(spark, tmp_path, dest, split_rows):
    rng = random.Random(7)
    rows = [(k, "é" * rng.choice([0, 3, 30, 400]), rng.choice(["a", "b", None, "c"]) if k < 150 else "a") for k in range(250)]
    df = spark.createDataFrame(rows, "k long, raw string, sourcetype string")
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    for lo, hi in ((0, 100), (100, 101), (101, 180), (180, 250)):
        df.where((F.col("k") >= lo) & (F.col("k") < hi)).coalesce(1).write.mode("append").parquet(src)
    stream = read_event_stream(spark, src, df.schema, glob="*.parquet", max_files_per_trigger=1)
    start_continued_delivery(stream, ["k"], out, f"{tmp_path}/ckpt", block_size=500, destination=dest, split_rows=split_rows).awaitTermination()
    assert spark.read.parquet(f"{out}/state").select("epoch").distinct().count() == 4
    finish_delivery(spark, out, f"{tmp_path}/ckpt")
    cols = [*dest, "batch_id", "n_events", "n_bytes", "status"]
    got = read_stream_receipts(spark, out).select(*cols)
    want = batch_events(df, ["k"], 500, destination=dest).withColumn("status", F.md5("payload")).select(*cols)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_replayed_micro_batch_gives_the_same(spark, tmp_path):
    """State and ledger of the last micro-batch are lost after it ran: it is replayed from the one before."""
    import shutil
    df = spark.createDataFrame([(k, "x" * (k % 50), "a") for k in range(200)], "k long, raw string, sourcetype string")
    src, out, ckpt = f"{tmp_path}/src", f"{tmp_path}/out", f"{tmp_path}/ckpt"
    for lo in (0, 100):
        df.where((F.col("k") >= lo) & (F.col("k") < lo + 100)).coalesce(1).write.mode("append").parquet(src)
    for _ in range(2):
        stream = read_event_stream(spark, src, df.schema, glob="*.parquet", max_files_per_trigger=1)
        start_continued_delivery(stream, ["k"], out, ckpt, block_size=500).awaitTermination()
        before = sorted(map(str, read_stream_receipts(spark, out).collect()))
        os.remove(f"{ckpt}/commits/1")
        shutil.rmtree(f"{out}/state/epoch=1")
        crc = f"{ckpt}/commits/.1.crc"
        if os.path.exists(crc):
            os.remove(crc)
    assert sorted(map(str, read_stream_receipts(spark, out).collect())) == before


def _files(tmp_path, seed, n_files=5):
    rng = random.Random(seed)
    os.makedirs(f"{tmp_path}/in")
    for k in range(n_files):
        lines = ["é" * rng.choice([0, 1, 10, 200]) for _ in range(rng.randrange(0, 400))]
        with open(f"{tmp_path}/in/f{k}.txt", "w", newline="") as f:
            f.write(rng.choice(["\n", "\r\n"]).join(lines) + ("\n" if k % 2 else ""))
    return f"{tmp_path}/in"


@pytest.mark.parametrize("per_file", [True, False])
@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_file_blocks_equal_the_shuffled_path(spark, tmp_path, per_file, broadcast_bytes, monkeypatch):
    path = _files(tmp_path, 3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    monkeypatch.setattr("eventloom.plans.files.file_blocks.__defaults__", (524_288, True, broadcast_bytes))
    try:
        want = file_batches(spark, path, 700, per_file=per_file)
        cols = [*(["file_path"] if per_file else []), "batch_id", "n_events", "n_bytes", "status"]
        want = want.withColumn("status", F.md5("payload")).select(*cols).collect()
        receipts, rejected, totals = ship_files(spark, path, block_size=700, per_file=per_file)
        assert sorted(map(str, receipts.select(*cols).collect())) == sorted(map(str, want)) and len(want) > 20
        assert rejected.count() == 0 and totals.agg(F.sum("read_bytes")).first()[0] == sum(r.n_bytes for r in want)
        pieces = file_blocks(spark, path, 700, per_file)
        per_split = pieces.where("edge").groupBy("file_path", "file_block_start").count().agg(F.max("count")).first()[0]
        assert per_split <= 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_file_blocks_repack_and_refuse(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    with open(f"{tmp_path}/in/a.txt", "w") as f:
        f.write("\n".join(["x" * 300, "y" * 2000, *["z" * 100] * 40]))
    receipts, rejected, _ = ship_files(spark, f"{tmp_path}/in", block_size=500, limit=600, repack=True, destination={"index": "main"})
    assert [r.dead_letter for r in rejected.collect()] == ["y" * 2000 + "\n"]
    assert receipts.agg(F.sum("n_events")).first()[0] == 41 and receipts.first()["index"] == "main"
    refused = ship_files(spark, f"{tmp_path}/in", lambda t, d: "400 no", block_size=500, retry=Retry(attempts=1))[1]
    assert "".join(sorted(r.dead_letter for r in refused.collect())).count("\n") == 42


def test_splits_are_summed_in_ranges(spark, tmp_path):
    path = _files(tmp_path, 5)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block_start"), F.col("value").alias("raw"))
        got = split_starts(lines, per_file=False, range_rows=7).orderBy("file_path", "file_block_start").collect()
        sizes = {(r[0], r[1]): r[2] for r in lines.groupBy("file_path", "file_block_start").agg(F.sum(F.octet_length("raw") + 1)).collect()}
        total = 0
        for r in got:
            assert r["_from"] == total
            total += sizes[r.file_path, r.file_block_start]
        assert len(got) == len(sizes) > 14
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("per_file", [True, False])
def test_text_is_in_no_exchange(spark, tmp_path, per_file):
    path = _files(tmp_path, 4)
    plan = file_blocks(spark, path, 700, per_file)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan and "rangepartitioning" not in plan
    starts = split_starts(spark.read.text(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block_start"), F.col("value").alias("raw")), per_file)
    assert "SinglePartition" not in starts._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["k", "t"])
def test_a_destination_of_few_wide_rows_is_cut_into_equal_bytes(spark, key):
    from eventloom.operators.batching import assign_batches, batch_of
    from eventloom.operators.prefix import SEG, add_segments

    rows = [(k, f"key-{k:05d}", "w" if k % 2 else "n", "x" * (40_000 if k < 200 and k % 2 else 10)) for k in range(1000)]
    df = spark.createDataFrame(rows, "k long, t string, sourcetype string, raw string")
    size = F.octet_length("raw") + 1
    cut, mode = add_segments(df, [key], ["sourcetype"], size=size, split_bytes=1_000_000)
    held = cut.groupBy("sourcetype", SEG).agg(F.sum(size).alias("b")).collect()
    wide = [r.b for r in held if r.sourcetype == "w"]
    assert mode == "hot" and len([r for r in held if r.sourcetype == "n"]) == 1
    assert len(wide) >= 8 and max(wide) < 1_000_000
    assert add_segments(df, [key], ["sourcetype"], size=size)[1] == "none"
    got = assign_batches(df, [key], 50_000, destination=["sourcetype"], split_bytes=1_000_000).select("k", "batch_id").collect()
    want, total = {}, {"w": 0, "n": 0}
    for k, _, d, raw in rows:
        total[d] += len(raw) + 1
        want[k] = (total[d] - 1) // 50_000
    assert {r.k: r.batch_id for r in got} == want


def test_a_resumable_task_holds_few_rows_as_python_objects(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    from eventloom.sinks.deliver import plain_values, row_slices

    batch = pa.RecordBatch.from_pydict({"k": list(range(1000)), "payload": ["x" * 1000] * 1000})
    slices = list(row_slices(iter([batch, batch.slice(0, 0), batch.slice(5, 1)]), 50_000))
    assert [k for s in slices for k in s.column("k").to_pylist()] == [*range(1000), 5] and max(s.num_rows for s in slices) <= 50
    noon = dt.datetime(2024, 7, 1, 12, 0, 0, 5)
    assert plain_values(pa.array([noon, None], pa.timestamp("us", "Europe/Berlin"))) == [noon + dt.timedelta(hours=2), None]
    assert plain_values(pa.array([1.5, float("nan")])) == [1.5, None] and plain_values(pa.array(["a", None])) == ["a", None]

    def no_frames(self, *a, **k):
        raise AssertionError("a whole Arrow batch as pandas objects")

    p = _payloads(spark, 100)
    monkeypatch.setattr(type(p), "mapInPandas", no_frames)
    receipts, _, _ = ship_resumable(p, "s", f"{tmp_path}/log", lambda t, d: f"200 {len(t)} {d['sourcetype']}")
    assert {(r.batch_id, r.sourcetype, r.status) for r in receipts.collect()} == {(r.batch_id, r.sourcetype, f"200 {r.n_bytes} {r.sourcetype}") for r in p.collect()}
