import os

from pyspark.sql import functions as F

from eventloom.operators.prefix import running_sum
from eventloom.sources.text import FILE_ORDER, FILE_SEGMENT, read_event_file


def test_file_order_restored_across_splits_and_files(spark, tmp_path):
    folder = tmp_path / "events"
    folder.mkdir()
    expected = []
    for f in range(3):
        lines = [f"f{f}-line{i:05d}-" + "x" * (i % 13) for i in range(4000)]
        ends = ["\n", "\r\n", "\r"]
        (folder / f"part-{f}.txt").write_bytes(
            "".join(line + ends[i % 3] for i, line in enumerate(lines)).encode())
        expected += lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # many splits per file
    try:
        lines = read_event_file(spark, str(folder))
        assert lines.select("file_path", "file_block_start").distinct().count() > 6
        numbered = running_sum(lines, F.lit(1), list(FILE_ORDER), segment=list(FILE_SEGMENT), out="n")
        got = [r.raw for r in numbered.orderBy("n").select("raw").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == expected


def test_read_event_file_empty_lines_kept(spark, tmp_path):
    p = tmp_path / "one.txt"
    p.write_bytes(b"a\r\nb\rc\n\nlast")
    got = read_event_file(spark, str(p)).orderBy(*FILE_ORDER).select("raw").collect()
    assert [r.raw for r in got] == ["a", "b", "c", "", "last"]
    assert os.path.exists(p)
