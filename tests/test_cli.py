from eventloom.__main__ import main

from conftest import SF_SMALL


def test_cli_ship_file(spark, tmp_path):
    f = tmp_path / "events.txt"
    f.write_text("".join(f'2024-01-01T00:00:00.000+0000|n="{i}"\n' for i in range(5000)))
    out = main(["ship", "--file", str(f), "--index", "main", "--sourcetype", "app", "--block-size", "4096",
                "--receipts", str(tmp_path / "ledger")], spark)
    (t,) = out["totals"]
    assert t["index"] == "main" and t["sourcetype"] == "app" and t["source"] is None
    assert t["n_events"] == 5000 and t["read_bytes"] == f.stat().st_size and t["rejected"] == 0


def test_cli_search_with_search_file_and_empty_result(spark, tmp_path):
    sfile = tmp_path / "q.txt"
    sfile.write_text("# errors above 100\n  event_type = 'error'\n\n   # value filter\nAND value > 100\n")
    out = main(["search", "--searchfile", str(sfile), "--table", f"{SF_SMALL}/events.parquet",
                "--earliest=-7d@d", "--latest=@d", "--now", "2024-01-16T09:30:00",
                "--omode", "json", "--outfile", str(tmp_path / "out")], spark)
    assert out["result_count"] == 68 and out["output"] == str(tmp_path / "out")
    none = main(["search", "event_type = 'nope'", "--table", f"{SF_SMALL}/events.parquet", "--earliest", "",
                 "--latest", "", "--outfile", str(tmp_path / "none")], spark)
    assert none["result_count"] == 0 and none["output"] is None and not (tmp_path / "none").exists()


def test_cli_dequote_applies_to_output(spark, tmp_path):
    src = tmp_path / "t.parquet"
    spark.createDataFrame([(1, '"x"', __import__("datetime").datetime(2024, 1, 15, 1))],
                          "id long, s string, ts timestamp_ntz").write.parquet(str(src))
    out = main(["search", "s = '\"x\"'", "--table", str(src), "--earliest", "", "--latest", "", "--omode", "json",
                "--outfile", str(tmp_path / "o"), "--dequote"], spark)
    assert out["result_count"] == 1
    assert spark.read.json(out["output"]).first().s == "x"


def test_cli_ship_table(spark, tmp_path):
    out = main(["ship", "--table", f"{SF_SMALL}/events.parquet", "--order", "event_id",
                "--fields", "event_id,event_type", "--index", "main", "--receipts", str(tmp_path / "l")], spark)
    (t,) = out["totals"]
    assert t["n_events"] == 10000 and t["calls"] >= 1 and t["index"] == "main"


def test_cli_search_raw_output_formats_rows(spark, tmp_path):
    out = main(["search", "event_type = 'error' AND value > 100", "--table", f"{SF_SMALL}/events.parquet",
                "--earliest=-7d@d", "--latest=@d", "--now", "2024-01-16T09:30:00", "--omode", "raw",
                "--outfile", str(tmp_path / "raw")], spark)
    lines = [r.value for r in spark.read.text(out["output"]).collect()]
    assert len(lines) == out["result_count"] == 68
    assert all(x.startswith("2024-01-") and '|event_type="error"' in x for x in lines)


def test_cli_ship_table_with_a_source_column(spark, tmp_path):
    out = main(["ship", "--table", f"{SF_SMALL}/documents.parquet", "--order", "doc_id", "--ts", "",
                "--fields", "doc_id,source,lang", "--index", "docs", "--receipts", str(tmp_path / "l")], spark)
    by_source = {t["source"]: t for t in out["totals"]}
    assert len(by_source) > 10 and all(k.startswith("src") for k in by_source)  # data column as default
    assert sum(t["n_events"] for t in out["totals"]) == 1000
