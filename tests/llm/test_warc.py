import gzip
import hashlib
import json
import random

import pytest

from eventloom.llm import warc

SCHEMA = "page_id long, url string, html string, archive string, record_id string"


def record(kind, block, **fields):
    head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in {"WARC_Type": kind, **fields, "Content_Length": len(block)}.items())
    return f"WARC/1.0\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def brute(rows):
    """page_id -> what the contract says of it; ids are distinct here."""
    out, first = {}, {}
    payloads = {r[0]: (r[2] or "").encode() for r in rows}
    for page in sorted(payloads):
        first.setdefault(payloads[page], page)
    for page, p in payloads.items():
        again = len(p) >= 100 and first[p] != page
        out[page] = (len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first[p] if again else None)
    return out


def test_pages_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    texts = ["", None, "é" * 49, "é" * 50, "x" * 99, "x" * 100, "a\r\n\r\nb" * 30, "WARC/1.1\r\n\r\n" * 20, "long " * 400_000]
    rows = [(k, rng.choice([None, "", "http://a.example/ä b\r\nc?q=%20", "http://b.example/"]), rng.choice(texts), "x", "y") for k in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = warc.warc_digest(df, f"{tmp_path}/w").collect()
    assert {r.page_id: tuple(r)[1:] for r in got} == brute(rows) and len(got) == len(rows)


def test_files_roll_and_every_record_is_a_member(spark, tmp_path):
    rows = [(k, f"http://h.example/{k}", f"page {k % 40} " * 30, "x", "y") for k in range(200)]
    index = warc.archive_pages(spark.createDataFrame(rows, SCHEMA).repartition(2), f"{tmp_path}/w", archive_bytes=5_000)
    lines = index.collect()
    assert len({r.archive for r in lines}) > 8 and len(lines) == 200
    for archive in {r.archive for r in lines}:
        whole = open(archive, "rb").read()
        mine = sorted((r for r in lines if r.archive == archive), key=lambda r: r.offset)
        assert [r.seq for r in mine] == list(range(len(mine)))
        assert sum(r.length for r in mine) == len(whole) and mine[0].offset == 0
        for r in mine:
            assert r.record_id.encode() in gzip.decompress(whole[r.offset : r.offset + r.length])
        sidecar = [json.loads(x) for x in open(archive + ".idx")]
        assert sidecar == [r.asDict() for r in mine]
    read = warc.read_records(index).collect()
    ids = {r.record_id: r for r in read}
    revisits = [r for r in read if r.record_type == "revisit"]
    assert len(revisits) == 160 and all(ids[r.refers_to_id].record_type == "response" for r in revisits)
    assert {r.target_uri for r in read} == {r[1] for r in rows}


def test_foreign_files(spark, tmp_path):
    blocks = [record("warcinfo", b"software: x", WARC_Record_ID="<a>"), record("response", b"HTTP/1.1 200 OK\r\n\r\nhello", WARC_Record_ID="<b>", Content_Type="application/http"), record("resource", b"z" * 3_000_000, WARC_Record_ID="<c>")]
    one = b"".join(blocks)
    files = {"mono": gzip.compress(one), "members": b"".join(map(gzip.compress, blocks)), "plain": one, "cut": gzip.compress(one)[:-200], "plaincut": one[:-10], "junk": b"no warc at all\r\n", "empty": b"", "nogzip": b"\x1f\x8bxx", "nolength": b"WARC/1.0\r\nWARC-Type: x\r\n\r\n"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    df = spark.createDataFrame([(f"{tmp_path}/{name}",) for name in files], "path string")
    index = warc.stored(warc.normalise(df, f"{tmp_path}/out"), "index")
    kinds = {}
    for r in index.orderBy("source", "seq").collect():
        kinds.setdefault(r.source.rsplit("/", 1)[1], []).append(r.record_type)
    whole = ["warcinfo", "response", "resource"]
    assert kinds == {"mono": whole, "members": whole, "plain": whole, "cut": [*whole[:2], "damaged"], "plaincut": [*whole[:2], "damaged"], "junk": ["damaged"], "nogzip": ["damaged"], "nolength": ["damaged"]}
    read = {r.record_id: r for r in warc.read_records(index.where(f"source = '{tmp_path}/mono'")).collect()}
    assert read["<b>"].payload_digest == hashlib.sha256(b"hello").hexdigest() and read["<c>"].payload_bytes == 3_000_000
    # A damaged record leaves nothing behind the whole ones.
    archive = index.where(f"source = '{tmp_path}/cut'").first().archive
    assert len(gzip.open(archive).read()) == len(blocks[0] + blocks[1])


def test_null_and_repeated_ids_and_empty_tables(spark, tmp_path):
    text = "same " * 50
    rows = [(None, "u", text, "x", "y"), (None, "u", "other " * 40, "x", "y"), (None, "u", "other " * 40, "x", "y"), (7, "u", text, "x", "y"), (7, "u", text, "x", "y"), (9, "u", text, "x", "y")]
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.warc_digest(spark.createDataFrame(rows, SCHEMA).repartition(3), f"{tmp_path}/a").collect()), key=str)
    assert got == [(7, "response", None), (7, "revisit", 7), (9, "revisit", 7), (None, "response", None), (None, "revisit", 7), (None, "revisit", None)]
    none = warc.warc_digest(spark.createDataFrame([], SCHEMA), f"{tmp_path}/b")
    assert none.count() == 0 and none.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    texts = spark.createDataFrame([("a b%+ü", "u", "t")], "page_id string, url string, html string")
    assert warc.warc_digest(texts, f"{tmp_path}/c").first().page_id == "a b%+ü"


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_oracle(spark, sf, tmp_path):
    import duckdb

    from eventloom.llm.queries import op11_warc

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('/root/testdata/{sf}/pages.parquet')")
    got = op11_warc(spark, f"/root/testdata/{sf}")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({warc.ORACLE})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
