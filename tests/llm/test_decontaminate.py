import random
import re

import duckdb
import pytest

from eventloom.llm import decontaminate as d

DOCS = "doc_id long, text string, item_id long, hash string, q int"
ITEMS = "item_id long, text string, doc_id string"


def shingles(text, sizes=(5,)):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[k : k + n]) for n in sizes for k in range(len(w) - n + 1)}


def of_item(text):
    return shingles(text) or shingles(text, (len((text or "").split()) or 1,))


@pytest.fixture(scope="module")
def tables():
    rnd = random.Random(4)
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randint(0, 40))
    items = [[word() for _ in range(rnd.randint(1, 60))] for _ in range(50)]
    docs = []
    for k in range(200):
        text = [word() for _ in range(rnd.randint(0, 400))]
        for _ in range(k % 3):
            passage = list(rnd.choice(items))
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                passage[rnd.randrange(len(passage))] = word()
            at = rnd.randint(0, len(text))
            text[at:at] = [w.upper() for w in passage] if k % 5 == 0 else passage
        docs.append((k if k % 61 else None, " \n".join(text), 1, "x", 2))
    docs += [(501, None, 1, "x", 2), (502, "", 1, "x", 2), docs[4], docs[4], (503, " ".join(items[7]) + " tail " * 30_000, 1, "x", 2)]
    rows = [(k, " ".join(i), "x") for k, i in enumerate(items)] + [(900, None, "x"), (901, "", "x"), (902, "a b", "x"), (903, " ".join(items[7]), "x")]
    return docs, rows


def brute(docs, items):
    by = {}
    for r in docs:
        by.setdefault(r[0], set()).update(shingles(r[1], range(1, 6)))
    out = set()
    for doc, have in by.items():
        for item, text, _ in items:
            want = of_item(text)
            if want and 10 * len(want & have) >= 8 * len(want):
                out.add((doc, item, len(want), len(want & have)))
    return out


def test_pairs_match_brute_force(spark, tables):
    docs, items = tables
    got = d.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    want = brute(docs, items)
    assert {tuple(r)[:4] for r in got} == want
    assert any(n < m for _, _, m, n in want)
    assert all(r.containment == r.n_found / r.n_item for r in got)


def test_short_items(spark):
    docs = [(1, "Well, WHAT is two\tplus two?", 1, "x", 2), (2, "what is two", 1, "x", 2), (3, "plus two what is", 1, "x", 2), (None, "two", 1, "x", 2), (4, None, 1, "x", 2)]
    items = [(1, "What is two plus", "x"), (2, "two", "x"), (3, "is two", "x"), (4, "a b c d e", "x"), (5, " ", "x"), (6, "what is", "x"), (6, "two plus", "x")]
    got = d.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (1, 2), (2, 2), (3, 2), (None, 2), (1, 3), (2, 3), (1, 6)}
    only = spark.createDataFrame(items[:1], ITEMS)
    assert [r.doc_id for r in d.contaminated(spark.createDataFrame(docs, DOCS), only).collect()] == [1]


def test_oracle(spark, tables):
    docs, items = (spark.createDataFrame(t, s) for t, s in zip(tables, (DOCS, ITEMS)))
    docs = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "int64"}))
    con.register("benchmark", items.toPandas())
    assert sorted(con.sql(d.ORACLE).fetchall()) == sorted(map(tuple, d.contaminated(docs, items).collect()))


def test_contaminated_documents_go(spark, tables):
    docs, items = tables
    df = spark.createDataFrame(docs, DOCS)
    clean = d.decontaminate(df, spark.createDataFrame(items, ITEMS))
    assert clean.columns == df.columns
    bad = {x[0] for x in brute(docs, items)}
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted((r for r in docs if r[0] not in bad), key=repr)


def test_rows_go_by_their_own_text(spark):
    """Clean rows stay though a contaminated one shares their id; pieces of an item in several rows are no document."""
    item = [f"w{k}" for k in range(40)]
    held, first, second = "a b " + " ".join(item), " ".join(item[:22]), " ".join(item[18:])
    rows = [(None, held, 1), (None, "clean one two three four five", 1), (None, None, 1), (5, held, 1), (5, "clean six seven eight nine ten", 1)]
    rows += [(6, first, 1), (6, second, 1), (None, first, 1), (None, second, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int")
    items = spark.createDataFrame([(1, " ".join(item), "x")], ITEMS)
    clean = d.decontaminate_rows(df, items)
    assert clean.columns == df.columns
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted((r for r in rows if r[1] != held), key=repr)
    assert d.decontaminate_rows(df, items.limit(0)).count() == len(rows)
    assert d.decontaminate_rows(df.limit(0), items).count() == 0


def test_pipeline_drops_by_row(spark, monkeypatch):
    import corpus_pipeline
    item = " ".join(f"w{k}" for k in range(40))
    monkeypatch.setattr(corpus_pipeline, "read_table", lambda *_: spark.createDataFrame([(1, item, "x")], ITEMS))
    rows = [(None, item), (None, "clean"), (5, item), (5, "clean too")]
    out = corpus_pipeline.decontamination(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.text for r in out.collect()) == ["clean", "clean too"]


@pytest.mark.parametrize("n", range(1, 70))
def test_sketch_is_large_enough(spark, n):
    """A document with the needed shingles can lack fewer than the sketch has."""
    least = -(-8 * n // 10)
    top = 1 << (n - 1).bit_length()
    k = max(top - -(-8 * top // 10) + 1, n - least + 1)
    assert k > n - least


def test_empty_tables(spark, tables):
    docs, items = (spark.createDataFrame(t, s) for t, s in zip(tables, (DOCS, ITEMS)))
    assert d.contaminated(docs, items.limit(0)).count() == 0
    assert d.contaminated(docs.limit(0), items).count() == 0
    assert d.decontaminate(docs, items.limit(0)).count() == docs.count()
