import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm import divergence, terms as cutting, transducer

SCHEMA = "doc_id long, text string, lang string, source string, term string, ord long, value long"


def brute(rows, least, top):
    """Sorted (lang, source, part, item, value, rank) of (text, lang, source) rows, by plain loops."""
    docs = defaultdict(Counter)
    counts, groups = defaultdict(Counter), defaultdict(set)
    cut = []
    for text, lang, source in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower)
        cut.append((terms, lang or "", source or ""))
        docs[lang or ""].update(set(terms))
        groups[lang or ""].add(source or "")
    kept = {lang: sorted((t for t, n in c.items() if n >= least), key=lambda t: t.encode()) for lang, c in docs.items()}
    for terms, lang, source in cut:
        counts[lang, source].update(t for t in terms if t in set(kept[lang]))
    out = []
    for lang, sources in groups.items():
        vocab = kept[lang]

        def shares(c):
            total = sum(c.values()) + 5 * len(vocab)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in vocab}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in vocab), o.encode(), o) for o in sources if o != s))
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)]
            terms = sorted(((q[t] - p[s][t], t.encode(), t) for t in vocab if counts[lang, s][t] and p[s][t] > q[t]))
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(terms[:top])]
    return sorted(out)


def check(spark, rows, least=3, top=5):
    df = spark.createDataFrame([(None, t, la, s, "x", 1, 2) for t, la, s in rows], SCHEMA).repartition(3)
    got = sorted(map(tuple, divergence.audit(df, least, top).collect()))
    assert got == brute(rows, least, top)
    return got


WORDS = ["a", "ab", "abc", "B", "Émile", "émile", "日本", "日本語", "zz", "x1y", "Ä", "o'neil", "\U0001f600", "aa", "b"]


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice([" ", "\n", "-", "7"]).join(rng.choices(WORDS, k=rng.randrange(20))), rng.choice(["en", "de", None, ""]), rng.choice(["s", "t", "ü", None, "Z"])) for _ in range(300)]
    rows += [(None, "en", "s"), ("", "xx", None), ("", "xx", "only"), ("once", "yy", "alone"), (None, None, None)] + rows[:30]
    got = check(spark, rows)
    assert ("xx", "only", "pair", "", 0, 1) in got


def test_many_sources_and_terms_cross_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "BLOCK", 4)
    monkeypatch.setattr(divergence, "_tile_distances", _own_sizes(3, 4))
    rng = random.Random(2)
    rows = [(" ".join(rng.choices(WORDS, k=8)), rng.choice(["en", "de"]), f"s{rng.randrange(8)}") for _ in range(200)]
    check(spark, rows, least=2)


def _own_sizes(tile, block):
    plain = divergence._tile_distances

    def run(key, table):  # tasks import the module anew
        divergence.TILE, divergence.BLOCK = tile, block
        return plain(key, table)

    return run


def test_shards_and_rounds_give_the_same_ordinals(spark):
    rng = random.Random(3)
    terms = sorted({"".join(rng.choices("abé日", k=rng.randrange(1, 7))).encode() for _ in range(500)})
    kept = spark.createDataFrame([(la, bytearray(t)) for la in ("a", "b") for t in terms], "lang string, term binary")
    vocab = divergence.vocabulary(kept, shard_terms=50, broadcast_bytes=5_000)
    assert vocab.count() >= 2 * len(terms) // 50 and vocab.agg({"round": "max"}).first()[0] > 1
    got = divergence.ordinals(kept, vocab).collect()
    assert sorted((r.lang, r.item, r.ord) for r in got) == sorted((la, t.decode(), k) for la in ("a", "b") for k, t in enumerate(terms))


def test_empty_and_long(spark):
    none = divergence.audit(spark.createDataFrame([], SCHEMA))
    assert none.columns == ["lang", "source", "part", "item", "value", "rank"] and none.count() == 0
    long_ = ["word " * 300_000 + "x" * 50_000, "y" * 100_000]
    check(spark, [(t, "en", s) for t in long_ for s in ("a", "b", "a")], least=3)
    check(spark, [("Aa bb", "en", "a"), ("bb", "en", "b")], least=3)  # nothing is kept


def test_cut_keeps_rows_apart(monkeypatch):
    texts = pa.array(["ab", "cd", None, "", "1", "AB é", "\n", "é"])
    rows, codes, terms = cutting.cut(texts, cutting.LETTERS, cutting.LOWER)
    assert [(int(r), terms[int(c)].as_py().decode()) for r, c in zip(rows, codes)] == [(0, "ab"), (1, "cd"), (5, "ab"), (5, "é"), (7, "é")]
    assert [cutting.cut(texts.slice(k, 2), cutting.LETTERS)[0].tolist() for k in (1, 2, 5)] == [[0], [], [0, 0]]
    assert cutting.cut(pa.array([], pa.string()), cutting.LETTERS)[0].tolist() == []
    monkeypatch.setattr(cutting, "PIECE", 3)
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    assert sum((p.column("text").to_pylist() for p in cutting.pieces(batch)), []) == texts.to_pylist()
    chunked = pa.chunked_array([texts, texts.slice(5)])
    rows, codes, terms = cutting.cut(chunked, cutting.BLACK)
    assert [(int(r), terms[int(c)].as_py().decode()) for r, c in zip(rows, codes)] == [(0, "ab"), (1, "cd"), (4, "1"), (5, "AB"), (5, "é"), (7, "é"), (8, "AB"), (8, "é"), (10, "é")]


@pytest.mark.parametrize("seed", range(5))
def test_transducer_is_minimal_and_ordered(seed):
    rng = random.Random(seed)
    terms = sorted({bytes(rng.choices(b"ab\xff", k=rng.randrange(0, 6))) for _ in range(rng.randrange(1, 120))})
    t = transducer.Transducer.from_bytes(*transducer.build(terms).to_bytes())
    asked = terms + [b"c", b"abab" * 5, b"\x00"]
    starts = np.cumsum([0, *map(len, asked)])[:-1]
    data = np.frombuffer(b"".join(asked), np.uint8)
    got = t.ordinals(data, starts, np.array(list(map(len, asked)))).tolist()
    places = {x: k for k, x in enumerate(terms)}
    assert got == [places.get(x, -1) for x in asked]
    # Minimal: as many states as there are different sets of endings.
    heads = {x[:k] for x in terms for k in range(len(x) + 1)}
    endings = {frozenset(x[len(h) :] for x in terms if x.startswith(h)) for h in heads}
    assert len(t.finals) == len(endings)


def test_transducer_wants_order():
    for terms in ([b"b", b"a"], [b"a", b"a"]):
        with pytest.raises(ValueError):
            transducer.build(terms)
    assert transducer.build([]).ordinals(np.zeros(2, np.uint8), np.array([0]), np.array([1])).tolist() == [-1]
