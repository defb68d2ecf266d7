import random
import re
import tracemalloc

import pytest
import xxhash

from eventloom.llm import graph, simhash

SCHEMA = "doc_id long, text string, fp string, component_id long, gone int"


def brute_fingerprint(text, k=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """pairs: (id, fingerprint); the least id reachable over links of four bits or fewer."""
    n = len(pairs)
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if bin(pairs[i][1] ^ pairs[j][1]).count("1") <= 4:
                parent[find(i)] = find(j)
    ids = {}
    for i, (k, _) in enumerate(pairs):
        r = find(i)
        ids[r] = k if ids.get(r) is None else ids[r] if k is None else min(ids[r], k)
    return [ids[find(i)] for i in range(n)]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    word = lambda: rnd.choice(["a", "B", "cé", "D😀", "e"]) + str(rnd.randint(0, 30))
    base = [[word() for _ in range(rnd.randint(1, 150))] for _ in range(120)]
    out = [" ".join(b) for b in base]
    for b in base[:60]:  # near copies: a word changed, twice
        for _ in range(3):
            c = list(b)
            c[rnd.randrange(len(c))] = word()
            out.append("\t".join(c))
    return out + out[:20] + [None, "", " \n", "one", "one two", "ONE two", "a b c d", "x " * 20_000]


@pytest.mark.parametrize("text", [None, "", " ", "a", "a b c", "a b c d", "A b C d e", "é😀 x y z é😀 x y z", "w " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_fingerprint_by_pieces(piece):
    rnd = random.Random(piece)
    for _ in range(200):
        text = "".join(rnd.choice(["a", "Bc", "é", " ", "\n", "  ", "long-word"]) for _ in range(rnd.randint(0, 80)))
        assert simhash.fingerprint(text.encode(), piece=piece) == brute_fingerprint(text)


def test_long_text_is_hashed_in_bounded_memory():
    text = b"some words of a very long text that go on " * 200_000
    tracemalloc.start()
    simhash.fingerprint(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < len(text) + (64 << 20)


def test_hash_is_sparks(spark):
    assert spark.sql("SELECT xxhash64('a b cé d')").first()[0] % (1 << 64) == xxhash.xxh64_intdigest("a b cé d".encode(), 42)


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])  # 2: nearly every bucket goes by midpoints
def test_components_match_brute_force(spark, texts, bucket):
    rows = [(k if k % 29 else None, t, "x", 1, 2) for k, t in enumerate(texts)]
    got = simhash.near_groups(spark.createDataFrame(rows, SCHEMA), bucket=bucket).collect()
    pairs = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = sorted(zip((p[0] for p in pairs), (p[1] for p in pairs), brute_components(pairs)), key=repr)
    assert sorted(((r.id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == want
    assert len({w[2] for w in want}) < len({w[1] for w in want})  # some links are between different fingerprints


def test_crowd_of_near_fingerprints(spark):
    """Chains and balls of close fingerprints, with buckets on both sides of the limit."""
    rnd = random.Random(2)
    fps = set()
    for _ in range(12):
        centre = rnd.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for _ in range(40)}
        for _ in range(15):
            centre ^= sum(1 << b for b in rnd.sample(range(64), 4))
            fps.add(centre)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    ranks = {f: k for k, f in enumerate(fps)}
    want = brute_components([(k, f % (1 << 64)) for k, f in enumerate(fps)])
    for bucket in (1 << 20, 30, 2):
        links = simhash.near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), bucket=bucket)
        got = {r.node: r.component for r in graph.components(links).collect()}
        assert [ranks[got.get(f, f)] for f in fps] == want
        assert all(bin((r.a ^ r.b) % (1 << 64)).count("1") <= 4 for r in links.collect())


def test_pivots_never_discard_a_link():
    import numpy as np
    rnd = np.random.default_rng(3)
    a = rnd.integers(0, 1 << 63, 5000, dtype=np.uint64)
    flips = np.zeros(5000, np.uint64)
    for _ in range(4):
        flips |= np.uint64(1) << rnd.integers(0, 64, 5000, dtype=np.uint64)
    for p in simhash.pivots():
        d = [np.bitwise_count(x ^ np.uint64(p % (1 << 64))).astype(int) for x in (a, a ^ flips)]
        assert np.abs(d[0] - d[1]).max() <= 4


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 400)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5), (9, 7), (7, 9)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 100 for k in range(100, 401)} | {k: 1000 for k in range(1000, 1300)} | {7: 7, 9: 7}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark, texts):
    rows = [(k, t, "x", 1, 2) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:3], SCHEMA)
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    comps = brute_components([(r[0], brute_fingerprint(r[1])) for r in rows])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(comps))


def test_ids_that_are_null_or_repeated_lose_no_text(spark):
    rnd = random.Random(5)
    a, b, c, d, e = (" ".join(f"w{rnd.randint(0, 10_000)}" for _ in range(60)) for _ in range(5))
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c)]  # b and c have null ids alone
    rows += [(7, d), (7, e), (2, e)]  # 7 is the id of d and of a copy of e
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(1, a), (None, b), (None, c), (7, d), (2, e)], key=repr)


def test_one_id_for_all_texts(spark):
    rnd = random.Random(6)
    texts = [" ".join(f"w{rnd.randint(0, 10_000)}" for _ in range(60)) for _ in range(20)]
    for key in (None, 3):
        df = spark.createDataFrame([(key, t, 1) for t in texts * 2], "doc_id long, text string, row int")
        assert sorted(r.text for r in simhash.drop_near_copies(df).collect()) == sorted(texts)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_digest(empty).count() == 0
    assert simhash.drop_near_copies(empty).count() == 0
