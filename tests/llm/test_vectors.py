import hashlib
import random

import numpy as np
import pytest

from eventloom.llm import anchors, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long"


def brute(rows, parts=4, entries=256, rounds=4):
    """Sorted (id, code, error) and the books, by plain loops over Python integers."""
    fine = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if v and all(x is not None and abs(x) <= 2**43 for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not fine:
        return [], []
    width = len(fine[0][1])
    fine = [r for r in fine if len(r[1]) == width]
    step = width // parts
    cut = [[[int(np.floor(x * 1024)) for x in v[p * step : (p + 1) * step]] for p in range(parts)] for _, v in fine]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for c in cut:
                of.setdefault(nearest(p, c[p])[0], []).append(c[p])
            for e, members in of.items():
                books[p][e] = [sum(col) // len(members) for col in zip(*members)]
    out = []
    for (i, _), c in zip(fine, cut):
        got = [nearest(p, c[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in got), min(sum(d for _, d in got), 2**63 - 1)))
    return sorted(out, key=str), books


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, None, "x", 0) for i, v in rows], SCHEMA).repartition(3)
    codes, books = vectors.compress(df, **kw)
    got = sorted(((r.vec_id, r.code, r.error) for r in codes.collect()), key=str)
    want, want_books = brute(rows, **kw)
    assert got == want
    assert [[[int(x) for x in e] for e in b] for b in books] == want_books
    return books


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(k if k % 9 else None, [rng.gauss((k % 3) * 0.4, 0.2) for _ in range(8)]) for k in range(400)]
    rows += rows[:40] + [(500 + k, [0.25] * 8) for k in range(200)]  # repeated rows, equal vectors
    books = check(spark, rows, entries=20)
    assert vectors.books_digest(books) == hashlib.sha256(",".join(str(x) for b in brute(rows, entries=20)[1] for e in b for x in e).encode()).hexdigest()


def test_ties_go_to_the_lower_entry(spark):
    check(spark, [(0, [0.0] * 4), (1, [2.0] * 4), (2, [1.0] * 4), (3, [0.0] * 4), (4, [1.0] * 4)], entries=2, rounds=1)
    check(spark, [(k, [float(k % 4)] * 4) for k in range(64)], entries=16)


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    check(spark, [(k, [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(12) for _ in range(4)]) for k in range(60)], entries=7)
    check(spark, [(k, [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(7) for _ in range(8)]) for k in range(60)], entries=7)
    check(spark, [(0, [2.0**43] * 4), (1, [-(2.0**43)] * 4), (2, [1e30] * 4)], entries=1)  # errors beyond a long


def test_rows_that_are_dropped(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [1.0, None, 1.0, 1.0]), (3, [nan] * 4), (4, [inf, 0.0, 0.0, 0.0]), (5, []), (6, [1.0] * 4), (7, [2.0] * 8), (8, [-inf] * 4), (None, [3.0] * 4)]
    df = spark.createDataFrame([(i, v, None, "x", 0) for i, v in rows], SCHEMA)
    assert sorted(map(str, (r.vec_id for r in vectors.code_digest(df).collect()))) == ["6", "None"]
    none = vectors.code_digest(df.limit(0))
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError):
        vectors.compress(spark.createDataFrame([(1, [1.0] * 6, 1, "x", 0)], SCHEMA))


def test_label_errors(spark):
    rng = random.Random(3)
    rows = [(k, [rng.random() for _ in range(4)], rng.choice([None, 1, 2]), "x", 0) for k in range(400)]
    got = vectors.code_digest(spark.createDataFrame(rows, SCHEMA)).collect()
    label = {r[0]: r[2] for r in rows}
    sums = {}
    for r in got:
        sums[label[r.vec_id]] = sums.get(label[r.vec_id], 0) + r.error
    assert len(got) == 400 and all(r.label_error == sums[label[r.vec_id]] for r in got)


@pytest.mark.parametrize("kind", [np.float64, object])
def test_tree_covers_all_points_with_right_caches(kind):
    rng = np.random.default_rng(4)
    points = np.concatenate([np.floor(rng.normal(c, 30, (300, 5))) for c in (0, 200, 900)] + [np.zeros((100, 5))]).astype(kind)
    tree = anchors.build(points)
    assert sorted(tree.order) == list(range(len(points))) and (points[tree.order] == tree.points).all()
    for k in range(len(tree.start)):
        mine = tree.points[tree.start[k] : tree.end[k]]
        assert (mine.sum(axis=0) == tree.sums[k]).all()
        assert np.sqrt(((mine.astype(float) - tree.pivot[k]) ** 2).sum(axis=1)).max() <= tree.radius[k] * (1 + 1e-9)
        inner = range(tree.first[k], tree.last[k])
        assert not inner or sorted((tree.start[c], tree.end[c]) for c in inner)[0][0] == tree.start[k]
        assert not inner or sum(tree.end[c] - tree.start[c] for c in inner) == tree.end[k] - tree.start[k]
    entries = points[:: len(points) // 16]
    got = np.full(len(points), -1)
    for node, entry in anchors.owners(tree, entries):
        got[tree.order[tree.start[node] : tree.end[node]]] = entry
    assert (got == anchors.squared(points, entries).argmin(axis=1)).all()


def test_balls_far_from_other_entries_are_owned_whole():
    rng = np.random.default_rng(5)
    points = np.concatenate([np.floor(rng.normal(c, 5, (500, 4))) for c in (0, 1000, 5000)])
    owned = anchors.owners(anchors.build(points), points[[0, 500, 1000]])
    assert len(owned) <= 6 and all(len(e) == 1 for _, e in owned)
