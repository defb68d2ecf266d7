import random
import re

import pytest

from eventloom.llm import quality

SCHEMA = "doc_id long, text string, votes string, quality_counts int, p_good double"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def texts():
    rnd = random.Random(9)
    out = [None, "", " \n\t", "a", "a a a a", "a b c a b c a b c", "x y z\nx y z\n\n \nx y z", "é😀 ##|"]
    for _ in range(60):
        words = [rnd.choice(["a", "b", "c", "dé", "x#", "|", "\n", " ", "\x0b"]) for _ in range(rnd.randint(0, 60))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("text", texts())
def test_counts_match_brute_force(text):
    assert quality.counts_of(text)[:5] == brute(text)


def corpus(n=300):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 8)))
    out = []
    for k in range(n):
        prose = [word() for _ in range(rnd.randint(60, 200))]
        kind = k % 10
        if kind == 0:
            prose = [w + rnd.choice(["###", "$$$", "&&&"]) for w in prose]
        elif kind == 1:
            prose = [x for w in prose for x in (w, "|")]
        elif kind == 2:
            prose = [w.upper() + "!!" for w in prose]
        elif kind == 3:
            prose = prose[:1] * 120
        elif kind == 4:
            prose = prose[:20]
        out.append((k, " ".join(prose), "clash", 1, 0.5))
    return out


def test_junk_goes_and_prose_stays(spark):
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(corpus(), SCHEMA).select("doc_id", "text")).collect()}
    assert len(got) == 300
    for k, r in got.items():
        assert r.kept == (k % 10 > 4), (k, r)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_filter_agrees_with_verdicts_and_keeps_columns(spark):
    df = spark.createDataFrame(corpus() + [(None, None, None, None, None), (7, "", "", 0, 0.0)], SCHEMA)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.schema == df.schema
    want = {r.doc_id for r in quality.judge(df).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want
    assert all(r.votes == "clash" for r in kept.collect())


def test_em_learns_which_rule_errs():
    names = list(quality.RULES)
    vote = lambda **v: "".join(v.get(n, "0") for n in names)
    patterns = {vote(prose="+"): 800, vote(prose="-", symbols="-"): 90, vote(prose="-", symbols="-", bare_marks="-"): 60, vote(prose="+", variety="-"): 50}
    posterior, share, accuracy = quality.fit(patterns)
    assert accuracy["symbols"] > 0.9 > accuracy["variety"]
    assert 0.8 < share < 0.9
    assert posterior[vote(prose="+", variety="-")] > 0.5 > posterior[vote(prose="-", symbols="-")]


def plain_verdicts(rows):
    """p_good of each document: the same model, summed over documents and rules one by one."""
    rules, n = list(quality.RULES.values()), len(rows)
    held = max(10.0, quality.HELD * n)
    held_of = {True: held * quality.GOOD_SHARE, False: held * (1 - quality.GOOD_SHARE)}
    right = {True: [r[3][0] for r in rules], False: [r[3][1] for r in rules]}
    share, before = quality.GOOD_SHARE, None
    while True:
        p = []
        for pattern in rows:
            like = {True: share, False: 1 - share}
            for k, vote in enumerate(pattern):
                for good in (True, False):
                    if vote != "0":
                        like[good] *= right[good][k] if (vote == "+") == good else 1 - right[good][k]
            p.append(like[True] / (like[True] + like[False]))
        if before and max(abs(a - b) for a, b in zip(p, before)) < 1e-9:
            return p
        before = p
        weight = {True: p, False: [1 - x for x in p]}
        for good in (True, False):
            for k, rule in enumerate(rules):
                voted = [(w, pattern[k]) for w, pattern in zip(weight[good], rows) if pattern[k] != "0"]
                hits = sum(w for w, vote in voted if (vote == "+") == good) + held_of[good] * rule[3][0 if good else 1]
                right[good][k] = hits / (sum(w for w, _ in voted) + held_of[good])
        share = (sum(p) + held_of[True]) / (n + held)


def plain_votes(text):
    words = text.split(" ")
    n, lines = len(words), text.split("\n")
    plain = sum(w.isalpha() or (w[-1] in ".,;:?" and w[:-1].isalpha()) for w in words)
    measures = {
        "prose": plain / n, "symbols": sum(c in "#*$%&|<>" for c in text) / n, "repetition": brute(text)[4] / n,
        "duplicate_lines": brute(text)[3] / len(lines), "capitals": sum(len(w) > 1 and w.isupper() for w in words) / n,
        "shouting": sum(w[-1] in "!?" for w in words) / n, "bare_marks": sum(not (w[0].isalnum() or w[-1].isalnum()) for w in words) / n,
        "variety": len(set(words)) / n**0.5, "word_length": abs(sum(map(len, words)) / n - 6),
    }
    test = {"<": float.__lt__, ">": float.__gt__, "<=": float.__le__, ">=": float.__ge__}
    out = ""
    for name, (_, bad, good, _) in quality.RULES.items():
        hit = [test[limit.split()[0]](float(measures[name]), float(limit.split()[1])) for limit in (bad, good)]
        out += "-" if hit[0] else "+" if hit[1] else "0"
    return out


def test_verdicts_match_plain_expectation_maximisation(spark):
    rows = [(k, text) for k, text, *_ in corpus(200)]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    patterns = [plain_votes(text) for _, text in rows]
    assert [got[k].votes for k, _ in rows] == patterns
    for (k, _), p in zip(rows, plain_verdicts(patterns)):
        assert got[k].p_good == pytest.approx(p, abs=1e-6)
        assert got[k].kept == (not got[k].base_failed and p >= quality.KEEP_FROM)


def test_one_bad_vote_rejects_only_where_nothing_speaks_for_the_text():
    names = list(quality.RULES)
    clean, odd = "+" * 9, []
    for k in range(9):
        for prose in "0+":
            odd.append("".join("-" if j == k else prose if j == 0 else "+" for j in range(9)))
    posterior = quality.fit({clean: 1000, **{p: 3 for p in odd}})[0]
    assert all(posterior[p] > 0.5 for p in odd)
    few = {"".join("-" if n in {"prose", fault} else "+" for n in names): 1 for fault in names[1:]}
    for pattern in few:
        assert quality.fit({pattern: 1})[0][pattern] < 0.5
        assert quality.fit({clean: 500, pattern: 30})[0][pattern] < 0.5
    assert quality.fit({"000000000": 1})[0]["000000000"] > 0.5  # all abstain


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.judge(empty).count() == 0
    assert quality.keep_good(empty).count() == 0
