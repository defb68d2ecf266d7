import random
import re

import pytest

from eventloom.llm import licenses

SCHEMA = "doc_id long, text string, row string, words string, start int"


def words_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def brute(text):
    """Base result, and labels and best containment over every block, by comparing all blocks with all templates."""
    w = words_of(text)
    places = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
    blocks = []
    paragraph = []
    for line in [*(text or "").split("\n"), ""]:
        lw = words_of(line)
        if lw:
            paragraph += lw
        elif not line.strip():
            blocks += [(True, paragraph[a : a + 64]) for a in range(0, max(1, len(paragraph) - 32), 32)]
            blocks += [(False, paragraph[a : a + 400]) for a in range(0, max(1, len(paragraph) - 200), 200)]
            paragraph = []
    labels, best = set(), 0.0
    for label, template in licenses.TEMPLATES:
        t = set(words_of(template))
        for short, b in blocks:
            named = t & {"apache", "commons", "creative", "gnu", "mit", "nc", "redistribution"} <= set(b)
            if short == (len(t) <= 16) and 10 * len(t & set(b)) >= 8 * len(t) and named:
                labels.add(label)
                best = max(best, len(t & set(b)) / len(t))
    base = sorted({x for _, x in places})
    starts = [k for k, _ in places]
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted(labels | set(base))), 1.0 if starts else best


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(8)
    notices = [t for _, t in licenses.TEMPLATES] + ["All rights reserved.", "cc-by", "CC BY 4.0", "GENERAL PUBLIC LICENSE", "all rights all rights reserved"]
    fill = ["the", "of", "é", "license", "software", "x1", "Version", "2", "0", "under"]
    out = []
    for _ in range(250):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            if rnd.random() < 0.4:
                w = re.split(r"[ ]", rnd.choice(notices))
                w = [x for x in w if rnd.random() > rnd.choice([0, 0, 0.1, 0.3])]
                if rnd.random() < 0.5 and len(w) > 3:  # over several lines
                    w[len(w) // 2] = "\n" + w[len(w) // 2]
                lines.append(" ".join(w))
            else:
                lines.append(" ".join(rnd.choices(fill, k=rnd.randint(0, 90))))
        out.append(rnd.choice(["\n", "\n\n", "\n \n"]).join(lines))
    return out + [None, "", "\n\n", out[0], "ÀLL rights", " ".join(["filler"] * 3000 + [notices[-1]])]


def test_matches_brute_force(spark, texts):
    rows = [(k if k % 31 else None, t, "x", "y", 1) for k, t in enumerate(texts)]
    got = licenses.license_digest(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [(r[0], *brute(r[1])) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {"mit", "apache-2.0", "gpl", "bsd", "cc-by"} <= {x for r in got for x in r.labels.split(",")}


def test_oracle(texts):
    import duckdb
    import pandas as pd
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    assert sorted(con.sql(licenses.ORACLE).fetchall()) == sorted((k, *brute(t)) for k, t in enumerate(texts))


def test_blocks_carry_places(spark):
    text = "one two\n\nReleased under the MIT License"
    _, found = licenses.scan(spark.createDataFrame([(1, text, "", "", 1)], SCHEMA))
    assert [(r.start, r.label, r.containment) for r in found.collect()] == [(2, "mit", 1.0)]


def test_empty_table(spark):
    assert licenses.license_digest(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("text, labels", [
    ("# This work is licensed under a Creative\n# Commons Attribution 4.0 International License", "cc-by"),
    ("Released under\nthe MIT License", "mit"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc"),
    ("Licensed under the Mozilla Public License, Version 2.0", ""),
    ("The songs were released under the license of a small label.", ""),
    ("Released under the\n\nMIT License", ""),  # two paragraphs
])
def test_wrapped_notices_and_other_licenses(spark, text, labels):
    import duckdb
    import pandas as pd
    assert licenses.license_digest(spark.createDataFrame([(1, text, "", "", 1)], SCHEMA)).first().labels == labels
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": [1], "text": [text]}))
    assert con.sql(f"SELECT labels FROM ({licenses.ORACLE})").fetchall() == [(labels,)]
