import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from eventloom.llm import perplexity as p

DOCS = "doc_id long, text string, lang string, n long, batch string, gram string"
LABELS = "doc_id long, quality int, toxic int, n string"


class Brute:
    """The same model by plain recursion over dictionaries."""

    def __init__(self, texts):
        grams = Counter()
        for t in texts:
            for w in re.findall(r"[^\x20\x09-\x0D]+", t or ""):
                padded = "\x02" * 3 + w + "\x03"
                grams.update(padded[k : k + 4] for k in range(len(padded) - 3))
        self.levels = {4: grams}
        for k in (3, 2, 1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.d, self.total, self.held = {}, {}, {}
        for k, level in self.levels.items():
            n = Counter(level.values())
            self.d[k] = p.discounts([n[1], n[2], n[3], n[4]])
            self.total[k], self.held[k] = Counter(), defaultdict(float)
            for g, c in level.items():
                self.total[k][g[:-1]] += c
                self.held[k][g[:-1]] += self.d[k][min(c, 3) - 1]

    def prob(self, g):
        k = len(g)
        if k == 0:
            return 1 / (len(self.levels[1]) + 1)
        context = g[:-1]
        if not self.total[k][context]:
            return self.prob(g[1:])
        c = self.levels[k][g]
        own = (c - self.d[k][min(c, 3) - 1]) / self.total[k][context] if c else 0
        return own + self.held[k][context] / self.total[k][context] * self.prob(g[1:])

    def perplexity(self, text):
        total, n = 0.0, 0
        for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
            padded = "\x02" * 3 + w + "\x03"
            total += sum(math.log(self.prob(padded[k : k + 4])) for k in range(len(padded) - 3))
            n += len(w) + 1
        return math.exp(-total / n) if n else None


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(6)
    syllables = {"en": ["the", "an", "ing", "er", "on"], "fr": ["eau", "ré", "le", "oi", "çon"], None: ["ka", "to", "mi"]}
    docs, labels = [], []
    for k in range(400):
        lang = rnd.choice(["en", "en", "fr", "fr", None])
        words = ["".join(rnd.choices(syllables[lang], k=rnd.randint(1, 4))) for _ in range(rnd.randint(1, 60))]
        junk = k % 8 == 0
        if junk:
            words = [w + rnd.choice(["###", "$$", "|%&"]) for w in words]
        docs.append((k if k % 97 else None, " ".join(words), lang, 1, "x", "y"))
        if k % 2 == 0 and k % 97:
            labels.append((k, 0 if junk else 1, 1 if k % 30 == 2 else 0, "x"))
    docs += [(1000, None, "en", 1, "x", "y"), (1001, "", "en", 1, "x", "y"), (1002, "😀 unseen ✓", "fr", 1, "x", "y"), docs[3]]
    labels += [(None, 1, 0, "x"), (6, None, 0, "x"), (10, 1, 0, "x"), (10, 0, 0, "x")]
    return docs, labels


def test_perplexities_match_plain_recursion(spark, corpus, monkeypatch):
    monkeypatch.setattr(p, "BATCH_BYTES", 4_000)  # several batches
    docs, labels = corpus
    good = defaultdict(lambda: True)
    for i, q, t, _ in labels:
        good[i] &= q == 1 and t == 0
    trusted = {i for i, v in good.items() if v and i is not None}
    assert 6 not in trusted and 10 not in trusted
    model = Brute([d[1] for d in docs if d[0] in trusted])
    d = spark.createDataFrame(docs, DOCS)
    got = p.perplexities(d, p.trusted_ids(spark.createDataFrame(labels, LABELS))).collect()
    assert len(got) == len(docs)
    want = sorted(((r[0], model.perplexity(r[1])) for r in docs), key=repr)
    have = sorted(((r.id, r.perplexity) for r in got), key=repr)
    for (i, a), (j, b) in zip(sorted(want, key=lambda x: (str(x[0]), x[1] or 0)), sorted(have, key=lambda x: (str(x[0]), x[1] or 0))):
        assert i == j and (a is None) == (b is None)
        assert a is None or b == pytest.approx(a, rel=1e-9)


def test_probabilities_sum_to_one(corpus):
    docs, _ = corpus
    model = Brute([d[1] for d in docs[:100]])
    for context in list(model.total[4])[:20]:
        seen = sum(model.prob(context + c) for c in model.levels[1])
        assert seen == pytest.approx(1 - model.prob(context + "\x07"), rel=1e-9)


def test_junk_goes_and_clean_stays(spark, corpus, monkeypatch):
    monkeypatch.setattr(p, "LEAST_TRUSTED", 20)
    docs, labels = corpus
    got = p.classify(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got}
    junk = [r for i, r in by.items() if i is not None and i < 400 and i % 8 == 0]
    clean = [r for i, r in by.items() if i is not None and i < 400 and i % 8]
    assert sum(r.kept for r in junk) <= 0.05 * len(junk)
    assert sum(r.kept for r in clean) >= 0.97 * len(clean)
    assert not by[1000].kept and by[1000].perplexity is None and not by[1001].kept
    assert len({r.threshold for r in got if r.lang == "en"}) == 1 and by[1].threshold is not None


def test_without_trusted_documents_or_rows(spark, corpus):
    docs, labels = (spark.createDataFrame(t, s) for t, s in zip(corpus, (DOCS, LABELS)))
    got = p.classify(docs, labels.limit(0)).collect()
    assert all(r.perplexity is None and r.threshold is None for r in got)
    assert sum(not r.kept for r in got) == 2  # those without words
    assert p.classify(docs.limit(0), labels).count() == 0


def test_equal_rows_and_null_ids_are_dealt_over_batches(spark, monkeypatch, tmp_path):
    """A third of the rows are one row with a null id: no batch holds more than its share of them."""
    monkeypatch.setattr(p, "BATCH_BYTES", 10_000)
    rows = [(None, "the same words again and again " * 3, "en")] * 1000 + [(k, f"word{k} and others {k % 7} here", "en") for k in range(2000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    got = p.perplexities(docs, spark.createDataFrame([(k,) for k in range(0, 2000, 3)], "trusted_id long"))
    assert got.count() == 3000 and got.where("id IS NULL").select("perplexity").distinct().count() == 1
    per = [r["count"] for r in docs.where("doc_id IS NULL").groupBy(p.batch_number(15).alias("b")).count().collect()]
    assert len(per) == 15 and max(per) < 2 * 1000 / 15


def test_one_very_long_text(spark):
    """Long words and a long text, beside short ones."""
    rows = [(1, "x" * 200_000 + " " + "word " * 200_000, "en"), (2, "word", "en"), (3, None, "en"), (4, "\t\n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.id: r for r in p.perplexities(docs, spark.createDataFrame([(2,)], "trusted_id long")).collect()}
    assert got[1].n == 200_001 + 5 * 200_000 and got[1].perplexity > got[2].perplexity > 0
    assert got[3].perplexity is None and got[4].perplexity is None


@pytest.mark.parametrize("words", [[], ["a"], ["ab", "日本語", "a", "\x02\x03", "\U0001f600x\U0001f601"], ["".join(map(chr, range(0x4E00, 0x9000)))], ["".join(map(chr, [*range(33, 0xD800), *range(0xE000, 0x20000)]))]])
def test_packed_sequences(words):
    of_word, number, found = p.grams(pa.array(words, pa.large_string()))
    assert [(int(w), found[int(g)]) for w, g in zip(of_word, number)] == [(k, g) for k, w in enumerate(words) for g in p.sequences(w)]
    assert len(set(found)) == len(found)
