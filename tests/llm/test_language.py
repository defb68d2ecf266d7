import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import language

PAGES = "page_id long, url string, html string, host string, p string, text string"
DOCS = "doc_id long, lang string, text string, bucket int"
SYLLABLES = {"en": ["the", "and", "ing", "wh", "er"], "fr": ["eau", "ré", "oi", "le", "que"], "de": ["sch", "ung", "ein", "ü", "keit"]}


def prose(rnd, lang, n):
    return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def documents(spark):
    rnd = random.Random(1)
    rows = [(k, lang, prose(rnd, lang, 60), 1) for k in range(40) for lang in SYLLABLES]
    return spark.createDataFrame(rows + [(None, None, None, 1), (1, "en", None, 1), (2, None, "x", 1)], DOCS)


def pages(rnd):
    out, truth = [], {}
    for k in range(300):
        lang = rnd.choice(list(SYLLABLES))
        host = {"en": "www.a.com", "fr": "b.fr", "de": "x.c.de"}[lang]
        declared = rnd.choice([lang, lang, lang, "en", None])
        attr = f' lang="{declared}-XX"' if declared else ""
        truth[k] = lang
        out.append((k, f"https://{host}/{k}", f"<html{attr}><script>the and</script><body><p>{prose(rnd, lang, rnd.choice([3, 40]))}</p></body></html>", "h", "p", "t"))
    # Nothing to read: the host and the suffix decide.
    for k, host in ((1000, "b.fr"), (1001, "x.c.de"), (1002, "new.c.de")):
        out.append((k, f"http://{host}/", "<html><body>123 456</body></html>", "h", "p", "t"))
    out += [(2000, None, None, None, None, None), (2001, "", "", "h", "p", "t"), (None, "http://b.fr", "<html lang=fr>", "h", "p", "t"), out[5]]
    return out, truth


def test_fused_evidence(spark, documents):
    rows, truth = pages(random.Random(2))
    got = language.language_digest(spark.createDataFrame(rows, PAGES), documents).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    right = sum(by[k].lang == v for k, v in truth.items())
    assert right >= 0.99 * len(truth)
    assert right >= sum(by[k].text_lang == v for k, v in truth.items())
    assert (by[1000].lang, by[1001].lang, by[1002].lang) == ("fr", "de", "de")
    assert all(0 < r.posterior <= 1 for r in got) and by[2000].lang is not None


def test_posterior_matches_plain_arithmetic(spark, documents):
    """The same sums over all pages in plain Python."""
    rows, _ = pages(random.Random(3))
    languages, model = language.fit_text_model(documents)
    assert languages == sorted(SYLLABLES)
    df = spark.createDataFrame(rows, PAGES)
    evidence = language.text_evidence(df, languages, model).collect()
    n = len(languages)

    def softmax(x):
        e = np.exp(np.array(x) - np.max(x))
        return e / e.sum()

    p = [softmax(r.text) for r in evidence]
    total = sum(p)
    overall, mass = (total + 1 / n) / (total.sum() + 1), total + 1

    def sums(by):
        out = {}
        for r, v in zip(evidence, p):
            out[r[by]] = out.get(r[by], 0) + v
        return out

    s = {by: sums(by) for by in ("declared", "suffix", "domain", "host")}
    want = []
    for r, own in zip(evidence, p):
        logs = np.array(r.text)
        for by in ("declared", "suffix"):
            c = s[by][r[by]]
            logs = logs + np.log((c + c.sum() / total.sum()) / mass)
        prior = overall
        for by in ("domain", "host"):
            rest = np.maximum(s[by][r[by]] - own, 0)
            prior = (rest + language.STRENGTH * prior) / (rest.sum() + language.STRENGTH)
        post = softmax(logs + np.log(prior))
        want.append((r.page_id, r.host, languages[int(post.argmax())], round(float(post.max()), 9)))
    got = language.identify(df, languages, model).collect()
    assert sorted(((r.page_id, r.host, r.lang, round(r.posterior, 9)) for r in got), key=repr) == sorted(want, key=repr)


def test_long_text_outweighs_a_large_host(spark):
    """20,000 pages of one language on the host; the other language is only 0.3 nats a trigram apart."""
    from pyspark.sql import functions as F
    model = np.tile(np.array([-0.3, 0.0], np.float32), (language.BUCKETS, 1))
    model[language.trigrams("aaaa " * 3)] = (0.0, -5.0)
    others = spark.range(20_000).select(F.col("id").alias("page_id"), F.lit("http://big.example.com/").alias("url"), F.lit("<p>" + "aaaa " * 10).alias("html"))
    rnd = random.Random(4)
    short, long = ("<p>" + " ".join(rnd.choices(["bcd", "efgh", "ijk"], k=n)) for n in (2, 1_000))
    own = spark.createDataFrame([(-1, "http://big.example.com/", short), (-2, "http://big.example.com/", long)], others.schema)
    got = {r.page_id: r.lang for r in language.identify(others.union(own), ["a", "b"], model).where("page_id < 1").collect()}
    assert got == {0: "a", -1: "a", -2: "b"}  # a few words say less than the host


def test_sample_is_bounded(documents):
    few, _ = language.fit_text_model(documents, sample=5)
    assert set(few) <= set(SYLLABLES)


def test_nothing_to_learn_from(spark, documents):
    rows, _ = pages(random.Random(2))
    df = spark.createDataFrame(rows, PAGES)
    assert all(r.lang is None for r in language.language_digest(df, documents.limit(0)).collect())
    assert language.language_digest(df.limit(0), documents).count() == 0


def test_equal_rows_and_null_ids_are_drawn_like_others(spark, tmp_path):
    rows = [(None, "ein Text der oft steht", "de")] * 4000 + [(k, f"word {k}", "en") for k in range(2000)] + [(k, "mot", f"l{k:03d}") for k in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    languages, model = language.fit_text_model(docs, sample=100)
    assert len(languages) == language.LANGUAGES and {"de", "en"} <= set(languages) and model.shape == (language.BUCKETS, language.LANGUAGES)
    draw = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))
    taken = docs.withColumn("draw", draw).where("lang = 'de'").where(F.col("draw") * 4000 < 100 * (1 << 30)).count()
    assert 50 < taken < 200


@pytest.mark.parametrize("text", ["<" * 4_000_000, "<script " * 500_000, "<html lang" * 400_000, "<!-- " * 800_000, "<a " * 1_000_000 + ">"])
def test_many_tags_take_linear_time(text):
    import time
    began = time.perf_counter()
    language._DROP.sub(" ", text)
    assert time.perf_counter() - began < 3
