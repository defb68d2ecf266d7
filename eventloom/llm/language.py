"""Language ID by Bayesian evidence fusion.

For each page the log odds of its languages add up from

* its text: trigram likelihoods of a naive Bayes model, of which the
  first ``TEXT_WEIGHT`` count in full and all together as the square root of their number
  (neighbouring trigrams are not independent, but a long text outweighs the host's others);
* the declared markup language: how pages of each language declare it;
* the address suffix (the last label of the host): how often pages of each language have it;
* its host: the languages of the host's other pages, smoothed towards those of its domain's,
  which are smoothed towards those of all pages.

The last three are grouped aggregates over all pages, in which a page counts by its text's
posterior; a page's own share is taken out of its host's and its domain's counts. The text
model is fitted on a bounded sample of documents with a known language (about
``SAMPLE`` documents of each, by a hash of their ids) into ``BUCKETS`` hashed trigrams.

Defined cases: null and empty html have no trigrams and only the other evidence; a null url
belongs to the host ''; an undeclared language is a value like others; repeated pages count
each; with no documents to learn from every language is null; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import small_side, stored
from eventloom.llm.html import host_of

SAMPLE = 2_000
BUCKETS = 1 << 16
TEXT_WEIGHT = 20.0
#: The languages of most documents that are told apart; the model has 256 KB for each.
LANGUAGES = 200
#: Pages that a domain's languages count for in its hosts, and all pages' in a domain.
STRENGTH = 5.0
#: Hosts and domains of up to so many are broadcast; more are shuffled.
HOSTS = 100_000

# No tag goes past the next "<", so a text of many of them takes linear time.
_DROP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|title|noscript|textarea)\b[^<>]*>.*?(?:</\1|\Z)|<[^<>]*>", re.S | re.I)
_DECLARED = r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-z]{2,3})"


def trigrams(text: str) -> np.ndarray:
    """The hashed trigrams of the letters of a text, runs of other characters being one space."""
    letters = re.sub(r"[\W\d_]+", " ", f" {text.lower()} ")
    codes = np.frombuffer(letters.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (codes[2:] * np.uint64(0x165667B19E3779F9))
    return ((mixed * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(48)).astype(np.int64) % BUCKETS


def fit_text_model(documents: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities [bucket, language], from about ``sample`` documents of each,
    drawn by their row numbers (``documents`` is a scan or a stored table): equal rows and null ids are drawn like any others.
    Of more than ``LANGUAGES`` languages those with the most documents are taken.

    What comes to the driver is a count for each language and bucket.
    """
    draw = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))
    known = documents.select("lang", "text", draw.alias("draw")).where(F.col("lang").isNotNull())
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    chosen = known.join(F.broadcast(sizes), "lang").where(F.col("draw").cast("double") * F.col("n") < float(sample << 30)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                seen = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                seen += np.bincount(trigrams(text or ""), minlength=BUCKETS)
        for lang, seen in total.items():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(seen[at])], names=["lang", "bucket", "n"])

    counts = chosen.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    arrays: dict[str, np.ndarray] = {}
    for row in counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("c")).toLocalIterator():
        own = arrays.setdefault(row["lang"], np.zeros(BUCKETS))
        for bucket, n in row["c"]:
            own[bucket] = n
    languages = sorted(arrays)
    if not languages:
        return [], np.zeros((BUCKETS, 0))
    smooth = np.stack([arrays[x] + 0.1 for x in languages], axis=1)
    return languages, np.log(smooth / smooth.sum(axis=0)).astype(np.float32)


def weight(n: int) -> float:
    """The number of independent trigrams that the n trigrams of a text count for."""
    return float(n) if n <= TEXT_WEIGHT else (TEXT_WEIGHT * n) ** 0.5


def text_evidence(pages: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """page_id, host, domain, suffix, declared, text (tempered log likelihood of each language) of every row."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages x 4 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for source in b.column("html").to_pylist():
                at = trigrams(entities.unescape(_DROP.sub(" ", source or "")))
                like = shared.value[at].sum(axis=0, dtype=np.float64) if len(at) else np.zeros(len(languages))
                out.append((like * (weight(len(at)) / max(len(at), 1))).tolist())
            kept = [c for c in b.schema.names if c != "html"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(out, pa.list_(pa.float64()))], names=[*kept, "text"])

    host = host_of(F.col("url"))
    read = pages.select(
        "page_id", host.alias("host"), F.substring_index(host, ".", -2).alias("domain"), F.substring_index(host, ".", -1).alias("suffix"),
        F.coalesce(F.lower(F.nullif(F.regexp_extract("html", _DECLARED, 1), F.lit(""))), F.lit("")).alias("declared"), "html")
    return read.mapInArrow(run, f"page_id {dict(pages.dtypes)['page_id']}, host string, domain string, suffix string, declared string, text array<double>")


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def _sums(rows: DataFrame, by: list[str], n: int, name: str) -> DataFrame:
    """The posterior counts of each language by the given columns, as one array."""
    return rows.groupBy(*by).agg(F.array(*[F.sum(F.get("p", F.lit(k))) for k in range(n)]).alias(name))


def _array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def identify(pages: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """page_id, host, declared, text_lang, lang, posterior of every row."""
    n = len(languages)
    rows = text_evidence(pages, languages, model)
    if not n:
        return rows.select("page_id", "host", "declared", *[F.lit(None).cast("string").alias(c) for c in ("text_lang", "lang")], F.lit(None).cast("double").alias("posterior"))
    rows = stored(rows.withColumn("p", _softmax(F.col("text"))), "evidence")
    everywhere = rows.agg(*[F.coalesce(F.sum(F.get("p", F.lit(k))), F.lit(0.0)) for k in range(n)]).first()
    total = sum(everywhere)
    overall = [(v + 1.0 / n) / (total + 1.0) for v in everywhere]
    mass = [v + 1.0 for v in everywhere]

    joined = rows
    for by in ("declared", "suffix"):
        # P(value | language), with a pseudo-page spread over the values as all pages are.
        sums = stored(_sums(rows, [by], n, f"{by}_sum"), by)
        share = F.aggregate(F.col(f"{by}_sum"), F.lit(0.0), lambda a, b: a + b) / F.lit(total or 1.0)
        logs = F.zip_with(F.col(f"{by}_sum"), _array(mass), lambda s, m: F.struct(s.alias("s"), m.alias("m")))
        sums = sums.select(by, F.transform(logs, lambda x: F.log((x["s"] + share) / x["m"])).alias(f"{by}_log"))
        joined = joined.join(small_side(sums, HOSTS), by)
    domains = stored(_sums(rows, ["domain"], n, "domain_sum"), "domains")
    hosts = stored(_sums(rows, ["host"], n, "host_sum"), "hosts")
    joined = joined.join(small_side(domains, HOSTS), "domain").join(small_side(hosts, HOSTS), "host")

    def smoothed(sums: str, towards: Column) -> Column:
        """The counts without the page's own, smoothed by STRENGTH pages of the level above."""
        rest = F.zip_with(F.col(sums), F.col("p"), lambda s, p: F.greatest(s - p, F.lit(0.0)))
        size = F.aggregate(rest, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(rest, towards, lambda r, t: (r + STRENGTH * t) / (size + STRENGTH))

    joined = joined.withColumn("domain_prior", smoothed("domain_sum", _array(overall)))
    joined = joined.withColumn("prior", smoothed("host_sum", F.col("domain_prior")))
    fused = F.transform("text", lambda x, i: x + F.get("declared_log", i) + F.get("suffix_log", i) + F.log(F.get("prior", i)))
    joined = joined.withColumn("posteriors", _softmax(fused))
    names = F.array(*[F.lit(x) for x in languages])
    of = lambda a: F.get(names, (F.array_position(a, F.array_max(a)) - 1).cast("int"))
    return joined.select("page_id", "host", "declared", of(F.col("p")).alias("text_lang"), of(F.col("posteriors")).alias("lang"), F.array_max("posteriors").alias("posterior"))


def language_digest(pages: DataFrame, documents: DataFrame) -> DataFrame:
    return identify(pages, *fit_text_model(documents))
