"""Source divergence audit: how far the term use of a language's sources lies apart, and by which terms.

1. Texts are cut into terms on their UTF-8 bytes: A-Z, a-z and every byte of other
   scripts belong to terms. Each batch counts the documents of its distinct terms,
   and each language keeps the terms in at least ``LEAST_DOCUMENTS`` documents.
2. The kept terms, sorted over range partitions, become minimal acyclic transducers of
   up to ``SHARD_TERMS`` terms each. A shard's base is the number of terms in its
   language's earlier shards, so base + output is the term's lexicographic ordinal.
3. The texts are streamed through the transducers, which are broadcast ``BROADCAST_BYTES``
   of them at a time (measured; a larger vocabulary takes several passes), and
   counted again by source and ordinal. What no transducer accepts isn't kept.
4. A group's share of a term is p = 1 + floor(10^9 (count + 5) / (N + 5 V)), in decimals.
   Sources are compared in tiles: a task has at most 2 x ``TILE`` sources and ``BLOCK``
   ordinals, and the differences are summed over the blocks. Terms whose share in a
   source is above the language's are ranked, ties by ordinal.

Defined cases: null text, lang and source are ''; every row is a document, repeated ones and
those with null ids too; a group without terms has the count 0 of each; a language that keeps
no term gives pairs with the value 0; a source alone in its language gives no pairs; a group
none of whose terms is above the language's share gives no terms; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import small_bytes, stored
from eventloom.llm.terms import LETTERS, LOWER, cut, pieces
from eventloom.llm.transducer import COLUMNS, Transducer, build

LEAST_DOCUMENTS = 30
TOP = 50
#: Terms of a transducer, and bytes of transducers that are broadcast at a time.
SHARD_TERMS = 100_000
BROADCAST_BYTES = 64 << 20
#: Sources of a tile and ordinals of a block.
TILE, BLOCK = 128, 2_048


def _coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def kept_terms(documents: DataFrame, least: int = LEAST_DOCUMENTS, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, term, documents) of every term in at least ``least`` documents of its language; term is binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for b in batches for p in pieces(b)):
            rows, codes, terms = cut(piece.column("text"), LETTERS, LOWER)
            if not len(terms):
                continue
            langs, names = _coded(piece.column("lang"))
            seen = np.unique(rows * len(terms) + codes)
            pairs, n = np.unique(langs[seen // len(terms)] * len(terms) + seen % len(terms), return_counts=True)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(pairs // len(terms))), terms.take(pa.array(pairs % len(terms))).cast(pa.binary()), pa.array(n)], names=["lang", "term", "n"])

    read = documents.select(_text(lang).alias("lang"), _text(text).alias("text"))
    counted = read.mapInArrow(run, "lang string, term binary, n long").groupBy("lang", "term").agg(F.sum("n").alias("documents"))
    return counted.where(F.col("documents") >= least)


def vocabulary(kept: DataFrame, shard_terms: int = SHARD_TERMS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The transducers of (lang, term): lang, base, n, round and the transducer's parts; stored.

    Transducers of one round have at most ``broadcast_bytes`` together (or are a single one).
    """
    ranges = max(1, -(-kept.count() // shard_terms))

    def shard(lang: str, terms: list[bytes]) -> pa.RecordBatch:
        parts = build(terms).to_bytes()
        values = [lang, terms[0], len(terms), sum(map(len, parts)), *parts]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["lang", "first_term", "n", "size", *COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, terms = None, []
        for b in batches:
            for at, term in zip(b.column("lang").to_pylist(), b.column("term").to_pylist()):
                if terms and (at != lang or len(terms) == shard_terms):
                    yield shard(lang, terms)
                    terms = []
                lang = at
                terms.append(term)
        if terms:
            yield shard(lang, terms)

    ordered = kept.select("lang", "term").repartitionByRange(ranges, "lang", "term").sortWithinPartitions("lang", "term")
    kinds = "lang string, first_term binary, n long, size long, " + ", ".join(f"{c} binary" for c in COLUMNS)
    shards = stored(ordered.mapInArrow(run, kinds), "transducers")
    # One row for each shard_terms terms: a small table.
    earlier = Window.partitionBy("lang").orderBy("first_term").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.orderBy("lang", "first_term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = shards.select("lang", "first_term", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"), F.floor(F.sum("size").over(so_far) / broadcast_bytes).cast("long").alias("round"))
    return stored(places.join(shards.drop("n", "size"), ["lang", "first_term"]).drop("first_term"), "vocabulary")


class _Walker:
    """The transducers of one round, by language."""

    def __init__(self, rows: list[tuple]) -> None:
        self.by_lang: dict[str, list[tuple[int, Transducer]]] = {}
        for lang, base, *parts in rows:
            self.by_lang.setdefault(lang, []).append((base, Transducer.from_bytes(*parts)))

    def ordinals(self, lang: str, terms: pa.Array) -> np.ndarray:
        terms = terms.cast(pa.large_binary())
        offsets = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
        data = np.frombuffer(terms.buffers()[2] or b"", np.uint8)
        out = np.full(len(terms), -1, np.int64)
        for base, transducer in self.by_lang.get(lang, ()):
            got = transducer.ordinals(data, offsets[:-1], np.diff(offsets))
            out = np.where(got >= 0, base + got, out)
        return out


def _by_round(vocab: DataFrame, df: DataFrame, run, kinds: str) -> DataFrame:
    """``df`` mapped by ``run(batches, walker)`` once for each round of transducers; once where there is none."""
    spark = df.sparkSession
    out = None
    for at in range((vocab.agg(F.max("round")).first()[0] or 0) + 1):
        rows = [tuple(map(lambda v: bytes(v) if isinstance(v, bytearray) else v, r)) for r in vocab.where(F.col("round") == at).select("lang", "base", *COLUMNS).collect()]
        sent = spark.sparkContext.broadcast(rows)
        mapped = df.mapInArrow(lambda batches, sent=sent: run(batches, _Walker(sent.value)), kinds)
        out = mapped if out is None else out.union(mapped)
    return out


def ordinals(kept: DataFrame, vocab: DataFrame) -> DataFrame:
    """(lang, ord, item) of every kept term; item is its text."""

    def run(batches: Iterator[pa.RecordBatch], walker: _Walker) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, names = _coded(b.column("lang"))
            out = np.full(b.num_rows, -1, np.int64)
            for k, name in enumerate(names.to_pylist()):
                mine = np.flatnonzero(langs == k)
                out[mine] = walker.ordinals(name, b.column("term").take(pa.array(mine)))
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("term"), pa.array(out)], names=["lang", "term", "ord"])

    walked = _by_round(vocab, kept.select("lang", "term"), run, "lang string, term binary, ord long")
    return walked.where("ord >= 0").select("lang", "ord", F.col("term").cast("string").alias("item"))


def recount(documents: DataFrame, vocab: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, ord, n): occurrences of each kept term in each group; each group has one row with ord -1 and n 0 at least."""

    def run(batches: Iterator[pa.RecordBatch], walker: _Walker) -> Iterator[pa.RecordBatch]:
        for piece in (p for b in batches for p in pieces(b)):
            langs, lang_names = _coded(piece.column("lang"))
            sources, source_names = _coded(piece.column("source"))
            groups, of_row = np.unique(langs * len(source_names) + sources, return_inverse=True)
            rows, codes, terms = cut(piece.column("text"), LETTERS, LOWER)
            size = max(1, len(terms))
            seen, n = np.unique(of_row[rows] * size + codes, return_counts=True)
            group, term = seen // size, seen % size
            ord_ = np.full(len(seen), -1, np.int64)
            for k, name in enumerate(lang_names.to_pylist()):
                mine = np.flatnonzero(groups[group] // len(source_names) == k)
                used, back = np.unique(term[mine], return_inverse=True)
                ord_[mine] = walker.ordinals(name, terms.take(pa.array(used)))[back]
            found = np.flatnonzero(ord_ >= 0)
            group = np.concatenate([group[found], np.arange(len(groups))])
            yield pa.RecordBatch.from_arrays(
                [
                    lang_names.take(pa.array(groups[group] // len(source_names))),
                    source_names.take(pa.array(groups[group] % len(source_names))),
                    pa.array(np.concatenate([ord_[found], np.full(len(groups), -1)])),
                    pa.array(np.concatenate([n[found], np.zeros(len(groups), np.int64)])),
                ],
                names=["lang", "source", "ord", "n"],
            )

    read = documents.select(_text(lang).alias("lang"), _text(source).alias("source"), _text(text).alias("text"))
    counted = _by_round(vocab, read, run, "lang string, source string, ord long, n long")
    return counted.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))


def _share(n: str, total: str) -> Column:
    """1 + floor(10^9 (n + 5) / total), exact for any long; 0 where total is 0."""
    return F.expr(f"CASE WHEN {total} = 0 THEN 0L ELSE 1 + (CAST({n} + 5 AS DECIMAL(20,0)) * CAST(1000000000 AS DECIMAL(10,0))) div CAST({total} AS DECIMAL(20,0)) END").cast("long")


def _tile_distances(key: tuple, table: pa.Table) -> pa.Table:
    """Sums of absolute differences between the sources of two tiles over one block of ordinals."""
    lang, low, high, block = (k.as_py() for k in key)
    s, ord_, p, width = (table.column(c).to_numpy() for c in ("s", "ord", "p", "width"))
    heads = ord_ < 0
    sources, places = np.unique(s[heads], return_index=True)
    shares = np.repeat(p[heads][places][:, None], int(width[heads][0]), axis=1)
    cells = ~heads
    shares[np.searchsorted(sources, s[cells]), ord_[cells] - block * BLOCK] = p[cells]
    right = np.flatnonzero(sources // TILE == high)
    a, b, f = [], [], []
    for i in np.flatnonzero(sources // TILE == low):
        others = right[right > i]
        a.append(np.full(len(others), sources[i]))
        b.append(sources[others])
        f.append(np.abs(shares[others] - shares[i]).sum(axis=1))
    a, b, f = (np.concatenate(x).astype(np.int64) for x in (a, b, f))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "f": f})


def audit(documents: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: the distances of each source to its language's others (part
    ``pair``) and the ``top`` terms that it uses more than its language does (part ``term``)."""
    kept = stored(kept_terms(documents, least, text, lang), "kept-terms")
    vocab = vocabulary(kept)
    counts = stored(recount(documents, vocab, text, lang, source), "term-counts")
    sizes = vocab.groupBy("lang").agg(F.sum("n").alias("v"))
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(sizes, "lang", "left")
    total = F.col("total") + 5 * F.coalesce("v", F.lit(0))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(groups.select("lang", "source", number.cast("long").alias("s"), F.coalesce("v", F.lit(0)).alias("v"), total.alias("total")), "groups")
    cells = counts.where("ord >= 0").join(small_bytes(groups), ["lang", "source"])

    # Each block of ordinals has a row for each source, with the share of a term that it lacks.
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("v") / BLOCK) - 1).cast("long")))
    heads = groups.select("lang", "s", blocks.alias("block"), F.lit(-1).cast("long").alias("ord"), _share("0", "total").alias("p"), "v")
    heads = heads.withColumn("width", F.least(F.lit(BLOCK), F.col("v") - F.col("block") * BLOCK)).drop("v")
    rows = heads.unionByName(cells.select("lang", "s", F.expr(f"ord div {BLOCK}").alias("block"), "ord", _share("n", "total").alias("p"), F.lit(0).cast("long").alias("width")))
    tiles = groups.groupBy("lang").agg(F.expr(f"max(s) div {TILE}").alias("tiles"))
    rows = rows.join(small_bytes(tiles), "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "tiles"))).withColumn("own", F.expr(f"s div {TILE}"))
    rows = rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("own", "other", "tiles")
    parts = rows.groupBy("lang", "low", "high", "block").applyInArrow(_tile_distances, "lang string, a long, b long, f long")
    apart = parts.groupBy("lang", "a", "b").agg(F.sum("f").alias("value"))
    both = apart.unionByName(apart.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", "s", "source")
    pairs = both.join(small_bytes(names.withColumnRenamed("s", "a")), ["lang", "a"]).join(small_bytes(names.select("lang", F.col("s").alias("b"), F.col("source").alias("item"))), ["lang", "b"])
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    langs = groups.groupBy("lang").agg((F.sum("total") - 5 * F.max("v") * (F.count("*") - 1)).alias("lang_total"))
    terms = cells.where("n > 0").withColumn("in_lang", F.sum("n").over(Window.partitionBy("lang", "ord")))
    terms = terms.join(small_bytes(langs), "lang").withColumn("value", _share("n", "total") - _share("in_lang", "lang_total")).where("value > 0")
    # The ordinal is the place among the language's sorted terms, so ties are by the term's bytes.
    terms = terms.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord"))).where(F.col("rank") <= top)
    terms = terms.join(ordinals(kept, vocab), ["lang", "ord"])
    out = [F.col(c) for c in ("lang", "source", "part", "item", "value", "rank")]
    return pairs.withColumn("part", F.lit("pair")).select(*out).unionByName(terms.withColumn("part", F.lit("term")).select(*out))


_TERMS = r"[^\x{00}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+"
ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERMS}') AS w
  FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS t FROM d),
kept AS (SELECT lang, t FROM (SELECT DISTINCT r, lang, t FROM o) GROUP BY lang, t HAVING count(*) >= {LEAST_DOCUMENTS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT o.lang, o.source, o.t, count(*) AS n FROM o JOIN kept USING (lang, t) GROUP BY ALL),
g AS (
  SELECT x.lang, x.source, coalesce(s.n, 0) + 5 * coalesce(v.v, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN v ON x.lang = v.lang
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s ON x.lang = s.lang AND x.source = s.source),
p AS (
  SELECT g.lang, g.source, k.t, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // total AS p
  FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
q AS (
  SELECT k.lang, k.t, 1 + (1000000000::HUGEINT * (sum(c.n) + 5)) // any_value(l.total) AS q
  FROM kept k JOIN c ON c.lang = k.lang AND c.t = k.t
  JOIN (SELECT c.lang, sum(n) + 5 * any_value(v.v) AS total FROM c JOIN v ON c.lang = v.lang GROUP BY c.lang) l ON l.lang = k.lang
  GROUP BY k.lang, k.t),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.f, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT p.lang, p.source, 'term' AS part, p.t AS item, (p - q)::BIGINT AS value FROM p JOIN q ON p.lang = q.lang AND p.t = q.t WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
WHERE part = 'pair' OR rank <= {TOP}
"""
