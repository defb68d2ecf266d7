"""Benchmark decontamination: size-partitioned MinHash containment search (DataFrame functions only).

A document contains a test item if it has at least ``CONTAINED`` of the item's
distinct five-word shingles. Items are partitioned by their number of shingles, in
powers of two; an item of q shingles is kept as its bottom-k MinHash sketch (its k
smallest shingle hashes) where k = (largest size of its partition) - ceil(CONTAINED *
that size) + 1, at least q - ceil(CONTAINED * q) + 1. A document that contains the
item lacks fewer than k of its shingles, so it holds one of any k of them: the search
misses none, however long the document is. Sketches of the documents themselves would
not do that: the longer a document, the less of a short item is in its smallest
hashes. Candidates are then verified by exact shingles, as texts.

Documents are read once for candidates (each shingle hash is looked up among the
sketches) and once for the candidates' shingles; their texts are not shuffled
unless candidates are too many to broadcast.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a null text has
none; an item of fewer than five words has one shingle, its whole word sequence, and is
found wherever these words stand consecutively (an item of one word is in every document
that has the word); items without words are never found; repeated items are searched once for each
item_id; rows that share a doc_id are one document, and null is a doc_id like others
(``decontaminate_rows`` takes each row as a document of its own, whatever its doc_id);
either table may be empty; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import WORD, ascii_lower, fresh, small_side, stored

SHINGLE = 5
CONTAINED = 0.8
#: Sketches, items' shingles and candidates of up to so many rows are broadcast (16 to 80 bytes each); more are shuffled.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _each_window(w: Column, sizes: Sequence[int], made: Callable[[Column], Column]) -> Column:
    """What is ``made`` of the runs of consecutive words of each of these sizes."""
    def of_size(n: int) -> Column:
        places = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: made(F.slice(w, i, n)))

    return F.concat(*[of_size(n) for n in sizes])


def shingle_hashes(w: Column, sizes: Sequence[int] = (SHINGLE,)) -> Column:
    return _each_window(w, sizes, lambda x: F.xxhash64(x))


def shingles(w: Column, sizes: Sequence[int] = (SHINGLE,)) -> Column:
    return F.array_distinct(_each_window(w, sizes, lambda x: F.array_join(x, " ")))


def item_shingles(w: Column) -> Column:
    """The five-word shingles, or the whole sequence of fewer words."""
    return F.when(F.size(w).between(1, SHINGLE - 1), F.array(F.array_join(w, " "))).otherwise(shingles(w))


def sizes_of(items: DataFrame) -> list[int]:
    """The sizes of shingle that items have, ``SHINGLE`` at most: documents are cut into these alone."""
    size = F.explode(F.transform("shingles", lambda s: F.size(F.split(s, " "))))
    return sorted({r[0] for r in items.select(size.alias("n")).distinct().collect()} | {SHINGLE})


def needed(n: Column, share: float = CONTAINED) -> Column:
    """The least whole number of n shingles that is ``share`` of them (in exact tenths: no rounding up by 0.1 + 0.2)."""
    tenths = round(share * 10)
    return F.floor((n * tenths + 9) / 10).cast("long")


def sketches(items: DataFrame) -> DataFrame:
    """(hash, item_id): the bottom-k sketch of each item, k from its size partition."""
    hashed = items.select("item_id", F.explode(F.array_distinct(F.transform("shingles", lambda s: F.xxhash64(F.split(s, " "))))).alias("hash"), "q")
    top = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("q").cast("double")))).cast("long")
    k = F.greatest(top - needed(top) + 1, F.col("q") - needed(F.col("q")) + 1)
    lists = hashed.withColumn("k", k).groupBy("item_id").agg(F.sort_array(F.collect_list("hash")).alias("hashes"), F.max("k").alias("k"))
    return lists.select("item_id", F.explode(F.slice("hashes", F.lit(1), F.col("k").cast("int"))).alias("hash"))


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_item, n_found, containment): every document and item that it contains."""
    items = benchmark.groupBy("item_id", "text").count().select("item_id", item_shingles(words(F.col("text"))).alias("shingles"))
    # Texts that share an item_id are one item: its shingles are those of all of them.
    items = items.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("shingles"))).alias("shingles"))
    items = stored(items.withColumn("q", F.size("shingles").cast("long")).where(F.col("q") > 0), "items")
    sizes = sizes_of(items)
    sketch = stored(sketches(items), "sketches")
    probes = documents.select("doc_id", words(F.col("text")).alias("w")).select("doc_id", F.explode(shingle_hashes(F.col("w"), sizes)).alias("hash"))
    hits = probes.join(small_side(sketch, BROADCAST_ROWS), "hash")
    candidates = stored(hits.groupBy("doc_id", "item_id").count().select("doc_id", "item_id"), "candidates")

    at = candidates.select(F.col("doc_id").alias("cand")).distinct()
    texts = documents.select("doc_id", "text").join(small_side(stored(at, "candidate_docs"), BROADCAST_ROWS), F.col("doc_id").eqNullSafe(F.col("cand")), "left_semi")
    held = texts.select("doc_id", words(F.col("text")).alias("w")).select("doc_id", F.explode(shingles(F.col("w"), sizes)).alias("shingle"))
    of_items = stored(items.select("item_id", "q", F.explode("shingles").alias("shingle")), "item_shingles")
    pairs = held.join(small_side(of_items, BROADCAST_ROWS), "shingle").groupBy("doc_id", "item_id", "q").agg(F.countDistinct("shingle").alias("n_found"))
    pairs = pairs.where(F.col("n_found") >= needed(F.col("q")))
    c = candidates.select(F.col("doc_id").alias("cand"), F.col("item_id").alias("cand_item"))
    both = pairs["doc_id"].eqNullSafe(c["cand"]) & pairs["item_id"].eqNullSafe(c["cand_item"])
    found = pairs.join(c, both, "left_semi")
    return found.select("doc_id", "item_id", F.col("q").alias("n_item"), "n_found", (F.col("n_found") / F.col("q")).alias("containment"))


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no test item, with their columns as they are."""
    found = stored(contaminated(documents, benchmark).select("doc_id").distinct(), "contaminated")
    bad = fresh(documents, "bad")
    drop = found.select(F.col("doc_id").alias(bad))
    return documents.join(small_side(drop, BROADCAST_ROWS), documents["doc_id"].eqNullSafe(F.col(bad)), "left_anti")


def decontaminate_rows(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that contain no test item themselves, with their columns as they are.

    Rows are told apart by a stored number and not by their doc_id: a clean row stays
    though another one has its doc_id (or a null, too) and goes.
    """
    row = fresh(documents, "row")
    numbered = stored(documents.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = contaminated(numbered.select(F.col(row).alias("doc_id"), "text"), benchmark).select("doc_id").distinct()
    drop = stored(found.select(F.col("doc_id").alias(fresh(numbered, "bad"))), "contaminated")
    return numbered.join(small_side(drop, BROADCAST_ROWS), F.col(row) == F.col(drop.columns[0]), "left_anti").drop(row)


_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
n AS (SELECT DISTINCT least(len(w), 5) AS n FROM i WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k+n-1], ' '))) AS s FROM d, n WHERE len(w) >= n),
sh AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda k: array_to_string(w[k:k+least(len(w), 5)-1], ' '))) AS s FROM i WHERE len(w) > 0),
q AS (SELECT item_id, count(*) AS n_item FROM sh GROUP BY item_id),
p AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN sh USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment FROM p JOIN q USING (item_id) WHERE n_found * 10 >= n_item * 8
"""
assert math.isclose(CONTAINED * 10, 8)
