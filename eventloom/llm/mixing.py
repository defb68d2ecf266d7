"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Each row gets the key ``-ln(u) / weight``: ``u`` in (0, 1) is a hash of the seed, the
row's id, source and text, and its number among the rows equal in these; ``weight`` is its
quality weight. Taking documents by ascending key is
weighted sampling without replacement. A source's target is first met by complete
epochs (every document once for each); of the next epoch come the first documents by
key until their prefix sum is as near the rest of the target as whole documents allow.

Defined cases: a null or empty text has no words and takes none; null sources are one
source, the last; rows are documents of their own, so repeated rows and null ids are drawn
each by itself (which of several equal rows has which number is left open, and shows in
columns that aren't read alone); ties in the key go by doc_id (null first); an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import WORD, fresh, global_prefix, small_side, stored

#: The sources by code point, null last, have these weights in turn.
TURN_WEIGHTS = (5, 2, 1)
#: All targets together, as a share of all words, and one target at most, in its source's words.
SHARE, MOST = 1.5, 2

SEED = "mix-1"
SYMBOLS = "#*$%&|<>"
#: Targets of up to so many sources are broadcast (some 40 bytes each); more are shuffled.
SOURCES = 500_000
#: Identities of repeated rows (60 bytes each) are broadcast up to so many; more are shuffled.
REPEATED = 500_000


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def identity(seed: str = SEED) -> Column:
    """Equal for rows of equal id, source and text: their MD5 with the seed."""
    marked = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in ("doc_id", "source")]
    return F.md5(F.concat_ws(":", F.lit(seed), *marked, F.coalesce(F.col("text"), F.lit(""))))


def uniform(same: Column, nth: Column) -> Column:
    """In (0, 1), the same for each run: 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", same, nth.cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target: ``share`` of all words by weight, no target above ``most`` times its source.

    What a full source can't take is shared again by weight among the others, until
    none is above. That ends at target = min(most * size, level * weight), where the
    level follows from the sources in order of most * size / weight: those before
    some place are full and the rest divide what is left. Ranks and sums run over
    range-partitioned sources, so their number may be large too.
    """
    sources = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1)).withColumn("all", F.lit(1)), "sources")
    ranked = global_prefix(sources, "all", [F.col("source").asc_nulls_last()], "one", "rank", 16)
    weights = F.element_at(F.array(*[F.lit(float(w)) for w in TURN_WEIGHTS]), ((F.col("rank") - 1) % len(TURN_WEIGHTS) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", weights).withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight")), "weights")
    order = [F.col("ratio"), F.col("rank")]
    full = global_prefix(ranked, "all", order, "cap", "caps", 16)
    full = global_prefix(full, "all", order, "weight", "weights", 16)
    goal, weight_sum = ranked.agg(share * F.sum("source_size"), F.sum("weight")).first()
    # The level if this source is the first that is not full; it is so if it stays below its own ratio.
    left = F.lit(goal) - (F.col("caps") - F.col("cap"))
    level = full.withColumn("level", left / (F.lit(weight_sum) - (F.col("weights") - F.col("weight"))))
    first = level.where(F.col("level") <= F.col("ratio")).agg(F.min(F.struct("ratio", "rank", "level"))["level"]).first()[0]
    target = F.col("cap").cast("double") if first is None else F.least(F.col("cap").cast("double"), F.col("weight") * first)
    return ranked.select("source", "source_size", target.alias("target"))


def quality_weight(text: Column) -> Column:
    """Between 0 and 1: prose weighs about 1, text with a symbol for each word about a half."""
    t = F.coalesce(text, F.lit(""))
    marks = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    return 1.0 / (1.0 + marks / F.greatest(word_count(text), F.lit(1)))


def _key(same: Column, nth: Column, weight: Column) -> Column:
    return -F.log(uniform(same, nth)) / weight


def repeated(rows: DataFrame, same: str) -> DataFrame | None:
    """The identities of several rows, once each; None if there are none. They meet in a partial aggregation."""
    found = stored(rows.groupBy(same).count().where("count > 1").select(same), "repeated")
    return None if found.isEmpty() else found


def numbered(rows: DataFrame, same: str, weight: str, nth: str) -> DataFrame:
    """``nth``: the number of a row among those of its identity, from 1. A stored row
    number orders them, so that equal rows, however many, lie over many ranges."""
    row, one = fresh(rows, "row"), fresh(rows, "one")
    rows = stored(rows.withColumn(row, F.monotonically_increasing_id()).withColumn(one, F.lit(1)), "numbered")
    return global_prefix(rows, same, [F.col(weight), F.col(row)], one, nth).drop(row, one)


def _sized(documents: DataFrame, weight: Column | None, seed: str) -> DataFrame:
    """doc_id, source, size and key of every row. Texts are read once."""
    weight = quality_weight(F.col("text")) if weight is None else weight
    rows = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), weight.alias("weight"), identity(seed).alias("same"))
    rows = stored(rows, "sizes")
    twice = repeated(rows, "same")
    single = rows.withColumn("nth", F.lit(1))
    if twice is not None:
        twice = small_side(twice, REPEATED)
        single = single.join(twice, "same", "left_anti")
        single = single.unionByName(numbered(rows.join(twice, "same", "left_semi"), "same", "weight", "nth"))
    return stored(single.select("doc_id", "source", "size", _key(F.col("same"), F.col("nth"), F.col("weight")).alias("key")), "keys")


def mix(documents: DataFrame, weight: Column | None = None, seed: str = SEED) -> DataFrame:
    """doc_id, size, source, key, source_size, target, epochs, copies, taken of every row of ``documents``.

    Texts are read once, for sizes and keys, which are stored; all else is done on those.
    """
    sized = _sized(documents, weight, seed)
    targets = stored(source_targets(sized), "targets")
    summed = global_prefix(sized, "source", [F.col("key"), F.col("doc_id"), F.col("size")], "size", "upto")
    t = targets.select(F.col("source").alias("of"), "source_size", "target")
    rows = summed.join(small_side(t, SOURCES), summed["source"].eqNullSafe(t["of"])).drop("of")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    # The last document is in if the sum with it is nearer the target than without it.
    more = (F.col("upto") - F.col("size") / 2 <= rest) & (F.col("epochs") < MOST)
    rows = rows.withColumn("epochs", epochs.cast("long")).withColumn("copies", F.col("epochs") + F.when(more, 1).otherwise(0))
    return rows.select("doc_id", "size", "source", "key", "source_size", "target", "epochs", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(documents: DataFrame, weight: Column | None = None, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, its columns as they are.

    A source's fractional epoch ends at one place in the order of keys, so a row is
    taken by comparing it with its source's place: sources are joined, not documents,
    and no text is shuffled; rows that are equal in id, source and text alone are stored once more and
    numbered. Documents without words stay in each complete epoch, once at least.
    """
    mixed = mix(documents, weight, seed)
    place = F.struct("key", "doc_id", "size")
    ends = mixed.groupBy("source").agg(F.max("epochs").alias("epochs"), F.max(F.when(F.col("copies") > F.col("epochs"), place)).alias("last"))
    names = {c: fresh(documents, f"mix_{c}") for c in ("of", "epochs", "last", "place", "copies", "same", "weight", "nth")}
    ends = stored(ends.select(F.col("source").alias(names["of"]), F.col("epochs").alias(names["epochs"]), F.col("last").alias(names["last"])), "ends")
    rows = _numbered_documents(documents, weight, seed, names["same"], names["weight"], names["nth"])
    key = _key(F.col(names["same"]), F.col(names["nth"]), F.col(names["weight"]))
    rows = rows.withColumn(names["place"], F.struct(key.alias("key"), F.col("doc_id"), word_count(F.col("text")).alias("size")))
    rows = rows.join(small_side(ends, SOURCES), F.col("source").eqNullSafe(F.col(names["of"])))
    more = F.coalesce(F.col(names["place"]) <= F.col(names["last"]), F.lit(False))
    copies = F.col(names["epochs"]) + F.when(more, 1).otherwise(0)
    copies = F.when(F.col(names["place"])["size"] == 0, F.greatest(copies, F.lit(1))).otherwise(copies)
    rows = rows.withColumn(names["copies"], F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
    return rows.select(*[F.col(f"`{c}`") for c in documents.columns])


def _numbered_documents(documents: DataFrame, weight: Column | None, seed: str, same: str, weigh: str, nth: str) -> DataFrame:
    """The documents with identity, weight and number. Only repeated ones move: their narrow
    numbers are found first and joined back to their stored rows."""
    weight = quality_weight(F.col("text")) if weight is None else weight
    rows = documents.withColumn(same, identity(seed)).withColumn(weigh, weight)
    twice = repeated(rows.select(same), same)
    if twice is None:
        return rows.withColumn(nth, F.lit(1))
    twice, row = small_side(twice, REPEATED), fresh(rows, "row")
    again = stored(rows.join(twice, same, "left_semi").withColumn(row, F.monotonically_increasing_id()), "repeated_rows")
    one, of = fresh(again, "one"), fresh(again, "of")
    numbers = global_prefix(again.select(same, weigh, F.col(row).alias(of), F.lit(1).alias(one)), same, [F.col(weigh), F.col(of)], one, nth)
    numbers = small_side(stored(numbers.select(of, nth), "numbers"), REPEATED)
    again = again.join(numbers, again[row] == numbers[of]).drop(row, of)
    return rows.join(twice, same, "left_anti").withColumn(nth, F.lit(1)).unionByName(again)


# MD5, logarithms and prefix sums by one order; sums over at most 2^53 words are exact in doubles.
ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, md5(concat('{SEED}:', coalesce('v' || doc_id::VARCHAR, 'n'), ':', coalesce('v' || source, 'n'), ':', coalesce(text, ''))) AS same, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
k AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(md5(same || ':' || row_number() OVER (PARTITION BY same)), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
    / (1.0 / (1.0 + (length(t) - length(translate(t, '{SYMBOLS}', '')))::DOUBLE / greatest(size, 1))) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM k GROUP BY source),
w AS (SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
o AS (
  SELECT *, {MOST} * source_size / weight AS ratio,
    ({SHARE}::DOUBLE * sum(source_size) OVER () - (sum({MOST} * source_size) OVER q - {MOST} * source_size))
    / (sum(weight) OVER () - (sum(weight) OVER q - weight)) AS level
  FROM w WINDOW q AS (ORDER BY {MOST} * source_size / weight, r ROWS UNBOUNDED PRECEDING)),
l AS (SELECT arg_min(level, ratio) AS level FROM o WHERE level <= ratio),
t AS (SELECT source, source_size, least(({MOST} * source_size)::DOUBLE, weight * coalesce((SELECT level FROM l), 1e300)) AS target FROM w),
u AS (
  SELECT k.doc_id, k.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST, k.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN epochs < {MOST} AND upto - size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM u
"""
