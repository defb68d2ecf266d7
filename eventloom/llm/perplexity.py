"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model predicts each character of a word, and its end, from the ``ORDER`` - 1
characters before it. It is counted over all trusted documents: orders below the highest
count the distinct characters that a sequence follows, and each order has its own
three discounts from its counts of counts. A document's perplexity is that of all its
words; it is kept up to a quantile of the trusted documents' perplexities in its own
language.

The count joins are sharded by sequence: texts are dealt by their row numbers (pass a scan or a
stored table, whose row order a recomputed task keeps) into batches of about ``BATCH_BYTES``; each batch asks for the distinct sequences it holds;
these are joined, once for the whole corpus, with the model's probabilities and back-off
weights; and each batch scores its documents with the answers. A batch's questions grow
much less than its text, so little more than the text itself is shuffled, and no task
needs the whole model.

Defined cases: null and empty texts have no perplexity and are not kept; a language
with fewer than ``LEAST_TRUSTED`` trusted documents, null included, has the quantile of
all trusted documents; with no trusted documents there is no model, no perplexity and
no threshold, and documents with words are kept; a document with several labels is
trusted if all of them are good; repeated rows each have their own result; empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import small_side, stored
from eventloom.llm.terms import BLACK, cut, pieces

ORDER = 4
BATCH_BYTES = 16 << 20
ASKERS = 1_024
QUANTILE, SLACK, LEAST_TRUSTED, STEADY = 0.99, 1.15, 50, 40
#: Trusted ids of up to so many are broadcast (8 bytes each); more are shuffled.
TRUSTED = 2_000_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_START, _END = "\x02" * (ORDER - 1), "\x03"
_FLUSH = 1_000_000
#: Bytes of text whose words are taken apart at a time: the arrays of their sequences are some thirty times as large.
_PIECE = 2 << 20


def sequences(word: str) -> list[str]:
    """Of each character of a word, and of its end, the ORDER characters that end there."""
    padded = f"{_START}{word}{_END}"
    return [padded[k : k + ORDER] for k in range(len(padded) - ORDER + 1)]


def grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Of every sequence of every word, in order: the word's number and the sequence's among the distinct ones, which come third.

    Characters are packed as 16-bit numbers of the alphabet at hand, so a sequence is one 64-bit number.
    """
    sizes = np.asarray(pc.utf8_length(words))
    of_word = np.repeat(np.arange(len(words)), sizes + 1)
    padded = pc.binary_join_element_wise(pa.scalar(_START, words.type), words, pa.scalar(_END, words.type), pa.scalar("", words.type))
    line = b"" if not len(words) else padded.buffers()[2].to_pybytes()
    chars = np.frombuffer(line.decode().encode("utf-32-le"), np.uint32)
    letters = None
    if chars.max(initial=0) >= 1 << 16:
        letters, chars = np.unique(chars, return_inverse=True)
        if len(letters) > 1 << 16:  # a larger alphabet than 16 bits number
            places: dict[str, int] = {}
            return of_word, np.array([places.setdefault(g, len(places)) for w in words.to_pylist() for g in sequences(w)], np.int64), list(places)
    chars = chars.astype(np.uint64)
    # The sequences of a word start at its padding and end at its characters and its end.
    heads = np.cumsum(sizes + ORDER) - (sizes + ORDER)
    at = np.arange(len(of_word)) + np.repeat(heads - (np.cumsum(sizes + 1) - (sizes + 1)), sizes + 1)
    packed = np.zeros(len(at), np.uint64)
    for k in range(ORDER):
        packed = packed << np.uint64(16) | chars[at + k]
    kinds, number = np.unique(packed, return_inverse=True)
    points = np.stack([kinds >> np.uint64(16 * (ORDER - 1 - k)) & np.uint64(0xFFFF) for k in range(ORDER)], axis=1)
    points = (points if letters is None else letters[points]).astype(np.uint32)
    line = points.tobytes().decode("utf-32-le")
    return of_word, number, [line[k : k + ORDER] for k in range(0, len(line), ORDER)]


def _words(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of every word its row and its number among the distinct words, which come third."""
    rows, codes, words = cut(texts, BLACK)
    try:
        return rows, codes, words.cast(pa.large_string())
    except pa.ArrowInvalid:  # bytes that aren't UTF-8
        return rows, codes, pa.array([w.decode("utf-8", "replace") for w in words.to_pylist()], pa.large_string())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["gram", "n"])
        total.clear()
        return made

    for piece in (p for b in batches for p in pieces(b, size=_PIECE)):
        _, codes, words = _words(piece.column("text"))
        of_word, number, found = grams(words)
        times = np.bincount(number, np.bincount(codes, minlength=len(words))[of_word], len(found)).astype(np.int64)
        for gram, n in zip(found, times.tolist()):
            total[gram] += n
        if len(total) > _FLUSH:
            yield out()
    if total:
        yield out()


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """From how many sequences were seen once, twice, three and four times; absolute discounting where that is too few."""
    n1, n2, n3, n4 = counts
    if not (n1 and n2 and n3):
        return (0.5, 0.75, 0.9)
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))  # type: ignore[return-value]


def build_model(counts: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """From (gram, n) of order ORDER: (gram, p) of all orders, (context, gamma) of orders 2 and up, and the probability of an unseen character."""
    levels = [counts]
    for _ in range(ORDER - 1):  # distinct sequences of the order above, by what is left without the first character
        levels.append(stored(levels[-1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n")), "level"))
    model = contexts = None
    floor = 0.0
    for order, level in enumerate(reversed(levels), start=1):
        seen = level.agg(*[F.count_if(F.col("n") == k) for k in range(1, 5)]).first()
        d1, d2, d3 = discounts(list(seen))
        off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        level = level.withColumn("context", F.expr(f"substring(gram, 1, {order - 1})"))
        sums = level.groupBy("context").agg(F.sum("n").alias("total"), F.sum(off).alias("held"))
        sums = stored(sums.select("context", "total", (F.col("held") / F.col("total")).alias("gamma")), "contexts")
        rows = level.join(sums, "context").withColumn("own", (F.col("n") - off) / F.col("total"))
        if order == 1:
            kinds, gamma = level.count(), (sums.first() or {"gamma": 1.0})["gamma"]
            floor = gamma / (kinds + 1)
            model = rows.select("gram", (F.col("own") + floor).alias("p"))
        else:
            lower = model.select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            rows = rows.withColumn("suffix", F.expr("substring(gram, 2)")).join(lower, "suffix")
            own = rows.select("gram", (F.col("own") + F.col("gamma") * F.col("lower")).alias("p"))
            model, contexts = own, (sums if contexts is None else contexts.union(sums))
            # Only sequences of the order above need this one; all are kept for those that back off.
        model = stored(model, "model")
        every = model if order == 1 else every.union(model)
    return stored(every, "model"), stored(contexts.select("context", "gamma"), "contexts"), floor


def log_probabilities(grams: DataFrame, model: DataFrame, contexts: DataFrame, floor: float) -> DataFrame:
    """``grams`` with ``logp`` of each sequence of order ORDER; each join is sharded by what it looks up."""
    rows = grams
    for k in range(1, ORDER + 1):  # the order-k probability of the last k characters
        p = model.where(F.length("gram") == k).select(F.col("gram").alias(f"g{k}"), F.col("p").alias(f"p{k}"))
        rows = rows.withColumn(f"g{k}", F.expr(f"substring(gram, {ORDER - k + 1}, {k})")).join(p, f"g{k}", "left").drop(f"g{k}")
        if k > 1:
            g = contexts.where(F.length("context") == k - 1).select(F.col("context").alias(f"c{k}"), F.col("gamma").alias(f"w{k}"))
            rows = rows.withColumn(f"c{k}", F.expr(f"substring(gram, {ORDER - k + 1}, {k - 1})")).join(g, f"c{k}", "left").drop(f"c{k}")
    p: Column = F.coalesce("p1", F.lit(floor))
    for k in range(2, ORDER + 1):
        p = F.coalesce(f"p{k}", F.coalesce(f"w{k}", F.lit(1.0)) * p)
    return rows.select(*grams.columns, F.log(p).alias("logp"))


def _questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    asked: dict[int, set[str]] = {}
    for piece in (p for b in batches for p in pieces(b, size=_PIECE)):
        numbers = piece.column("batch").to_numpy()
        for batch in np.unique(numbers).tolist():
            words = _words(piece.column("text").filter(pa.array(numbers == batch)))[2]
            asked.setdefault(batch, set()).update(grams(words)[2])
    for batch, found in asked.items():
        yield pa.RecordBatch.from_arrays([pa.array([batch] * len(found), pa.int64()), pa.array(list(found), pa.string())], names=["batch", "gram"])


def _score(texts: pa.Table, answers: pa.Table) -> pa.Table:
    logp = dict(zip(answers.column("gram").to_pylist(), answers.column("logp").to_pylist()))
    scores, sizes = [], []
    for piece in pieces(texts, size=_PIECE):
        rows, codes, words = _words(piece.column("text"))
        of_word, number, found = grams(words)
        value = np.bincount(of_word, np.fromiter(map(logp.__getitem__, found), np.float64, len(found))[number], len(words))
        size = np.asarray(pc.utf8_length(words)) + 1
        scores.append(np.bincount(rows, value[codes], piece.num_rows))
        sizes.append(np.bincount(rows, size[codes], piece.num_rows).astype(np.int64))
    n, total = (np.concatenate([*x, np.zeros(0, x[0].dtype)]) if x else np.zeros(0) for x in (sizes, scores))
    out = pa.array(np.exp(-total / np.maximum(n, 1)), pa.float64(), mask=n == 0)
    return pa.table([texts.column("id"), texts.column("lang"), out, pa.array(n.astype(np.int64))], names=["id", "lang", "perplexity", "n"])


def trusted_ids(labels: DataFrame) -> DataFrame:
    good = labels.groupBy("doc_id").agg(F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))).alias("good"))
    return good.where("good AND doc_id IS NOT NULL").select(F.col("doc_id").alias("trusted_id"))


def batch_number(batches: int) -> Column:
    """The batch of a row, by its number in the scan and nothing of its own: equal rows are dealt like any others."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, batches)))


def perplexities(documents: DataFrame, trusted: DataFrame) -> DataFrame:
    """(id, lang, perplexity, n) of every row, n being the characters and word ends it is over; the model is counted over the documents whose id is in ``trusted``."""
    learned = documents.select("doc_id", "text").join(small_side(trusted, TRUSTED), F.col("doc_id") == F.col("trusted_id"), "left_semi")
    counts = stored(learned.select("text").mapInArrow(_count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    kind = dict(documents.dtypes)
    if counts.isEmpty():
        return documents.select(F.col("doc_id").alias("id"), "lang", F.lit(None).cast("double").alias("perplexity"), F.lit(0).cast("long").alias("n"))
    model, contexts, floor = build_model(counts)
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batch = batch_number(math.ceil(size / BATCH_BYTES))
    dealt = documents.select(F.col("doc_id").alias("id"), "lang", "text", batch.alias("batch")).repartition("batch")
    asked = dealt.mapInArrow(_questions, "batch long, gram string")
    # A common sequence is looked up once for each ASKERS batches, whose numbers travel with it.
    grouped = asked.groupBy("gram", F.floor(F.col("batch") / ASKERS).alias("part")).agg(F.collect_list("batch").alias("batches"))
    answers = log_probabilities(grouped, model, contexts, floor).select(F.explode("batches").alias("batch"), "gram", "logp")
    scored = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_score, f"id {kind['doc_id']}, lang {kind['lang']}, perplexity double, n long")
    return stored(scored, "perplexities")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, perplexity, threshold, kept of every row."""
    trusted = stored(trusted_ids(labels), "trusted")
    scored = perplexities(documents, trusted)
    known = scored.join(small_side(trusted, TRUSTED), F.col("id") == F.col("trusted_id"), "left_semi").where("perplexity IS NOT NULL")
    cut = (F.percentile_approx("perplexity", QUANTILE, 10_000) * SLACK).alias("own")
    middle = F.percentile_approx("perplexity", 0.5, 10_000).alias("usual")
    overall, usual = known.agg(cut, middle).first()
    by = known.groupBy(F.col("lang").alias("of")).agg(cut, middle, F.count("*").alias("trusted_n")).where(f"trusted_n >= {LEAST_TRUSTED} AND of IS NOT NULL")
    rows = scored.join(small_side(stored(by, "thresholds"), 100_000), F.col("lang") == F.col("of"), "left")
    # A few words say little: their perplexity counts as if STEADY usual characters stood beside them.
    ours = F.log(F.coalesce("usual", F.lit(usual).cast("double")))
    held = F.exp((F.log("perplexity") * F.col("n") + ours * STEADY) / (F.col("n") + STEADY))
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    rows = rows.select(F.col("id").alias("doc_id"), "lang", "perplexity", threshold.alias("threshold"), held.alias("held"))
    if overall is None:
        texts = documents.select("doc_id", "lang", F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), "text")
        return texts.select("doc_id", "lang", "perplexity", "threshold", F.coalesce(F.regexp_like("text", F.lit(_WORD.pattern)), F.lit(False)).alias("kept"))
    return rows.withColumn("kept", F.coalesce(F.col("held") <= F.col("threshold"), F.lit(False))).drop("held")
