"""Quality rules as weak supervision.

Each rule votes that a document is good or bad, or abstains. Votes are counted over all
documents by their pattern: nine rules with at most three votes have 3^9 = 19,683 patterns
at most, whatever the number of documents, so expectation-maximisation runs on that table
alone. It estimates each rule's accuracy on good and on bad documents (how often its
votes are right there; whether it abstains says nothing) and the share of good
documents; a pattern's posterior probability of good decides. Two accuracies and not
one, since most rules know one fault each: they pass nearly all good documents
and catch some of the bad ones, so that their good vote says little and their bad one much.

The estimates start from, and are held by pseudo-counts to, ``PROSE`` and ``FAULT``:
without labels nothing else says which of two classes is the good one. From there a
bad vote is outweighed by three good ones of other rules; bad votes for prose and for one fault
are not by the other seven. What the corpus teaches can change that.

Defined cases: a null or empty text has no words, fails the base limits and is not
kept; repeated rows get equal verdicts; an empty table gives no rows; other columns pass
through the filter unread, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import fresh, stored

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"

#: Base limits: fewer words, or more than this share of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 0.5
KEEP_FROM = 0.5

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_shouted long, n_marks long, n_distinct long, n_plain long"
NAMES = [c.split()[0] for c in COUNTS.split(", ")]

#: Where estimates start: the share of a rule's votes that are right on good and on bad documents. Prose tells
#: both kinds; a fault is rare in good documents and is found in some of the bad ones.
PROSE, FAULT = (0.9, 0.9), (0.97, 0.3)
#: The share of good documents at the start, and the share of all documents that the pseudo-counts weigh.
GOOD_SHARE, HELD = 0.8, 0.05
#: For each rule its measure, where it votes bad and good (it abstains elsewhere), and its start.
RULES: dict[str, tuple[str, str, str, tuple[float, float]]] = {
    "prose": ("n_plain / n_words", "< 0.6", ">= 0.9", PROSE),
    "symbols": ("n_symbols / n_words", "> 0.3", "<= 0.1", FAULT),
    "repetition": ("n_repeat_words / n_words", "> 0.3", "<= 0.1", FAULT),
    "duplicate_lines": ("n_dup_lines / n_lines", "> 0.6", "<= 0.2", FAULT),
    "capitals": ("n_upper / n_words", "> 0.5", "<= 0.1", FAULT),
    "shouting": ("n_shouted / n_words", "> 0.3", "<= 0.1", FAULT),
    "bare_marks": ("n_marks / n_words", "> 0.2", "<= 0.05", FAULT),
    "variety": ("n_distinct / sqrt(n_words)", "< 2", ">= 4", FAULT),
    "word_length": ("abs(word_chars / n_words - 6)", "> 5", "<= 3", FAULT),
}


def counts_of(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    text = text or ""
    words = _WORD.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            seen = Counter(windows)
            reach = 0  # words before it are counted
            for k, w in enumerate(windows):
                if seen[w] > 1:
                    repeated += k + 3 - max(k, reach)
                    reach = k + 3
    return (
        n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines),
        sum(1 for w in words if len(w) > 1 and w.isupper()), sum(1 for w in words if w[-1] in "!?"),
        sum(1 for w in words if not (w[0].isalnum() or w[-1].isalnum())), len(set(words)),
        sum(1 for w in words if w.isalpha() or (w[-1] in ".,;:?" and w[:-1].isalpha())),
    )


def text_counts(text: Column) -> Column:
    """The counts as a struct column. Only the text goes to Python."""

    @F.pandas_udf(COUNTS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([counts_of(t) for t in b], columns=NAMES).astype("int64")

    # Said to be nondeterministic so that a filter on the counts is not pushed below, which would count twice.
    return run.asNondeterministic()(text)


def votes(c: str) -> Column:
    """The pattern of a counts struct: one of - 0 + for each rule. No words, no votes."""
    out = []
    for measure, bad, good, _ in RULES.values():
        value = re.sub(r"\w+", lambda m: f"{c}.{m[0]}" if m[0] in NAMES else m[0], measure)
        out.append(f"CASE WHEN {c}.n_words = 0 THEN '0' WHEN {value} {bad} THEN '-' WHEN {value} {good} THEN '+' ELSE '0' END")
    return F.expr(f"concat({', '.join(out)})")


def fit(patterns: dict[str, int], rounds: int = 500, tol: float = 1e-9) -> tuple[dict[str, float], float, dict[str, float]]:
    """Expectation-maximisation over pattern counts: P(good) of each pattern, the share of good, the share of each rule's votes that are right."""
    names = sorted(patterns)
    n = np.array([patterns[p] for p in names], float)
    marks = np.array([list(p) for p in names]).reshape(len(names), len(RULES))
    plus, minus = (marks == "+").astype(float), (marks == "-").astype(float)
    start_good, start_bad = np.array([start for *_, start in RULES.values()]).T
    held = max(10.0, HELD * n.sum())
    held_good, held_bad = held * GOOD_SHARE, held * (1 - GOOD_SHARE)
    on_good, on_bad, share, good = start_good, start_bad, GOOD_SHARE, np.full(len(names), -1.0)
    for _ in range(rounds):
        odds = plus @ np.log(on_good / (1 - on_bad)) - minus @ np.log(on_bad / (1 - on_good)) + np.log(share / (1 - share))
        now = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(now - good).max(initial=0) < tol:
            break
        good = now
        is_good, is_bad = n * good, n * (1 - good)
        on_good = (is_good @ plus + held_good * start_good) / (is_good @ (plus + minus) + held_good)
        on_bad = (is_bad @ minus + held_bad * start_bad) / (is_bad @ (plus + minus) + held_bad)
        share = (is_good.sum() + held_good) / (n.sum() + held)
    right = (n * good) @ plus + (n * (1 - good)) @ minus
    accuracy = (right + held_good * start_good + held_bad * start_bad) / (n @ (plus + minus) + held)
    return dict(zip(names, good.tolist())), float(share), dict(zip(RULES, accuracy.tolist()))


def _posterior(marked: DataFrame, pattern: str, p_good: str) -> DataFrame:
    """(pattern, p_good): 3^9 rows at most; the same bound holds for what comes to the driver."""
    seen = {r[0]: r[1] for r in marked.groupBy(pattern).count().collect()}
    rows = list(fit(seen)[0].items())
    return F.broadcast(marked.sparkSession.createDataFrame(rows, f"`{pattern}` string, `{p_good}` double"))


def base_failed(c: str = "") -> Column:
    return F.expr(f"{c}n_words < {LEAST_WORDS} OR 100 * {c}n_repeat_words > {int(100 * MOST_REPEATED)} * {c}n_words")


def judge(documents: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, the counts, base_failed, the votes, p_good and kept of every row. Texts are read once and not shuffled."""
    counted = documents.select(F.col(id_col), text_counts(F.col(text)).alias("c")).withColumn("votes", votes("c"))
    counted = stored(counted.select(id_col, "c.*", "votes"), "counts").withColumn("base_failed", base_failed())
    judged = counted.join(_posterior(counted, "votes", "p_good"), "votes")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_FROM))


def keep_good(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows that are kept, their columns as they are. Counting twice costs less than shuffling texts to their verdicts."""
    c, pattern, p = fresh(documents, "quality_counts"), fresh(documents, "quality_votes"), fresh(documents, "quality_p")
    counted = documents.withColumn(c, text_counts(F.col(text))).withColumn(pattern, votes(c))
    table = _posterior(counted.select(pattern), pattern, p)
    good = ~base_failed(f"{c}.") & (F.col(p) >= KEEP_FROM)
    return counted.join(table, pattern).where(good).select(*[F.col(f"`{x}`") for x in documents.columns])


def quality_digest(documents: DataFrame) -> DataFrame:
    return judge(documents).select("doc_id", *NAMES[:5], "base_failed", "kept", "p_good", "votes")
