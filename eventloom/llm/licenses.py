"""License scans: exact set-similarity join of text blocks with license templates.

A block meets a template if it has at least ``CONTAINED`` of the template's distinct
words, and all of its naming words (``NAMES``: without them a sentence about some other
license, of the same common words, would do). Blocks are windows over a paragraph's words, across
its line ends: of ``LINE`` words for short templates, of ``PARAGRAPH`` words for longer ones. A window
starts every half window, so any stretch of half a window lies in one.

The join: words are ordered by their number of short blocks in the whole corpus, rarest first.
With c the least number of common words, a template's prefix is its first n - c + 1 words
and a block's its first m - c + 1; if no word is in both prefixes, fewer than c can be
common. Blocks of fewer than c words can't meet the template (length filter), nor can
those where too few words stand behind the common one in either (positional filter). What
is left is verified by the words themselves. Only words of some template count for that,
so blocks carry no others. The templates are a parameter; they bound what is broadcast.

Defined cases: a null or empty text has no words, labels or places, and a score of 0;
repeated rows each have their own result; an empty table gives no rows; columns other
than the id and the text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored

CONTAINED = 0.8
#: Templates of up to so many distinct words are looked for in windows of LINE words.
SHORT = 16
LINE, PARAGRAPH = 64, 400

# On UTF-8 bytes: lower() changes A-Z alone, and all bytes of other scripts belong to words.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# The base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices as their licenses word them, and the one-line forms that stand for them.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
)

#: Words that name a license: a template that has some isn't met without them.
NAMES = frozenset(("apache", "commons", "creative", "gnu", "mit", "nc", "redistribution"))


class Template(NamedTuple):
    number: int
    label: str
    words: frozenset[str]
    short: bool
    least: int

    @property
    def names(self) -> list[str]:
        return sorted(self.words & NAMES)


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def prepared(templates: Sequence[tuple[str, str]] = TEMPLATES, contained: float = CONTAINED) -> list[Template]:
    out = []
    for k, (label, text) in enumerate(templates):
        words = frozenset(w.decode() for w in words_of(text.encode()))
        tenths = round(contained * 10)
        out.append(Template(k, label, words, len(words) <= SHORT, -(-len(words) * tenths // 10)))
    return out


def windows(words: list[bytes], size: int) -> Iterator[tuple[int, list[bytes]]]:
    """(start, words) of windows of ``size`` words, one every half of it."""
    step = size // 2
    for at in range(0, max(1, len(words) - step), step):
        yield at, words[at : at + size]


def phrase_places(words: list[bytes], phrases: Sequence[tuple[str, str]] = PHRASES) -> dict[str, list[int]]:
    """label -> starts of the places where the phrase's words stand one after the other."""
    out: dict[str, list[int]] = {}
    for phrase, label in phrases:
        p = phrase.encode().split(b" ")
        at = -1
        try:
            while True:
                at = words.index(p[-1], at + 1)
                start = at - len(p) + 1
                if start >= 0 and words[start : at + 1] == p:
                    out.setdefault(label, []).append(start)
        except ValueError:
            pass
    return out


_PARTS = "row long, id {id}, part string, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, word string, n long, short boolean, start long, words array<string>"
_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def _parts(templates: list[Template]):
    """Of each text: its base result ('d'), the blocks that are long enough ('b'), and of each batch the short blocks of each word ('t')."""
    vocabulary = frozenset(w.encode() for t in templates for w in t.words)
    least = {s: min((t.least for t in templates if t.short == s), default=None) for s in (True, False)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, blocks_with = [], Counter()
            for row, key, text in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "text"))):
                every: list[bytes] = []
                paragraph: list[bytes] = []
                blocks = []

                def close() -> None:
                    for at, w in windows(paragraph, LINE) if paragraph else ():
                        blocks.append((True, len(every) - len(paragraph) + at, w))
                    if least[False] is not None and len(paragraph) >= least[False]:
                        for at, w in windows(paragraph, PARAGRAPH):
                            blocks.append((False, len(every) - len(paragraph) + at, w))
                    paragraph.clear()

                for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
                    w = words_of(line)
                    if not w:
                        if not line.strip():
                            close()
                        continue
                    every += w
                    paragraph += w
                close()
                for short, at, w in blocks:
                    known = vocabulary.intersection(w)
                    if short:
                        blocks_with.update(known)
                    if known and least[short] is not None and len(known) >= least[short]:
                        rows.append((row, None, "b", None, None, None, None, None, None, None, short, at, sorted(w.decode() for w in known)))
                places = phrase_places(every)
                starts = [s for x in places.values() for s in x]
                rows.append((row, key, "d", len(every), len(starts), min(starts, default=None), max(starts, default=None), sorted(places), None, None, None, None, None))
            rows += [(None, None, "t", None, None, None, None, None, w.decode(), n, None, None, None) for w, n in blocks_with.items()]
            kinds = [(c.split()[0], _ARROW.get(c.split()[1], batch.schema.field("id").type)) for c in _PARTS.split(", ")]
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(columns, kinds)], names=[n for n, _ in kinds])

    return run


def met_templates(blocks: DataFrame, counts: DataFrame, templates: list[Template]) -> DataFrame:
    """(row, start, template, label, containment) of every block that meets a template."""
    spark = blocks.sparkSession
    # At most the templates' words: a bounded table, whatever the corpus.
    seen = {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    order = sorted(frozenset().union(*(t.words for t in templates)), key=lambda w: (seen.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    prefix, whole = [], []
    for t in templates:
        inorder = sorted(t.words, key=rank.__getitem__)
        whole.append((t.number, t.label, inorder, t.names))
        prefix += [(w, t.number, t.short, k, len(inorder), t.least) for k, w in enumerate(inorder[: len(inorder) - t.least + 1])]
    prefixes = F.broadcast(spark.createDataFrame(prefix, "word string, template int, for_short boolean, t_at int, t_size int, least int"))
    wholes = F.broadcast(spark.createDataFrame(whole, "template int, label string, t_words array<string>, t_names array<string>"))
    ranks = F.create_map(*[x for w, k in rank.items() for x in (F.lit(w), F.lit(k))])
    inorder = F.transform(F.array_sort(F.transform("words", lambda w: F.struct(ranks[w].alias("rank"), w.alias("word")))), lambda s: s["word"])
    blocks = blocks.select("row", "short", "start", inorder.alias("words"))
    b = blocks.select("row", "short", "start", F.size("words").alias("b_size"), F.posexplode("words").alias("b_at", "word"), "words")
    both = b.join(prefixes, "word").where("short = for_short AND b_size >= least AND b_at <= b_size - least")
    both = both.where("1 + least(t_size - t_at - 1, b_size - b_at - 1) >= least")
    # One row for each block and template, by the first common word of their prefixes.
    pairs = both.join(wholes, "template").withColumn("common", F.array_intersect("words", "t_words"))
    pairs = pairs.where((F.size("common") >= F.col("least")) & (F.element_at("common", 1) == F.col("word")))
    pairs = pairs.where(F.size(F.array_except("t_names", "words")) == 0)
    return pairs.select("row", "start", "template", "label", (F.size("common") / F.col("t_size")).alias("containment"))


def scan(documents: DataFrame, id_col: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES) -> tuple[DataFrame, DataFrame]:
    """(one row for each document with its base result, one row for each block and template that it meets).

    Both have ``row``, a number of the document's row.
    """
    ready = prepared(templates)
    numbered = documents.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    parts = stored(numbered.mapInArrow(_parts(ready), _PARTS.format(id=dict(documents.dtypes)[id_col])), "license_parts")
    found = met_templates(parts.where("part = 'b'"), parts.where("part = 't'"), ready)
    return parts.where("part = 'd'").select("row", "id", "n_words", "n_base", "first_word", "last_word", "base_labels"), found


def license_digest(documents: DataFrame) -> DataFrame:
    base, found = scan(documents)
    found = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    rows = base.join(found, "row", "left")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )


_TOKENS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TEMPLATE_ROWS = ", ".join(
    f"('{t.label}', {str(t.short).lower()}, [{', '.join(repr(w) for w in sorted(t.words))}], {t.least}, [{', '.join(repr(w) for w in t.names)}]::VARCHAR[])" for t in prepared())
_PHRASE_ROWS = ", ".join(f"('{label}', [{', '.join(repr(w) for w in phrase.split())}])" for phrase, label in PHRASES)
#: Every block against every template and every place against every phrase.
ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
l AS (
  SELECT r, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS ln FROM d),
lw AS (
  SELECT r, ln, regexp_extract_all(line, '{_TOKENS}') AS w,
    sum(CASE WHEN regexp_full_match(line, '[\\x20\\x09-\\x0D]*') THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY ln) AS p FROM l),
pw AS (SELECT r, p, flatten(list(w ORDER BY ln)) AS w FROM lw GROUP BY r, p),
b AS (
  SELECT r, true AS short, w[a + 1 : a + {LINE}] AS w FROM (
    SELECT r, w, unnest(range(0, greatest(1, len(w) - {LINE // 2}), {LINE // 2})) AS a FROM pw WHERE len(w) > 0)
  UNION ALL
  SELECT r, false AS short, w[a + 1 : a + {PARAGRAPH}] AS w FROM (
    SELECT r, w, unnest(range(0, greatest(1, len(w) - {PARAGRAPH // 2}), {PARAGRAPH // 2})) AS a FROM pw WHERE len(w) > 0)),
tm(label, short, words, least_words, names) AS (VALUES {_TEMPLATE_ROWS}),
m AS (
  SELECT r, label, len(list_intersect(words, w)) AS n, len(words) AS size, least_words
  FROM b JOIN tm ON b.short = tm.short AND len(w) >= least_words AND list_has_all(w, names)),
f AS (SELECT r, list(DISTINCT label) AS more, max(n / size) AS best FROM m WHERE n >= least_words GROUP BY r),
dw AS (SELECT r, doc_id, regexp_extract_all(t, '{_TOKENS}') AS w FROM d),
ph(label, words) AS (VALUES {_PHRASE_ROWS}),
pl AS (
  SELECT r, label, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i] = words[1] AND w[i : i + len(words) - 1] = words)) - 1 AS spot
  FROM dw JOIN ph ON list_contains(w, words[1])),
g AS (SELECT r, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list(DISTINCT label) AS base FROM pl GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base, []::VARCHAR[])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []::VARCHAR[]), coalesce(more, []::VARCHAR[])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM dw LEFT JOIN g USING (r) LEFT JOIN f USING (r)
"""
