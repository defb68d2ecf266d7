"""Vector code compression: product codes by k-means over metric trees of the vectors' parts.

1. Vectors become whole numbers, floor(1024 x), and are cut into ``PARTS`` equal parts. A task
   takes its rows in chunks of bounded size and builds, for each chunk and part, the
   anchors-hierarchy tree (:mod:`eventloom.llm.anchors`). Chunks are written once; nothing
   is shuffled for it.
2. A round sends the codebooks (``PARTS`` x ``ENTRIES`` entries) to the chunks. Each tree is walked
   from its root; a ball inherits its parent's candidate entries and drops those that no
   point of it can be nearest to. A ball with one candidate left adds its cached sum and count
   to that entry without looking at its points.
3. A task emits one row for each part and entry, and these sums are added up by Spark. The
   driver gets at most ``PARTS`` x ``ENTRIES`` rows, the new entries.
4. After ``ROUNDS`` rounds the trees are walked once more, for each vector's code and error.

Defined cases: rows whose vector is null, or has a null, non-finite component or one
beyond +-2^43 (whose integers a double doesn't hold) are dropped; so are empty vectors, and
those of another length than the first kept vector by id; a length that ``PARTS`` doesn't divide is an
error. Null ids come after all others; rows of one id are ordered by their components. With
fewer kept rows than entries, each row is one entry. Repeated rows count as often as they
come. Errors beyond a long are its maximum. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import anchors
from eventloom.llm.common import small_bytes, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Components of a chunk of vectors: 4 MB of tree points, whatever the vectors' length.
CHUNK = 1 << 19
LARGEST = float(1 << 43)
LONG_MAX = (1 << 63) - 1


def whole(values: np.ndarray, kind: type) -> np.ndarray:
    """floor(1024 x) as exact whole numbers of type ``kind``."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    return scaled if kind is np.float64 else np.array([int(v) for v in scaled.ravel()], object).reshape(scaled.shape)


def kept_vectors(embeddings: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label") -> DataFrame:
    """(vec_id, label, embedding) of the rows that have a vector of finite components."""
    v = F.col(vector)
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce((x >= F.lit(-LARGEST)) & (x <= F.lit(LARGEST)) & ~F.isnan(x), F.lit(False)))
    return embeddings.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), v.cast("array<double>").alias("embedding")).where(fine)


def _chunks(rows: DataFrame, width: int, parts: int, kind: type) -> DataFrame:
    """One row for each chunk: ids, labels and the pickled trees of its parts."""
    size = max(1, CHUNK // width)
    kinds = dict(rows.dtypes)

    def pack(ids: list, labels: list, vectors: list[np.ndarray]) -> pa.RecordBatch:
        points = whole(np.concatenate(vectors), kind)
        trees = [tuple(anchors.build(np.ascontiguousarray(p))) for p in np.split(points, parts, axis=1)]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(points)], pa.int32()), pa.concat_arrays(values)) for values in (ids, labels)]
        return pa.RecordBatch.from_arrays([*lists, pa.array([pickle.dumps(trees, 5)])], names=["ids", "labels", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, held = [], [], [], 0
        for b in batches:
            flat = b.column("embedding").flatten().to_numpy().reshape(b.num_rows, width)
            at = 0
            while at < b.num_rows:
                n = min(size - held, b.num_rows - at)
                ids.append(b.column("vec_id").slice(at, n))
                labels.append(b.column("label").slice(at, n))
                vectors.append(flat[at : at + n])
                at, held = at + n, held + n
                if held == size:
                    yield pack(ids, labels, vectors)
                    ids, labels, vectors, held = [], [], [], 0
        if held:
            yield pack(ids, labels, vectors)

    return rows.mapInArrow(run, f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, trees binary")


def _sums(chunks: DataFrame, books: list[np.ndarray]) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) to the number and the sum of the parts that it is nearest to."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(books), len(books[0])), np.int64)
        totals = [np.zeros(book.shape, object) for book in books]
        for b in batches:
            for blob in b.column("trees").to_pylist():
                for p, tree in enumerate(anchors.Tree(*t) for t in pickle.loads(blob)):
                    added = np.zeros(books[p].shape, books[p].dtype)
                    for node, entry in anchors.owners(tree, books[p]):
                        if len(entry) == 1:
                            counts[p, entry[0]] += tree.end[node] - tree.start[node]
                            added[entry[0]] += tree.sums[node]
                        else:
                            np.add.at(counts[p], entry, 1)
                            np.add.at(added, entry, tree.points[tree.start[node] : tree.end[node]])
                    # A chunk's sums are exact in the points' type, those of a task in Python integers.
                    used = np.flatnonzero(added.any(axis=1))
                    for e in used:
                        totals[p][e] += np.array([int(v) for v in added[e]], object)
        parts, entries = np.nonzero(counts)
        sums = [[str(v) for v in totals[p][e]] for p, e in zip(parts, entries)]
        yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(entries), pa.array(counts[parts, entries]), pa.array(sums, pa.list_(pa.string()))], names=["part", "entry", "n", "total"])

    rows = chunks.select("trees").mapInArrow(run, "part long, entry long, n long, total array<string>")
    added = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[k].cast("decimal(38,0)")).alias(f"t{k}") for k in range(width)])
    return {(r[0], r[1]): (r[2], [int(v) for v in r[3:]]) for r in added.collect()}  # parts x entries at most


def codebooks(chunks: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after ``rounds`` rounds; an entry that no part is nearest to stays."""
    for _ in range(rounds):
        books = [book.copy() for book in books]
        for (part, entry), (n, total) in _sums(chunks, books).items():
            books[part][entry] = [v // n for v in total]
    return books


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(v)) for book in books for v in book.ravel()).encode()).hexdigest()


def _assigned(chunks: DataFrame, books: list[np.ndarray], kinds: dict[str, str]) -> DataFrame:
    digits = max(2, len(f"{len(books[0]) - 1:x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, blob in enumerate(b.column("trees").to_pylist()):
                ids, labels = b.column("ids")[k].values, b.column("labels")[k].values
                code, error = np.zeros((len(ids), len(books)), np.int64), np.zeros(len(ids), books[0].dtype)
                for p, tree in enumerate(anchors.Tree(*t) for t in pickle.loads(blob)):
                    for node, entry in anchors.owners(tree, books[p]):
                        at = tree.order[tree.start[node] : tree.end[node]]
                        code[at, p] = entry
                        error[at] += ((tree.points[tree.start[node] : tree.end[node]] - books[p][entry]) ** 2).sum(axis=1)
                text = ["".join(f"{e:0{digits}x}" for e in row) for row in code.tolist()]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text), pa.array([min(int(e), LONG_MAX) for e in error])], names=["vec_id", "label", "code", "error"])

    return chunks.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every kept row, and the codebooks (empty without rows)."""
    kept = kept_vectors(embeddings, vector, vec_id, label)
    kinds = dict(kept.dtypes)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(1).collect()
    if not first:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    width = len(first[0]["embedding"])
    if width % parts:
        raise ValueError(f"vectors of {width} components have no {parts} equal parts")
    kept = kept.where(F.size("embedding") == width)
    # Equal ids and embeddings are equal entries, so any order among them is the same.
    starts = kept.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    most = kept.agg(F.max(F.array_max(F.transform("embedding", F.abs)))).first()[0]
    kind = anchors.exact_type((math.floor(most) + 1) * SCALE, width)
    chunks = stored(_chunks(kept, width, parts, kind), "trees")
    books = [np.ascontiguousarray(b) for b in np.split(whole(np.array([r["embedding"] for r in starts]), kind), parts, axis=1)]
    books = codebooks(chunks, books, rounds)
    return _assigned(chunks, books, kinds), books


def code_digest(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept row."""
    codes, books = compress(embeddings)
    codes = stored(codes, "codes")
    labels = codes.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"))
    labels = small_bytes(stored(labels, "label-errors").withColumnRenamed("label", "of"))
    joined = codes.join(labels, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    rounds = []
    for k in range(ROUNDS + 1):
        rounds.append(f"""a{k} AS MATERIALIZED (
  SELECT x.r, x.part, min_by(e.entry, (list_sum(list_transform(list_zip(x.w, e.w), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e.entry)) AS entry,
    min(list_sum(list_transform(list_zip(x.w, e.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d
  FROM x JOIN b{k} e ON x.part = e.part GROUP BY x.r, x.part)""")
        if k < ROUNDS:
            rounds.append(f"""s{k} AS MATERIALIZED (
  SELECT part, entry, list(v ORDER BY j) AS w FROM (
    SELECT part, entry, j, floor(sum(v) / count(*))::BIGINT AS v FROM (
      SELECT x.part, a.entry, unnest(x.w) AS v, generate_subscripts(x.w, 1) AS j FROM x JOIN a{k} a USING (r, part)) GROUP BY part, entry, j)
  GROUP BY part, entry),
b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(s.w, b.w) AS w FROM b{k} b LEFT JOIN s{k} s ON b.part = s.part AND b.entry = s.entry)""")
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda y: floor(1024 * y::DOUBLE)::BIGINT) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (SELECT r, part, w[part * len(w) // {PARTS} + 1 : (part + 1) * len(w) // {PARTS}] AS w FROM v, (SELECT unnest(range({PARTS})) AS part)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, w FROM x WHERE r <= {ENTRIES}),
{", ".join(rounds)},
c AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM v JOIN c USING (r), h
"""


ORACLE = _oracle()
