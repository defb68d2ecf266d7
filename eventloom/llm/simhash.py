"""SimHash near-dedup with pivot distance tables.

1. A document's fingerprint has a bit set if over half of its shingles' hashes have it.
2. Equal fingerprints are one class, so copies are never compared with each other.
3. For each class the pivot distance table has its Hamming distances to ``PIVOTS``
   reference fingerprints.
4. Pairs of classes are discarded if any of these distances differ by more than the
   maximum bit distance (the triangle inequality: no linked pair is lost), and the
   survivors are verified by their differing bits.
5. Components of the linked classes, by ``graph.components``.

Pivot distances alone can't say which pairs to look at: unrelated fingerprints are 32
+- 4 bits from any pivot, so one pivot lets about 57 % of all pairs pass. The
pairs that step 4 takes are those that agree on two of six bit blocks. At most four
differing bits touch at most four blocks, so every linked pair agrees on two at least.

Rows with equal blocks are a bucket. One of up to ``BUCKET`` classes is compared in a
task, in blocks, which gives a spanning forest of its links and not all of them. A
larger one (a crowd of near copies) links each class to all fingerprints within half
the maximum distance: two classes share such a midpoint if and only if they are
linked. That work grows with the classes and not with their pairs.

Defined cases: null and empty texts have no words; their fingerprint is zero and links
like any other; a text of fewer words than a shingle is hashed as one; repeated rows
are copies; null ids get the component of their fingerprint, whose id is the least
non-null one (null if there is none); an empty table gives no rows; columns other than
id and text are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import fresh, small_side, stored
from eventloom.llm.graph import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
PIVOTS = 8
#: Classes of a bucket that one task compares with each other.
BUCKET = 4_096
BLOCKS = (11, 11, 11, 11, 10, 10)

#: Bytes of a text whose words are held at once; a piece ends at white space.
PIECE = 1 << 20

# On UTF-8 bytes, whose lower() changes A-Z alone.
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _shingles(text: bytes, shingle: int, piece: int) -> Iterator[np.ndarray]:
    """The hashes of the shingles, one array for each piece of the text; each piece goes on with the last words of the one before."""
    words, at, whole = [], 0, True
    digest = xxhash.xxh64_intdigest
    while at < len(text):
        stop = _SPACE.search(text, at + piece)
        end = stop.start() if stop else len(text)
        words += _WORD.findall(text, at, end)
        at = end
        n = len(words) - shingle + 1
        if n < 1:
            continue
        line = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes).tolist()
        ends = ends.tolist()
        yield np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])), np.uint64, n)
        words, whole = words[n:], False
    if whole and words:
        yield np.array([digest(b" ".join(words), SEED)], np.uint64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE, piece: int = PIECE) -> int:
    """The 64 bits of one text in UTF-8."""
    n, counts = 0, np.zeros(64, np.int64)
    for hashes in _shingles(text.lower() if text else b"", shingle, piece):
        n += len(hashes)
        for at in range(0, len(hashes), 8192):  # 8192 hashes are 512 KB of bits
            part = hashes[at : at + 8192]
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, row: str | None = None) -> DataFrame:
    """(id, fp) of every row; fp is the fingerprint as a signed long. With ``row``, a long column of that name, (id, row, fp)."""
    keys = {"id": id_col} | ({"row": row} if row else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # One text at a time: a batch of long ones is not copied whole.
            texts = (t.as_buffer().to_pybytes() if t.is_valid else None for t in b.column("text"))
            fps = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, b.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(fps)], names=[*keys, "fp"])

    kinds = dict(documents.dtypes)
    read = documents.select(*[F.col(c).alias(k) for k, c in keys.items()], F.col(text).alias("text"))
    return read.mapInArrow(run, ", ".join(f"{k} {kinds[c]}" for k, c in keys.items()) + ", fp long")


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: signed longs from a hash of their number."""
    return [xxhash.xxh64_intdigest(b"pivot-%d" % k, SEED) - (1 << 63) for k in range(n)]


def pivot_table(fp: Column) -> Column:
    """The Hamming distances to the pivots, a byte each, packed in a long."""
    out = F.lit(0).cast("long")
    for k, p in enumerate(pivots()):
        out = out.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long"), 8 * k))
    return out


def block_keys(fp: Column, max_bits: int = MAX_BITS) -> Column:
    """For each two of the blocks (bits of two blocks, number of the pair)."""
    if max_bits > len(BLOCKS) - 2:
        raise ValueError(f"two blocks agree for certain up to {len(BLOCKS) - 2} differing bits")
    masks, at = [], 0
    for size in BLOCKS:
        masks.append(((1 << size) - 1) << at)
        at += size
    signed = [m - (1 << 64) if m >> 63 else m for m in (a | b for a, b in itertools.combinations(masks, 2))]
    return F.array(*[F.struct(F.lit(k).cast("byte").alias("pair"), fp.bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(signed)])


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _forest(fps: np.ndarray, coords: np.ndarray, max_bits: int, step: int = 512) -> list[tuple[int, int]]:
    """Links that connect what the links of this bucket connect: its classes less one at most."""
    n, out = len(fps), []
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(0, n, step):
        for j in range(i, n, step):
            a, b = np.arange(i, min(i + step, n)), np.arange(j, min(j + step, n))
            near = np.ones((len(a), len(b)), bool) if i != j else np.triu(np.ones((len(a), len(b)), bool), 1)
            for k in range(coords.shape[1]):
                near &= np.abs(coords[a, k][:, None] - coords[b, k][None, :]) <= max_bits
            x, y = np.nonzero(near)
            hit = np.bitwise_count(fps[a[x]] ^ fps[b[y]]) <= max_bits
            for p, q in zip(a[x[hit]].tolist(), b[y[hit]].tolist()):
                rp, rq = find(p), find(q)
                if rp != rq:
                    parent[max(rp, rq)] = min(rp, rq)
                    out.append((p, q))
    return out


def _compare(max_bits: int):
    """Over rows sorted by bucket: the links of each bucket that ends, the rest carried over to the next batch."""

    def links(pair: np.ndarray, bits: np.ndarray, fp: np.ndarray, table: np.ndarray) -> pd.DataFrame:
        first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (bits[1:] != bits[:-1])])
        size = np.diff(np.r_[first, len(fp)])
        coords = table.view(np.uint8).reshape(-1, 8).astype(np.int16)
        fps, a, b = fp.view(np.uint64), [], []
        for n in np.unique(size[(size > 1) & (size <= 16)]).tolist():  # all small buckets of one size at once
            at = first[size == n]
            x, y = np.triu_indices(n, 1)
            i, j = (at[:, None] + x).ravel(), (at[:, None] + y).ravel()
            keep = (np.abs(coords[i] - coords[j]) <= max_bits).all(axis=1)
            i, j = i[keep], j[keep]
            keep = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
            a.append(fp[i[keep]])
            b.append(fp[j[keep]])
        for at, n in zip(first[size > 16].tolist(), size[size > 16].tolist()):
            found = _forest(fps[at : at + n], coords[at : at + n], max_bits)
            a.append(fp[[at + p for p, _ in found]] if found else fp[:0])
            b.append(fp[[at + q for _, q in found]] if found else fp[:0])
        none = np.zeros(0, np.int64)
        return pd.DataFrame({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if rest is not None and len(rest):
                batch = pd.concat([rest, batch], ignore_index=True)
            if not len(batch):
                continue
            pair, bits = batch["pair"].to_numpy(), batch["bits"].to_numpy()
            ends = np.flatnonzero((pair[1:] != pair[:-1]) | (bits[1:] != bits[:-1]))
            cut = int(ends[-1]) + 1 if len(ends) else 0
            rest, done = batch.iloc[cut:], batch.iloc[:cut]
            if len(done):
                yield links(*(np.ascontiguousarray(done[c].to_numpy()) for c in ("pair", "bits", "fp", "pivots")))
        if rest is not None and len(rest):
            yield links(*(np.ascontiguousarray(rest[c].to_numpy()) for c in ("pair", "bits", "fp", "pivots")))

    return run


def _midpoint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links over shared midpoints: every class to the least one that shares a fingerprint within half the distance."""
    masks = [0] + [sum(1 << b for b in c) for r in range(1, (max_bits + 1) // 2 + 1) for c in itertools.combinations(range(64), r)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    spread = fps.select("fp", F.explode(F.transform(F.array(*[F.lit(m) for m in signed]), lambda m: F.col("fp").bitwiseXOR(m))).alias("mid"))
    least = spread.groupBy("mid").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    links = spread.join(least, "mid").select(F.col("fp").alias("a"), "b").where("a != b").distinct()
    # An odd maximum distance has midpoints at unequal halves; those that are too far apart are no links.
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits) if max_bits % 2 else links


def near_links(classes: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): pairs of the distinct fingerprints ``fp`` of ``classes`` whose links connect what all links connect."""
    if max_bits % 2:
        raise ValueError("an even maximum distance has midpoints")
    keyed = classes.select("fp", F.explode(block_keys(F.col("fp"), max_bits)).alias("k")).select("k.pair", "k.bits", "fp")
    sizes = keyed.groupBy("pair", "bits").agg(F.count("*").alias("n")).where("n > 1")
    keyed = stored(keyed.join(sizes, ["pair", "bits"]), "buckets")
    usual = keyed.where(F.col("n") <= bucket).withColumn("pivots", pivot_table(F.col("fp")))
    usual = usual.repartition("pair", "bits").sortWithinPartitions("pair", "bits", "fp")
    links = usual.select("pair", "bits", "fp", "pivots").mapInPandas(_compare(max_bits), "a long, b long")
    crowded = keyed.where(F.col("n") > bucket).select("fp").distinct()
    return links.union(_midpoint_links(crowded, max_bits))


def _rooted(marked: DataFrame, first: Column, max_bits: int, bucket: int) -> DataFrame:
    """(fp, first, root) of every distinct fingerprint: the least ``first`` of its rows, and one fingerprint for each component."""
    classes = stored(marked.groupBy("fp").agg(F.min(first).alias("first")), "classes")
    linked = components(near_links(classes, max_bits, bucket))
    linked = stored(linked.select(F.col("node").alias("fp"), F.col("component").alias("root")), "linked")
    return classes.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_groups(documents: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(id, fp, component_id) of every row; component_id is the least id that links lead to."""
    marked = stored(fingerprints(documents, id_col, text, shingle), "fingerprints")
    rooted = _rooted(marked, F.col("id"), max_bits, bucket)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = stored(rooted.join(least, "root").select("fp", "component_id"), "components")
    # A fingerprint that many rows share is a hot key of this join; its other side has one row for each.
    return marked.join(of, "fp").select("id", "fp", "component_id")


def simhash_digest(documents: DataFrame) -> DataFrame:
    found = near_groups(documents)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(documents: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group: that with the least id, one with a null id only if the group has no other.

    Rows are told apart by a stored number and not by their id, which may be null or
    that of other texts, too. The numbers to drop are joined, not those to keep: texts
    are shuffled only if those are too many to broadcast.
    """
    row = fresh(documents, "row")
    numbered = stored(documents.withColumn(row, F.monotonically_increasing_id()), "rows")
    marked = stored(fingerprints(numbered, id_col, text, row=row), "fingerprints")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    rooted = _rooted(marked, first, MAX_BITS, BUCKET)
    keep = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.row")
    drop = stored(marked.select("row").join(keep, "row", "left_anti").select(F.col("row").alias(fresh(numbered, "gone"))), "drop")
    return numbered.join(small_side(drop, 1_000_000), F.col(row) == F.col(drop.columns[0]), "left_anti").drop(row)
