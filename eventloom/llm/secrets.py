"""Secret scans over an incremental blob ledger (DataFrame functions only).

Every version of every path is addressed by the SHA-256 of its text. A blob is
scanned once for each (rule, rule version), whatever paths hold it and however
often: the ledger has a row for each scan of a blob, with the rules it ran and the
spans it found, and a run scans only pairs that no row has. Findings are joined
back to all paths through the blob's address.

A run moves the addresses of all rows, but only the texts of blobs that it scans: an
unchanged corpus ends with a comparison of addresses. Where more addresses are unseen than
can be broadcast, rows meet them in a shuffled join.

Defined cases: a null text is the empty blob; null paths stay rows of their own;
repeated rows each get the findings of their blob; an empty table gives no rows;
columns other than the path columns and the text are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.llm.common import fresh, small_bytes, stored


@dataclass(frozen=True)
class Rule:
    """One kind of secret. ``group`` names the part that must have ``least`` characters (0: the whole match).

    A changed pattern needs a higher ``version``: then it is a new rule to the ledger.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    """ASCII letters in either case; unlike a flag, the same in all engines (some fold s with the long s)."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMED = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))

# The base kinds in their listed order. A run of 32 or more hex digits
# is the only one whose length is in the pattern: shorter runs can't hold a match, so
# the result is that of matching every run and dropping the short ones.
BASE_RULES = (
    Rule("assign", rf"""(?:{_NAMED})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob binary, rules array<string>, spans array<struct<start:int,end:int,kind:string>>"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; none if nothing was written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _matches(text: Column, rule: Rule, rank: int, wanted: Column) -> Column:
    """Every match of the rule in order: characters before it, since the last match, and its own length.

    Also matches that are too short are rows: the search goes on behind them.
    """
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)),
    ).cast("array<struct<gap:string,hit:string,part:string>>")
    rows = F.transform(
        F.filter(zipped, lambda z: z["hit"].isNotNull()),
        lambda z, i: F.struct(
            F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), i.alias("n"), F.length(z["gap"]).alias("gap"),
            F.length(z["hit"]).alias("size"), (F.length(z["part"]) >= rule.least).alias("found"),
        ),
    )
    none = F.array().cast("array<struct<rank:int,kind:string,n:int,gap:int,size:int,found:boolean>>")
    return F.when(wanted & F.regexp_like(text, F.lit(rule.pattern)), rows).otherwise(none)


def scan_new(versions: DataFrame, text: str, ledger: str, rules: Sequence[Rule] = RULES) -> None:
    """Scan the blobs of ``versions`` by those rules that the ledger has no row for; append what was found.

    Copies meet in a partial aggregation before the shuffle by address, so a blob that
    a third of all rows hold arrives once from each task. Positions are running sums
    over one blob's matches; they need no further shuffle.
    """
    rows = versions.select(blob_of(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keys = F.array(*[F.lit(r.key) for r in rules])
    if read_ledger(versions.sparkSession, ledger).isEmpty():
        _scan(rows.groupBy("blob").agg(F.first("text").alias("text")).withColumn("rules", keys), ledger, rules)
        return
    todo = stored(unseen(rows.select("blob"), ledger, rules), "unseen")
    if todo.isEmpty():
        return
    texts = rows.join(small_bytes(todo.select("blob")), "blob", "left_semi").groupBy("blob").agg(F.first("text").alias("text"))
    _scan(texts.join(todo, "blob"), ledger, rules)


def unseen(blobs: DataFrame, ledger: str, rules: Sequence[Rule]) -> DataFrame:
    """(blob, rules): each address once with the rules that no row of the ledger has run on it; none whose rules all have."""
    seen = read_ledger(blobs.sparkSession, ledger).select("blob", F.explode("rules").alias("rule"))
    seen = seen.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    todo = F.array_except(F.array(*[F.lit(r.key) for r in rules]), F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.distinct().join(seen, "blob", "left").select("blob", todo.alias("rules")).where(F.size("rules") > 0)


def _scan(unseen: DataFrame, ledger: str, rules: Sequence[Rule]) -> None:
    """Append the findings of these blobs (blob, text, rules) to the ledger."""
    found = F.concat(*[_matches(F.col("text"), r, k, F.array_contains("rules", r.key)) for k, r in enumerate(rules)])
    rows = unseen.select("blob", "rules", F.explode_outer(found).alias("m")).select("blob", "rules", "m.*")
    upto = Window.partitionBy("blob", "rank").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto).cast("int"))
    span = F.when(F.col("found"), F.struct((F.col("end") - F.col("size")).alias("start"), "end", "kind"))
    done = rows.groupBy("blob").agg(F.first("rules").alias("rules"), F.sort_array(F.collect_list(span)).alias("spans"))
    done.write.mode("append").parquet(ledger)


def scan_versions(versions: DataFrame, path: Sequence[str], text: str, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every row's path columns with the spans (start, rank, kind, end; end exclusive, code points) of its blob.

    The ledger may hold several rows for a blob (rules added later); rows of rules that
    are not in ``rules`` any more are left out by their key.
    """
    scan_new(versions, text, ledger, rules)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    ran = F.array_intersect("rules", F.array(*[F.lit(r.key) for r in rules]))
    rows = read_ledger(versions.sparkSession, ledger).where(F.size("spans") > 0).withColumn("ran", ran)
    spans_of = "filter(spans, s -> exists(ran, r -> substring_index(r, '@', 1) = s.kind))"
    found = rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list(F.expr(spans_of)))).alias("spans"))
    ranked = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), (F.array_position(kinds, s["kind"]) - 1).cast("int").alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    only = versions.select(*path)
    blob, spans = fresh(only, "blob"), fresh(only, "spans")
    found = found.select(F.col("blob").alias(blob), F.sort_array(ranked).alias(spans))
    paths = versions.select(*path, blob_of(F.col(text)).alias(blob))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    return paths.join(found, blob, "left").select(*path, F.coalesce(spans, none).alias(spans))


def joined_spans(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(documents: DataFrame, ledger: str) -> DataFrame:
    """The digest columns of the documents' findings, from the operator's spans."""
    found = scan_versions(documents, ["doc_id"], "text", ledger)
    n = len(BASE_RULES)
    counts = [F.expr(f"size(filter(spans, s -> s.kind = '{r.kind}'))").cast("long").alias(f"n_{r.kind}") for r in BASE_RULES]
    base = F.filter("spans", lambda s: s["rank"] < n)
    return found.select("doc_id", *counts, F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


def _sql_rule(rule: Rule, rank: int) -> str:
    p = rule.pattern.replace("'", "''")
    return (
        f"SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, {rule.least} AS least, string_split_regex(t, '{p}') AS gaps, "
        f"regexp_extract_all(t, '{p}') AS hits, regexp_extract_all(t, '{p}', {rule.group}) AS parts FROM d WHERE regexp_matches(t, '{p}')"
    )


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_sql_rule(r, k) for k, r in enumerate(RULES))}),
e AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
s AS (
  SELECT doc_id, kind, rank, length(hits[i]) AS size, length(parts[i]) >= least AS found,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(hits[1:i], lambda x: length(x))) AS stop
  FROM e),
f AS (SELECT doc_id, kind, rank, stop - size AS start, concat(kind, ':', stop - size, ':', stop) AS txt FROM s WHERE found),
g AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(txt, ',' ORDER BY start, rank) FILTER (rank < {len(BASE_RULES)}) AS base, string_agg(txt, ',' ORDER BY start, rank) AS spans
  FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""
