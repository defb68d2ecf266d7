"""Command line: ``python -m eventloom ship ...`` and ``python -m eventloom search ...``.

Runs under ``spark-submit`` (or plain ``python`` with a local session); every step
is a Spark job, the command line only reads options.

ship    lines of event files (``--file``) or rows of a table formatted as events
        (``--table``) -> destination -> payloads -> one POST per payload (``--url``)
        or the MD5 test sender; prints per-destination totals.
search  a Spark SQL predicate (inline, or from ``--searchfile``: lines whose first
        non-blank character is ``#`` are skipped, the rest joined with spaces) over
        a table, in an ``--earliest``/``--latest`` window; prints the counters and
        writes the results in ``--omode`` to ``--outfile`` (nothing when empty).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventloom.functions.timerange import DEFAULT_EARLIEST, DEFAULT_LATEST
from eventloom.operators.batching import BLOCK_SIZE, MAX_PAYLOAD
from eventloom.operators.format import DESTINATION, with_destination
from eventloom.plans.search import run_search
from eventloom.plans.ship import batch_file_lines, ship, table_batches
from eventloom.sinks.deliver import md5_sender
from eventloom.sinks.export import MODES
from eventloom.sinks.http import http_post_sender
from eventloom.sources.text import read_event_file


#: Destinations whose totals are printed, and the most lines that a search file has.
SHOWN, SEARCH_LINES = 100, 10_000


def read_search_file(spark: SparkSession, path: str) -> str:
    """The predicate in a search file: non-comment lines joined with spaces (a small
    driver-side read of one file)."""
    lines = [r.value for r in spark.read.text(path).limit(SEARCH_LINES + 1).collect()]
    if len(lines) > SEARCH_LINES:
        raise SystemExit(f"{path} has over {SEARCH_LINES} lines: not a search file")
    kept = [line for line in lines if not line.strip().startswith("#")]
    text = " ".join(kept).strip()
    if not text:
        raise SystemExit(f"no search expression found in {path}")
    return text


def _headers(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs:
        k, sep, v = p.partition("=")
        if not sep:
            raise SystemExit(f"--header takes NAME=VALUE, got {p!r}")
        out[k.strip()] = v.strip()
    return out


def cmd_ship(spark: SparkSession, a: argparse.Namespace) -> dict:
    if bool(a.file) == bool(a.table):
        raise SystemExit("give exactly one of --file or --table")
    if a.file:
        lines = read_event_file(spark, a.file)
        routed = with_destination(lines, index=a.index, source=a.source, sourcetype=a.sourcetype)
        payloads = batch_file_lines(routed, a.block_size)
    else:
        if not a.order:
            raise SystemExit("--table needs --order (a unique event order, e.g. an event id)")
        rows = spark.read.format(a.table_format).load(a.table)
        names = a.fields.split(",") if a.fields else [c for c in rows.columns if c != a.ts]
        # a data column named like a destination is written from a copy of its own
        # value, and is that destination's default unless overridden
        taken = [d for d in DESTINATION if d in rows.columns]
        rows = rows.select("*", *[F.col(d).alias(f"__field_{d}") for d in taken])
        fields = [(n, f"__field_{n}") if n in taken else (n, n) for n in names]
        routed = with_destination(rows, index=a.index, source=a.source, sourcetype=a.sourcetype,
                                  defaults={d: F.col(f"__field_{d}") for d in taken})
        payloads = table_batches(routed, a.order.split(","), fields, a.ts or None, a.delim, a.block_size)
    send = http_post_sender(a.url, _headers(a.header), a.timeout) if a.url else md5_sender
    receipts, rejected, totals = ship(payloads, send, a.limit, a.receipts, a.tasks, a.send_order, a.shipment)
    out = {"destinations": totals.count(), "rejected_batches": rejected.count()}
    most = totals.orderBy(F.desc("read_bytes")).limit(SHOWN)  # printed; the ledger has all
    return {**out, "totals": [r.asDict() for r in most.collect()]}


def cmd_search(spark: SparkSession, a: argparse.Namespace) -> dict:
    predicate = read_search_file(spark, a.searchfile) if a.searchfile else a.query
    if not predicate:
        raise SystemExit("a search expression or --searchfile is required")
    df = spark.read.format(a.table_format).load(a.table)
    res = run_search(df, predicate, a.outfile, a.omode, a.earliest or None, a.latest or None, a.now,
                     a.time_col, a.order_by.split(",") if a.order_by else None, a.offset, a.count, a.dequote)
    return {"scan_count": res.scan_count, "event_count": res.event_count, "result_count": res.result_count,
            "output": res.path}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m eventloom")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("ship", help="ship a file (or folder) of events")
    s.add_argument("--file", help="event file or folder, one event per line")
    s.add_argument("--table", help="table whose rows are formatted as events")
    s.add_argument("--table-format", default="parquet")
    s.add_argument("--order", help="comma list: unique event order of --table rows")
    s.add_argument("--ts", default="ts", help="time column of --table rows ('' stamps the send time)")
    s.add_argument("--fields", help="comma list of --table columns to write (default: all but --ts)")
    s.add_argument("--delim", default="|")
    s.add_argument("--index")
    s.add_argument("--source")
    s.add_argument("--sourcetype")
    s.add_argument("--url", help="collector endpoint; without it the MD5 test sender is used")
    s.add_argument("--header", action="append", default=[], help="NAME=VALUE request header (repeatable)")
    s.add_argument("--timeout", type=float, default=60.0)
    s.add_argument("--block-size", type=int, default=BLOCK_SIZE)
    s.add_argument("--limit", type=int, default=MAX_PAYLOAD, help="largest payload sent; larger ones are dead letters")
    s.add_argument("--receipts", help="where the per-batch ledger is written (default: below spark.checkpoint.dir)")
    s.add_argument("--send-order", choices=("none", "destination"), default="destination",
                   help="'destination': each one's batches one after the other; 'none': all tasks at once")
    s.add_argument("--shipment", help="id of this shipment in batch keys (default: a new one)")
    s.add_argument("--tasks", type=int, help="number of concurrent sending tasks (default: as partitioned)")

    q = sub.add_parser("search", help="search a table and export the results")
    q.add_argument("query", nargs="?", help="Spark SQL boolean expression")
    q.add_argument("--searchfile")
    q.add_argument("--table", required=True)
    q.add_argument("--table-format", default="parquet")
    q.add_argument("--time-col", default="ts")
    q.add_argument("--earliest", default=DEFAULT_EARLIEST,
                   help="e.g. --earliest=-1d@d (use '=' for values starting with '-'); '' for no lower bound")
    q.add_argument("--latest", default=DEFAULT_LATEST, help="'' for no upper bound")
    q.add_argument("--now", help="clock for relative times (default: now, session time zone)")
    q.add_argument("--omode", choices=MODES, default="csv")
    q.add_argument("--outfile", required=True)
    q.add_argument("--order-by", help="comma list; used with --count/--offset")
    q.add_argument("--count", type=int, default=0, help="maximum results (0 = all)")
    q.add_argument("--offset", type=int, default=0)
    q.add_argument("--dequote", action="store_true", help="remove surrounding double quotes from string fields")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"eventloom-{a.command}").getOrCreate()
    out = cmd_ship(spark, a) if a.command == "ship" else cmd_search(spark, a)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
