"""Two-level batching against one window per destination on a multiplied table.

usage: python tools/scale_experiment.py [copies] [sf_dir]
Builds ``copies`` of ``lineitem`` with shifted order keys inside the plan (nothing
is written), routes rows by ``l_linestatus`` and times both batchers end to end
(payload MD5s collected, so the payload text is built). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from eventloom.operators.batching import BLOCK_SIZE, batch_of  # noqa: E402
from eventloom.plans import catalog  # noqa: E402
from eventloom.plans.ship import table_batches  # noqa: E402
from eventloom.session import local_session  # noqa: E402


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=32, app="eventloom-scale")
    spark.sparkContext.setLogLevel("ERROR")
    li = catalog.read_table(spark, sf, "lineitem")
    big = reduce(lambda a, b: a.unionByName(b),
                 [li.withColumn("l_orderkey", F.col("l_orderkey") + F.lit(k * 10_000_000)) for k in range(copies)])
    routed = catalog.with_destination(big, sourcetype=F.col("l_linestatus"))

    def two_level():
        return table_batches(routed, catalog.LINEITEM_ORDER, catalog.LINEITEM_FIELDS, "l_shipdate")

    def one_window():
        d = routed.withColumn("raw", catalog.lineitem_text())
        w = Window.partitionBy("sourcetype").orderBy(*catalog.LINEITEM_ORDER).rowsBetween(
            Window.unboundedPreceding, 0)
        a = d.withColumn("batch_id", batch_of(F.sum(F.octet_length("raw") + 1).over(w), BLOCK_SIZE))
        o = ", ".join(catalog.LINEITEM_ORDER)
        return a.groupBy("sourcetype", "batch_id").agg(
            F.expr(f"listagg(concat(raw, '\\n'), '') WITHIN GROUP (ORDER BY {o})").alias("payload"))

    times: dict[str, list[float]] = {}
    results = {}
    for name, f in [("two_level", two_level), ("one_window", one_window)] * 2:
        t0 = time.perf_counter()
        rows = f().select("sourcetype", "batch_id", F.md5("payload").alias("h")).collect()
        times.setdefault(name, []).append(round(time.perf_counter() - t0, 2))
        results[name] = sorted(map(tuple, rows))
    print(json.dumps({"rows": li.count() * copies, "copies": copies, "batches": len(results["two_level"]),
                      "same_payloads": results["two_level"] == results["one_window"],
                      "seconds": {k: min(v) for k, v in times.items()}}))


if __name__ == "__main__":
    main()
