"""Write PLANS.md: the physical plan outline of every registered query.

Usage: python tools/plans.py [sf_dir] > PLANS.md
For each query: operator tree (formatted explain, outline only), number of
exchanges, aggregate kinds, and every scan's pushed/partition filters and
read schema.  Sink queries return a read of the table they loaded, so their
outline is that read; their writes run inside the query function.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


READING = """How to read them:

* Bars from `lineitem`: partial aggregate per task -> one Exchange on
  (supplier, month) -> final aggregate.  `min_by`/`max_by` over the struct
  line order make it a SortAggregate (struct buffers are not hash-mutable);
  aggregates without them (`symbol_list`) stay HashAggregate.
* Variation: one more Exchange on symbol, then Sort + Window.  None on the
  bucketed table (`bucketed_variation` reads it with a bucketed scan).
* Predicates on raw columns reach the scan: the symbol of `symbol_series`
  becomes `EqualTo(l_suppkey, 1)`, partition filters select one batch.
* `union_symbols` and the copy-aware variation read a checkpoint: the job
  that computed it is listed with the query's writes.
* Sink queries (`etl_*`, `*_reload`, `clear_*`, `append_load`,
  `bucketed_variation`) return a read of the table they loaded; the plans of
  their table writes and checkpoints follow, taken from Spark's event log.
* Batches are written through a staging table definition over the version's
  folder, so their write reads `saveAsTable` there; publishing is a catalog
  command without a plan.
* `hot_series_lag`: one exchange by range (written in order), one by (range,
  symbol) for window, borders and join; only borders are dealt by symbol.
"""


def outline(formatted: str) -> tuple[str, list[str]]:
    tree, _, details = formatted.partition("\n\n\n")
    scans = []
    for block in details.split("\n\n"):
        lines = block.strip().splitlines()
        if lines and re.match(r"\(\d+\) (Scan|BatchScan)", lines[0]):
            keep = [ln for ln in lines
                    if ln.startswith(("(", "PushedFilters", "PartitionFilters", "ReadSchema",
                                      "DataFilters"))]
            scans.append("\n".join(keep))
    tree = tree.replace("== Physical Plan ==\n", "")
    return tree, scans


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="run-plans-", dir="/tmp")
    os.makedirs(f"{scratch}/events")
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", f"{scratch}/events")
             .config("spark.eventLog.compress", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.checkpoint.dir", f"{scratch}/ckpt")
             .config("spark.sql.warehouse.dir", f"{scratch}/wh")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from barsmith.plans import catalogue, loads

    print("# PLANS\n")
    print(f"Physical plans of the bar queries (`tools/plans.py`, {sf_dir}, "
          "8 shuffle partitions, AQE on; initial plans, before runtime re-planning).\n")
    print(READING)
    sections, windows = [], []
    for name, fn in {**catalogue.QUERIES, **loads.QUERIES}.items():
        t0 = time.time() * 1000
        df = fn(spark, sf_dir)
        windows.append((name, t0, time.time() * 1000))
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        tree, scans = outline(text)
        n_ex = len(re.findall(r"Exchange \(", tree))
        aggs = sorted(set(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)", tree)))
        body = [f"exchanges: {n_ex}; aggregates: {', '.join(aggs) or 'none'}\n",
                "```\n" + tree.strip() + "\n```\n"]
        body += ["```\n" + sc + "\n```\n" for sc in scans]
        sections.append((name, body))
    spark.stop()

    writes = load_plans(scratch, windows)
    for name, body in sections:
        print(f"## {name}\n")
        print("\n".join(body))
        for i, plan in enumerate(writes.get(name, []), 1):
            print(f"job {i} (table write or checkpoint, from the event log):\n")
            print("```\n" + plan + "\n```\n")


def load_plans(scratch: str, windows) -> dict[str, list[str]]:
    """Physical plans of the table writes each query ran, from the event log."""
    files = [p for p in glob.glob(f"{scratch}/events/**", recursive=True) if os.path.isfile(p)]
    found: dict[str, list[str]] = {}
    for path in files:
        for line in open(path):
            e = json.loads(line)
            if not e["Event"].endswith("SQLExecutionStart"):
                continue
            plan = e.get("physicalPlanDescription", "")
            if "InsertIntoHadoopFsRelationCommand" not in plan and "checkpoint" not in e.get("description", ""):
                continue
            tree = plan.split("\n\n\n")[0].replace("== Physical Plan ==\n", "").strip()
            for name, t0, t1 in windows:
                if t0 <= e["time"] <= t1:
                    found.setdefault(name, []).append(tree)
    return found


if __name__ == "__main__":
    main()
