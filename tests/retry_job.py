"""Run the ETL transform with injected task failures; print a JSON verdict.

Used by tests/test_retries.py in its own process: ``local[4,3]`` allows task
retries, which the shared test session (plain ``local[*]``) does not.
"""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


MARKS = tempfile.mkdtemp(prefix="run-retry-marks-", dir="/tmp")


def first_attempt_fails(x):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        # one marker per failed attempt (stage, partition), then fail it
        open(os.path.join(MARKS, f"{ctx.stageId()}-{ctx.partitionId()}"), "a").close()
        raise RuntimeError("injected task failure")
    return True


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="run-retry-", dir="/tmp")
    spark = (SparkSession.builder.master("local[4,3]")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.checkpoint.dir", f"{scratch}/ckpt")
             .config("spark.sql.warehouse.dir", f"{scratch}/wh")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from barsmith.plans.catalogue import _landed_twice
    from barsmith.plans.etl import prepare_table, transform
    from barsmith.session import work_table
    from barsmith.sinks.tables import reload_process_date
    from barsmith.sources.payloads import ingest_payloads

    # nondeterministic: the optimizer keeps each filter where it is written
    flaky = F.udf(first_attempt_fails, "boolean").asNondeterministic()
    raw, _ = ingest_payloads(spark, _landed_twice(spark, sys.argv[1]))
    raw = raw.repartition(4)

    def load(inject: bool) -> list:
        t = work_table(spark, "retry")
        n = prepare_table(spark, t, 4)
        src = raw.where(flaky(F.col("symbol"))) if inject else raw
        out = transform(src, partitions=n)
        if inject:  # a second failure point, after the window's shuffle
            out = out.where(flaky(F.col("symbol")))
        reload_process_date(out, t, "2023-07-11")
        return sorted(tuple(str(v) for v in r) for r in spark.table(t).collect())

    clean, retried = load(False), load(True)
    marks = os.listdir(MARKS)
    stages = {m.split("-")[0] for m in marks}
    print(json.dumps({"rows": len(clean), "equal": clean == retried,
                      "failed_attempts": len(marks), "failed_stages": len(stages)}))
    spark.stop()


if __name__ == "__main__":
    main()
