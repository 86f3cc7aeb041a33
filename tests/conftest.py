import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("barsmith-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def landing(spark):
    """Write literal payload documents as ``symbol=<SYM>/<n>.json`` files."""
    from barsmith.session import scratch_path

    def make(docs: dict[str, list[str]]) -> str:
        root = scratch_path(spark, "t-landing")
        for sym, bodies in docs.items():
            d = os.path.join(root, f"symbol={sym}")
            os.makedirs(d, exist_ok=True)
            for i, body in enumerate(bodies):
                with open(os.path.join(d, f"part-{i}.json"), "w") as f:
                    f.write(body)
        return root

    return make


def plan_text(df) -> str:
    """The formatted physical plan, as ``df.explain("formatted")`` prints it."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def executed_nodes(df):
    """(node name, output rows) of every operator in the final executed plan.

    Runs ``df`` once; reads Spark's SQL metrics from the adaptive plan,
    descending into query stages.  Test support only.
    """
    df.collect()
    root = df._jdf.queryExecution().executedPlan()
    if root.nodeName() == "AdaptiveSparkPlan":
        root = root.finalPhysicalPlan()
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        metrics = node.metrics()
        rows = metrics.get("numOutputRows")
        out.append((node.nodeName(), rows.get().value() if rows.isDefined() else None))
        if node.nodeName().endswith("QueryStage") or node.nodeName() == "ReusedQueryStage":
            todo.append(node.plan())
        kids = node.children()
        todo.extend(kids.apply(i) for i in range(kids.size()))
    return out
