"""The registered training-data queries: SQL where there is some, and the entry's guard."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as E
from barsmith.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import canon, duck, spark_types

ROOT = Path(E.__file__).parent


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    con = duck(SF_SMALL)
    rel = con.sql(ORACLES[name])
    assert spark_types(df) == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert canon(df.columns, rows) == canon(names, cur.fetchall())


def test_all_queries_and_the_pipeline_are_registered():
    numbers = [int(m[1]) for n in E.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in E.queries()


def test_entry_without_the_subpackage(tmp_path):
    """Only __spark_entry__ guards the import; without both parts the rest is still there."""
    import shutil

    shutil.copytree(ROOT / "barsmith", tmp_path / "barsmith", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    n, m, has = out.stdout.split()
    assert n == m == str(len(E.queries()) - 14) and has == "False", out.stderr


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "barsmith").rglob("*.py"):
        if "llm" not in p.parts:
            assert "barsmith.llm" not in p.read_text(), p


def test_no_cap_or_local_folder_in_the_operators():
    text = "\n".join(p.read_text() for p in (ROOT / "barsmith" / "llm").glob("*.py") if p.name != "runtime.py")
    for banned in (".limit(", "localCheckpoint", "crossJoin", "tempfile", "gettempdir"):
        assert banned not in text, banned
    for native in ("entropy_mix", "splitter_shards"):
        own = (ROOT / "barsmith" / "llm" / f"{native}.py").read_text()
        for banned in ("InArrow", "InPandas", "udf", "pandas", "pyarrow", ".rdd"):
            assert banned not in own, (native, banned)
