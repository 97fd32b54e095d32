"""Registered corpus queries against their DuckDB SQL at sf0.001."""

import os

import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as entry
from contrail.llm import registry

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def norm(value):
    return repr(value) if isinstance(value, float) else str(value)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    return sorted(tuple(norm(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(registry.oracle_sql()[name])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert want and sorted(df.columns) == sorted(cols)
    assert canon(df.columns, df.collect()) == canon(cols, want)


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and len(corpus_pipeline.STAGES) == 5


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy of the repository without the corpus operators still imports and lists its queries."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "repo"
    shutil.copytree(os.path.join(root, "contrail"), copy / "contrail", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), copy)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 40; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)
