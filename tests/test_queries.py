"""Every query with an SQL twin gives the twin's rows on the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from plotweave import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def plain(df: pd.DataFrame) -> list:
    def value(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        if hasattr(v, "item") and not hasattr(v, "__len__"):
            return value(v.item())
        return round(v, 6) + 0.0 if isinstance(v, float) else v if isinstance(v, (int, str, bool)) else str(v)

    df = df[sorted(df.columns)]
    return sorted((tuple(value(v) for v in r) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_twin(spark, db, name):
    got = registry.queries()[name](spark, SF).toPandas()
    want = db.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    import shutil
    import subprocess
    import sys

    root = Path(entry.__file__).parent
    shutil.copytree(root / "plotweave", tmp_path / "plotweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q.startswith('op') and q[2].isdigit()]; assert 'pipeline' not in e.queries(); from pyspark.sql import SparkSession; s = SparkSession.builder.master('local[2]').config('spark.sql.shuffle.partitions', '2').config('spark.ui.enabled', 'false').getOrCreate(); assert e.entry(s).count() > 0"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True, timeout=300)
