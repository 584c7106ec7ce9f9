"""Every query that has a SQL twin gives the same rows as it, over the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from tessera import queries as engine

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def normal(df):
    out = df[sorted(df.columns)].copy()
    for c in out.columns:
        if pd.api.types.is_numeric_dtype(out[c]) and not pd.api.types.is_bool_dtype(out[c]):
            out[c] = out[c].astype(float)
    return out.astype(str).sort_values(list(out.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(engine.SQL))
def test_equals_sql(spark, duck, name):
    got, want = engine.QUERIES[name](spark, DATA).toPandas(), duck.execute(engine.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got)
    pd.testing.assert_frame_equal(normal(got), normal(want))


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(engine.SQL) <= set(engine.QUERIES) <= set(entry_module.queries())


def test_entry_without_the_corpus_subpackage(tmp_path):
    """The other queries stay when the optional subpackage and pipeline are gone."""
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    subprocess.run(["cp", "-r", f"{root}/tessera", f"{root}/__spark_entry__.py", tmp_path], check=True)
    subprocess.run(["rm", "-rf", f"{tmp_path}/tessera/llm"], check=True)
    code = "import __spark_entry__ as e; assert 'barcode_summary' in e.queries() and not [k for k in e.queries() if k.startswith('op')]; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
