"""Every registered query of the engine against its SQL on the smallest tables."""

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from quarry.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
REPO = Path(__file__).parent.parent


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return str(value) if value is not None else None


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(name, spark, sf_dir, duck):
    df = registry.queries()[name](spark, sf_dir)
    found = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    sql = registry.oracle_sql()[name]
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, found) == rows(columns, result.fetchall())


def test_entry_runs(spark):
    import __spark_entry__

    found = __spark_entry__.entry(spark)
    assert found.columns == ["o_orderpriority", "order_count"]
    assert found.count() > 0


def test_imports_without_the_llm_package(tmp_path):
    shutil.copytree(REPO / "quarry", tmp_path / "quarry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'tpch_q4' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_duplicate_names_are_refused():
    with pytest.raises(ValueError, match="two queries"):
        registry.query(name="tpch_q4")(lambda spark, d: None)
