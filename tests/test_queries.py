"""Every query of the library against its SQL on the smallest tables, and the library without its llm subpackage."""

import math
import shutil
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from shelfwright.jobs import registry

TOP = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
TABLES = ["part", "orders", "lineitem", "events", "documents", "conversations"]


def same(value):
    if isinstance(value, (float, Decimal)):
        return "nan" if math.isnan(value) else repr(round(float(value), 6) + 0.0)
    return str(value)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(same(r[c]) for c in cols) for r in df.collect())
    ran = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in ran.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(same(r[names.index(c)]) for c in cols) for r in ran.fetchall())


def test_without_llm(tmp_path):
    shutil.copytree(TOP / "shelfwright", tmp_path / "shelfwright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(TOP / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'undecided_by_label' in q and not any(k.startswith('op') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin", "PYTHONPATH": ""})
