"""Every registered query against its SQL on the smallest tables."""

import math
import os
import subprocess
import sys
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for file in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else repr(round(number, 6) + 0.0)
    return str(value)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in row) for row in df.select(*columns).collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = Counter(tuple(plain(row[i]) for i in at) for row in result.fetchall())
    assert got == expected


def test_entry_in_a_fresh_process():
    """Nothing may have been imported or registered before entry() runs."""
    code = (
        "import __spark_entry__ as e; from pyspark.sql import SparkSession as S; "
        "b = S.builder.master('local[2]').config('spark.ui.enabled', 'false'); "
        "print('ROWS', e.entry(b.config('spark.sql.session.timeZone', 'UTC').getOrCreate()).count())"
    )
    root = Path(entry.__file__).parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert "ROWS 2" in done.stdout, done.stderr[-2000:]
