"""Every registered query with SQL, against DuckDB on the smallest generated tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="generated tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, type(v).__name__, repr(v)) for v in r))


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = _sorted(tuple(r[c] for c in columns) for r in df.collect())
    result = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    order = [names.index(c) for c in sorted(names)]
    theirs = _sorted(tuple(r[i] for i in order) for r in result.fetchall())
    assert columns == sorted(names)
    assert ours == theirs


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 4
