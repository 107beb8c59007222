"""Every registered query against its DuckDB SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from oracle import SQL
from tidemart.catalog import QUERIES, run
from tests.conftest import SF_DIR
from verify import TABLES, rows_of

# covered on literal feeds in test_stages
SLOW = {"p03_raw_to_clean_in_two_runs", "p03_raw_to_clean_row_counts", "p04_clean_to_staging", "s08_window_load"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{Path(SF_DIR) / t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, duck, name):
    df = run(name, spark, SF_DIR)
    theirs = duck.execute(SQL[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, theirs.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
