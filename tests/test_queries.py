"""Registered queries against their SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import normalized

# The queries that write and read back whole indexes have tests of their own.
SLOW = {
    "upsert_points", "lexical_append", "search_lexical_stored", "ingest_batch", "ingest_stream", "ingest_folder", "vector_table",
    "list_files", "scan_files",
}
NAMES = [n for n in queries() if n not in SLOW]


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, con, name):
    got = queries()[name](spark, sf).toPandas()
    if name not in oracle_sql():
        assert len(got)
        return
    want = con.execute(oracle_sql()[name])
    want = pd.DataFrame(want.fetchall(), columns=[d[0] for d in want.description])
    assert sorted(got.columns) == sorted(want.columns)
    assert normalized(got) == normalized(want)


def test_entry(spark):
    assert entry(spark).columns == ["query_id", "chunk_id", "score", "rank"]
