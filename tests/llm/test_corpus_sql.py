"""The corpus operators that have SQL against it in DuckDB, on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

from tests.test_oracle import TABLES, plain
from tidemark.llm import registry


@pytest.mark.parametrize("name", list(registry.ORACLE_SQL))
def test_corpus_query_equals_its_sql(spark, tiny, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{tiny}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    df = registry.QUERIES[name](spark, tiny)
    columns = sorted(df.columns)
    cursor = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want
