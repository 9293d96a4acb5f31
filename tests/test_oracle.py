"""Every query of the catalogue against its SQL in DuckDB, on the smallest tables."""

import datetime
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from tidemark.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{tiny}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, (float, Decimal)):
        return None if math.isnan(x) else float(f"{float(x):.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x) if isinstance(x, datetime.date) else x


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_its_sql(spark, duck, tiny, name):
    df = catalogue.QUERIES[name](spark, tiny)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
    assert got == want


def test_entry_reads_the_ledger(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["key", "seq", "value", "available_date"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
