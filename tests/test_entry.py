import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from reelrank.plans import catalog
from tests.conftest import SF_SMALL

def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["genres", "recs"]
    rows = df.collect()
    assert rows and all(1 <= len(r.recs) <= 10 for r in rows)


def test_oracles_are_registered_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_every_query_equals_its_oracle_on_small_data(spark, name):
    rows = E.queries()[name](spark, SF_SMALL)
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF_SMALL}/{f}'")
    want = con.sql(E.oracle_sql()[name])
    columns = sorted(rows.columns)
    assert columns == sorted(want.columns)
    got = Counter(tuple(map(plain, r)) for r in rows.select(*columns).collect())
    assert got and got == Counter(tuple(map(plain, r)) for r in want.select(", ".join(f'"{c}"' for c in columns)).fetchall())


def plain(v):
    return "nan" if isinstance(v, float) and v != v else float(v) if isinstance(v, (int, float)) else v
