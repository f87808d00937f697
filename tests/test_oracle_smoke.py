"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(rows):
    def cell(x):
        if isinstance(x, float):
            return None if math.isnan(x) else round(x, 6)
        if hasattr(x, "item") and not hasattr(x, "__len__"):
            return cell(x.item())
        return x
    return sorted((tuple(cell(v) for v in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_of_the_inventory_has_an_oracle():
    from podium.plans.queries import QUERIES
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SMOKE)
    cols = sorted(sdf.columns)
    got = _norm(tuple(r[c] for c in cols) for r in sdf.collect())
    res = duck.execute(entry.oracle_sql()[key])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = _norm(tuple(r[i] for i in idx) for r in res.fetchall())
    assert got == want
