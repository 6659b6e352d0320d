"""Every registered query equals its DuckDB oracle on the sf0.001 tables
(rows, column names and an order-insensitive hash of all values)."""

import duckdb
import pytest

import __spark_entry__ as E
from docsynth.plans.queries import QUERIES
from tools.check_oracle import TABLES, TYPE_MAP, digest

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)
    assert set(QUERIES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "template_id", "pos", "field_name", "kind", "value", "error"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, con, name):
    df = E.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    dtypes = {d[0]: str(d[1]).upper() for d in res.description}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert TYPE_MAP.get(t, t) == dtypes[f.name], (f.name, t, dtypes[f.name])
    assert len(srows) == len(drows)
    hs, ls = digest(df.columns, srows)
    hd, ld = digest(dcols, drows)
    assert hs == hd, (sorted(set(ls) - set(ld))[:3], sorted(set(ld) - set(ls))[:3])
