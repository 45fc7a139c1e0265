"""Every registered query against its DuckDB oracle on the smallest test data."""


import duckdb
import pytest

import __spark_entry__ as entry
from barsmith import catalog
from conftest import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _canon(pdf):
    pdf = pdf[sorted(pdf.columns)]

    def cell(v):
        if v is None or (isinstance(v, float) and v != v):
            return "<null>"
        if hasattr(v, "isoformat") and not isinstance(v, str):
            return str(v)[:10]
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in row) for row in pdf.itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(catalog.queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _canon(got) == _canon(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 10 and "momentum_signal" in df.columns
