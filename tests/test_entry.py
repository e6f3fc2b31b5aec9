"""The driver contract on sf0.001: entry() and every query against its oracle."""

import math

import duckdb
import pytest

from tests.conftest import SF_SMOKE

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.12g}") if not math.isnan(v) else "nan"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns[-3:] == ["bus_stops_within_1km", "subway_stations_within_1km", "parks_within_1km"]
    assert df.count() > 0


def _names():
    from metroframe.bindings import QUERIES, load_all

    load_all()
    return sorted(QUERIES)


def test_every_query_has_an_oracle():
    import __spark_entry__ as E

    assert set(_names()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, oracle, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SF_SMOKE)
    cols, rows = df.columns, df.collect()
    rel = oracle.sql(E.oracle_sql()[name])
    otypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == otypes  # same names and types
    res = oracle.execute(E.oracle_sql()[name])
    ocols, orows = [c[0] for c in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    assert _key([[r[i] for i in order] for r in rows]) == _key([[r[i] for i in oorder] for r in orows])
