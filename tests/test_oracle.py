"""Every registered query with an oracle equals its DuckDB twin (sf0.001)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from leadlens.sources.tables import TABLES, table_path

from .conftest import SF_SMALL

ORACLES = E.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "NaN"
        return f"{f:.9g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    duck_types = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}
    stypes = dict(sdf.dtypes)
    for c, t in zip(dcols, res.description):
        dt_ = str(t[1])
        if dt_ in duck_types:
            assert stypes[c] == duck_types[dt_], (c, stypes[c], dt_)
    assert len(srows) == len(drows)
    assert _rows(sdf.columns, srows) == _rows(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["supplier_name", "total_orders", "avg_lead_time", "avg_defect_rate",
                          "avg_production_volume"]
