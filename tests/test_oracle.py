"""A sample of registered queries against their SQL; the full set is compared by the driver."""

import os

import duckdb
import pytest

from tidemark.workload import catalog
from tidemark.workload.derive import BASE

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
NAMES = os.environ.get(
    "ORACLE_QUERIES", "market_board,fixed_point_parse,grid_snap,seq_gaps,seq_verdicts,session_islands,fee_asof,grid_asof,frame_router,book_bbo"
).split(",")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(rows, positions):
    return sorted(str([row[i] for i in positions]) for row in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    found = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    got, want = df.collect(), found.fetchall()
    columns = sorted(names)
    assert plain(got, [df.columns.index(c) for c in columns]) == plain(want, [names.index(c) for c in columns])


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
