"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from cadenza.catalogue import ORACLES, QUERIES
from tools.check_oracles import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    mine = table(df.columns, df.collect())
    cur = db.execute(ORACLES[name])
    assert mine == table([d[0] for d in cur.description], cur.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_entry(spark):
    assert entry(spark).columns == ["artist_id", "num_positive_weeks", "rolling_pct_chg", "tw_streams", "pct_chg"]
