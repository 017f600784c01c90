"""Every query with an SQL twin gives its rows."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd
import pytest

from pitchside import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalogue.load()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def text(v: object) -> str:
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
            return "null"
        return repr(round(float(v), 6) + 0.0) if isinstance(v, (float, int)) and not isinstance(v, bool) else str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(map(text, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, db, name):
    got, want = QUERIES[name](spark, SF).toPandas(), db.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_groups_have_no_more_than_their_samples(spark):
    n = QUERIES["hashed_sample"](spark, SF).groupBy("dataset_url", "feed_id", "kind").count().agg({"count": "max"}).first()[0]
    assert n <= 500
