"""Every query with SQL gives the rows that DuckDB gives."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from canopyflow.plans import catalog

SF = "/root/testdata/sf0.001"


def plain(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: "-" if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)) else f"{v:.5f}" if isinstance(v, float) else str(v)[:10] if hasattr(v, "year") else str(v))
    return sorted(map(tuple, df.to_numpy().tolist()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings labels".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, duck, name):
    assert plain(catalog.QUERIES[name](spark, SF).toPandas()) == plain(duck.sql(catalog.SQL[name]).df())
