"""Every query with SQL gives the rows that DuckDB gives."""

import duckdb
import pandas as pd
import pytest

from catamill.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or (isinstance(x, float) and pd.isna(x)) or x is pd.NaT or x is pd.NA:
        return None
    return round(float(x), 6) if isinstance(x, float) else x.item() if hasattr(x, "item") else x


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    return sorted((tuple(plain(x) for x in r) for r in df.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf, duck, name):
    got = rows(QUERIES[name](spark, sf).toPandas())
    want = rows(duck.sql(ORACLES[name]).df())
    assert len(got) == len(want)
    assert got == want
