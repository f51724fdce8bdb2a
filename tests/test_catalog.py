"""Every registered query against its DuckDB twin at the smallest scale."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from waymeld.plans import catalog, engine  # noqa: F401 - engine adds its queries to the catalog's

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _plain(df: pd.DataFrame) -> list:
    def value(x):
        if pd.isna(x):
            return None
        return round(float(x), 3) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return sorted((tuple(value(v) for v in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in catalog.ORACLE:
        assert _plain(got) == _plain(duck.execute(catalog.ORACLE[name]).df())
