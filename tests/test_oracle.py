"""Every query of the reference's operators against its SQL, over the smallest tables."""

import duckdb
import pandas as pd
import pytest

from wildgrid.plans import registry
from wildgrid.plans.views import TABLES

TINY = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{TINY}/{t}.parquet')")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    """Rows as text, columns by name; numbers of both engines alike whatever their width."""

    def value(v, number: bool) -> str:
        if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and v != v:
            return ""
        if number or isinstance(v, float):
            return f"{float(v):.6f}"
        return str(list(v)) if hasattr(v, "__len__") and not isinstance(v, str) else str(v)

    number = {c for c in df.columns if str(df[c].dtype).lower().startswith(("int", "uint", "float"))}
    cols = sorted(df.columns)
    return sorted(tuple(value(v, c in number) for c, v in zip(cols, row)) for row in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, TINY).toPandas()
    theirs = duck.execute(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)
