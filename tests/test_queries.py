"""Every query of the library proper against its SQL, over the smallest corpus."""

import duckdb
import pytest
from helpers import DATA

from clipweave.plans import registry


def plain(df):
    def value(v):
        if v is None or v != v if not hasattr(v, "__len__") else False:
            return "null"
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        if hasattr(v, "is_integer") or type(v).__name__.startswith("float"):
            return repr(round(float(v), 6))
        return str(v)

    df = df[sorted(df.columns)]
    return sorted("|".join(value(v) for v in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for file in (DATA / "sf0.001").glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, small, oracle, name):
    got = registry.queries()[name](spark, small).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql:
        want = oracle.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)
    else:
        assert len(got)


def test_entry_runs_without_the_subpackage(spark):
    import __spark_entry__

    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns
