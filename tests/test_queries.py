import duckdb
import pandas as pd
import pytest

from curiospark.plans import census_queries, place_queries, profile_queries, queries, stage_queries

SF = "/root/testdata/sf0.01"
QUERIES = queries.QUERIES | profile_queries.QUERIES | stage_queries.QUERIES | census_queries.QUERIES | place_queries.QUERIES
ORACLE_SQL = queries.ORACLE_SQL | profile_queries.ORACLE_SQL | stage_queries.ORACLE_SQL | census_queries.ORACLE_SQL | place_queries.ORACLE_SQL
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    """Numbers by value, so that an integer column with nulls equals itself."""
    if not pd.api.types.is_scalar(value):
        return [plain(v) for v in value]
    if pd.isna(value):
        return None
    return float(value) if isinstance(value, int | float) else value


@pytest.fixture(scope="module")
def con():
    found = duckdb.connect()
    for name in TABLES:
        found.sql(f"create view {name} as from '{SF}/{name}.parquet'")
    return found


@pytest.mark.parametrize("name", [q for q in QUERIES if q in ORACLE_SQL])
def test_query_equals_its_sql(spark, con, name):
    want = con.sql(ORACLE_SQL[name]).df()
    df = QUERIES[name](spark, SF)
    assert set(df.columns) == set(want.columns)
    got = df.toPandas()[list(want.columns)]
    rows = lambda f: sorted(str([plain(v) for v in r]) for r in f.values.tolist())
    assert len(want) and rows(got) == rows(want)
