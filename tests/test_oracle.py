"""Each query outside the llm part that has SQL gives the rows that DuckDB gives for it."""

import pytest

from meterline.queries import ORACLE_SQL, QUERIES
from tests.compare import difference, duck_connection


@pytest.fixture(scope="module")
def db(sf_dir):
    return duck_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_is_its_sql(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE_SQL:
        assert difference(df, db, ORACLE_SQL[name]) is None
    else:
        df.collect()
