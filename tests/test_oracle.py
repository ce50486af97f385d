"""Every registered query against its DuckDB SQL (driver-style digest)."""

import os
import re

import pytest

import __spark_entry__ as E
from sf_dirs import SF_SMALL
from tools.compare import digest, duck

SF = os.environ.get("BEHAVIO_ORACLE_SF", SF_SMALL)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# the queries of the llm subpackage have tests of their own
OWN = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sdf.columns) > 0
        return
    assert digest(sdf) == digest(con.execute(sql).df())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"]
    assert df.count() > 0
