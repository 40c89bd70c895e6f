"""Every registered query against its SQL on the supplied tables."""

import pytest
from parity import compare, connect

import __spark_entry__ as entrypoint

QUERIES = entrypoint.queries()
ORACLES = entrypoint.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


# The document operators are optional and tested apart.
MODEL_QUERIES = [name for name in QUERIES if name not in entrypoint.LLM_QUERIES]


def test_every_model_query_has_an_oracle():
    assert set(MODEL_QUERIES) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_matches_oracle(name, spark, sf_dir, duck):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_entry_runs(spark):
    result = entrypoint.entry(spark)
    assert result.columns[0] == "date_day"
    assert result.count() == 2556
