"""Every registered query that has one against its SQL twin in DuckDB
(sf0.01). Mirrors the driver's correctness gate."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE
from tools.oracle_check import compare, duck_con

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck_con(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_ORACLE, name, QUERIES[name], ORACLES[name], con)
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["disposition", "window_start", "window_end",
                          "original_crime_type_name", "call_count", "description"]
    assert df.count() > 0


def test_every_query_of_the_reference_has_sql():
    own = {n for n in QUERIES if n != "pipeline" and not n.startswith("op")}
    assert own <= set(ORACLES)
