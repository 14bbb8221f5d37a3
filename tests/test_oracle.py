"""Every registered query with an oracle, against DuckDB on the small tables."""

import pytest

from tests.compare import connect, contract, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(n for n in contract.oracle_sql() if n.startswith("q_")))
def test_query_matches_oracle(spark, con, name):
    assert differences(spark, con, name, SF_DIR) == []


def test_every_query_has_an_oracle():
    library = {name for name in contract.queries() if name.startswith("q_")}
    assert library == {name for name in contract.oracle_sql() if name.startswith("q_")}


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()
