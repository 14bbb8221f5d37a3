"""The registered queries with an oracle, on the small tables."""

from __future__ import annotations

import pytest

from gleanspark.llm.queries import ORACLES
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    assert differences(spark, connect(SF_DIR), name, SF_DIR) == []
