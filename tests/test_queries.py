"""Every registered query against its SQL counterpart in DuckDB at sf0.01."""

import pytest
from compare import connect, differences

from hubbub.plans import catalog

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_matches_sql(spark, con, name):
    assert differences(catalog.queries()[name](spark, SF_DIR), con, catalog.oracles()[name]) is None


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracles())
