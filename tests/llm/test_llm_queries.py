import pytest
from compare import connect, differences

from hubbub.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_matches_sql(spark, name):
    assert differences(queries.queries()[name](spark, SF), connect(SF), queries.oracles()[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
