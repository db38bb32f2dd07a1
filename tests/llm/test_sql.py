import os

import pytest

from tallyweave.llm import queries
from tests.oracle import tables, values

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    got = queries.queries()[name](spark, SF).toPandas()
    assert values(got) == values(tables(SF).sql(queries.oracle_sql()[name]).fetchdf())


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries()) == list(range(1, 14))
