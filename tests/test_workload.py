import os

import pytest

from tallyweave import workload
from tests.oracle import tables, values

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_a_random_pick_is_of_the_table(spark):
    rows = workload.queries()["random_pick"](spark, SF).collect()
    table = {tuple(r) for r in spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey").collect()}
    assert len(set(map(tuple, rows))) == 20 and set(map(tuple, rows)) <= table


@pytest.mark.parametrize("name", list(workload.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    got = workload.queries()[name](spark, SF).toPandas()
    want = tables(SF).sql(workload.oracle_sql()[name]).fetchdf()
    assert values(got) == values(want)
