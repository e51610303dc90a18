import pytest
from oracle_check import oracle_rows, spark_rows

from paneflow.llm.oracles import ORACLES
from paneflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == oracle_rows(SF, ORACLES[name])
