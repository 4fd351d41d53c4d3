import pytest

from tarn.plans import queries as Q
from tests.oracle import same

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_against_sql(spark, name):
    same(spark, Q.QUERIES[name], Q.SQL[name], SF)
