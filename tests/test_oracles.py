import pytest
from compare import rows, twin

from corpusmill.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert rows(got) == rows(twin(ORACLES[name], SF))
    assert len(got) > 0
