import pytest

from tests.comparing import duck_rows, spark_rows
from tidemark.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, data, name):
    names, rows = spark_rows(QUERIES[name](spark, data))
    if name in SQL:
        assert (names, rows) == duck_rows(duck, SQL[name])
    else:
        assert rows
