import pytest

from cargolens.llm import queries as Q
from tests.test_oracles import sorted_rows


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, sf, name):
    df = Q.QUERIES[name](spark, sf)
    got = sorted_rows(df.columns, df.collect())
    cursor = duck.execute(Q.ORACLE_SQL[name])
    assert got == sorted_rows([c[0] for c in cursor.description], cursor.fetchall())
