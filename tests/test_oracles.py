"""Queries against their SQL."""

import math

import pytest

from cargolens.plans import io_queries, process_queries, search_queries, store_queries  # noqa: F401  (add their queries)
from cargolens.plans import queries as Q

SLOW = ("gra02", "gra03", "gra19", "agg14", "gra20")
NAMES = sorted(n for n in Q.ORACLE_SQL if not n.startswith(SLOW))


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else v if isinstance(v, (int, bool, str)) else str(v)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, duck, sf, name):
    df = Q.QUERIES[name](spark, sf)
    got = sorted_rows(df.columns, df.collect())
    cursor = duck.execute(Q.ORACLE_SQL[name])
    assert got == sorted_rows([c[0] for c in cursor.description], cursor.fetchall())
