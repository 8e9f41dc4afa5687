"""Every registered core query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from patchloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are absent")


def plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, (bool, int)) or type(v).__name__.startswith("bool"):
        return str(int(v))
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    want = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    left = sorted(tuple(plain(r[c]) for c in sorted(names)) for r in got.collect())
    right = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in want.fetchall())
    assert left == right
