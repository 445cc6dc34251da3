"""Every registered query of the engine against its SQL, at the smallest size."""

import os
from decimal import Decimal

import duckdb
import pytest

from tesselorn.plans import registry

SF = os.environ.get("TESSELORN_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in sorted(os.listdir(SF)):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def _plain(v):
    return float(v) if isinstance(v, Decimal) else round(v, 9) if isinstance(v, float) else v


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query_matches_sql(spark, db, name):
    found = registry.queries()[name](spark, SF)
    names, rows = found.columns, [tuple(r) for r in found.collect()]
    db.execute(registry.oracle_sql()[name])
    wanted_names, wanted = [d[0] for d in db.description], db.fetchall()
    assert sorted(names) == sorted(wanted_names)
    assert _sorted(names, rows) == _sorted(wanted_names, wanted)
    if name not in ("recipe_lookup",):
        assert rows
