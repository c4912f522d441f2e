"""Every core query runs, and equals its SQL where it has one, at the smallest scale."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from humusgrid.plans import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, DATA)
    rows = df.collect()
    if name not in catalog.ORACLE:
        return
    found = db.execute(catalog.ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    a = sorted(repr([plain(r[n]) for n in order]) for r in rows)
    b = sorted(repr([plain(r[names.index(n)]) for n in order]) for r in found.fetchall())
    assert a == b
