"""Every query against its SQL."""

import math

import pytest

import __spark_entry__ as entry
from sluice import queries as core


def rows(names, got):
    order = sorted(range(len(names)), key=lambda k: names[k])
    show = lambda v: "null" if v is None else f"{v:.6g}" if isinstance(v, float) and not math.isnan(v) else str(v)
    return sorted(tuple(show(r[k]) for k in order) for r in got)


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_same_rows(spark, duck, sf_dir, name):
    df = core.QUERIES[name](spark, sf_dir)
    want = duck.execute(core.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    a, b = rows(df.columns, df.collect()), rows(names, want.fetchall())
    assert len(a) == len(b)
    assert a == b


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(core.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
