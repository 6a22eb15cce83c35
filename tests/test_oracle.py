"""Every query with an oracle entry equals its DuckDB SQL (order-insensitive)."""

import math

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF_SMALL

ORACLE = oracle_sql()
QUERIES = queries()


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    recs = pdf.astype(object).where(pdf.notna(), None).to_dict("records")
    rows = [tuple(_norm(r[c]) for c in cols) for r in recs]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.sql(ORACLE[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
