"""Every registered query with an oracle equals its DuckDB SQL at sf0.001."""

import pytest

import __spark_entry__ as entry
from support import SF_SMALL, rows_of

ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert rows_of(scols, srows) == rows_of(dcols, drows)


def test_every_query_has_a_docstring_and_reads_tables():
    qs = entry.queries()
    assert len(qs) >= 100
    for name, fn in qs.items():
        assert fn.__doc__, name


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "rfm_score" in df.columns
