"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from marquee.plans import registry
from tools.oracle_check import digest, duck

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols, got = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    ocols, want = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(cols, got) == digest(ocols, want)


def test_every_catalogue_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["genre", "best_name", "best_rank"]


def test_bad_values_make_a_difference(spark):
    """On the unclean inputs the operator under test changes the result."""
    q = lambda n: sorted(map(tuple, E.queries()[n](spark, SF_SMALL).collect()), key=repr)
    assert len(q("ru2_unclean")) > len(q("ru2_strict_unclean"))
    assert any(r[1] == float("-inf") for r in q("rda4_max_unclean"))
    assert any(r[2] is None for r in q("rda4_top_unclean"))
    n = E.queries()["den_movies"](spark, SF_SMALL).count()
    assert 0 < len(q("flt_not_nan_unclean")) < n
    assert any(-1 in r for r in q("clean_sentinel"))
    assert any(r[1] is None for r in q("clean_numeric")) and any(r[2] is None for r in q("clean_numeric"))
