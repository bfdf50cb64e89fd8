"""The SQL text of each catalogue query equals its DataFrame plan."""

import pytest

from marquee.operators import denormalize
from marquee.plans import catalogue as Q
from marquee.plans import sql as S
from marquee.sources.testdata import Catalog

from conftest import SF_SMALL


def rows(df):
    # sums of doubles depend on their order in the last digits
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.fixture(scope="module")
def den(spark):
    d = denormalize.build_all(Catalog(spark, SF_SMALL))
    S.register_catalogue(d)
    return d


CASES = {
    "ru1": lambda m, d, k: Q.ru1(m),
    "ru2": lambda m, d, k: Q.ru2(d),
    "ru2_strict": lambda m, d, k: Q.ru2(d, strict=True),
    "ru3": lambda m, d, k: Q.ru3(m),
    "ru4": lambda m, d, k: Q.ru4(m, d, k),
    "rda1": lambda m, d, k: Q.rda1(m, d, k),
    "rda2": lambda m, d, k: Q.rda2(d),
    "rda3": lambda m, d, k: Q.rda3(m),
    "rda4_top": lambda m, d, k: Q.rda4_top(m, d, k),
    "rda4_max": lambda m, d, k: Q.rda4_max(m, d, k),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_sql_equals_dataframe(spark, den, name):
    got = S.run(spark, name)
    want = CASES[name](den["movies"], den["directors"], den["director_movies"])
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_sql_parameters(spark, den):
    assert rows(S.run(spark, "rda2", n_genres=6)) == rows(Q.rda2(den["directors"], 6))
    assert S.run(spark, "ru4", first_name="No", last_name="Body").count() == 0
    assert S.run(spark, "rda1", first_name="No", last_name="Body").count() == 0
    with pytest.raises(ValueError, match="n_genre"):
        S.run(spark, "rda2", n_genre=5)
