"""Property tests on random small inputs (brute force in Python as the oracle)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marquee.operators import aggregates as A
from marquee.operators import denormalize, nest

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ids = st.integers(min_value=0, max_value=12)
genre = st.sampled_from(["Drama", "War", "Noir", None])
rank = st.one_of(st.none(), st.floats(min_value=0, max_value=10, allow_nan=False))


@SETTINGS
@given(movies=st.dictionaries(ids, rank, min_size=1, max_size=8),
       genres=st.lists(st.tuples(ids, genre), max_size=15),
       dirs=st.lists(st.tuples(ids, ids), max_size=15),
       roles=st.lists(st.tuples(ids, ids), max_size=15))
def test_movie_documents_match_brute_force(spark, movies, genres, dirs, roles):
    m = spark.createDataFrame([(k, f"m{k}", 2000, r) for k, r in movies.items()],
                              "id bigint, name string, year int, rank double")
    g = spark.createDataFrame(genres, "movie_id bigint, genre string")
    d = spark.createDataFrame(dirs, "director_id bigint, movie_id bigint")
    r = spark.createDataFrame([(a, mv, "x") for a, mv in roles], "actor_id bigint, movie_id bigint, role string")
    want = sorted((k, x, sorted(t for i, t in genres if i == k and t is not None),
                   sorted(p for p, i in dirs if i == k), sum(i == k for _, i in roles)) for k, x in movies.items())
    pick = ("id", "rank", "list_genres", "list_directors_id", "den_nb_actors")
    whole = denormalize.den_movies(m, g, d, r)
    assert sorted(tuple(x) for x in whole.select(*pick).collect()) == want
    some = spark.createDataFrame([(k,) for k in list(movies)[::2]], "id bigint")
    part = denormalize.den_movies(m, g, d, r, keys=some)
    assert sorted(tuple(x) for x in part.select(*pick).collect()) == [w for w in want if w[0] in list(movies)[::2]]


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40)), min_size=1, max_size=60),
       width=st.integers(1, 50))
def test_chunks_keep_every_pair(spark, pairs, width):
    roles = spark.createDataFrame([(a, m, "r") for a, m in pairs], "actor_id bigint, movie_id bigint, role string")
    got = {}
    for row in nest.chunk_lists(nest.link_rows(roles, "actor_id"), width).collect():
        assert row.list_movies == sorted(row.list_movies) and len(row.list_movies) <= width
        for e in row.list_movies:
            assert e.movie_id // width == row.chunk
            got[row.id, e.movie_id] = e.n
    assert got == Counter(pairs)


@SETTINGS
@given(rows_=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), ids, rank), min_size=1, max_size=30,
                      unique_by=lambda t: t[1]))
def test_top_per_group_matches_brute_force(spark, rows_):
    df = spark.createDataFrame([(g, i, f"n{i}", r) for g, i, r in rows_],
                               "genre string, id bigint, name string, rank double")
    got = {r.genre: (r.best_name, r.best_rank) for r in A.top_per_group(df, "genre", ["name", "rank"]).collect()}
    want = {}
    for g in {t[0] for t in rows_}:
        group = [t for t in rows_ if t[0] == g]
        best = min(group, key=lambda t: (t[2] is None, -(t[2] or 0.0), t[1]))
        want[g] = (f"n{best[1]}", best[2])
    assert got == want


@SETTINGS
@given(xs=st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), max_size=12))
def test_trimmed_mean_matches_brute_force(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs] or [(None,)], "x double")
    got = df.agg(A.trimmed_mean("x").alias("t")).first().t
    if len(xs) <= 2:
        assert got is None
    else:
        t = list(xs)
        t.remove(max(t))
        t.remove(min(t))
        want = sum(t) / len(t)
        assert abs(got - want) <= 1e-6 * max(1.0, abs(want))
