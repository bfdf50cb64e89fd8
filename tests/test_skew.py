"""A director holding 40% of all movies: one document row, many link rows in
many files, chunked lists of bounded length, brute-force answers."""

from collections import Counter

from pyspark.sql import functions as F

from marquee.operators import denormalize, nest
from marquee.plans import catalogue as Q
from marquee.session import scratch_path

N = 400


def _catalogue(spark):
    movies = spark.range(N).select(
        F.col("id"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("name"),
        F.lit(2000).alias("year"), ((F.col("id") * 37) % 101 / 10.0).alias("rank"))
    genres = spark.range(N).select(F.col("id").alias("movie_id"),
                                   F.element_at(F.array(F.lit("Drama"), F.lit("War"), F.lit("Noir")),
                                                (F.col("id") % 3 + 1).cast("int")).alias("genre"))
    # director 1 directs 40% of the movies, directors 2..21 share the rest; movie 0 is listed 900 times
    mdirs = spark.range(N).select(
        F.when(F.col("id") % 5 < 2, F.lit(1)).otherwise(F.col("id") % 20 + 2).cast("bigint").alias("director_id"),
        F.col("id").alias("movie_id"))
    mdirs = mdirs.unionByName(spark.range(899).select(F.lit(1).cast("bigint").alias("director_id"),
                                                      F.lit(0).cast("bigint").alias("movie_id")))
    roles = spark.range(N).select((F.col("id") % 7).alias("actor_id"), F.col("id").alias("movie_id"),
                                  F.lit("r").alias("role"))
    directors = spark.range(1, 22).select(F.col("id"), F.lit("First").alias("first_name"),
                                          F.col("id").cast("string").alias("last_name"))
    dg = spark.createDataFrame([], "director_id bigint, genre string, prob double")
    m = denormalize.den_movies(movies, genres, mdirs, roles)
    return m, denormalize.den_directors(directors, mdirs, dg), nest.link_rows(mdirs, "director_id")


MINE = [i for i in range(N) if i % 5 < 2]


def test_one_row_per_person_and_flat_links(spark):
    _, d, links = _catalogue(spark)
    assert d.count() == 21 and d.filter("id = 1").first().n_movies == len(MINE) + 899
    got = {r.movie_id: r.n for r in links.filter("id = 1").collect()}
    assert got == {i: 900 if i == 0 else 1 for i in MINE}


def test_chunks_are_bounded_whole_and_independent_of_counts(spark):
    _, _, links = _catalogue(spark)
    for width in (16, 100, 100_000):
        rows = nest.chunk_lists(links, width).collect()
        assert all(len(r.list_movies) <= width for r in rows)
        assert all(e.movie_id // width == r.chunk for r in rows for e in r.list_movies)
        assert sorted((e.movie_id, e.n) for r in rows if r.id == 1 for e in r.list_movies) == \
            [(i, 900 if i == 0 else 1) for i in MINE]
        assert max(Counter((r.id, r.chunk) for r in rows).values()) == 1


def test_links_of_a_hot_person_lie_in_many_files(spark):
    _, _, links = _catalogue(spark)
    path = scratch_path(spark, "links")
    links.repartition(16, "movie_id").write.parquet(path)
    rows = spark.read.parquet(path).filter("id = 1").select(F.input_file_name().alias("f")).collect()
    per_file = Counter(r.f for r in rows)
    assert len(per_file) > 12 and max(per_file.values()) < len(MINE) / 3


def test_lookups_on_the_hot_director(spark):
    m, d, links = _catalogue(spark)
    rank = {i: (i * 37) % 101 / 10.0 for i in range(N)}
    genre = {i: ["Drama", "War", "Noir"][i % 3] for i in range(N)}
    got = sorted(r.id for r in Q.ru4(m, d, links, "First", "1", "War").collect())
    assert got == sorted(i for i in MINE if genre[i] == "War")
    avg = Q.rda1(m, d, links, "First", "1").first().average_rank
    assert abs(avg - sum(rank[i] for i in MINE) / len(MINE)) < 1e-6
    top = {r.genre: (r.best_name, r.best_rank) for r in Q.rda4_top(m, d, links, ["First 1"]).collect()}
    for g in ("Drama", "War", "Noir"):
        best = min((i for i in MINE if genre[i] == g), key=lambda i: (-rank[i], i))
        assert top[g] == (f"m{best}", rank[best])
