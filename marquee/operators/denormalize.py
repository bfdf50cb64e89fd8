"""The document tables (denormalisation job).

``movies``           id, name, year, rank, list_genres, list_directors_id, den_nb_actors
``directors``        id, first_name, last_name, n_movies, dict_genres_den_prob
``actors``           id, first_name, last_name, n_movies
``director_movies``  id, movie_id, n    (flat links, one row per distinct pair)
``actor_movies``     id, movie_id, n

All are built as "aggregate each child on the parent key, then left join",
never as join-then-group: list columns never become grouping keys and every
join meets a child that is unique on the key.  A movie's lists are bounded
(its genres by the genre vocabulary, its directors by its crew); a person's
filmography is not, so it stays flat and is chunked by ``nest.chunk_lists``
where a list is asked for.  Every person is exactly one row at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import nest

KINDS = ("movies", "directors", "actors", "director_movies", "actor_movies")


def only_keys(df: DataFrame, col: str, keys: DataFrame | None) -> DataFrame:
    """Rows of ``df`` whose ``col`` is in ``keys.id`` (all rows when None)."""
    return df if keys is None else df.join(keys.select(F.col("id").alias(col)), col, "left_semi")


def den_movies(movies: DataFrame, movies_genres: DataFrame, movies_directors: DataFrame,
               roles: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """``keys`` (a DataFrame with ``id``) builds only those movies: the parent
    and every child are semi-joined to it before any join or aggregate."""
    parent = nest.unique_parent(only_keys(movies, "id", keys).select("id", "name", "year", "rank"))
    child = lambda df: only_keys(df, "movie_id", keys).withColumnRenamed("movie_id", "id")
    genres = nest.child_list(child(movies_genres), "id", "genre", "list_genres")
    directors = nest.child_list(child(movies_directors), "id", "director_id", "list_directors_id")
    actors = nest.child_count(child(roles), "id", "actor_id", "den_nb_actors")
    j = (parent.join(genres, "id", "left")
         .join(directors, "id", "left")
         .join(actors, "id", "left"))
    return j.select(
        "id", "name", "year", "rank",
        F.coalesce("list_genres", nest.empty_array("string")).alias("list_genres"),
        F.coalesce("list_directors_id", nest.empty_array("bigint")).alias("list_directors_id"),
        F.coalesce("den_nb_actors", F.lit(0).cast("bigint")).alias("den_nb_actors"),
    )


def _people(people: DataFrame, child: DataFrame, person: str) -> DataFrame:
    parent = nest.unique_parent(people.select("id", "first_name", "last_name"))
    n = nest.child_count(child.withColumnRenamed(person, "id"), "id", "movie_id", "n_movies")
    return (parent.join(n, "id", "left")
            .withColumn("n_movies", F.coalesce("n_movies", F.lit(0).cast("bigint"))))


def den_directors(directors: DataFrame, movies_directors: DataFrame,
                  directors_genres: DataFrame) -> DataFrame:
    gmap = nest.child_map(directors_genres.withColumnRenamed("director_id", "id"),
                          "id", "genre", "prob", "dict_genres_den_prob")
    j = _people(directors, movies_directors, "director_id").join(gmap, "id", "left")
    return j.select("id", "first_name", "last_name", "n_movies",
                    F.coalesce("dict_genres_den_prob", nest.empty_map("string", "double"))
                    .alias("dict_genres_den_prob"))


def den_actors(actors: DataFrame, roles: DataFrame) -> DataFrame:
    # gender is read from the source but not kept (as in the reference)
    return _people(actors, roles, "actor_id").select("id", "first_name", "last_name", "n_movies")


def build_all(cat, movies_genres: DataFrame | None = None) -> dict[str, DataFrame]:
    """The five document tables from a ``Catalog`` (lazy).

    ``movies_genres`` is read by two tables; a job passes it in materialised
    so the join behind it runs once (see ``plans.jobs``).
    """
    mg = movies_genres if movies_genres is not None else cat.movies_genres()
    return {
        "movies": den_movies(cat.movies(), mg, cat.movies_directors(), cat.roles()),
        "directors": den_directors(cat.directors(), cat.movies_directors(), cat.directors_genres(mg)),
        "actors": den_actors(cat.actors(), cat.roles()),
        "director_movies": nest.link_rows(cat.movies_directors(), "director_id"),
        "actor_movies": nest.link_rows(cat.roles(), "actor_id"),
    }


def movies_for(cat):
    """Builds only the movies with the given ids (see ``den_movies``); the
    line-item join behind the genres starts from those movies' lines."""
    return lambda keys: den_movies(cat.movies(), cat.movies_genres(keys), cat.movies_directors(),
                                   cat.roles(), keys)


# -- documents in parts (incremental denormalisation) ---------------------------

MOVIE_PARTS = ("id long, is_movie boolean, name string, year int, rank double, list_genres array<string>, "
               "list_directors_id array<long>, den_nb_actors long")


def movie_parts(movies: DataFrame, movies_genres: DataFrame, movies_directors: DataFrame,
                roles: DataFrame) -> DataFrame:
    """What one load of source rows adds to the movie documents: a part per
    parent row and per child list, none of them joined.  ``merge_movies`` makes
    documents of the parts of any number of loads."""
    child = lambda df: df.withColumnRenamed("movie_id", "id")
    rows = [nest.unique_parent(movies.select("id", "name", "year", "rank")).withColumn("is_movie", F.lit(True)),
            nest.child_list(child(movies_genres), "id", "genre", "list_genres"),
            nest.child_list(child(movies_directors), "id", "director_id", "list_directors_id"),
            nest.child_count(child(roles), "id", "actor_id", "den_nb_actors")]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return _typed(out)


def _typed(parts: DataFrame) -> DataFrame:
    return parts.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in MOVIE_PARTS.split(", ")])


def merged_parts(parts: DataFrame) -> DataFrame:
    """One part per movie; parts merged in any grouping give the same.  Genres
    are a set (a pair may come in two loads), directors a list."""
    lists = lambda c: F.flatten(F.collect_list(c))
    return _typed(parts.groupBy("id").agg(
        F.max("is_movie").alias("is_movie"), *[F.max(c).alias(c) for c in ("name", "year", "rank")],
        F.sort_array(F.array_distinct(lists("list_genres"))).alias("list_genres"),
        F.sort_array(lists("list_directors_id")).alias("list_directors_id"),
        F.sum("den_nb_actors").alias("den_nb_actors")))


def merge_movies(parts: DataFrame) -> DataFrame:
    """Movie documents; children whose movie has not come yet make none."""
    return (merged_parts(parts).filter("is_movie").drop("is_movie")
            .withColumn("den_nb_actors", F.coalesce("den_nb_actors", F.lit(0).cast("bigint"))))


def merge_links(links: DataFrame) -> DataFrame:
    """(id, movie_id, n) of several loads."""
    return links.groupBy("id", "movie_id").agg(F.sum("n").alias("n"))
