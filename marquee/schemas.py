"""Explicit schemas: the seven normalised tables and the three document tables.

Source files carry text only (headerless CSV read positionally), so every
source schema is all-string; ``functions.clean`` types them.  Ids are BIGINT,
the key type of the driver tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# Positional column names of the seven headerless source files (fixed values).
SOURCE_COLUMNS: dict[str, list[str]] = {
    "movies": ["id", "name", "year", "rank"],
    "movies_genres": ["movie_id", "genre"],
    "movies_directors": ["director_id", "movie_id"],
    "roles": ["actor_id", "movie_id", "role"],
    "directors": ["id", "first_name", "last_name"],
    "directors_genres": ["director_id", "genre", "prob"],
    "actors": ["id", "first_name", "last_name", "gender"],
}

# Typed target of each source column (anything not listed stays string).
SOURCE_TYPES: dict[str, dict[str, str]] = {
    "movies": {"id": "bigint", "year": "int", "rank": "double"},
    "movies_genres": {"movie_id": "bigint"},
    "movies_directors": {"director_id": "bigint", "movie_id": "bigint"},
    "roles": {"actor_id": "bigint", "movie_id": "bigint"},
    "directors": {"id": "bigint"},
    "directors_genres": {"director_id": "bigint", "prob": "double"},
    "actors": {"id": "bigint"},
}


def text_schema(table: str) -> T.StructType:
    """All-string schema for a headerless source file."""
    return T.StructType([T.StructField(c, S, True) for c in SOURCE_COLUMNS[table]])


DEN_MOVIES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", S),
    T.StructField("year", T.IntegerType()),
    T.StructField("rank", T.DoubleType()),
    T.StructField("list_genres", T.ArrayType(S)),
    T.StructField("list_directors_id", T.ArrayType(T.LongType())),
    T.StructField("den_nb_actors", T.LongType()),
])

DEN_DIRECTORS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("first_name", S),
    T.StructField("last_name", S),
    T.StructField("n_movies", T.LongType()),
    T.StructField("dict_genres_den_prob", T.MapType(S, T.DoubleType())),
])

DEN_ACTORS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("first_name", S),
    T.StructField("last_name", S),
    T.StructField("n_movies", T.LongType()),
])

LINKS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("n", T.LongType()),
])
