"""The eight catalogue queries as Spark SQL over the document tables.

The same plans as ``plans.catalogue``, written as parameterised SQL text
(named markers, bound with ``spark.sql(text, args=...)``): ``IN (subquery)``
becomes the semi join, higher-order functions (``map_filter``) stay inside
code generation.  ``register_catalogue`` exposes the document tables as the
views ``den_movies``, ``den_directors``, ``den_actors``, ``den_director_movies``
and ``den_actor_movies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.plans import catalogue as C

_DIRECTOR = """
one AS (SELECT id FROM den_directors
        WHERE first_name = :first_name AND last_name = :last_name
        ORDER BY id LIMIT 1),
ids AS (SELECT movie_id AS id FROM den_director_movies WHERE id IN (SELECT id FROM one))"""

_CHOSEN = """
chosen AS (SELECT id FROM den_directors
           WHERE array_contains(:names, concat(first_name, ' ', last_name))),
ids AS (SELECT movie_id AS id FROM den_director_movies WHERE id IN (SELECT id FROM chosen)),
m AS (SELECT id, name, rank, explode(list_genres) AS genre FROM den_movies
      WHERE id IN (SELECT id FROM ids))"""

QUERIES: dict[str, str] = {
    "ru1": """SELECT name, rank FROM den_movies
              WHERE array_contains(list_genres, :genre) AND rank > :min_rank""",
    "ru2": """SELECT first_name, last_name FROM den_directors
              WHERE map_contains_key(dict_genres_den_prob, :genre)""",
    "ru2_strict": """SELECT first_name, last_name FROM den_directors
              WHERE map_contains_key(dict_genres_den_prob, :genre)
                AND try_element_at(dict_genres_den_prob, :genre) != 0""",
    "ru3": """SELECT name FROM den_movies
              WHERE array_contains(list_genres, :genre) AND year = :year""",
    "ru4": f"""WITH {_DIRECTOR}
              SELECT id, name, year, rank FROM den_movies
              WHERE array_contains(list_genres, :genre) AND id IN (SELECT id FROM ids)""",
    "rda1": f"""WITH {_DIRECTOR}
              SELECT avg(rank) AS average_rank FROM den_movies
              WHERE rank IS NOT NULL AND NOT isnan(rank) AND id IN (SELECT id FROM ids)
              HAVING count(*) > 0""",
    "rda2": """SELECT first_name, last_name FROM den_directors
              WHERE size(map_filter(dict_genres_den_prob, (k, v) -> v IS NOT NULL AND v != 0)) = :n_genres""",
    "rda3": """SELECT name FROM den_movies WHERE den_nb_actors < :max_actors AND rank > :min_rank""",
    "rda4_top": f"""WITH {_CHOSEN},
              best AS (SELECT genre, max(coalesce(rank, CAST('-Infinity' AS DOUBLE))) AS best FROM m GROUP BY genre),
              tied AS (SELECT m.genre, min(m.id) AS id FROM m JOIN best b
                       ON m.genre = b.genre AND coalesce(m.rank, CAST('-Infinity' AS DOUBLE)) = b.best GROUP BY m.genre)
              SELECT m.genre, m.name AS best_name, m.rank AS best_rank
              FROM m JOIN tied t ON m.genre = t.genre AND m.id = t.id""",
    "rda4_max": f"""WITH {_CHOSEN},
              best AS (SELECT genre, max(coalesce(rank, CAST('-Infinity' AS DOUBLE))) AS best_rank, min(id) AS id
                       FROM m GROUP BY genre)
              SELECT m.genre, b.best_rank, m.name AS first_name
              FROM m JOIN best b ON m.genre = b.genre AND m.id = b.id""",
}

# default arguments of each query: the fixed values of plans.catalogue
DEFAULTS: dict[str, dict] = {
    "ru1": {"genre": C.RU1_GENRE, "min_rank": float(C.RU1_MIN_RANK)},
    "ru2": {"genre": C.RU2_GENRE},
    "ru2_strict": {"genre": C.RU2_GENRE},
    "ru3": {"genre": C.RU3_GENRE, "year": C.RU3_YEAR},
    "ru4": {"first_name": C.RU4_FIRST, "last_name": C.RU4_LAST, "genre": C.RU4_GENRE},
    "rda1": {"first_name": C.RDA1_FIRST, "last_name": C.RDA1_LAST},
    "rda2": {"n_genres": C.RDA2_N_GENRES},
    "rda3": {"max_actors": C.RDA3_MAX_ACTORS, "min_rank": float(C.RDA3_MIN_RANK)},
    "rda4_top": {"names": C.default_names()},
    "rda4_max": {"names": C.default_names()},
}


def register_catalogue(tables: dict[str, DataFrame]) -> None:
    """Expose the document tables as temporary views den_<kind>."""
    for kind, df in tables.items():
        df.createOrReplaceTempView(f"den_{kind}")


def run(spark: SparkSession, name: str, **params) -> DataFrame:
    """One query with its default arguments, some replaced.  Spark ignores
    named arguments that a text does not use, so unknown names are errors here."""
    if unknown := set(params) - set(DEFAULTS[name]):
        raise ValueError(f"{name} has no parameter {', '.join(sorted(unknown))}; it has {', '.join(DEFAULTS[name])}")
    args = dict(DEFAULTS[name])
    args.update(params)
    return spark.sql(QUERIES[name], args=args)
