"""The eight catalogue queries over the document tables.

User queries Ru1-Ru4 and analyst queries Rda1-Rda4.  Each takes the document
tables it reads plus its parameters and returns a lazy DataFrame.  Where the
reference runs two queries and ships ids through the client, the plan here is
one DataFrame with a semi join.

A director's movies come from the flat link rows, never from nested lists.
Movies are then taken by a semi join on the ids; a lazily built catalogue can
pass ``movies_for`` instead, which builds the documents of those ids only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import docops as D
from marquee.operators import aggregates as A
from marquee.operators import lookup as L

# Default query parameters (fixed values).  The thresholds and the year are the
# reference's; its genre and person names are replaced by values that exist in
# the test mapping (part types as genres, "Customer 00000000N" as names).
RU1_GENRE, RU1_MIN_RANK = "PROMO", 8
RU2_GENRE = "PROMO"
RU3_GENRE, RU3_YEAR = "ECONOMY", 1995
RU4_FIRST, RU4_LAST, RU4_GENRE = "Customer", "000000007", "SMALL"
RDA1_FIRST, RDA1_LAST = "Customer", "000000007"
RDA2_N_GENRES = 2
RDA3_MAX_ACTORS, RDA3_MIN_RANK = 5, 7
RDA4_N_DIRECTORS = 10


# builds the movie documents of the given keys (a DataFrame with ``id``)
MoviesFor = Callable[[DataFrame], DataFrame]


def movie_ids_of(director_movies: DataFrame, directors: DataFrame) -> DataFrame:
    """(id): movie ids linked to the given directors, once per director.
    (A semi join never multiplies rows, so ``directors`` needs no distinct.)"""
    return L.keep_matching(director_movies, directors.select("id"), "id").select(
        F.col("movie_id").alias("id"))


def one_director(den_directors: DataFrame, first_name: str, last_name: str) -> DataFrame:
    """(id): the lowest id with that name, at most one row."""
    return L.one_key(den_directors,
                     (F.col("first_name") == F.lit(first_name)) & (F.col("last_name") == F.lit(last_name)))


def movies_of(den_movies: DataFrame, ids: DataFrame, movies_for: MoviesFor | None) -> DataFrame:
    return movies_for(ids) if movies_for else L.keep_matching(den_movies, ids)


# -- user queries ----------------------------------------------------------

def ru1(den_movies: DataFrame, genre: str = RU1_GENRE, min_rank: float = RU1_MIN_RANK) -> DataFrame:
    """Movies of a genre ranked above a value: name, rank."""
    return (den_movies.filter(D.has_element("list_genres", genre) & D.greater("rank", min_rank))
            .select("name", "rank"))


def ru2(den_directors: DataFrame, genre: str = RU2_GENRE, strict: bool = False) -> DataFrame:
    """Directors whose genre map has the genre.

    The reference's second condition compares the value with the *array*
    [null, 0], which every scalar passes, so the literal form only tests the
    key (``strict=False``); ``strict=True`` is the intended reading: value
    neither null nor zero (D9).
    """
    cond = (D.map_value_set if strict else D.map_has_key)("dict_genres_den_prob", genre)
    return den_directors.filter(cond).select("first_name", "last_name")


def ru3(den_movies: DataFrame, genre: str = RU3_GENRE, year: int = RU3_YEAR) -> DataFrame:
    """Movies of a genre released in a year: name."""
    return (den_movies.filter(D.has_element("list_genres", genre) & (F.col("year") == F.lit(year)))
            .select("name"))


def ru4(den_movies: DataFrame, den_directors: DataFrame, director_movies: DataFrame,
        first_name: str = RU4_FIRST, last_name: str = RU4_LAST, genre: str = RU4_GENRE,
        movies_for: MoviesFor | None = None) -> DataFrame:
    """Movies of one director (the lowest id with that name, D10) in a genre."""
    one = one_director(den_directors, first_name, last_name)
    found = movies_of(den_movies, movie_ids_of(director_movies, one), movies_for)
    return found.filter(D.has_element("list_genres", genre)).select("id", "name", "year", "rank")


# -- analyst queries -------------------------------------------------------

def rda1(den_movies: DataFrame, den_directors: DataFrame, director_movies: DataFrame,
         first_name: str = RDA1_FIRST, last_name: str = RDA1_LAST,
         movies_for: MoviesFor | None = None) -> DataFrame:
    """Average rank of one director's movies; unranked movies skipped; no row
    when the director is unknown or has no ranked movie (D7)."""
    one = one_director(den_directors, first_name, last_name)
    found = movies_of(den_movies, movie_ids_of(director_movies, one), movies_for)
    return A.global_avg(found.filter(D.not_nan("rank")), "rank", "average_rank")


def rda2(den_directors: DataFrame, n_genres: int = RDA2_N_GENRES) -> DataFrame:
    """Directors with exactly N genres of non-null, non-zero probability."""
    kept = den_directors.select(
        "first_name", "last_name",
        D.nonzero_entries("dict_genres_den_prob").alias("filtered_genres"))
    return (kept.filter(F.col("filtered_genres").isNotNull()
                        & (F.size("filtered_genres") == F.lit(n_genres)))
            .select("first_name", "last_name"))


def rda3(den_movies: DataFrame, max_actors: int = RDA3_MAX_ACTORS,
         min_rank: float = RDA3_MIN_RANK) -> DataFrame:
    """Movies with fewer than X role rows and a rank above N: name."""
    return (den_movies.filter(D.less("den_nb_actors", max_actors) & D.greater("rank", min_rank))
            .select("name"))


def selected_movies(den_movies: DataFrame, den_directors: DataFrame, director_movies: DataFrame,
                    names: Sequence[str], movies_for: MoviesFor | None = None) -> DataFrame:
    """Rda4 step 1: movies of the directors whose full name is in the list,
    one row per (movie, genre)."""
    chosen = den_directors.filter(D.in_list(D.full_name(), names))
    movies = movies_of(den_movies, movie_ids_of(director_movies, chosen), movies_for)
    return movies.select("id", "name", "rank", F.explode("list_genres").alias("genre"))


def rda4_top(den_movies: DataFrame, den_directors: DataFrame, director_movies: DataFrame,
             names: Sequence[str] | None = None, movies_for: MoviesFor | None = None) -> DataFrame:
    """Best movie per genre among the listed directors' movies: the name and
    rank of the highest-ranked movie (ties: lowest id, D8)."""
    m = selected_movies(den_movies, den_directors, director_movies, names or default_names(), movies_for)
    return A.top_per_group(m, "genre", ["name", "rank"])


def rda4_max(den_movies: DataFrame, den_directors: DataFrame, director_movies: DataFrame,
             names: Sequence[str] | None = None, movies_for: MoviesFor | None = None) -> DataFrame:
    """Literal form of Rda4: per genre, the maximum rank (null counted as
    negative infinity) and the name of the group's first (lowest-id) movie,
    which need not be the best one."""
    m = selected_movies(den_movies, den_directors, director_movies, names or default_names(), movies_for)
    return m.groupBy("genre").agg(A.max_or_neg_inf("rank").alias("best_rank"),
                                  F.min_by("name", "id").alias("first_name"))


def default_names(n: int = RDA4_N_DIRECTORS) -> list[str]:
    """Rda4's default director list on the test mapping: directors 1..n."""
    return [f"Customer {i:09d}" for i in range(1, n + 1)]
