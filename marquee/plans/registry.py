"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query reads the driver tables of ``sf_dir`` through the catalogue
mapping, builds the document tables lazily and runs one operator on them;
Catalyst prunes whatever part of the document build the query does not read.
Arrays and maps are returned as sorted text so that results compare across
engines; doubles that are derived (means, shares) are rounded half-up to 6
decimals with the same formula on both sides.

``ORACLE`` holds, per name, DuckDB SQL over the driver tables that computes
the same result; ``marquee.sources.testdata.ORACLE_CTES`` defines the mapping
views it starts from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import docops as D
from marquee.operators import denormalize, nest
from marquee.plans import catalogue as Q
from marquee.plans import jobs
from marquee.plans.reports import column_stats, table_stats
from marquee.functions import clean
from marquee.sources.testdata import Catalog, UncleanCatalog, oracle_with, unclean_with

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def den(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return denormalize.build_all(Catalog(spark, sf_dir))


def movies_for(spark: SparkSession, sf_dir: str) -> Q.MoviesFor:
    """Lookups on the lazily built catalogue build only the looked-up movies."""
    return denormalize.movies_for(Catalog(spark, sf_dir))


STORED_BUCKETS = 8                      # at least
_stored: dict[tuple[str, str], dict[str, str]] = {}


def stored(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The stored catalogue of ``sf_dir``: written by the job on the first
    call of this application, then opened."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        buckets = max(STORED_BUCKETS, jobs.parts_of(Catalog(spark, sf_dir)))
        _stored[key] = jobs.denormalize_job(spark, sf_dir, buckets, prefix=f"stored{len(_stored)}")
    return jobs.open_catalogue(spark, _stored[key])


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Derived doubles rounded for comparison between engines, here only."""
    return df.withColumns({c: D.round_half_up(c) for c in cols})


# -- SQL building blocks (DuckDB) -----------------------------------------

# sql text of a rounded double and of its fixed-decimal form (same formula as
# docops.round_half_up / fixed_text)
def _r6(x: str) -> str:
    return f"floor(({x}) * 1000000.0 + 0.5) / 1000000.0"


def _fx(x: str, d: int = 6) -> str:
    s = float(10 ** d)
    return f"printf('%.{d}f', floor(({x}) * {s} + 0.5) / {s})"


_GENRE_LISTS = """genre_lists as (select movie_id, string_agg(genre, ',' order by genre) as list_genres
    from movies_genres group by movie_id)"""
_DIRECTOR_LISTS = """director_lists as (select movie_id,
    string_agg(cast(director_id as varchar), ',' order by director_id) as list_directors_id
    from movies_directors group by movie_id)"""
_ACTOR_COUNTS = """actor_counts as (select movie_id, count(actor_id) as den_nb_actors
    from roles group by movie_id)"""
_DEN_MOVIES = """den_movies as (select m.id, m.name, m."year", m."rank",
    coalesce(g.list_genres, '') as list_genres,
    coalesce(d.list_directors_id, '') as list_directors_id,
    coalesce(a.den_nb_actors, 0) as den_nb_actors
  from movies m left join genre_lists g on g.movie_id = m.id
  left join director_lists d on d.movie_id = m.id
  left join actor_counts a on a.movie_id = m.id)"""
_GENRE_MAPS = f"""genre_maps as (select director_id,
    string_agg(genre || ':' || {_fx('prob')}, ',' order by genre) as dict_text,
    count(*) as n_genres
  from directors_genres where genre is not null and prob is not null group by director_id)"""
_MOVIE_COUNTS = """movie_counts as (select director_id, count(movie_id) as n_movies
  from movies_directors group by director_id)"""
_ROLE_COUNTS = """role_counts as (select actor_id, count(movie_id) as n_movies from roles group by actor_id)"""


def _chunks(links: str, person: str, width: int) -> str:
    """Chunked lists of a person's movies as text: movie:repeats."""
    return f"""select id, chunk, string_agg(movie_id || ':' || n, ',' order by movie_id) as list_movies,
  count(*) as n_movies
from (select {person} as id, movie_id, movie_id // {width} as chunk, count(*) as n
      from {links} where {person} is not null and movie_id is not null group by all)
group by id, chunk"""


def _with(views: tuple[str, ...], *extra: str) -> str:
    w = oracle_with(*views).rstrip("\n")
    if extra:
        w += ",\n" + ",\n".join(extra)
    return w + "\n"


_W_DEN_MOVIES = _with(("movies", "movies_genres", "movies_directors", "roles"),
                      _GENRE_LISTS, _DIRECTOR_LISTS, _ACTOR_COUNTS, _DEN_MOVIES)
_W_DIRECTORS = _with(("directors", "movies_directors", "directors_genres"),
                     _GENRE_MAPS, _MOVIE_COUNTS)
_W_ALL = _with(("movies", "movies_genres", "movies_directors", "roles", "directors",
                "actors", "directors_genres"),
               _GENRE_LISTS, _DIRECTOR_LISTS, _ACTOR_COUNTS, _DEN_MOVIES, _GENRE_MAPS,
               _MOVIE_COUNTS, _ROLE_COUNTS)


def _one_director(first: str, last: str) -> str:
    return (f"one as (select min(id) as id from directors "
            f"where first_name = '{first}' and last_name = '{last}'),\n"
            "one_movies as (select md.movie_id from movies_directors md "
            "join one on md.director_id = one.id)")


def _names_sql(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


# -- document tables (denormalisation) -------------------------------------

@register("den_movies", _W_DEN_MOVIES + """
select id, name, "year", "rank", list_genres, list_directors_id, den_nb_actors from den_movies""")
def q_den_movies(spark, sf_dir):
    m = den(spark, sf_dir)["movies"]
    return m.select("id", "name", "year", "rank",
                    D.sorted_text("list_genres").alias("list_genres"),
                    D.sorted_text("list_directors_id").alias("list_directors_id"),
                    "den_nb_actors")


@register("den_directors", _W_DIRECTORS + """
select d.id, d.first_name, d.last_name, coalesce(l.n_movies, 0) as n_movies,
  coalesce(g.dict_text, '') as dict_genres_den_prob
from directors d left join movie_counts l on l.director_id = d.id
left join genre_maps g on g.director_id = d.id""")
def q_den_directors(spark, sf_dir):
    return _directors_text(den(spark, sf_dir)["directors"])


def _directors_text(d: DataFrame) -> DataFrame:
    return d.select("id", "first_name", "last_name", "n_movies",
                    D.map_text("dict_genres_den_prob").alias("dict_genres_den_prob"))


@register("den_actors", _with(("actors", "roles"), _ROLE_COUNTS) + """
select a.id, a.first_name, a.last_name, coalesce(l.n_movies, 0) as n_movies
from actors a left join role_counts l on l.actor_id = a.id""")
def q_den_actors(spark, sf_dir):
    return den(spark, sf_dir)["actors"]


@register("den_list_genres", _W_DEN_MOVIES + "select id, list_genres from den_movies")
def q_den_list_genres(spark, sf_dir):
    m = den(spark, sf_dir)["movies"]
    return m.select("id", D.sorted_text("list_genres").alias("list_genres"))


@register("den_list_directors", _W_DEN_MOVIES + "select id, list_directors_id from den_movies")
def q_den_list_directors(spark, sf_dir):
    m = den(spark, sf_dir)["movies"]
    return m.select("id", D.sorted_text("list_directors_id").alias("list_directors_id"))


@register("den_nb_actors", _W_DEN_MOVIES + "select id, den_nb_actors from den_movies")
def q_den_nb_actors(spark, sf_dir):
    return den(spark, sf_dir)["movies"].select("id", "den_nb_actors")


def _list_rows(links: DataFrame, width: int) -> DataFrame:
    lists = nest.chunk_lists(links, width)
    text = F.transform("list_movies", lambda e: F.concat_ws(":", e["movie_id"], e["n"]))
    return lists.select("id", "chunk", F.array_join(text, ",").alias("list_movies"),
                        F.size("list_movies").cast("bigint").alias("n_movies"))


SMALL_CHUNK = 1000


@register("den_list_movies", oracle_with("movies_directors") + _chunks("movies_directors", "director_id", nest.CHUNK_IDS))
def q_den_list_movies(spark, sf_dir):
    return _list_rows(den(spark, sf_dir)["director_movies"], nest.CHUNK_IDS)


@register("den_list_movies_small", oracle_with("movies_directors") + _chunks("movies_directors", "director_id", SMALL_CHUNK))
def q_den_list_movies_small(spark, sf_dir):
    """The same rule with a small range, so every list has several chunks."""
    return _list_rows(den(spark, sf_dir)["director_movies"], SMALL_CHUNK)


@register("den_list_roles_small", oracle_with("roles") + _chunks("roles", "actor_id", SMALL_CHUNK))
def q_den_list_roles_small(spark, sf_dir):
    return _list_rows(den(spark, sf_dir)["actor_movies"], SMALL_CHUNK)


@register("den_genre_prob_map", _W_DIRECTORS + """
select d.id, coalesce(g.dict_text, '') as dict_genres_den_prob, coalesce(g.n_genres, 0) as n_genres
from directors d left join genre_maps g on g.director_id = d.id""")
def q_den_genre_prob_map(spark, sf_dir):
    d = den(spark, sf_dir)["directors"]
    return d.select("id", D.map_text("dict_genres_den_prob").alias("dict_genres_den_prob"),
                    F.size("dict_genres_den_prob").cast("bigint").alias("n_genres"))


@register("agg_group_by_array", _W_DEN_MOVIES + """
select list_genres, count(*) as n_movies from den_movies group by list_genres""")
def q_agg_group_by_array(spark, sf_dir):
    """A4: group by an array-typed column (canonical because lists are sorted)."""
    m = den(spark, sf_dir)["movies"]
    return (m.groupBy("list_genres").agg(F.count(F.lit(1)).alias("n_movies"))
            .select(D.sorted_text("list_genres").alias("list_genres"), "n_movies"))


# -- user queries ----------------------------------------------------------

@register("ru1", oracle_with("movies", "movies_genres") + """
select m.name, m."rank" from movies m
where m."rank" > 8 and exists (select 1 from movies_genres g where g.movie_id = m.id and g.genre = 'PROMO')""")
def q_ru1(spark, sf_dir):
    """Only the documents of movies that pass the rank are built."""
    cat = Catalog(spark, sf_dir)
    ids = cat.movies().filter(D.greater("rank", 8)).select("id")
    return Q.ru1(denormalize.movies_for(cat)(jobs.spread(ids, cat)), "PROMO", 8)


@register("ru2", oracle_with("directors", "movies_directors", "directors_genres") + """
select d.first_name, d.last_name from directors d
where exists (select 1 from directors_genres g where g.director_id = d.id
              and g.genre = 'PROMO' and g.prob is not null)""")
def q_ru2(spark, sf_dir):
    return Q.ru2(den(spark, sf_dir)["directors"], "PROMO", strict=False)


@register("ru2_strict", oracle_with("directors", "movies_directors", "directors_genres") + """
select d.first_name, d.last_name from directors d
where exists (select 1 from directors_genres g where g.director_id = d.id
              and g.genre = 'PROMO' and g.prob is not null and g.prob <> 0)""")
def q_ru2_strict(spark, sf_dir):
    return Q.ru2(den(spark, sf_dir)["directors"], "PROMO", strict=True)


@register("ru3", oracle_with("movies", "movies_genres") + """
select m.name from movies m
where m."year" = 1995 and exists (select 1 from movies_genres g where g.movie_id = m.id and g.genre = 'ECONOMY')""")
def q_ru3(spark, sf_dir):
    """Only the documents of that year's movies are built."""
    cat = Catalog(spark, sf_dir)
    ids = cat.movies().filter(F.col("year") == 1995).select("id")
    return Q.ru3(denormalize.movies_for(cat)(jobs.spread(ids, cat)), "ECONOMY", 1995)


@register("ru4", _with(("movies", "movies_genres", "movies_directors", "directors"),
                       _one_director("Customer", "000000007")) + """
select m.id, m.name, m."year", m."rank" from movies m
where m.id in (select movie_id from one_movies)
  and exists (select 1 from movies_genres g where g.movie_id = m.id and g.genre = 'SMALL')""")
def q_ru4(spark, sf_dir):
    d = den(spark, sf_dir)
    return Q.ru4(d["movies"], d["directors"], d["director_movies"], "Customer", "000000007", "SMALL",
                 movies_for=movies_for(spark, sf_dir))


@register("lim_find_one", oracle_with("directors") + """
select id, first_name, last_name from directors
where first_name = 'Customer' and last_name = '000000007' order by id limit 1""")
def q_lim_find_one(spark, sf_dir):
    from marquee.operators.lookup import find_one
    d = den(spark, sf_dir)["directors"]
    return find_one(d, (F.col("first_name") == "Customer") & (F.col("last_name") == "000000007")
                    ).select("id", "first_name", "last_name")


# -- analyst queries -------------------------------------------------------

@register("rda1", _with(("movies", "movies_directors", "directors"),
                        _one_director("Customer", "000000007")) + f"""
select {_r6('avg(m."rank")')} as average_rank from movies m
where m.id in (select movie_id from one_movies) and m."rank" is not null and not isnan(m."rank")
having count(*) > 0""")
def q_rda1(spark, sf_dir):
    d = den(spark, sf_dir)
    return _rounded(Q.rda1(d["movies"], d["directors"], d["director_movies"], "Customer", "000000007",
                           movies_for=movies_for(spark, sf_dir)), "average_rank")


def _rda2_sql(n: int) -> str:
    return oracle_with("directors", "movies_directors", "directors_genres") + f"""
select d.first_name, d.last_name from directors d
left join (select director_id, count(*) as n from directors_genres
           where genre is not null and prob is not null and prob <> 0 group by director_id) c
  on c.director_id = d.id
where coalesce(c.n, 0) = {n}"""


@register("rda2", _rda2_sql(2))
def q_rda2(spark, sf_dir):
    return Q.rda2(den(spark, sf_dir)["directors"], 2)


@register("rda2_n6", _rda2_sql(6))
def q_rda2_n6(spark, sf_dir):
    return Q.rda2(den(spark, sf_dir)["directors"], 6)


@register("rda3", oracle_with("movies", "roles") + """
select m.name from movies m
left join (select movie_id, count(actor_id) as n from roles group by movie_id) r on r.movie_id = m.id
where coalesce(r.n, 0) < 5 and m."rank" > 7""")
def q_rda3(spark, sf_dir):
    return Q.rda3(den(spark, sf_dir)["movies"], 5, 7)


def _rda4_rows_sql() -> str:
    names = _names_sql(Q.default_names())
    return _with(("movies", "movies_genres", "movies_directors", "directors"),
                 f"sel as (select id from directors where first_name || ' ' || last_name in ({names}))",
                 "mv as (select distinct md.movie_id from movies_directors md join sel on md.director_id = sel.id)",
                 """x as (select g.genre, m.id, m.name, m."rank" from movies m
                    join mv on mv.movie_id = m.id join movies_genres g on g.movie_id = m.id)""")


@register("rda4_top", _rda4_rows_sql() + """
select genre, best_name, best_rank from (
  select genre, name as best_name, "rank" as best_rank,
         row_number() over (partition by genre order by "rank" desc nulls last, id) as rn
  from x) t where rn = 1""")
def q_rda4_top(spark, sf_dir):
    d = den(spark, sf_dir)
    return Q.rda4_top(d["movies"], d["directors"], d["director_movies"], movies_for=movies_for(spark, sf_dir))


@register("rda4_max", _rda4_rows_sql() + """
select genre, max(coalesce("rank", '-inf'::double)) as best_rank, arg_min(name, id) as first_name
from x group by genre""")
def q_rda4_max(spark, sf_dir):
    d = den(spark, sf_dir)
    return Q.rda4_max(d["movies"], d["directors"], d["director_movies"], movies_for=movies_for(spark, sf_dir))


# -- document operators, one key each --------------------------------------

_NAMES_IN = Q.default_names() + ["Nobody Here"]


@register("flt_array_contains", oracle_with("movies", "movies_genres") + """
select m.id, m.name from movies m
where exists (select 1 from movies_genres g where g.movie_id = m.id and g.genre = 'STANDARD')""")
def q_flt_array_contains(spark, sf_dir):
    m = den(spark, sf_dir)["movies"]
    return m.filter(D.has_element("list_genres", "STANDARD")).select("id", "name")


@register("flt_in_list", oracle_with("directors") + f"""
select id, first_name || ' ' || last_name as full_name from directors
where first_name || ' ' || last_name in ({_names_sql(_NAMES_IN)})""")
def q_flt_in_list(spark, sf_dir):
    d = den(spark, sf_dir)["directors"]
    return (d.select("id", D.full_name().alias("full_name"))
            .filter(D.in_list("full_name", _NAMES_IN)))


@register("flt_in_list_id", oracle_with("movies") + """
select id, name from movies where id in (1, 2, 3, 32, 33, 1000000007)""")
def q_flt_in_list_id(spark, sf_dir):
    """P10 on a stored column: the list reaches the scan."""
    m = den(spark, sf_dir)["movies"]
    return m.filter(D.in_list("id", [1, 2, 3, 32, 33, 1000000007])).select("id", "name")


@register("flt_arrays_overlap", oracle_with("movies", "movies_genres") + """
select m.id, m.name from movies m
where exists (select 1 from movies_genres g where g.movie_id = m.id and g.genre in ('PROMO', 'SMALL'))""")
def q_flt_arrays_overlap(spark, sf_dir):
    m = den(spark, sf_dir)["movies"]
    return m.filter(D.any_element_in("list_genres", ["PROMO", "SMALL"])).select("id", "name")


@register("flt_not_nan", oracle_with("movies") + """
select id, "rank" from movies where "rank" is not null and not isnan("rank")""")
def q_flt_not_nan(spark, sf_dir):
    m = den(spark, sf_dir)["movies"]
    return m.filter(D.not_nan("rank")).select("id", "rank")


@register("arr_transform", oracle_with("roles") + f"""
select id, chunk, string_agg(cast(movie_id as varchar), ',' order by movie_id) as list_movies_id, count(*) as n_movies
from (select distinct actor_id as id, movie_id, movie_id // {SMALL_CHUNK} as chunk from roles) group by id, chunk""")
def q_arr_transform(spark, sf_dir):
    """map a conversion over every element (text ids back to bigint)."""
    lists = nest.chunk_lists(den(spark, sf_dir)["actor_movies"], SMALL_CHUNK)
    as_text = lists.select("id", "chunk", F.transform("list_movies", lambda e: e["movie_id"].cast("string")).alias("l"))
    typed = as_text.select("id", "chunk", F.transform("l", lambda e: e.try_cast("bigint")).alias("l"))
    return typed.select("id", "chunk", D.sorted_text("l").alias("list_movies_id"),
                        F.size("l").cast("bigint").alias("n_movies"))


@register("arr_size", _W_DEN_MOVIES + """
select m.id, coalesce(g.n, 0) as n_genres, coalesce(d.n, 0) as n_directors from movies m
left join (select movie_id, count(genre) as n from movies_genres group by 1) g on g.movie_id = m.id
left join (select movie_id, count(director_id) as n from movies_directors group by 1) d on d.movie_id = m.id""")
def q_arr_size(spark, sf_dir):
    m = den(spark, sf_dir)["movies"]
    return m.select("id", F.size("list_genres").cast("bigint").alias("n_genres"),
                    F.size("list_directors_id").cast("bigint").alias("n_directors"))


@register("arr_unwind", oracle_with("movies", "movies_genres") + """
select m.id, g.genre from movies m join movies_genres g on g.movie_id = m.id""")
def q_arr_unwind(spark, sf_dir):
    m = den(spark, sf_dir)["movies"]
    return m.select("id", F.explode("list_genres").alias("genre"))


@register("map_entries", oracle_with("directors", "movies_directors", "directors_genres") + """
select d.id, g.genre, g.prob from directors d join directors_genres g on g.director_id = d.id
where g.genre is not null and g.prob is not null""")
def q_map_entries(spark, sf_dir):
    d = den(spark, sf_dir)["directors"]
    e = d.select("id", F.explode(F.map_entries("dict_genres_den_prob")).alias("e"))
    return e.select("id", F.col("e.key").alias("genre"), F.col("e.value").alias("prob"))


@register("map_from_entries", _with(("directors", "movies_directors", "directors_genres")) + f"""
select d.id, coalesce(string_agg(g.genre || ':' || {_fx('g.prob')}, ',' order by g.genre), '') as dict_major
from directors d left join directors_genres g on g.director_id = d.id and g.prob >= 0.5
group by d.id""")
def q_map_from_entries(spark, sf_dir):
    """entries filtered as an array, then turned back into a map."""
    d = den(spark, sf_dir)["directors"]
    kept = F.filter(F.map_entries("dict_genres_den_prob"), lambda e: e["value"] >= F.lit(0.5))
    return d.select("id", D.map_text(F.map_from_entries(kept)).alias("dict_major"))


@register("map_transform_values", _W_DIRECTORS + """
select d.id, coalesce(g.dict_text, '') as dict_genres_den_prob
from directors d left join genre_maps g on g.director_id = d.id""")
def q_map_transform_values(spark, sf_dir):
    """A map of text values converted value by value to double."""
    from marquee.functions.clean import fix_types
    d = den(spark, sf_dir)["directors"]
    as_text = d.select("id", F.col("dict_genres_den_prob").cast("map<string,string>")
                       .alias("dict_genres_den_prob"))
    fixed = fix_types(as_text, {"dict_genres_den_prob": "map<string,double>"})
    return fixed.select("id", D.map_text("dict_genres_den_prob").alias("dict_genres_den_prob"))


@register("map_filter", oracle_with("directors", "movies_directors", "directors_genres") + """
select d.id, coalesce(c.n, 0) as n_nonzero from directors d
left join (select director_id, count(*) as n from directors_genres
           where genre is not null and prob is not null and prob <> 0 group by 1) c on c.director_id = d.id""")
def q_map_filter(spark, sf_dir):
    d = den(spark, sf_dir)["directors"]
    return d.select("id", F.size(D.nonzero_entries("dict_genres_den_prob")).cast("bigint")
                    .alias("n_nonzero"))


@register("fn_cond", oracle_with("movies") + """
select id, case when "rank" is null then -1.0 else "rank" end as rank_filled,
  case when "rank" > 8 then 'high' when "rank" > 5 then 'mid' else 'low' end as rank_class
from movies""")
def q_fn_cond(spark, sf_dir):
    m = den(spark, sf_dir)["movies"]
    r = F.col("rank")
    return m.select("id", F.when(r.isNull(), F.lit(-1.0)).otherwise(r).alias("rank_filled"),
                    F.when(r > 8, "high").when(r > 5, "mid").otherwise("low").alias("rank_class"))


@register("agg_push", oracle_with("directors", "movies_directors") + f"""
select md.movie_id from directors d join movies_directors md on md.director_id = d.id
where d.first_name || ' ' || d.last_name in ({_names_sql(Q.default_names())})""")
def q_agg_push(spark, sf_dir):
    """The pushed list of movie ids of the chosen directors, kept as rows
    of a DataFrame (one per unwound element) instead of one global array."""
    cat = Catalog(spark, sf_dir)
    chosen = cat.directors().filter(D.in_list(D.full_name(), Q.default_names()))
    links = cat.movies_directors().withColumnRenamed("director_id", "id")
    return Q.movie_ids_of(links, chosen).withColumnRenamed("id", "movie_id")


@register("project_full_name", oracle_with("directors") + """
select id, first_name || ' ' || last_name as full_name from directors""")
def q_project_full_name(spark, sf_dir):
    d = den(spark, sf_dir)["directors"]
    return d.select("id", D.full_name().alias("full_name"))


@register("str_distinct_parts", oracle_with("roles") + f"""
select actor_id as id, movie_id // {SMALL_CHUNK} as chunk, count(distinct movie_id) as n_distinct
from roles group by all""")
def q_str_distinct_parts(spark, sf_dir):
    """distinct parts of a delimited text (an actor's movies, each named
    once more if the actor has several roles in it)."""
    lists = nest.chunk_lists(den(spark, sf_dir)["actor_movies"], SMALL_CHUNK)
    ids = F.transform("list_movies", lambda e: e["movie_id"])
    again = F.transform(F.filter("list_movies", lambda e: e["n"] > 1), lambda e: e["movie_id"])
    text = F.array_join(F.concat(ids, again).cast("array<string>"), ",")
    return lists.select("id", "chunk", D.distinct_parts(text).cast("bigint").alias("n_distinct"))


@register("str_split_trim", _W_DEN_MOVIES + """
select id, replace(list_genres, ',', '|') as genres from den_movies""")
def q_str_split_trim(spark, sf_dir):
    """a quoted, blank-padded list text split back into clean parts."""
    m = den(spark, sf_dir)["movies"]
    quoted = F.array_join(F.transform("list_genres", lambda g: F.concat(F.lit("'"), g, F.lit("'"))),
                          ",  ")
    return m.select("id", F.array_join(D.split_trim(quoted), "|").alias("genres"))


# -- cleaning and type repair, on inputs with bad values ---------------------

def _unclean(spark, sf_dir) -> UncleanCatalog:
    return UncleanCatalog(spark, sf_dir)


@register("clean_numeric", unclean_with("movies") + 'select id, "rank", "year" from movies')
def q_clean_numeric(spark, sf_dir):
    t = clean.clean_numeric(_unclean(spark, sf_dir).movies_text())
    return t.select(clean.lenient(F.col("id"), "bigint").alias("id"), "rank", "year")


@register("clean_sentinel", unclean_with("movies") + 'select id, coalesce("year", -1) as "year" from movies')
def q_clean_sentinel(spark, sf_dir):
    t = clean.clean_sentinel(_unclean(spark, sf_dir).movies_text())
    return t.select(clean.lenient(F.col("id"), "bigint").alias("id"), "year")


@register("clean_strict", oracle_with("movies") + 'select id, "rank", "year" from movies')
def q_clean_strict(spark, sf_dir):
    """Strict typing of well-formed text (bad text raises: tests)."""
    m = Catalog(spark, sf_dir).movies()
    text = m.select([F.col(c).cast("string").alias(c) for c in m.columns])
    return clean.type_table(text, "movies", "strict").select("id", "rank", "year")


@register("flt_not_nan_unclean", unclean_with("movies") + """
select id, "rank" from movies where "rank" is not null""")
def q_flt_not_nan_unclean(spark, sf_dir):
    return _unclean(spark, sf_dir).raw_movies().filter(D.not_nan("rank")).select("id", "rank")


_UNCLEAN_GENRES = unclean_with("directors", "movies_directors", "directors_genres")


@register("ru2_unclean", _UNCLEAN_GENRES + """
select d.first_name, d.last_name from directors d
where exists (select 1 from directors_genres g where g.director_id = d.id
              and g.genre = 'PROMO' and g.prob is not null)""")
def q_ru2_unclean(spark, sf_dir):
    return Q.ru2(denormalize.build_all(_unclean(spark, sf_dir))["directors"], "PROMO", strict=False)


@register("ru2_strict_unclean", _UNCLEAN_GENRES + """
select d.first_name, d.last_name from directors d
where exists (select 1 from directors_genres g where g.director_id = d.id
              and g.genre = 'PROMO' and g.prob <> 0)""")
def q_ru2_strict_unclean(spark, sf_dir):
    return Q.ru2(denormalize.build_all(_unclean(spark, sf_dir))["directors"], "PROMO", strict=True)


@register("rda2_unclean", _UNCLEAN_GENRES + """
select d.first_name, d.last_name from directors d
join (select director_id, count(*) as n from directors_genres where prob <> 0 group by 1) c on c.director_id = d.id
where c.n = 2""")
def q_rda2_unclean(spark, sf_dir):
    return Q.rda2(denormalize.build_all(_unclean(spark, sf_dir))["directors"], 2)


_FEW = ["Customer 000000029"]        # has genres without any ranked movie
_UNRANKED = unclean_with("movies", "movies_genres", "movies_directors", "directors") + f""",
x as (select distinct g.genre, m.id, m.name, m."rank" from movies m join movies_genres g on g.movie_id = m.id
  join movies_directors md on md.movie_id = m.id join directors d on d.id = md.director_id
  where d.first_name || ' ' || d.last_name in ({_names_sql(_FEW)}))
"""


@register("rda4_max_unclean", _UNRANKED + """
select genre, max(coalesce("rank", '-inf'::double)) as best_rank, arg_min(name, id) as first_name from x group by genre""")
def q_rda4_max_unclean(spark, sf_dir):
    """Genres whose movies are all unranked give negative infinity."""
    cat = _unclean(spark, sf_dir)
    d = denormalize.build_all(cat)
    return Q.rda4_max(d["movies"], d["directors"], d["director_movies"], _FEW, denormalize.movies_for(cat))


@register("rda4_top_unclean", _UNRANKED + """
select genre, best_name, best_rank from (
  select genre, name as best_name, "rank" as best_rank,
         row_number() over (partition by genre order by "rank" desc nulls last, id) as rn from x) where rn = 1""")
def q_rda4_top_unclean(spark, sf_dir):
    cat = _unclean(spark, sf_dir)
    d = denormalize.build_all(cat)
    return Q.rda4_top(d["movies"], d["directors"], d["director_movies"], _FEW, denormalize.movies_for(cat))


def _repaired(spark, df: DataFrame, spec: dict[str, str], mode: str) -> DataFrame:
    """The collection repaired, written to a new path and read back."""
    return jobs.materialize(clean.fix_types(df, spec, mode), "repaired")


_BAD = "x"          # stands before a number that then is none


def _spoilt(c: str, when) -> F.Column:
    return F.when(when, F.concat(F.lit(_BAD), F.col(c).cast("string"))).otherwise(F.col(c).cast("string")).alias(c)


def _movies_text(d: DataFrame, spoil: bool) -> DataFrame:
    every = lambda k: (F.col("id") % k == 0) & F.lit(spoil)
    ids = F.col("list_directors_id").cast("array<string>")
    return d.select("name", _spoilt("id", every(7)), _spoilt("rank", every(5)), _spoilt("year", every(3)),
                    F.when(every(4), F.concat(ids, F.array(F.lit("?")))).otherwise(ids).alias("list_directors_id"),
                    F.col("den_nb_actors").cast("string").alias("den_nb_actors"))


_MOVIE_SPEC = {"id": "bigint", "rank": "double", "year": "int", "list_directors_id": "array<bigint>",
               "den_nb_actors": "bigint"}


def _movie_rows(df: DataFrame) -> DataFrame:
    return df.select("name", "id", "rank", "year", D.sorted_text(F.filter("list_directors_id", lambda x: x.isNotNull()))
                     .alias("list_directors_id"), F.size("list_directors_id").cast("bigint").alias("n_directors"),
                     "den_nb_actors")


@register("fix_movies_lenient", _W_DEN_MOVIES + """
select name, case when id % 7 <> 0 then id end as id, case when id % 5 <> 0 then "rank" end as "rank",
  case when id % 3 <> 0 then "year" end as "year", list_directors_id,
  case when list_directors_id = '' then 0 else len(string_split(list_directors_id, ',')) end
    + case when id % 4 = 0 then 1 else 0 end as n_directors, den_nb_actors from den_movies""")
def q_fix_movies_lenient(spark, sf_dir):
    text = _movies_text(den(spark, sf_dir)["movies"], spoil=True)
    return _movie_rows(_repaired(spark, text, _MOVIE_SPEC, "lenient"))


_FIX_SQL = _W_DEN_MOVIES + """select name, id, "rank", "year", list_directors_id,
  cast(case when list_directors_id = '' then 0 else len(string_split(list_directors_id, ',')) end as bigint) as n_directors,
  den_nb_actors from den_movies"""


@register("fix_types_lenient", _FIX_SQL)
def q_fix_types_lenient(spark, sf_dir):
    return _movie_rows(clean.fix_types(_movies_text(den(spark, sf_dir)["movies"], spoil=False), _MOVIE_SPEC, "lenient"))


@register("fix_types_strict", _FIX_SQL)
def q_fix_types_strict(spark, sf_dir):
    text = _movies_text(den(spark, sf_dir)["movies"], spoil=False)
    return _movie_rows(_repaired(spark, text, _MOVIE_SPEC, "strict"))


@register("fix_directors_lenient", _with(("directors", "movies_directors", "directors_genres"), f"""maps as (
  select director_id, string_agg(genre || ':' || case when length(genre) % 2 = 0 then 'null' else {_fx('prob')} end, ','
                                 order by genre) as dict_text
  from directors_genres where genre is not null and prob is not null group by director_id)""", _MOVIE_COUNTS) + """
select d.last_name, case when d.id % 7 <> 0 then d.id end as id,
  case when d.id % 3 <> 0 then coalesce(l.n_movies, 0) end as n_movies, coalesce(m.dict_text, '') as dict_genres_den_prob
from directors d left join maps m on m.director_id = d.id left join movie_counts l on l.director_id = d.id""")
def q_fix_directors_lenient(spark, sf_dir):
    d = den(spark, sf_dir)["directors"]
    values = F.transform_values("dict_genres_den_prob", lambda k, v: F.when(
        F.length(k) % 2 == 0, F.concat(F.lit(_BAD), v.cast("string"))).otherwise(v.cast("string")))
    text = d.select("last_name", _spoilt("id", F.col("id") % 7 == 0), _spoilt("n_movies", F.col("id") % 3 == 0),
                    values.alias("dict_genres_den_prob"))
    fixed = _repaired(spark, text, {"id": "bigint", "n_movies": "bigint",
                                    "dict_genres_den_prob": "map<string,double>"}, "lenient")
    return fixed.select("last_name", "id", "n_movies", D.map_text("dict_genres_den_prob").alias("dict_genres_den_prob"))


@register("fix_actors_lenient", oracle_with("roles") + f"""
select id, chunk, string_agg(case when movie_id % 3 <> 0 then cast(movie_id as varchar) end, ',' order by movie_id)
    as list_movies_id, count(*) as n_movies
from (select distinct actor_id as id, movie_id, movie_id // {SMALL_CHUNK} as chunk from roles) group by id, chunk""")
def q_fix_actors_lenient(spark, sf_dir):
    lists = nest.chunk_lists(den(spark, sf_dir)["actor_movies"], SMALL_CHUNK)
    text = F.transform("list_movies", lambda e: F.when(e["movie_id"] % 3 == 0, F.concat(
        F.lit(_BAD), e["movie_id"].cast("string"))).otherwise(e["movie_id"].cast("string")))
    fixed = _repaired(spark, lists.select(F.col("id").cast("string").alias("id"), "chunk", text.alias("list_movies_id")),
                      {"id": "bigint", "list_movies_id": "array<bigint>"}, "lenient")
    good = F.filter("list_movies_id", lambda x: x.isNotNull())
    return fixed.select("id", "chunk", F.when(F.size(good) > 0, D.sorted_text(good)).alias("list_movies_id"),
                        F.size("list_movies_id").cast("bigint").alias("n_movies"))


# -- sources and sinks (written under the shared checkpoint folder) --------

@register("src_csv_roundtrip", oracle_with("movies") + 'select id, name, "year", "rank" from movies')
def q_src_csv_roundtrip(spark, sf_dir):
    from marquee.functions.clean import type_table
    from marquee.session import scratch_path
    from marquee.sources import files
    path = scratch_path(spark, "movies-csv")
    files.write_source_csv(Catalog(spark, sf_dir).movies(), path)
    return type_table(files.read_source_csv(spark, path, "movies"), "movies", "lenient")


@register("sink_json_roundtrip", _W_DEN_MOVIES + """
select id, name, "year", "rank", list_genres, list_directors_id, den_nb_actors from den_movies""")
def q_sink_json_roundtrip(spark, sf_dir):
    from marquee import schemas
    from marquee.session import scratch_path
    from marquee.sources import files
    path = scratch_path(spark, "den-movies-json")
    files.write_json(den(spark, sf_dir)["movies"], path)
    m = files.read_json(spark, path, schemas.DEN_MOVIES)
    return m.select("id", "name", "year", "rank",
                    D.sorted_text("list_genres").alias("list_genres"),
                    D.sorted_text("list_directors_id").alias("list_directors_id"),
                    "den_nb_actors")


@register("sink_append", oracle_with("actors") + "select id, cast(2 as bigint) as n_copies from actors")
def q_sink_append(spark, sf_dir):
    """The same rows appended twice; every id is then stored twice,
    and the observed counts of both writes agree."""
    from marquee.session import scratch_path
    from marquee.sources import files
    path = scratch_path(spark, "den-actors-append")
    a = den(spark, sf_dir)["actors"]
    n1 = files.append(a, path)
    n2 = files.append(a, path)
    if n1 != n2:
        raise RuntimeError(f"append wrote {n1} then {n2} rows")
    rows = spark.read.parquet(path)
    return rows.groupBy("id").agg(F.count(F.lit(1)).alias("n_copies"))


# -- reports -----------------------------------------------------------------

def _share_sql(src: str, pred: str) -> str:
    return f"""
select count(*) filter (where {pred}) as matched,
  count(*) - count(*) filter (where {pred}) as other,
  count(*) as total,
  {_r6(f'count(*) filter (where {pred}) * 100.0 / count(*)')} as pct_matched,
  {_fx(f'count(*) filter (where {pred}) * 100.0 / count(*)', 1)} || '%' as pct_label
from {src}"""


@register("rpt_share_genres", oracle_with("directors", "movies_directors", "directors_genres") + """,
nz as (select d.id, coalesce(c.n, 0) as n from directors d
  left join (select director_id, count(*) as n from directors_genres
             where genre is not null and prob is not null and prob <> 0 group by 1) c
  on c.director_id = d.id)""" + _share_sql("nz", "n = 2"))
def q_rpt_share_genres(spark, sf_dir):
    from marquee.plans.reports import share_directors_with_n_genres
    return _rounded(share_directors_with_n_genres(den(spark, sf_dir)["directors"], 2), "pct_matched")


@register("rpt_share_movies", _W_DEN_MOVIES + _share_sql(
    "den_movies", 'den_nb_actors < 5 and "rank" > 7'))
def q_rpt_share_movies(spark, sf_dir):
    from marquee.plans.reports import share_movies
    return _rounded(share_movies(den(spark, sf_dir)["movies"], 5, 7), "pct_matched")


@register("rpt_distribution", oracle_with("movies", "directors", "actors") + """,
a as (select cast(id % 4 as int) as shard, count(*) as n from actors group by 1),
m as (select cast(id % 4 as int) as shard, count(*) as n from movies group by 1),
d as (select cast(id % 4 as int) as shard, count(*) as n from directors group by 1)
select coalesce(a.shard, m.shard, d.shard) as shard, coalesce(a.n, 0) as count_actors,
  coalesce(m.n, 0) as count_movies, coalesce(d.n, 0) as count_directors
from a full outer join m on a.shard = m.shard full outer join d on coalesce(a.shard, m.shard) = d.shard""")
def q_rpt_distribution(spark, sf_dir):
    from marquee.plans.reports import distribution
    d = den(spark, sf_dir)
    return distribution({k: d[k] for k in ("actors", "movies", "directors")}, shards=4)


@register("rpt_table_stats", _W_ALL + f""",
ds as (select d.id, coalesce(l.n_movies, 0) as n from directors d left join movie_counts l on l.director_id = d.id),
acs as (select a.id, coalesce(l.n_movies, 0) as n from actors a left join role_counts l on l.actor_id = a.id),
ms as (select id, len(string_split(list_genres, ',')) - case when list_genres = '' then 1 else 0 end as n
       from den_movies)
select 'movies' as collection, count(*) as n_rows, count(distinct id) as n_distinct_id,
  cast(min(n) as bigint) as min_list, {_r6('avg(n)')} as avg_list, cast(max(n) as bigint) as max_list from ms
union all
select 'directors', count(*), count(distinct id), cast(min(n) as bigint), {_r6('avg(n)')}, cast(max(n) as bigint) from ds
union all
select 'actors', count(*), count(distinct id), cast(min(n) as bigint), {_r6('avg(n)')}, cast(max(n) as bigint) from acs""")
def q_rpt_table_stats(spark, sf_dir):
    d = den(spark, sf_dir)
    stats = (table_stats("movies", d["movies"], F.size("list_genres"))
             .unionByName(table_stats("directors", d["directors"], F.col("n_movies")))
             .unionByName(table_stats("actors", d["actors"], F.col("n_movies"))))
    return _rounded(stats, "avg_list")


_STAT_COLUMNS = {"movies": ["id", "name", "year", "den_nb_actors", "list_genres"],
                 "directors": ["id", "first_name", "last_name", "n_movies"],
                 "actors": ["id", "first_name", "last_name", "n_movies"]}
_STAT_SQL = {"movies": """(select m.*, a.den_nb_actors, nullif(g.list_genres, '') list_genres from movies m
                left join actor_counts a on a.movie_id = m.id left join genre_lists g on g.movie_id = m.id)""",
             "directors": """(select d.*, l.n_movies from directors d left join movie_counts l on l.director_id = d.id)""",
             "actors": """(select a.*, l.n_movies from actors a left join role_counts l on l.actor_id = a.id)"""}


@register("rpt_column_stats", unclean_with("movies", "movies_genres", "roles", "directors", "actors", "movies_directors")
          + f", {_GENRE_LISTS}, {_ACTOR_COUNTS}, {_MOVIE_COUNTS}, {_ROLE_COUNTS}\n" + " union all ".join(
    f"""select '{t}' as collection, '{c}' as "column", count(*) as n_rows, count(*) - count("{c}") as n_null,
  count(distinct "{c}") as n_distinct from {_STAT_SQL[t]}""" for t, cols in _STAT_COLUMNS.items() for c in cols))
def q_rpt_column_stats(spark, sf_dir):
    """Null and distinct counts of every column, on documents whose counts and
    lists are null where there is nothing to count."""
    d = denormalize.build_all(_unclean(spark, sf_dir))
    none = lambda c: F.when(F.col(c) > 0, F.col(c)).alias(c)
    d["movies"] = d["movies"].withColumns({
        "den_nb_actors": none("den_nb_actors"),
        "list_genres": F.when(F.size("list_genres") > 0, D.sorted_text("list_genres"))})
    frames = [column_stats(t, d[t] if t == "movies" else d[t].withColumn("n_movies", none("n_movies")), cols)
              for t, cols in _STAT_COLUMNS.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@register("agg_trimmed_mean", oracle_with("movies", "movies_genres") + f"""
select g.genre, count(m."rank") as n_movies,
  case when count(m."rank") > 2 then
    {_r6('(sum(m."rank") - max(m."rank") - min(m."rank")) / (count(m."rank") - 2)')} end as trimmed_rank
from movies m join movies_genres g on g.movie_id = m.id group by g.genre""")
def q_agg_trimmed_mean(spark, sf_dir):
    from marquee.operators.aggregates import trimmed_mean
    m = den(spark, sf_dir)["movies"].select("rank", F.explode("list_genres").alias("genre"))
    return m.groupBy("genre").agg(F.count("rank").alias("n_movies"),
                                  D.round_half_up(trimmed_mean("rank")).alias("trimmed_rank"))


@register("fmt_percent", oracle_with("movies", "movies_genres") + f""",
c as (select g.genre, count(*) as n from movies m join movies_genres g on g.movie_id = m.id group by 1)
select genre, n as n_movies, {_fx('n * 100.0 / sum(n) over ()', 1)} || '%' as pct_label from c""")
def q_fmt_percent(spark, sf_dir):
    """each genre's share of all genre tags as a percent label.  The
    window has no partition, but it runs over the per-genre aggregate, whose
    size is bounded by the genre vocabulary."""
    from pyspark.sql import Window
    m = den(spark, sf_dir)["movies"].select(F.explode("list_genres").alias("genre"))
    c = m.groupBy("genre").agg(F.count(F.lit(1)).alias("n_movies"))
    pct = F.col("n_movies") * F.lit(100.0) / F.sum("n_movies").over(Window.partitionBy())
    return c.select("genre", "n_movies", D.percent_label(pct).alias("pct_label"))


# -- incremental load (streaming file source to a Parquet collection) --------

@register("stream_load", _W_DEN_MOVIES + """
select id, name, "year", "rank", list_genres, list_directors_id, den_nb_actors from den_movies""")
def q_stream_load(spark, sf_dir):
    """Export den_movies as JSON lines, load it with the streaming loader, run
    the loader again (nothing new: nothing appended), read the collection."""
    from marquee import schemas
    from marquee.session import scratch_path
    from marquee.sources import files
    from marquee.streaming.load import load_documents, read_collection
    src, table = (scratch_path(spark, n) for n in ("export", "collection"))
    files.write_json(den(spark, sf_dir)["movies"], src)
    load_documents(spark, src, schemas.DEN_MOVIES, table)
    if load_documents(spark, src, schemas.DEN_MOVIES, table) != 0:
        raise RuntimeError("second load appended rows again")
    m = read_collection(spark, schemas.DEN_MOVIES, table)
    return m.select("id", "name", "year", "rank",
                    D.sorted_text("list_genres").alias("list_genres"),
                    D.sorted_text("list_directors_id").alias("list_directors_id"),
                    "den_nb_actors")


@register("den_from_csv", _W_DEN_MOVIES + """
select id, name, "year", "rank", list_genres, list_directors_id, den_nb_actors from den_movies""")
def q_den_from_csv(spark, sf_dir):
    """S1 for all seven tables: the sources exported as headerless CSV, read
    back positionally as text, typed leniently, and denormalised."""
    from marquee.session import scratch_path
    from marquee.sources import files
    base = scratch_path(spark, "sources-csv")
    files.export_sources(Catalog(spark, sf_dir), base)
    m = denormalize.build_all(files.CsvCatalog(spark, base))["movies"]
    return m.select("id", "name", "year", "rank",
                    D.sorted_text("list_genres").alias("list_genres"),
                    D.sorted_text("list_directors_id").alias("list_directors_id"),
                    "den_nb_actors")


@register("load_counts", oracle_with("movies", "actors") + """
select 'movies' as collection, count(*) as n_loaded, count(*) as n_again from movies
union all select 'actors', count(*), count(*) from actors""")
def q_load_counts(spark, sf_dir):
    """The rows a load reports, twice: by the append and by the loader."""
    from marquee import schemas
    from marquee.session import scratch_path
    from marquee.sources import files
    from marquee.streaming.load import load_documents
    d, rows = den(spark, sf_dir), []
    for kind, schema in (("movies", schemas.DEN_MOVIES), ("actors", schemas.DEN_ACTORS)):
        src = scratch_path(spark, "export")
        files.write_json(d[kind], src)
        rows.append((kind, files.append(files.read_json(spark, src, schema), scratch_path(spark, "appended")),
                     load_documents(spark, src, schema, scratch_path(spark, "collection"))))
    return spark.createDataFrame(rows, "collection string, n_loaded bigint, n_again bigint")


@register("den_directors_from_csv", _W_DIRECTORS + """
select d.id, d.first_name, d.last_name, coalesce(l.n_movies, 0) as n_movies,
  coalesce(g.dict_text, '') as dict_genres_den_prob
from directors d left join movie_counts l on l.director_id = d.id
left join genre_maps g on g.director_id = d.id""")
def q_den_directors_from_csv(spark, sf_dir):
    """den_directors from CSV sources, directors_genres read as its own file
    (with prob as text, parsed leniently) instead of derived."""
    from marquee.session import scratch_path
    from marquee.sources import files
    base = scratch_path(spark, "sources-csv")
    names = ("directors", "movies_directors", "directors_genres")
    files.export_sources(Catalog(spark, sf_dir), base, names)
    csv = files.CsvCatalog(spark, base)
    return _directors_text(denormalize.den_directors(*[csv.table(n) for n in names]))


# -- the eight queries over the stored catalogue, as plans and as SQL ----------

def _over_stored() -> dict[str, Callable[[dict[str, DataFrame]], DataFrame]]:
    lookup = lambda fn: lambda t: fn(t["movies"], t["directors"], t["director_movies"])
    return {"ru1": lambda t: Q.ru1(t["movies"]), "ru2": lambda t: Q.ru2(t["directors"]),
            "ru2_strict": lambda t: Q.ru2(t["directors"], strict=True), "ru3": lambda t: Q.ru3(t["movies"]),
            "ru4": lookup(Q.ru4), "rda1": lookup(Q.rda1), "rda2": lambda t: Q.rda2(t["directors"]),
            "rda3": lambda t: Q.rda3(t["movies"]), "rda4_top": lookup(Q.rda4_top), "rda4_max": lookup(Q.rda4_max)}


def _register_stored() -> None:
    from marquee.plans import sql
    for name, plan in _over_stored().items():
        def by_plan(spark, sf_dir, plan=plan, name=name):
            out = plan(stored(spark, sf_dir))
            return _rounded(out, "average_rank") if name == "rda1" else out

        def by_sql(spark, sf_dir, name=name):
            sql.register_catalogue(stored(spark, sf_dir))
            out = sql.run(spark, name)
            return _rounded(out, "average_rank") if name == "rda1" else out
        register(f"stored_{name}", ORACLE[name])(by_plan)
        register(f"sql_{name}", ORACLE[name])(by_sql)


_register_stored()


# -- the eight queries as filter and stage documents -----------------------------

def _documents() -> dict[str, Callable[[dict[str, DataFrame]], DataFrame]]:
    from marquee.plans import documents as doc
    return {"ru1": lambda t: doc.ru1(t, Q.RU1_GENRE, Q.RU1_MIN_RANK), "ru2": lambda t: doc.ru2(t, Q.RU2_GENRE),
            "ru2_strict": lambda t: doc.ru2_strict(t, Q.RU2_GENRE), "ru3": lambda t: doc.ru3(t, Q.RU3_GENRE, Q.RU3_YEAR),
            "ru4": lambda t: doc.ru4(t, Q.RU4_FIRST, Q.RU4_LAST, Q.RU4_GENRE),
            "rda1": lambda t: doc.rda1(t, Q.RDA1_FIRST, Q.RDA1_LAST), "rda2": lambda t: doc.rda2(t, Q.RDA2_N_GENRES),
            "rda3": lambda t: doc.rda3(t, Q.RDA3_MAX_ACTORS, Q.RDA3_MIN_RANK),
            "rda4_top": lambda t: doc.rda4(t, Q.default_names())}


def _register_documents() -> None:
    for name, query in _documents().items():
        def run(spark, sf_dir, query=query, name=name):
            out = query(stored(spark, sf_dir))
            return _rounded(out, "average_rank") if name == "rda1" else out
        register(f"doc_{name}", ORACLE[name])(run)


_register_documents()


# -- the same questions to the further layouts ------------------------------------

PERSON_BUCKETS = 16
_layouts: dict[tuple[str, str], dict[str, str]] = {}


def layouts_of(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Folders of the further layouts, written on the first call of this application."""
    from marquee.plans import layouts
    from marquee.session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _layouts:
        tables = stored(spark, sf_dir)
        with jobs.shuffled_in(spark, max(STORED_BUCKETS, jobs.parts_of(Catalog(spark, sf_dir)))):
            _layouts[key] = layouts.write_all(tables, scratch_path(spark, "layouts"), PERSON_BUCKETS)
    return _layouts[key]


def person_links(spark: SparkSession, sf_dir: str, kind: str = "director_links"):
    from marquee.plans import layouts
    return layouts.PersonLinks(spark, layouts_of(spark, sf_dir)[kind])


def _ids(links: DataFrame) -> DataFrame:
    return links.select(F.col("movie_id").alias("id"))


@register("lookup_links_of_id", oracle_with("movies_directors") + """
select director_id as id, movie_id, count(*) as n from movies_directors where director_id = 7 group by all""")
def q_lookup_links_of_id(spark, sf_dir):
    """The links of one literal id, from its own folder."""
    return person_links(spark, sf_dir).of_id(7)


@register("lookup_actor_links", oracle_with("roles", "actors") + """
select actor_id as id, movie_id, count(*) as n from roles
where actor_id = (select min(id) from actors where last_name = '000000003') and movie_id is not null group by all""")
def q_lookup_actor_links(spark, sf_dir):
    from marquee.operators.lookup import one_key
    actors = stored(spark, sf_dir)["actors"]
    return person_links(spark, sf_dir, "actor_links").of(one_key(actors, F.col("last_name") == "000000003"), one=True)


@register("lookup_ru4", ORACLE["ru4"])
def q_lookup_ru4(spark, sf_dir):
    t = stored(spark, sf_dir)
    ids = _ids(person_links(spark, sf_dir).of(Q.one_director(t["directors"], Q.RU4_FIRST, Q.RU4_LAST), one=True))
    return Q.movies_of(t["movies"], ids, None).filter(D.has_element("list_genres", Q.RU4_GENRE)).select(
        "id", "name", "year", "rank")


@register("lookup_rda1", ORACLE["rda1"])
def q_lookup_rda1(spark, sf_dir):
    from marquee.operators.aggregates import global_avg
    t = stored(spark, sf_dir)
    ids = _ids(person_links(spark, sf_dir).of(Q.one_director(t["directors"], Q.RDA1_FIRST, Q.RDA1_LAST), one=True))
    return _rounded(global_avg(Q.movies_of(t["movies"], ids, None).filter(D.not_nan("rank")), "rank", "average_rank"),
                    "average_rank")


def _chosen(t: dict[str, DataFrame]) -> DataFrame:
    return t["directors"].filter(D.in_list(D.full_name(), Q.default_names())).select("id")


@register("lookup_rda4_top", ORACLE["rda4_top"])
def q_lookup_rda4_top(spark, sf_dir):
    from marquee.operators.aggregates import top_per_group
    t = stored(spark, sf_dir)
    movies = Q.movies_of(t["movies"], _ids(person_links(spark, sf_dir).of(_chosen(t))), None)
    return top_per_group(movies.select("id", "name", "rank", F.explode("list_genres").alias("genre")), "genre", ["name", "rank"])


@register("summary_rda4_top", ORACLE["rda4_top"])
def q_summary_rda4_top(spark, sf_dir):
    """A8 / Rda4 from the stored best movie per (director, genre); no document is read."""
    from marquee.plans.layouts import best_of
    return best_of(spark.read.parquet(layouts_of(spark, sf_dir)["best"]), _chosen(stored(spark, sf_dir)))


def _postings(spark: SparkSession, sf_dir: str):
    from marquee.plans.layouts import Postings
    return Postings(spark, layouts_of(spark, sf_dir)["postings"])


@register("posting_ru1", ORACLE["ru1"])
def q_posting_ru1(spark, sf_dir):
    """Genre membership by the genre's ids; no list_genres is read."""
    p = _postings(spark, sf_dir)
    movies = stored(spark, sf_dir)["movies"].filter(D.greater("rank", Q.RU1_MIN_RANK))
    return Q.movies_of(movies, p.ids(p.genre(Q.RU1_GENRE)), None).select("name", "rank")


@register("posting_ru3", ORACLE["ru3"])
def q_posting_ru3(spark, sf_dir):
    p = _postings(spark, sf_dir)
    movies = stored(spark, sf_dir)["movies"].filter(F.col("year") == Q.RU3_YEAR)
    return Q.movies_of(movies, p.ids(p.genre(Q.RU3_GENRE)), None).select("name")


@register("posting_ru4", ORACLE["ru4"])
def q_posting_ru4(spark, sf_dir):
    """The director's ids and the genre's meet block by block, before any movie is read."""
    t, p = stored(spark, sf_dir), _postings(spark, sf_dir)
    mine = _ids(person_links(spark, sf_dir).of(Q.one_director(t["directors"], Q.RU4_FIRST, Q.RU4_LAST), one=True))
    ids = p.ids(p.intersect(p.of(mine), p.genre(Q.RU4_GENRE)))
    return Q.movies_of(t["movies"], ids, None).select("id", "name", "year", "rank")


@register("posting_two_genres", oracle_with("movies_genres") + """
select movie_id as id from movies_genres where genre = 'PROMO'
intersect select movie_id from movies_genres where genre = 'ECONOMY'""")
def q_posting_two_genres(spark, sf_dir):
    p = _postings(spark, sf_dir)
    return p.ids(p.intersect(p.genre("PROMO"), p.genre("ECONOMY")))


def _register_clustered() -> None:
    for name, plan in (("ru1", Q.ru1), ("ru3", Q.ru3), ("rda3", Q.rda3)):
        def run(spark, sf_dir, plan=plan):
            return plan(spark.read.parquet(layouts_of(spark, sf_dir)["clustered"]))
        register(f"clustered_{name}", ORACLE[name])(run)


_register_clustered()


# -- collections that change: deltas, keyed loads, versions ------------------------

def _collection(spark: SparkSession, name: str, schema: str, buckets: int = 8):
    from pyspark.sql import types as T

    from marquee.session import scratch_path
    from marquee.sources.collections import Collection
    return Collection(spark, scratch_path(spark, name), T.StructType.fromDDL(schema), buckets=buckets)


def _in_three_loads(spark: SparkSession, sf_dir: str) -> list[dict[str, DataFrame]]:
    """The source tables split by line number and order: children come before
    and after their movie."""
    cat = Catalog(spark, sf_dir)
    roles, genres = cat.roles(), cat.movies_genres()
    by = lambda df, c, k: df.filter(F.pmod(F.xxhash64(c), F.lit(3)) == k)
    return [{"movies": by(cat.movies(), "id", k), "movies_genres": by(genres, "genre", k),
             "movies_directors": by(cat.movies_directors(), "movie_id", (k + 1) % 3),
             "roles": by(roles, "role", k)} for k in range(3)]


@register("delta_den_movies", _W_DEN_MOVIES + """
select id, name, "year", "rank", list_genres, list_directors_id, den_nb_actors from den_movies""")
def q_delta_den_movies(spark, sf_dir):
    """Q-DM from three loads: base, delta, compaction, another delta merged on read."""
    parts = _collection(spark, "movie-parts", denormalize.MOVIE_PARTS)
    loads = _in_three_loads(spark, sf_dir)
    for load in loads[:2]:
        parts.append(denormalize.movie_parts(**load))
    parts.compact(denormalize.merged_parts)
    parts.append(denormalize.movie_parts(**loads[2]))
    m = denormalize.merge_movies(parts.read())
    return m.select("id", "name", "year", "rank", D.sorted_text("list_genres").alias("list_genres"),
                    D.sorted_text("list_directors_id").alias("list_directors_id"), "den_nb_actors")


@register("delta_director_movies", oracle_with("movies_directors") + """
select director_id as id, movie_id, count(*) as n from movies_directors group by all""")
def q_delta_director_movies(spark, sf_dir):
    """Q-DD's links from three loads, compacted."""
    links = _collection(spark, "links", "id long, movie_id long, n long")
    for load in _in_three_loads(spark, sf_dir):
        links.append(nest.link_rows(load["movies_directors"], "director_id"))
    links.compact(denormalize.merge_links)
    return links.read()


_ACTOR = "id long, first_name string, last_name string, n_movies long"


def _loaded_actors(spark: SparkSession, sf_dir: str, replace: bool):
    """Even actors stored, then all actors, renamed and each twice, loaded by key."""
    a = den(spark, sf_dir)["actors"]
    c = _collection(spark, "actors", _ACTOR)
    c.load(a.filter(F.col("id") % 2 == 0))
    again = a.withColumn("last_name", F.concat(F.lit("new "), F.col("last_name")))
    return c, c.load(again.unionByName(again), replace=replace)


@register("load_keyed_reject", _with(("actors", "roles"), _ROLE_COUNTS) + """
select a.id, a.first_name, case when a.id % 2 = 0 then a.last_name else 'new ' || a.last_name end as last_name,
  coalesce(l.n_movies, 0) as n_movies from actors a left join role_counts l on l.actor_id = a.id""")
def q_load_keyed_reject(spark, sf_dir):
    """S4 with a key: stored ids refuse the batch's rows."""
    return _loaded_actors(spark, sf_dir, replace=False)[0].read()


@register("load_keyed_replace", _with(("actors", "roles"), _ROLE_COUNTS) + """
select a.id, a.first_name, 'new ' || a.last_name as last_name, coalesce(l.n_movies, 0) as n_movies
from actors a left join role_counts l on l.actor_id = a.id""")
def q_load_keyed_replace(spark, sf_dir):
    """S4 with a key: the batch's rows replace the stored ones."""
    return _loaded_actors(spark, sf_dir, replace=True)[0].read()


@register("load_keyed_counts", oracle_with("actors") + """
select 'reject' as mode, count(*) filter (where id % 2 = 1) as n_loaded, 2 * count(*) - count(*) filter (where id % 2 = 1) as n_refused,
  cast(0 as bigint) as n_replaced from actors
union all select 'replace', count(*), count(*), count(*) filter (where id % 2 = 0) from actors""")
def q_load_keyed_counts(spark, sf_dir):
    """What the two loads report."""
    rows = [(mode, *[_loaded_actors(spark, sf_dir, mode == "replace")[1][k] for k in ("loaded", "refused", "replaced")])
            for mode in ("reject", "replace")]
    return spark.createDataFrame(rows, "mode string, n_loaded long, n_refused long, n_replaced long")


def _rewritten_actors(spark: SparkSession, sf_dir: str):
    """S10 as one commit: text ids repaired, zero counts made null."""
    a = den(spark, sf_dir)["actors"]
    c = _collection(spark, "actors", _ACTOR)
    c.append(a)
    c.rewrite(lambda df: df.withColumns({"n_movies": F.when(F.col("n_movies") > 0, F.col("n_movies")),
                                         "last_name": F.concat(F.lit("No. "), F.col("last_name"))}))
    return c


@register("snapshot_rewrite", _with(("actors", "roles"), _ROLE_COUNTS) + """
select a.id, a.first_name, 'No. ' || a.last_name as last_name, l.n_movies
from actors a left join role_counts l on l.actor_id = a.id""")
def q_snapshot_rewrite(spark, sf_dir):
    return _rewritten_actors(spark, sf_dir).read()


@register("snapshot_as_of", ORACLE["den_actors"])
def q_snapshot_as_of(spark, sf_dir):
    """The version before the rewrite still answers."""
    return _rewritten_actors(spark, sf_dir).read(as_of=1)


# -- documents without a fixed schema -----------------------------------------------

def _loose_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies as JSON lines: a null rank is left out where the id is even, and
    written as null where it is odd; the year is text in every third."""
    from marquee.session import scratch_path
    from marquee.sources import files
    m = _unclean(spark, sf_dir).movies().select("id", "name", "year", "rank")
    year = F.when(F.col("id") % 3 == 0, F.concat(F.lit('"'), F.col("year"), F.lit('"'))).otherwise(F.col("year").cast("string"))
    rank = F.when(F.col("rank").isNotNull(), F.concat(F.lit(',"rank":'), F.col("rank").cast("string"))) \
        .when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.lit(',"rank":null'))
    text = F.concat(F.lit('{"id":'), F.col("id"), F.lit(',"year":'), F.coalesce(year, F.lit("null")), rank, F.lit("}"))
    path = scratch_path(spark, "loose-movies")
    m.select(text).write.text(path)
    return files.read_documents(spark, path)


_LOOSE = unclean_with("movies") + ", m as (select id, \"year\", case when isnan(\"rank\") then null else \"rank\" end r from movies)\n"


@register("variant_field_counts", _LOOSE + """
select count(*) as n_rows, count(*) filter (where r is not null or id % 2 = 1) as n_exists,
  count(*) filter (where r is not null) as n_not_null, count(*) filter (where r is null and id % 2 = 1) as n_null,
  count(*) filter (where id % 3 <> 0 and "year" is not null) as n_number_year from m""")
def q_variant_field_counts(spark, sf_dir):
    """A missing field, a null field and a field of another kind are three things."""
    d = _loose_movies(spark, sf_dir)
    is_number = F.schema_of_variant(D.field_value("doc", "$.year", "variant")) == "BIGINT"
    return d.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(D.field_exists("doc", "$.rank")).alias("n_exists"),
                 F.count_if(D.field_not_null("doc", "$.rank")).alias("n_not_null"),
                 F.count_if(D.field_is_null("doc", "$.rank")).alias("n_null"),
                 F.count_if(is_number).alias("n_number_year"))


@register("variant_null_rank", _LOOSE + "select id from m where r is null and id % 2 = 1")
def q_variant_null_rank(spark, sf_dir):
    """Documents whose rank is there and null."""
    d = _loose_movies(spark, sf_dir).filter(D.field_is_null("doc", "$.rank"))
    return d.select(D.field_value("doc", "$.id", "long").alias("id"))


# -- statistics from mergeable sketches ---------------------------------------------

_SKETCHED = {"movies": ["id", "name", "year", "rank", "den_nb_actors"], "directors": ["id", "last_name", "n_movies"]}
_sketches: dict[tuple[str, str], str] = {}


def sketches_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of the stored collections, written once per application."""
    from marquee.plans.reports import column_sketches
    from marquee.session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _sketches:
        _sketches[key] = scratch_path(spark, "sketches")
        t = stored(spark, sf_dir)
        for k, columns in _SKETCHED.items():
            column_sketches(k, t[k], columns, STORED_BUCKETS).write.mode("append").parquet(_sketches[key])
    return spark.read.parquet(_sketches[key])


def _sketch_sql(t: str, c: str) -> str:
    text = c.endswith("name")
    lo, hi = (f'{f}("{c}")' for f in ("min", "max"))
    num, txt = ("cast(null as double)", "cast(null as varchar)")
    return (f"""select '{t}' as collection, '{c}' as "column", count(*) as n_rows, count(*) - count("{c}") as n_null, """
            + ", ".join(f"{e} as {n}" for n, e in (
                ("min_number", num if text else f"cast({lo} as double)"), ("max_number", num if text else f"cast({hi} as double)"),
                ("min_text", lo if text else txt), ("max_text", hi if text else txt)))
            + f" from {dict(movies='den_movies', directors='dd')[t]}")


@register("rpt_sketch_stats", _W_ALL + """,
dd as (select d.*, coalesce(l.n_movies, 0) as n_movies from directors d left join movie_counts l on l.director_id = d.id)
""" + " union all ".join(_sketch_sql(t, c) for t, cols in _SKETCHED.items() for c in cols))
def q_rpt_sketch_stats(spark, sf_dir):
    """A15 / Adm2: the exact columns of the merged sketches (the distinct estimate: tests)."""
    from marquee.plans.reports import merged_stats
    return merged_stats(sketches_of(spark, sf_dir)).drop("n_distinct_estimate")
