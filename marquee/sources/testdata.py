"""The seven normalised catalogue tables, derived from the driver's tables.

Orders act as movies, customers as directors, suppliers as actors and part
types as genres.  Everything is a lazy DataFrame over the parquet scans, so
Catalyst prunes columns and pushes filters into the scans of whatever a query
actually reads.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.clean import nan_to_null

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")

# rank is o_totalprice scaled to run from 0 to 10 (fixed value of the mapping)
RANK_SCALE = 50000.0


class Catalog:
    """Lazy access to the source tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    # -- the seven normalised tables --------------------------------------
    def movies(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("name"),
            F.year("o_orderdate").cast("int").alias("year"),
            nan_to_null(F.col("o_totalprice") / F.lit(RANK_SCALE)).alias("rank"),
        )

    def movies_genres(self, keys: DataFrame | None = None) -> DataFrame:
        """``keys`` (a DataFrame with ``id``) reads only those movies' pairs."""
        # N:M movie-genre pairs.  The join is on part key: Spark broadcasts part
        # only when its runtime size is under the threshold, else sort-merge.
        # distinct() runs a partial (map-side) aggregate first, so a movie with
        # very many lines ships at most one row per genre per map task.
        li = self.raw("lineitem").select("l_orderkey", "l_partkey")
        if keys is not None:
            li = li.join(keys.select(F.col("id").alias("l_orderkey")), "l_orderkey", "left_semi")
        p = self.raw("part").select("p_partkey", "p_type")
        return (li.join(p, li.l_partkey == p.p_partkey)
                .select(F.col("l_orderkey").alias("movie_id"), F.col("p_type").alias("genre"))
                .distinct())

    def movies_directors(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_custkey").alias("director_id"), F.col("o_orderkey").alias("movie_id"))

    def roles(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("actor_id"), F.col("l_orderkey").alias("movie_id"),
            F.col("l_linenumber").cast("string").alias("role"))

    def directors(self) -> DataFrame:
        return _people(self.raw("customer"), "c_custkey", "c_name")

    def actors(self) -> DataFrame:
        s = _people(self.raw("supplier"), "s_suppkey", "s_name")
        # no source column for gender; the denormalisation drops it anyway
        return s.withColumn("gender", F.lit(None).cast("string"))

    def directors_genres(self, movies_genres: DataFrame | None = None) -> DataFrame:
        """Share of a director's movies that carry each genre.

        Both aggregates are partial-then-final hash aggregates, so a director
        with a huge filmography costs one row per (map task, genre) in the
        shuffle; the final join is between two tables unique on their keys.
        ``movies_genres`` may be passed in already materialised, so the
        line-item join behind it runs once per job.
        """
        md = self.movies_directors()
        mg = movies_genres if movies_genres is not None else self.movies_genres()
        pairs = (md.join(mg, "movie_id")
                 .groupBy("director_id", "genre").agg(F.count(F.lit(1)).alias("_k")))
        n = md.groupBy("director_id").agg(F.count(F.lit(1)).alias("_n"))
        return (pairs.join(n, "director_id")
                .select("director_id", "genre", (F.col("_k") / F.col("_n")).alias("prob")))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()


class UncleanCatalog(Catalog):
    """The same tables with a fixed share of bad values, chosen by id: text
    that is no number, NaN and missing ranks, unknown years, zero and missing
    genre shares.  ``UNCLEAN_CTES`` is its mapping after cleaning."""

    def movies_text(self) -> DataFrame:
        """Movies as raw text, as a source file would hold them."""
        m = super().movies()
        r, y = F.col("id") % 19, F.col("id") % 17
        rank = (F.when(r == 0, "NULL").when(r == 1, "").when(r == 2, "3d").when(r == 3, "2.5f").when(r == 4, "nan")
                .when(r == 6, "n/a").when(r != 5, F.col("rank").cast("string")))
        year = (F.when(y == 1, "unknown").when(y == 2, "1999.5").when(y == 3, F.concat(F.col("year"), F.lit(".0")))
                .when(y != 0, F.col("year").cast("string")))
        return m.select(F.col("id").cast("string").alias("id"), "name", year.alias("year"), rank.alias("rank"))

    def raw_movies(self) -> DataFrame:
        """Typed, but ranks that were no number are NaN or missing."""
        r = F.col("id") % 19
        rank = F.when(r <= 4, F.lit(float("nan"))).when(r > 6, F.col("rank"))
        return super().movies().withColumn("rank", rank)

    def movies(self) -> DataFrame:
        return (self.raw_movies().withColumn("rank", nan_to_null(F.col("rank")))
                .withColumn("year", F.when(F.col("id") % 17 > 2, F.col("year"))))

    def directors_genres(self, movies_genres: DataFrame | None = None) -> DataFrame:
        k = (F.col("director_id") + F.length("genre")) % 4
        return super().directors_genres(movies_genres).withColumn(
            "prob", F.when(k == 0, F.lit(0.0)).when(k != 1, F.col("prob")))


def _people(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(
        F.col(key).alias("id"),
        F.split_part(F.col(name), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col(name), F.lit("#"), F.lit(2)).alias("last_name"),
    )


# DuckDB views equal to the mapping above, usable as a CTE prefix in oracle SQL
# (fixed text of the mapping; "rank" and "year" quoted as they are also
# function names).
ORACLE_CTES = {
    "movies": """select o_orderkey as id, 'Order#' || cast(o_orderkey as varchar) as name,
        cast(year(o_orderdate) as int) as "year", o_totalprice / 50000.0 as "rank" from orders""",
    "movies_genres": """select distinct l_orderkey as movie_id, p_type as genre
        from lineitem join part on l_partkey = p_partkey""",
    "movies_directors": "select o_custkey as director_id, o_orderkey as movie_id from orders",
    "roles": """select l_suppkey as actor_id, l_orderkey as movie_id,
        cast(l_linenumber as varchar) as role from lineitem""",
    "directors": """select c_custkey as id, split_part(c_name, '#', 1) as first_name,
        split_part(c_name, '#', 2) as last_name from customer""",
    "actors": """select s_suppkey as id, split_part(s_name, '#', 1) as first_name,
        split_part(s_name, '#', 2) as last_name from supplier""",
    "directors_genres": """select d.director_id, g.genre, count(*) / any_value(n.n) as prob
        from movies_directors d join movies_genres g using (movie_id)
        join (select director_id, count(*) as n from movies_directors group by 1) n
          on n.director_id = d.director_id
        group by 1, 2""",
}


UNCLEAN_CTES = ORACLE_CTES | {
    "movies": """select o_orderkey as id, 'Order#' || cast(o_orderkey as varchar) as name,
        case when o_orderkey % 17 > 2 then cast(year(o_orderdate) as int) end as "year",
        case when o_orderkey % 19 > 6 then o_totalprice / 50000.0 end as "rank" from orders""",
    "directors_genres": f"""select director_id, genre, case (director_id + length(genre)) % 4 when 0 then 0.0::double
        when 1 then null else prob end as prob from ({ORACLE_CTES["directors_genres"]})""",
}


def unclean_with(*names: str) -> str:
    return oracle_with(*names, ctes=UNCLEAN_CTES)


def oracle_with(*names: str, ctes: dict[str, str] | None = None) -> str:
    """``with`` clause defining the named views (and what they depend on)."""
    deps = {"directors_genres": ["movies_directors", "movies_genres"]}
    order = ["movies", "movies_genres", "movies_directors", "roles", "directors",
             "actors", "directors_genres"]
    want: set[str] = set()

    def add(n: str) -> None:
        for d in deps.get(n, []):
            add(d)
        want.add(n)

    for n in names:
        add(n)
    parts = [f"{n} as ({(ctes or ORACLE_CTES)[n]})" for n in order if n in want]
    return "with " + ",\n".join(parts) + "\n"
