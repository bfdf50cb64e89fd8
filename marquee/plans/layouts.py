"""Further layouts of the stored catalogue, each for one kind of query.

``person links``  (id, movie_id, n) again, by person: a folder per hash bucket
    of the person, rows range-partitioned by (bucket, person, movie) and sorted
    so, which splits a hot person over files, and a Bloom filter on ``id`` in
    each file.  A looked-up person costs one folder; the person's rows are
    neighbours, so page statistics skip the rest of its files.  For the movies'
    own layout see ``jobs``: there the same links lie by movie.
``genre postings``  (genre, block, offsets): the sorted ids of a genre's movies,
    ``width`` ids to a block, as distances from the block's first id.  No list is
    longer than ``width``; id sets meet block by block (``intersect``).
``clustered movies``  movies in the order of an interleaved key over year, rank and
    number of actors (quantile steps, ``BITS`` bits each), so a filter on any one
    of them skips row groups.
``best movies``  the best movie per (director, genre) as a state that merges over
    any list of directors (Rda4 without documents).

``write`` functions take a new folder; a manifest inside keeps the parameters that
readers need.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import aggregates as A
from marquee.operators import lookup as L
from marquee.plans.jobs import materialize, read_parameters, write_parameters

POSTING_IDS = 100_000
BITS = 4
CLUSTER_BY = ("year", "rank", "den_nb_actors")


# -- links by person ---------------------------------------------------------

def person_bucket(person: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(person), F.lit(buckets)).cast("int")


def write_person_links(links: DataFrame, path: str, buckets: int, page_rows: int = 20_000) -> None:
    """``buckets``: so many that a folder holds some hundred MB; ``page_rows``:
    rows whose statistics a lookup can skip at once."""
    order = ["person_bucket", "id", "movie_id"]
    (links.withColumn("person_bucket", person_bucket(F.col("id"), buckets))
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .write.option("parquet.bloom.filter.enabled#id", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
     .option("parquet.page.row.count.limit", page_rows)
     # sorted longs as differences: a dictionary would be read whole for one person
     .option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary#movie_id", "false")
     .partitionBy("person_bucket").parquet(path))
    write_parameters(links.sparkSession, path, buckets=buckets)


class PersonLinks:
    """Stored links by person: ``of_id`` for one id, ``of`` for a DataFrame of persons."""

    def __init__(self, spark: SparkSession, path: str):
        self.buckets = read_parameters(spark, path)["buckets"]
        self.links = spark.read.schema("id long, movie_id long, n long, person_bucket int").parquet(path)

    def of_id(self, person: int) -> DataFrame:
        """The folder is known when the query is planned."""
        mine = (F.col("person_bucket") == person_bucket(F.lit(person).cast("long"), self.buckets)) & (F.col("id") == person)
        return self.links.filter(mine).drop("person_bucket")

    def of(self, people: DataFrame, one: bool = False) -> DataFrame:
        """Links of ``people`` (``id``); the folders are pruned when the query
        runs (a dynamic partition filter) wherever Spark broadcasts the persons.
        They are written first, so it decides by their size.  ``one``: at most
        one row, broadcast as it is."""
        bucket = person_bucket(F.col("id"), self.buckets).alias("person_bucket")
        keys = people.select("id", bucket) if one else materialize(people.select("id", bucket).distinct(), "people")
        # what Spark takes for a selective filter, and so a reason to prune; every bucket passes
        keys = keys.filter(F.col("person_bucket") >= 0)
        return self.links.join(F.broadcast(keys) if one else keys, ["person_bucket", "id"], "left_semi").drop("person_bucket")


# -- genre postings ----------------------------------------------------------

def blocks(ids: DataFrame, by: list[str], width: int = POSTING_IDS) -> DataFrame:
    """(by..., block, offsets) of a set of ``id``, one row per range of ``width`` ids."""
    block = F.floor(F.col("id") / F.lit(width)).cast("long")
    offset = (F.col("id") - F.col("block") * width).cast("int")
    return (ids.withColumn("block", block).groupBy(*by, "block")
            .agg(F.sort_array(F.collect_set(offset)).alias("offsets")))


def write_postings(movies: DataFrame, path: str, width: int = POSTING_IDS) -> None:
    rows = blocks(movies.select("id", F.explode("list_genres").alias("genre")), ["genre"], width)
    (rows.repartitionByRange("genre", "block").sortWithinPartitions("genre", "block")
     .write.option("parquet.writer.version", "PARQUET_2_0").parquet(path))       # delta-coded integers
    write_parameters(movies.sparkSession, path, width=width)


class Postings:
    def __init__(self, spark: SparkSession, path: str):
        self.width = read_parameters(spark, path)["width"]
        self.rows = spark.read.schema("genre string, block long, offsets array<int>").parquet(path)

    def genre(self, name: str) -> DataFrame:
        return self.rows.filter(F.col("genre") == name).select("block", "offsets")

    def of(self, ids: DataFrame) -> DataFrame:
        return blocks(ids.select("id"), [], self.width)

    def intersect(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """Blocks of the ids in both."""
        both = a.join(b.withColumnRenamed("offsets", "_other"), "block")
        return (both.select("block", F.array_intersect("offsets", "_other").alias("offsets"))
                .filter(F.size("offsets") > 0))

    def ids(self, posting: DataFrame) -> DataFrame:
        return (posting.select("block", F.explode("offsets").alias("offset"))
                .select((F.col("block") * self.width + F.col("offset")).alias("id")))


# -- clustered movies ----------------------------------------------------------

def interleaved(steps: list[Column], bits: int = BITS) -> Column:
    """One number from the bits of several, highest bits first, in turn."""
    out = F.lit(0)
    for bit in range(bits - 1, -1, -1):
        for s in steps:
            out = F.call_function("shiftleft", out, F.lit(1)).bitwiseOR(
                F.call_function("shiftright", s, F.lit(bit)).bitwiseAND(F.lit(1)))
    return out


def with_cluster_key(movies: DataFrame, columns: tuple[str, ...] = CLUSTER_BY, bits: int = BITS) -> DataFrame:
    """``movies`` with ``_key`` over quantile steps of the columns (2**bits - 1
    cuts each, in one row that every task gets); null is the lowest step."""
    n = 1 << bits
    shares = [k / n for k in range(1, n)]
    value = lambda c: F.col(c).cast("double")
    cuts = movies.agg(F.struct(*[F.array_distinct(F.percentile_approx(value(c), shares, 10_000)).alias(c)
                                 for c in columns]).alias("_cuts")).withColumn("_one", F.lit(1))
    step = lambda c: F.size(F.filter(F.col(f"_cuts.{c}"), lambda cut: cut < value(c)))
    steps = [F.greatest(F.coalesce(step(c), F.lit(0)), F.lit(0)) for c in columns]
    return (movies.withColumn("_one", F.lit(1)).join(F.broadcast(cuts), "_one")
            .withColumn("_key", interleaved(steps, bits)).drop("_one", "_cuts"))


def write_clustered(movies: DataFrame, path: str, row_group_bytes: int | None = None,
                    columns: tuple[str, ...] = CLUSTER_BY) -> None:
    out = (with_cluster_key(movies, columns).repartitionByRange("_key", "id")
           .sortWithinPartitions("_key", *columns).drop("_key"))
    writer = out.write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


# -- best movie per (director, genre) --------------------------------------------

def write_best(movies: DataFrame, director_movies: DataFrame, path: str) -> None:
    """(id, genre, best): grouping by the pair combines a hot director map-side."""
    pairs = movies.select(F.col("id").alias("movie_id"), "name", "rank", F.explode("list_genres").alias("genre"))
    best = A.best_state(F.col("rank"), F.col("movie_id"), F.col("name").alias("name"))
    (director_movies.select("id", "movie_id").join(pairs, "movie_id").groupBy("id", "genre").agg(best.alias("best"))
     .sortWithinPartitions("id").write.parquet(path))


def best_of(best: DataFrame, directors: DataFrame) -> DataFrame:
    """Rda4 from the summary: genre, best_name, best_rank of the directors' movies."""
    mine = L.keep_matching(best, directors.select("id"))
    return (mine.groupBy("genre").agg(A.merge_best("best").alias("best"))
            .select("genre", F.col("best.name").alias("best_name"), F.col("best.rank").alias("best_rank")))


def write_all(tables: dict[str, DataFrame], out_dir: str, person_buckets: int) -> dict[str, str]:
    """All layouts from the stored tables; their folders by name."""
    paths = {k: os.path.join(out_dir, k) for k in ("director_links", "actor_links", "postings", "clustered", "best")}
    write_person_links(tables["director_movies"], paths["director_links"], person_buckets)
    write_person_links(tables["actor_movies"], paths["actor_links"], person_buckets)
    write_postings(tables["movies"], paths["postings"])
    write_clustered(tables["movies"], paths["clustered"])
    write_best(tables["movies"], tables["director_movies"], paths["best"])
    return paths
