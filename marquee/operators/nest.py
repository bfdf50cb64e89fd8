"""Nesting child rows under a parent key: lists, counts, maps and chunked lists.

Each child is aggregated on its own key *before* it meets the parent, so the
aggregated child is unique on the key (the later left join cannot multiply
parent rows, and Catalyst removes the join from any query that does not read
the child's column), and its output is already hash-partitioned on the key.
Counts combine map-side: a hot key ships one partial row per map task.  A
collected list does not shrink that way, so only lists bounded by a small
domain (a movie's genres, its crew, a director's genre map) are nested.

A person's movies have no such bound.  They stay flat rows, one per distinct
(person, movie) pair with the number of repeats (``link_rows``), and where a
list is asked for, every person's list is cut by one rule that knows no counts
(``chunk_lists``): the movie ids of one chunk come from one range of ``width``
ids, so no list is longer than ``width``, for any person at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Range of movie ids in one list chunk: a list row holds at most this many
# (id, repeats) pairs, about 1.6 MB.
CHUNK_IDS = 100_000


def child_list(child: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """(key, out): values collected per key, duplicates kept, nulls skipped,
    sorted so the result does not depend on shuffle order (D5)."""
    return child.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias(out))


def child_count(child: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """(key, out): non-null child rows per key (D6: rows, not distinct values)."""
    return child.groupBy(key).agg(F.count(value).alias(out))


def child_map(child: DataFrame, key: str, k: str, v: str, out: str) -> DataFrame:
    """(key, out): map k -> v per key; pairs with a null side are skipped.

    A repeated k under one key raises DUPLICATED_MAP_KEY (session default),
    as the map build of the reference does.
    """
    pairs = child.filter(F.col(k).isNotNull() & F.col(v).isNotNull())
    return pairs.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(k, v))).alias(out))


def link_rows(child: DataFrame, person: str, movie: str = "movie_id") -> DataFrame:
    """(id, movie_id, n): one row per distinct pair with its number of repeats.

    Grouping by the pair spreads a hot person over all tasks; a pair repeated
    very often is one partial row per map task.  Pairs with a null side are
    no links.
    """
    pairs = child.select(F.col(person).alias("id"), F.col(movie).alias("movie_id"))
    return (pairs.filter(F.col("id").isNotNull() & F.col("movie_id").isNotNull())
            .groupBy("id", "movie_id").agg(F.count(F.lit(1)).alias("n")))


def chunk_lists(links: DataFrame, width: int = CHUNK_IDS) -> DataFrame:
    """(id, chunk, list_movies): per person and range of ``width`` movie ids,
    the (movie_id, n) pairs sorted by movie.  Persons without movies have no row.

    The shuffle is by (id, chunk), so the chunks of a hot person land in many
    tasks and none builds more than ``width`` pairs.
    """
    chunk = F.floor(F.col("movie_id") / F.lit(width)).cast("bigint")
    return (links.withColumn("chunk", chunk).groupBy("id", "chunk")
            .agg(F.sort_array(F.collect_list(F.struct("movie_id", "n"))).alias("list_movies")))


def unique_parent(parent: DataFrame) -> DataFrame:
    """Exact duplicate parent rows are kept once (combined map-side)."""
    return parent.dropDuplicates()


def empty_array(elem: str) -> Column:
    return F.array().cast(f"array<{elem}>")


def empty_map(kt: str, vt: str) -> Column:
    return F.create_map().cast(f"map<{kt},{vt}>")
