"""Administrator reports: shares, distribution over shards, table statistics.

Every report is a single aggregate pass per table; nothing is collected to
the driver.  The reference hard-codes the table sizes in its share charts;
here the total is counted in the same pass as the matching rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import docops as D
from marquee.operators import aggregates as A


def share_directors_with_n_genres(den_directors: DataFrame, n_genres: int = 2) -> DataFrame:
    """Shr1: directors with exactly N non-zero genres against all directors."""
    nz = D.nonzero_entries("dict_genres_den_prob")
    return A.share(den_directors, F.coalesce(F.size(nz) == F.lit(n_genres), F.lit(False)))


def share_movies(den_movies: DataFrame, max_actors: int = 5, min_rank: float = 7) -> DataFrame:
    """Shr2: movies with fewer than X role rows and rank above N against all."""
    pred = F.coalesce(D.less("den_nb_actors", max_actors) & D.greater("rank", min_rank),
                      F.lit(False))
    return A.share(den_movies, pred)


def shard_of(key: str, shards: int) -> F.Column:
    """Deterministic shard of a non-negative integer key."""
    return F.pmod(F.col(key), F.lit(shards)).cast("int")


def distribution(tables: dict[str, DataFrame], shards: int = 4, key: str = "id") -> DataFrame:
    """Adm1 / J4: rows per shard for several tables side by side.

    Each table is counted per shard (a partial aggregate, output at most
    ``shards`` rows), then the small per-table counts are joined on the shard
    with full outer joins, so a shard missing from one table still shows.
    """
    out = None
    for name, df in tables.items():
        c = (df.groupBy(shard_of(key, shards).alias("shard"))
             .agg(F.count(F.lit(1)).alias(f"count_{name}")))
        out = c if out is None else out.join(c, "shard", "full_outer")
    return out.select("shard", *[F.coalesce(f"count_{n}", F.lit(0)).alias(f"count_{n}")
                                 for n in tables])


def table_stats(name: str, df: DataFrame, size: Column) -> DataFrame:
    """Adm2 re-aimed: row count, distinct ids and the min / mean / max of a
    list length (``size``, one value per document), in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_distinct_id"),
        F.min(size).cast("bigint").alias("min_list"),
        F.avg(size).alias("avg_list"),
        F.max(size).cast("bigint").alias("max_list"),
    ).select(F.lit(name).alias("collection"), "*")


def column_stats(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, nulls and distinct values of every column, exactly.

    The columns are unpivoted to (column number, two hashes of the value), so
    distinct values of all columns are counted in one grouping, combined
    map-side and spread over all tasks, and no value itself is shuffled.  Two
    values are one only if 128 bits agree.
    """
    value = lambda c: F.col(c).cast("string")
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).cast("short").alias("i"), F.when(F.col(c).isNotNull(), F.xxhash64(value(c))).alias("a"),
                 F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(1), value(c))).alias("b")) for i, c in enumerate(columns)]))
    values = (df.select(cells.alias("_c")).groupBy("_c.i", "_c.a", "_c.b").agg(F.count(F.lit(1)).alias("n")))
    names = F.array(*[F.lit(c) for c in columns])
    return (values.groupBy("i")
            .agg(F.sum("n").alias("n_rows"),
                 F.coalesce(F.sum(F.when(F.col("a").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
                 F.count("a").alias("n_distinct"))
            .select(F.lit(name).alias("collection"), F.get(names, "i").alias("column"), "n_rows", "n_null", "n_distinct"))


SKETCH_BITS = 12                        # a distinct count's relative standard error is 1.04 / 2**6, about 1.6%


def column_sketches(name: str, df: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """Per part of a collection and column: rows, nulls, least and greatest value
    (as number and as text) and a distinct sketch.  One row per part and column
    moves; written with a collection, they answer ``merged_stats`` without it."""
    def one(c: str) -> Column:
        kind = df.schema[c].dataType.typeName()
        number = F.col(c).cast("double") if kind not in ("string", "array", "map", "struct") else F.lit(None).cast("double")
        text = F.col(c) if kind == "string" else F.lit(None).cast("string")
        return F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(c).isNull()).alias("n_null"),
            F.min(number).alias("min_number"), F.max(number).alias("max_number"),
            F.min(text).alias("min_text"), F.max(text).alias("max_text"),
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_BITS)).alias("sketch"))

    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")
    wide = df.groupBy(part).agg(F.array(*[one(c) for c in columns]).alias("_columns"))
    return wide.select(F.lit(name).alias("collection"), "part", F.inline("_columns"))


def merged_stats(sketches: DataFrame) -> DataFrame:
    """A15 / Adm2 / A14 from stored sketches: exact rows, nulls, least and
    greatest values, and an estimate of the distinct values, of any union of parts."""
    return sketches.groupBy("collection", "column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"),
        F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct_estimate"))
