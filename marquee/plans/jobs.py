"""The denormalisation job and the stored document catalogue.

``denormalize_job`` builds the document tables and writes them once as Parquet
tables in a folder all executors share.  Queries then read the stored tables:
the lineage of the build is cut, and a lost executor costs a re-read of files,
not a re-run of the joins.

Layout, chosen for the queries that read it:

* documents are bucketed by ``id``, links by ``movie_id``: the movies of a
  director are a semi join of two equally bucketed tables, so the movies are
  never shuffled, and the links of one person spread over all buckets;
* links are sorted by person inside a bucket, so row-group statistics skip
  most of the file for a looked-up person;
* ``movies`` is sorted by (year, rank) inside a bucket: statistics skip row
  groups for ``year = y``.  A filter on rank alone is pushed to the scan but
  skips little, as every year holds all ranks.

A manifest written beside the tables holds the bucket count, columns, bucket
and sort keys.  ``attach_catalogue`` declares the tables from it, so a reader
cannot name another bucket count by mistake.
"""

from __future__ import annotations

import contextlib
import math
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee.operators import denormalize
from marquee.session import ensure_checkpoint_dir
from marquee.sources.testdata import Catalog

BUCKET_KEY = {"movies": "id", "directors": "id", "actors": "id",
              "director_movies": "movie_id", "actor_movies": "movie_id"}
SORT_KEYS = {"movies": ["year", "rank"], "directors": ["id"], "actors": ["id"],
             "director_movies": ["id"], "actor_movies": ["id"]}
MANIFEST = "_catalogue_manifest"
MANIFEST_SCHEMA = "kind string, buckets int, bucket_key string, sort_keys array<string>, ddl string"
LINES_PER_TASK = 1_000_000              # with the movies, links and documents that belong to them


def parts_of(cat: Catalog) -> int:
    """Partitions that keep a task's share of the line items the same at any size (rows observed, no column read)."""
    from marquee.sources.files import drain
    seen = Observation("lines")
    drain(cat.raw("lineitem").select().observe(seen, F.count(F.lit(1)).alias("lines")))
    return math.ceil(seen.get["lines"] / LINES_PER_TASK)


def spread(ids: DataFrame, cat: Catalog) -> DataFrame:
    """``ids`` dealt by number, so that what is joined to many of them is not
    merged into as many tasks as there are cores."""
    return ids.repartition(max(parts_of(cat), ids.sparkSession.sparkContext.defaultParallelism), "id")


@contextlib.contextmanager
def shuffled_in(spark: SparkSession, parts: int) -> Iterator[None]:
    """Shuffles of the jobs inside have ``parts`` partitions, none merged."""
    conf = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def denormalize_job(spark: SparkSession, sf_dir: str, buckets: int, out_dir: str | None = None,
                    prefix: str = "den") -> dict[str, str]:
    """Write the document tables; return table names by kind.

    ``buckets``: size it so a bucket file of the movies stays around 0.5-1 GB
    at the target scale.  ``out_dir`` defaults to a new folder under
    ``spark.checkpoint.dir``.
    """
    out_dir = out_dir or os.path.join(ensure_checkpoint_dir(spark), f"catalogue-{uuid.uuid4().hex[:8]}")
    cat = Catalog(spark, sf_dir)
    names, rows = {}, []
    # as many partitions as buckets: tables joined on their bucket key are not dealt again for the write
    with shuffled_in(spark, max(buckets, parts_of(cat))):
        # the movie-genre pairs come from the largest join of the job (line items
        # against parts) and feed two tables: write them once, by movie, read them twice
        pairs = f"{prefix}_movies_genres_{uuid.uuid4().hex[:8]}"
        mg = _bucketed(cat.movies_genres(), buckets, "movie_id", ["movie_id"], os.path.join(out_dir, pairs), pairs)
        for kind, df in denormalize.build_all(cat, movies_genres=mg).items():
            key, name = BUCKET_KEY[kind], f"{prefix}_{kind}"
            _bucketed(df, buckets, key, SORT_KEYS[kind], os.path.join(out_dir, kind), name)
            names[kind] = name
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
            rows.append((kind, buckets, key, SORT_KEYS[kind], ddl))
    spark.sql(f"DROP TABLE {pairs}")                # its files stay, like those of the tables
    # written last: a folder with a manifest is complete
    spark.createDataFrame(rows, MANIFEST_SCHEMA).write.mode("overwrite").json(os.path.join(out_dir, MANIFEST))
    return names


def _bucketed(df: DataFrame, buckets: int, key: str, sort_keys: list[str], path: str, name: str) -> DataFrame:
    (df.repartition(buckets, key)
       .write.mode("overwrite")
       .bucketBy(buckets, key).sortBy(*sort_keys)
       .option("path", path)
       .saveAsTable(name))
    return df.sparkSession.table(name)


def write_parameters(spark: SparkSession, path: str, **values: int) -> None:
    """The numbers that readers of a layout need, written last: a folder that has them is complete."""
    spark.createDataFrame(list(values.items()), "name string, value long").write.json(os.path.join(path, MANIFEST))


def read_parameters(spark: SparkSession, path: str) -> dict[str, int]:
    schema = "name string, value long"
    return {r.name: r.value for r in spark.read.schema(schema).json(os.path.join(path, MANIFEST)).collect()}   # a row each


def export_json(tables: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """The document tables as JSON lines (the interchange format of the
    reference's job), one file per task, never funnelled into one writer."""
    from marquee.sources import files
    paths = {}
    for kind, df in tables.items():
        paths[kind] = os.path.join(out_dir, f"den_{kind}.json")
        files.write_json(df, paths[kind])
    return paths


def open_catalogue(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    return {k: spark.table(v) for k, v in names.items()}


def attach_catalogue(spark: SparkSession, out_dir: str, prefix: str = "den",
                     buckets: int | None = None) -> dict[str, str]:
    """Declare the tables written by ``denormalize_job`` in another session.

    Columns, bucket spec and sort keys come from the manifest.  A ``buckets``
    other than the manifest's, and a table of the same name over another
    folder, are errors: both would give wrong rows without one.
    """
    names = {}
    for m in spark.read.schema(MANIFEST_SCHEMA).json(os.path.join(out_dir, MANIFEST)).collect():  # a row per table
        if buckets is not None and buckets != m.buckets:
            raise ValueError(f"{out_dir} was written with {m.buckets} buckets, not {buckets}")
        name = names[m.kind] = f"{prefix}_{m.kind}"
        path = os.path.join(out_dir, m.kind)
        if spark.catalog.tableExists(name):
            detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
            if _plain(detail.get("Location", "")) != _plain(path) or detail.get("Num Buckets") != str(m.buckets):
                raise ValueError(f"table {name} exists over {detail.get('Location')}; choose another prefix")
            continue
        spark.sql(f"CREATE TABLE {name} ({m.ddl}) USING parquet "
                  f"CLUSTERED BY ({m.bucket_key}) SORTED BY ({', '.join(m.sort_keys)}) INTO {m.buckets} BUCKETS "
                  f"LOCATION '{path}'")
    if set(names) != set(BUCKET_KEY):
        raise ValueError(f"{out_dir} holds no complete catalogue")
    return names


def _plain(path: str) -> str:
    return path.removeprefix("file:").replace("//", "/").rstrip("/")


def materialize(df: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Cut lineage: write to the shared folder and read back."""
    base = base or ensure_checkpoint_dir(df.sparkSession)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
