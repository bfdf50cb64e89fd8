"""File sources and sinks: headerless CSV, JSON lines, Parquet append.

* S1 ``read_source_csv``: the normalised tables arrive as headerless CSV read
  positionally; we give an explicit all-string schema (no inference, no
  extra pass over the data) and type afterwards with ``functions.clean``.
* S2 / S3 ``write_json`` / ``read_json``: JSON-lines interchange of the
  document tables, always with an explicit schema on read.  No
  ``coalesce(1)``: every task writes its own file.
* S1 for a whole catalogue: ``CsvCatalog`` reads the seven source files and
  ``export_sources`` writes them.
* S4 / S5 ``append``: add rows to a Parquet collection and count the rows
  written with an ``Observation`` during that same write (no second pass).
* S9 ``drain``: run a plan to the end without keeping its rows (noop sink).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions.clean import type_table


def read_source_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Headerless CSV with the positional all-string schema of ``table``.

    A header line, if present, is read as data; after typing it shows up as
    a row with null id (lenient) or an error (strict).
    """
    return spark.read.schema(schemas.text_schema(table)).csv(path, header=False)


def write_source_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All columns as text, no header, one file per task."""
    df.select([F.col(c).cast("string").alias(c) for c in df.columns]) \
      .write.mode(mode).csv(path, header=False)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines.  Null fields are omitted by the writer (read back as
    null); empty arrays and maps are kept."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Append rows to a collection; return how many were written.

    The count is an ``Observation`` on the write itself, so the data is
    computed once.
    """
    obs = Observation("append")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").format(fmt).save(path)
    return int(obs.get["rows"])


def drain(df: DataFrame) -> None:
    """Run the whole plan, keep nothing (benchmark sink)."""
    df.write.format("noop").mode("overwrite").save()


class CsvCatalog:
    """The seven source tables read from headerless CSV files, typed.

    Same interface as ``sources.testdata.Catalog`` (``movies()``,
    ``movies_genres()``, ...), so the denormalisation and the queries run
    unchanged on either.  ``mode`` picks lenient (null on bad text) or strict
    (error on bad text) typing.
    """

    def __init__(self, spark: SparkSession, base: str, mode: str = "lenient"):
        self.spark, self.base, self.mode = spark, base, mode

    def table(self, name: str) -> DataFrame:
        return type_table(read_source_csv(self.spark, os.path.join(self.base, name), name),
                          name, self.mode)

    def movies_genres(self, keys: DataFrame | None = None) -> DataFrame:
        pairs = self.table("movies_genres")
        return pairs if keys is None else pairs.join(
            keys.select(F.col("id").alias("movie_id")), "movie_id", "left_semi")

    def __getattr__(self, name: str):
        if name in schemas.SOURCE_COLUMNS:
            return lambda *args, **kw: self.table(name)
        raise AttributeError(name)


def export_sources(cat, base: str, names: tuple[str, ...] = tuple(schemas.SOURCE_COLUMNS)) -> None:
    """Write source tables of a catalogue as headerless CSV under ``base``
    (one folder per table, one file per task)."""
    for name in names:
        write_source_csv(cat.table(name), os.path.join(base, name))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """S3 without a schema: JSON lines as one VARIANT column ``doc``, in which
    a missing field and a null field differ.  Lines that are no JSON are null."""
    from marquee.functions.docops import document
    return spark.read.text(path).select(document("value").alias("doc"))
