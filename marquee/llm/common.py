"""Helpers the operators share: words, row keys, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path

# ASCII white space separates words, nothing else does.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as long; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS + "+")), F.lit(0)).cast("long")


WRITTEN: list[str] = []                 # paths of this process's stored tables, in order


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write under the shared folder, read back.

    A lost executor later costs a re-read of these files only.  The folder is
    scratch space of the job (``spark.checkpoint.dir``).
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Gives back the space of stored tables that nothing will read again."""
    for p in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def broadcast_if_small(stored: DataFrame, max_rows: int) -> DataFrame:
    """A stored table, marked for broadcast when it has at most ``max_rows``
    rows; beyond that the join shuffles it like any other."""
    return stored.hint("broadcast") if stored.count() <= max_rows else stored


def drop_clashes(df: DataFrame, names: list[str]) -> DataFrame:
    """Without the columns whose names an operator is about to add."""
    own = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in own])


def key_text(c: Column) -> Column:
    """A join and grouping key that keeps null apart from every value."""
    return F.coalesce(F.concat(F.lit("s"), c.cast("string")), F.lit("n"))




def byte_slices(batches: Iterator[pa.RecordBatch], column: int = 0, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts have about ``limit`` bytes
    (at least one row each): Arrow counts rows, a task's memory holds bytes."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
        yield from (b.slice(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:]) if hi > lo)


def tree_sum(vectors: DataFrame, parts: int, dtype: str, fan: int = 64) -> DataFrame:
    """(key long, part long, vector binary) to (key, vector): the vectors of all
    parts added, ``fan`` of one key in a task at each level, in the order of
    their parts, so a rerun adds alike.  ``parts`` bounds the part numbers."""
    def add(t: pa.Table) -> pa.Table:
        rows = sorted(zip(t.column("part").to_pylist(), t.column("vector").to_pylist()), key=lambda r: r[0])
        total = np.sum([np.frombuffer(v, dtype) for _, v in rows], axis=0, dtype=dtype)
        return pa.table({"key": t.column("key")[:1], "part": t.column("up")[:1],
                         "vector": pa.array([total.tobytes()], pa.binary())})

    while True:
        vectors = (vectors.withColumn("up", F.floor(F.col("part") / fan)).groupBy("key", "up")
                   .applyInArrow(add, "key long, part long, vector binary"))
        parts = -(-parts // fan)
        if parts <= 1:
            return vectors.select("key", "vector")
