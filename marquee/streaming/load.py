"""Incremental load of document files into a collection (S3 + S4).

The reference reads JSON-lines exports and inserts them into a collection.
Here that load is a Structured Streaming query: a file source over the export
folder, an ``availableNow`` trigger, and a batch writer that puts batch ``b``
into the partition ``batch=b`` of the Parquet collection, replacing whatever a
failed attempt left there.  The checkpoint belongs to the collection (it lies
inside it, where readers ignore it), so every load of one collection continues
the same log: files already loaded are not loaded twice, new files are picked
up, and no load can start over at batch 0 on a collection that has rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHECKPOINT = "_load_checkpoint"


def load_documents(spark: SparkSession, src_dir: str, schema: StructType, table_path: str,
                   max_files_per_batch: int | None = None) -> int:
    """Append every not-yet-loaded JSON-lines file of ``src_dir`` to the
    Parquet collection at ``table_path``; return the rows written by this run.

    The rows are counted on the write of each batch, so the count is exact
    for any number of batches.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    written = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal written
        seen = Observation()
        (batch.observe(seen, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").parquet(os.path.join(table_path, f"batch={batch_id}")))
        written += int(seen.get["rows"])

    q = (reader.json(src_dir).writeStream.foreachBatch(write)
         .option("checkpointLocation", os.path.join(table_path, CHECKPOINT))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return written


def read_collection(spark: SparkSession, schema: StructType, table_path: str) -> DataFrame:
    """The rows of a loaded collection, without the batch they came in."""
    return spark.read.parquet(table_path).select(*schema.fieldNames())
