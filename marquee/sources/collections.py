"""Collections that change: versions, keyed loads, deltas and compaction.

A collection is a folder of Parquet data, dealt to ``buckets`` by a hash of the
key, and small version files.  A version names the data folders that make up the
collection; data is only ever added, never changed in place:

* a write puts its data in a new folder, then commits a version file that did
  not exist before.  A write that dies in between leaves the old version as it
  was, and two writers that start from one version cannot both commit;
* ``read(as_of=...)`` answers as of any version;
* ``load`` refuses rows whose key is stored already, or replaces the stored
  ones, rewriting only the buckets the batch touches (S4, S5 with keys);
* ``append`` adds rows as deltas; ``compact`` merges the buckets that have any
  and leaves the folders of the others as they are.

A version file is renamed into place, which is atomic on HDFS-like file systems;
an object store needs a table format of its own.  Spark reads and writes all
data; the driver handles one line per bucket and folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources import files

BUCKET = "_bucket"
FILES = 4                               # of a bucket, at most, in one write


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class Collection:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "id", buckets: int = 16):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets
        jvm = spark.sparkContext._jvm
        self._place = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._place(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- versions ------------------------------------------------------------

    def _file(self, version: int) -> str:
        return f"{self.path}/_versions/{version:010d}.json"

    def version(self) -> int:
        """The latest version; 0 before the first commit."""
        folder = self._place(f"{self.path}/_versions")
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max([int(n[:10]) for n in names if n.endswith(".json") and not n.startswith("_")], default=0)

    def parts(self, version: int) -> list[dict]:
        """{bucket, folder, rows} of a version."""
        if not version:
            return []
        stream = self._fs.open(self._place(self._file(version)))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, parts: list[dict], base: int) -> int:
        """The next version, if ``base`` is still the latest."""
        tmp, dst = self._place(f"{self.path}/_versions/_{uuid.uuid4().hex}"), self._place(self._file(base + 1))
        out = self._fs.create(tmp, False)
        out.write(bytearray(json.dumps(parts).encode()))
        out.close()
        if self.version() != base or self._fs.exists(dst) or not self._fs.rename(tmp, dst):
            self._fs.delete(tmp, False)
            raise Conflict(f"version {base + 1} of {self.path} exists")
        return base + 1

    # -- data ------------------------------------------------------------------

    def _rows(self, parts: list[dict]) -> DataFrame:
        folders = [f"{self.path}/{p['folder']}/{BUCKET}={p['bucket']}" for p in parts]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, as_of: int | None = None) -> DataFrame:
        return self._rows(self.parts(self.version() if as_of is None else as_of))

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame) -> list[dict]:
        """New data folders of ``df``; at most one line per bucket comes back."""
        folder = f"data-{uuid.uuid4().hex[:12]}"
        path = f"{self.path}/{folder}"
        seen = Observation(folder)
        per_bucket = [F.count_if(F.col(BUCKET) == k).alias(str(k)) for k in range(self.buckets)]
        plain = [c for c in self.schema.names if not _is_map(self.schema[c].dataType)]
        (df.select(*self.schema.names, self._bucket().alias(BUCKET))
         .repartition(BUCKET, F.pmod(F.xxhash64(*plain), F.lit(FILES)))
         .observe(seen, *per_bucket).write.partitionBy(BUCKET).parquet(path))
        rows = {k: int(seen.get[str(k)]) for k in range(self.buckets)}
        return [{"bucket": k, "folder": folder, "rows": n} for k, n in rows.items() if n]

    def append(self, df: DataFrame) -> int:
        """Adds rows as they are (deltas, for ``compact`` to merge)."""
        base = self.version()
        return self.commit(self.parts(base) + self._write(df), base)

    def rewrite(self, change: Callable[[DataFrame], DataFrame]) -> int:
        """A whole collection changed in one commit (a type repair, say)."""
        base = self.version()
        return self.commit(self._write(change(self.read(base))), base)

    def load(self, batch: DataFrame, replace: bool = False) -> dict[str, int]:
        """Rows by key: {version, loaded, refused, replaced}.

        A key is loaded once: of several rows in the batch the first in the
        order of their text, the others are refused, like rows without a key.
        Stored keys are refused too, or replaced by the batch's row.
        """
        base = self.version()
        old = self.parts(base)
        incoming = f"{self.path}/incoming-{uuid.uuid4().hex[:12]}"        # the batch, computed once
        n = files.append(batch.select(*self.schema.names), incoming)
        first = self.spark.read.schema(self.schema).parquet(incoming).filter(F.col(self.key).isNotNull()).withColumn("_text", F.to_json(F.struct(*self.schema.names)))
        # the least row of a key per task before the shuffle: a key that a third of the batch repeats stays small
        first = (first.groupBy(self.key).agg(F.min_by(F.struct(*self.schema.names), "_text").alias("_row"))
                 .select("_row.*"))
        keys = self.read(base).select(self.key)
        if not replace:
            new = self._write(first.join(keys, self.key, "left_anti"))
            loaded, parts, replaced = sum(p["rows"] for p in new), old + new, 0
        else:
            fresh = self._write(first)
            touched = {p["bucket"] for p in fresh}
            stay = [p for p in old if p["bucket"] in touched]
            kept = self._write(self._rows(stay).join(self._rows(fresh).select(self.key), self.key, "left_anti"))
            loaded = sum(p["rows"] for p in fresh)
            replaced = sum(p["rows"] for p in stay) - sum(p["rows"] for p in kept)
            parts = [p for p in old if p["bucket"] not in touched] + kept + fresh
        return {"version": self.commit(parts, base), "loaded": loaded, "refused": n - loaded,
                "replaced": replaced}

    def compact(self, merge: Callable[[DataFrame], DataFrame]) -> int:
        """Merges the buckets that hold several folders; the others keep theirs."""
        base = self.version()
        parts = self.parts(base)
        several = {p["bucket"] for p in parts if sum(q["bucket"] == p["bucket"] for q in parts) > 1}
        stay = [p for p in parts if p["bucket"] not in several]
        merged = self._write(merge(self._rows([p for p in parts if p["bucket"] in several])))
        return self.commit(stay + merged, base)


def _is_map(kind: T.DataType) -> bool:
    """Maps cannot be hashed."""
    if isinstance(kind, T.ArrayType):
        return _is_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_is_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)
