"""Line dedup by range-partitioned hashes.

1. Every line whose key (stripped of ASCII space, A-Z lower-cased) is long
   enough becomes a narrow row (hash, document, position); texts stay where
   they are.
2. The rows are range-partitioned and sorted by (hash, document descending,
   position), so equal keys are neighbours and the first document of a run is
   the one that keeps its lines.  The range includes the document: a line that
   a third of all documents hold is spread over many tasks.
3. A first pass over the sorted, stored rows reports what a task cannot see
   alone: the run at either edge of its rows (two rows a task), with its
   leading distinct documents.  Merged by hash, these edges are broadcast; their
   number is bounded by twice the number of tasks.
4. A second pass streams the runs, keeping the first occurrence's document and
   emitting the other lines' positions.  Only a run's second document is held
   back until a third one is seen (or the edge table already knows).
5. Positions are gathered per document into a zlib-compressed keep bitmap, and
   the bitmap, not text, joins back to the document.

Keys are compared by two 64-bit hashes.  A document is its doc_id: rows with
the same doc_id count as one document and share decisions when their texts are
equal.  Defined cases: null or empty text is one empty line; null doc_id counts
as one document below all others; repeated rows keep or lose the same lines;
an empty table gives no rows; long texts are handled line by line; input
columns named like an added one are replaced by it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import common

MIN_CHARS = 20
MIN_DOCS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDED = ["n_lines", "n_dropped", "keep"]
NO_ID = -(1 << 63)                     # stands for a null doc_id: below every other
EDGE_SCHEMA = "h1 long, h2 long, doc long"
DROP_SCHEMA = "doc long, t long, pos int, n int"


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(common.SPACE_CHARS)), UPPER, LOWER)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def row_key(df: DataFrame) -> DataFrame:
    """With _doc and _t, which name a document row: its id and its text's hash."""
    return df.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                           "_t": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc, t, pos, n) of every line that may be dropped."""
    d = row_key(docs.select("doc_id", "text"))
    d = d.select("_doc", "_t", F.size(split_lines(F.col("text"))).alias("n"),
                 F.posexplode(split_lines(F.col("text"))).alias("pos", "_line"))
    d = d.withColumn("_key", line_key(F.col("_line"))).filter(F.length("_key") >= min_chars)
    return d.select(F.xxhash64("_key").alias("h1"), F.xxhash64(F.lit(1), "_key").alias("h2"),
                    F.col("_doc").alias("doc"), F.col("_t").alias("t"), "pos", "n")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Sorted rows as numpy columns with the starts of (hash) and (hash, doc) runs;
    a run may go on in the next batch."""
    for b in batches:
        if b.num_rows:
            yield tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns))


def edge_runs(min_docs: int):
    """Per task: the leading ``min_docs`` documents of its first and last hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = None, None                 # (h1, h2, [docs])
        for h1, h2, doc, *_ in _runs(batches):
            starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            ends = np.r_[starts[1:], len(h1)]
            for k in sorted({0, len(starts) - 1}):
                s, e = starts[k], ends[k]
                key = (int(h1[s]), int(h2[s]))
                part = doc[s:e]
                docs = part[np.r_[True, part[1:] != part[:-1]]][:min_docs].tolist()
                if last is not None and last[0] == key:
                    last[1].extend(x for x in docs if x not in last[1])
                    del last[1][min_docs:]
                else:
                    last = (key, docs)
                if first is None:
                    first = last
        out = [] if first is None else [first] if first is last else [first, last]
        rows = [(k[0], k[1], d) for k, docs in out for d in docs]
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["h1", "h2", "doc"])
    return run


def dropped_lines(min_docs: int, edges):
    """Stream a task's runs; ``edges`` (a broadcast) maps an edge hash to
    (largest document, whether enough documents hold it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = edges.value
        key, keeper, enough, seen, held = None, 0, False, [], []
        for h1, h2, doc, t, pos, n in _runs(batches):
            new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            starts = np.flatnonzero(new)
            ends = np.r_[starts[1:], len(h1)]
            out: list[np.ndarray] = []
            # runs inside the batch that hold one row drop nothing
            for k in np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(h1))):
                s, e = int(starts[k]), int(ends[k])
                if (this := (int(h1[s]), int(h2[s]))) != key:
                    key, held, seen = this, [], []
                    if this in known:
                        keeper, enough = known[this]
                    else:
                        keeper, enough = int(doc[s]), False
                part = doc[s:e]
                if not enough:
                    distinct = part[np.r_[True, part[1:] != part[:-1]]][:min_docs].tolist()
                    seen = (seen + [x for x in distinct if x not in seen])[:min_docs]
                    enough = len(seen) >= min_docs and key not in known
                rows = s + np.flatnonzero(part != keeper)
                if enough:
                    out += [*held, np.stack([doc[rows], t[rows], pos[rows], n[rows]])]
                    held = []
                elif key not in known:           # at most the lines of min_docs - 2 documents
                    held.append(np.stack([doc[rows], t[rows], pos[rows], n[rows]]))
            if out:
                d, tt, p, nn = np.concatenate(out, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d), pa.array(tt), pa.array(p.astype("int32")), pa.array(nn.astype("int32"))],
                    ["doc", "t", "pos", "n"])
    return run


def find_dropped(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, t, pos, n): the lines to drop, with their document's number of lines."""
    spark = docs.sparkSession
    lines = common.materialize(hashed_lines(docs, min_chars), "line-hashes")
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("t"), F.col("pos")]
    # checkpoint() keeps each task's rows together and in order for both passes
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    merged = (ordered.mapInArrow(edge_runs(min_docs), EDGE_SCHEMA).distinct()
              .groupBy("h1", "h2").agg(F.max("doc").alias("keeper"), F.count(F.lit(1)).alias("n")))
    # at most two hashes a task
    known = {(r.h1, r.h2): (r.keeper, r.n >= min_docs) for r in merged.collect()}
    edges = spark.sparkContext.broadcast(known)
    return ordered.mapInArrow(dropped_lines(min_docs, edges), DROP_SCHEMA)


@F.pandas_udf(T.BinaryType())
def keep_bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    """Compressed keep bitmap of a document: one bit a line, 0 where dropped."""
    def one(n: int, positions: np.ndarray) -> bytes:
        keep = np.ones(n, dtype=np.uint8)
        keep[positions] = 0
        return zlib.compress(np.packbits(keep).tobytes())
    return pd.Series([one(n, p) for n, p in zip(n_lines, dropped)], dtype=object)


def kept(text: str | None, bitmap: bytes | None) -> str:
    """The text's kept lines; a null bitmap keeps all."""
    if bitmap is None:
        return text or ""
    lines = (text or "").split("\n")
    mask = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return "\n".join(x for x, k in zip(lines, mask) if k)


@F.pandas_udf(T.StringType())
def kept_text(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    return pd.Series([kept(x, b) for x, b in zip(text, bitmap)], dtype=object)


@F.pandas_udf(T.StringType())
def kept_sha256(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    return pd.Series([hashlib.sha256(kept(x, b).encode()).hexdigest() for x, b in zip(text, bitmap)], dtype=object)


def bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, t, n_dropped, keep) for the documents that lose lines.

    A group holds positions of one document's own lines.
    """
    return (find_dropped(docs, min_chars, min_docs).groupBy("doc", "t")
            .agg(F.collect_set("pos").alias("_pos"), F.max("n").alias("_n"))
            .select("doc", "t", F.size("_pos").cast("long").alias("n_dropped"),
                    keep_bitmap("_n", "_pos").alias("keep")))


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of ``docs`` plus n_lines, n_dropped and ``keep``, the
    compressed keep bitmap (null where every line stays)."""
    docs = common.drop_clashes(docs, ADDED)
    found = bitmaps(docs, min_chars, min_docs)
    keyed = row_key(docs).withColumn("n_lines", F.size(split_lines(F.col("text"))).cast("long"))
    joined = keyed.join(found, (F.col("_doc") == F.col("doc")) & (F.col("_t") == F.col("t")), "left")
    return joined.select(*[keyed[c] for c in docs.columns], "n_lines",
                         F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", kept_sha256("text", "keep").alias("kept_sha256"))


LINE_DEDUP_SQL = rf"""
with l as (
  select rid, doc_id, unnest(ln) line, generate_subscripts(ln, 1) pos
  from (select row_number() over () rid, doc_id, string_split(coalesce(text, ''), chr(10)) ln from documents)),
k as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{UPPER}', '{LOWER}') key from l),
f as (
  select key, max(coalesce(doc_id, {NO_ID})) keeper from k where length(key) >= {MIN_CHARS}
  group by key having count(distinct coalesce(doc_id, {NO_ID})) >= {MIN_DOCS}),
m as (
  select k.*, f.key is not null and coalesce(doc_id, {NO_ID}) <> keeper dropped from k left join f using (key))
select any_value(doc_id) doc_id, count(*) n_lines, cast(sum(dropped::int) as bigint) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) kept_sha256
from m group by rid
"""
