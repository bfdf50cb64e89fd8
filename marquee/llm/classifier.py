"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal.

A text's features are n-grams over two views of its words: the words as they
are (one and two) and their shapes (one, two and three), where a shape keeps a
word's punctuation and turns runs of letters and digits into one sign each, so
unseen words still count.  One more n-gram names how much of the text repeats
earlier three-word windows.  Features are hashed into 2**DIM_BITS weights and
weighed by their share of the text, so a score is a sparse dot product.

Training reads a bounded sample: TRAIN_DOCS labelled documents in hash order
(a documented bound), never one with crc32(doc_id as text) mod 3 = 1.  Their
features are made in parallel; one task runs the follow-the-regularised-leader
updates and returns the weights (4 bytes times 2**DIM_BITS), which are
broadcast.  Scoring reads every whole text once.

Defined cases: null and empty texts score by the bias alone; a null doc_id is
never held out nor trained on; several labels of one doc_id count as their
greatest; no labels give scores of 0.5; repeated rows score alike; an empty
table gives no rows; texts of any length are read whole; input columns named
like an added one are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import common

DIM_BITS = 18
TRAIN_DOCS = 8_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
SCALE = 20.0                          # a text's feature shares sum to this per view
CACHE_WORDS = 1 << 18
RUNS = ((regex.compile(r"\p{Lu}\p{Lu}+"), "B"), (regex.compile(r"\p{Lu}?[\p{Ll}\p{Lo}\p{M}]+|\p{Lu}"), "a"),
        (regex.compile(r"\p{N}+"), "0"))
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
MASK = np.uint64((1 << DIM_BITS) - 1)


def shape(word: str) -> str:
    for pattern, sign in RUNS:
        word = pattern.sub(sign, word)
    return word


class Features:
    """Texts to feature numbers with their weights."""

    def __init__(self):
        self.cache: dict[bytes, bytes] = {}

    def word(self, w: bytes) -> bytes:
        """Hashes of the word and of its shape."""
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        s = shape(w.decode("utf-8", "replace"))
        h = self.cache[w] = xxhash.xxh3_64_digest(w) + xxhash.xxh3_64_digest(s.encode(), seed=1)
        return h

    def __call__(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or b"").split()
        get, word = self.cache.get, self.word
        h = np.frombuffer(b"".join([get(w) or word(w) for w in words]), np.uint64).reshape(-1, 2)
        if not len(h):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        w, s = h[:, 0], h[:, 1]
        views = [w * M1, s * M2, w[:-1] * M1 + w[1:] * M3, s[:-1] * M2 + s[1:] * M3,
                 s[:-2] * M1 + s[1:-1] * M2 + s[2:] * M3]
        windows = w[:-2] * M2 + w[1:-1] * M3 + w[2:] * M1
        repeats = int(10 * (1 - len(np.unique(windows)) / len(windows))) if len(windows) else 0
        views.append(np.array([repeats + 1], dtype=np.uint64) * M3)
        index = np.concatenate([(v ^ (v >> np.uint64(29))) * M1 >> np.uint64(64 - DIM_BITS) for v in views])
        share = np.concatenate([np.full(len(v), SCALE / len(v)) if len(v) else np.zeros(0) for v in views])
        return index.astype(np.int64), share


def texts(batch: pa.RecordBatch, i: int) -> Iterator[bytes | None]:
    return (x.as_py() for x in batch.column(i).cast(pa.binary()))


def training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, label, text) to (place, label, index, share) with summed shares."""
    features = Features()
    for b in batches:
        index, share = [], []
        for x in texts(b, 2):
            i, v = features(x)
            u, at = np.unique(i, return_inverse=True)
            index.append(u.astype(np.int32).tobytes())
            share.append(np.bincount(at, v, len(u)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(index, pa.binary()), pa.array(share, pa.binary())],
            ["place", "label", "index", "share"])


class Ftrl:
    """FTRL-proximal logistic regression; the last weight is the bias."""

    def __init__(self, dim: int):
        self.z, self.n = np.zeros(dim + 1), np.zeros(dim + 1)

    def weights(self, i: np.ndarray) -> np.ndarray:
        z = self.z[i]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[i])) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, i: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(i)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[i] = n + g * g


def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole bounded sample, sorted by place, to one row of weights."""
    dim = 1 << DIM_BITS
    rows = [(int(y), np.append(np.frombuffer(i, np.int32), dim), np.append(np.frombuffer(v, np.float32), 1.0))
            for b in batches
            for y, i, v in zip(*(b.column(c).to_pylist() for c in ("label", "index", "share")))]
    model = Ftrl(dim)
    for _ in range(EPOCHS):
        for y, i, v in rows:
            model.learn(i, v, y)
    w = model.weights(np.arange(dim + 1)).astype(np.float32)
    yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], ["weights"])


def score(weights):
    """(text column last) to the carried columns and ``score``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, w = Features(), weights.value
        for b in batches:
            out = []
            for x in texts(b, b.num_columns - 1):
                i, v = features(x)
                out.append(1 / (1 + np.exp(-np.clip(w[i] @ v + w[-1], -35, 35))))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.float64())],
                                             [*b.schema.names[:-1], "score"])
    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(3) == F.lit(1), F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> np.ndarray:
    """Weights learnt from ``train_docs`` labelled rows outside the held-out fold."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
             .withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(train_docs))
    sample = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")     # at most train_docs rows
              .select("place", "label", "text")
              .mapInArrow(training_rows, "place long, label int, index binary, share binary"))
    # a doc_id that many rows repeat is one training row
    sample = (sample.groupBy("place", "label").agg(F.min(F.struct("index", "share")).alias("_x"))
              .select("place", "label", "_x.index", "_x.share"))
    rows = (sample.repartition(1).sortWithinPartitions("place")                   # the bounded sample
            .mapInArrow(train, "weights binary").collect())
    return np.frombuffer(rows[0].weights, np.float32) if rows else np.zeros((1 << DIM_BITS) + 1, np.float32)


def classify(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None,
             train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``carry`` columns, held_out, score (0 to 1) and predicted."""
    docs = common.drop_clashes(docs, ["held_out", "score", "predicted"])
    carry = carry or ["doc_id"]
    weights = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, train_docs))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry) + ", score double"
    scored = docs.select(*[F.col(f"`{c}`") for c in carry], "text").mapInArrow(score(weights), schema)
    return scored.select(*[F.col(f"`{c}`") for c in carry], held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
