"""Best-two-fit packing of tokenized documents into fixed-length sequences.

1. Each document becomes token ids plus an end id, cut into pieces of
   ``capacity`` tokens; only the last piece may be shorter.
2. Pieces are counted by length.  There are at most ``capacity`` lengths, so
   this histogram is bounded at any input size, and the packing is planned on
   it: fill a bin greedily, largest fitting length first; then, as long as it
   helps, replace the bin's smallest piece with the two unpacked pieces whose
   sum fits the widened gap best.  The finished bin is a pattern, repeated for
   as many bins as the counts allow, so a plan has a few patterns per length.
3. Pieces of one length are numbered in parallel (hash blocks of about
   ``BLOCK_ROWS`` pieces, then a running sum over block counts), and a piece's
   number picks its pattern, its bin and its offset.  The plan is the only
   broadcast; its size depends on ``capacity`` alone.  Token ids, where they are
   asked for, stay in the stored pieces meanwhile and join their places once.

Tokenizing looks up whole words in a bounded cache; words out of it go through
the tokenizer's own model, and words with characters beyond the plain Latin
range through the whole tokenizer, so ids equal those of the full text.

Defined cases: null text is empty and gives one piece, the end id; null doc_id
and repeated rows are packed like any other; an empty table gives no rows;
input columns are not carried, except those named in ``carry``.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import common

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
BLOCK_ROWS = 50_000
CACHE_WORDS = 1 << 18
SLICE = 1 << 20                                 # bytes of texts tokenized together
# How the tokenizer's file splits a word, and its byte alphabet.
WORD_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
PLAIN = regex.compile("[!-~¡-ʯ]+")
MARK = "<|"                                     # begins the tokenizer's special strings


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary; it
    is the byte's own character for plain letters, digits and punctuation."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def id_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Token ids (little-endian unsigned 32 bit) of texts, by cached words."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))
        self.model = self.tokenizer.model
        self.letters = str.maketrans(byte_letters())
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def part(self, s: str) -> bytes:
        if (ids := self.parts.get(s)) is None:
            if len(self.parts) >= CACHE_WORDS:
                self.parts.clear()
            letters = s if s.isascii() else s.encode().decode("latin-1").translate(self.letters)
            ids = self.parts[s] = id_bytes([t.id for t in self.model.tokenize(letters)])
        return ids

    def word(self, w: bytes) -> bytes:
        s = w.decode("utf-8", "replace")
        core, tail = (s[:-1], s[-1]) if s[-1] in ".,!?;:" else (s, "")
        low = core.lower()                  # not always letters: a dotted capital I gives a combining mark
        if low.isalpha() and (core.isascii() or PLAIN.fullmatch(core)):      # letters, perhaps one mark
            ids = self.part(low) + (self.part(tail) if tail else b"")
        elif PLAIN.fullmatch(s) and MARK not in s:
            ids = b"".join([self.part(p) for p in WORD_PARTS.findall(s.lower())])
        else:
            ids = id_bytes(self.tokenizer.encode(s, add_special_tokens=False).ids)
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        self.words[w] = ids
        return ids

    def text(self, text: bytes | None) -> bytes:
        get, word = self.words.get, self.word
        return b"".join([get(w) or word(w) for w in (text or b"").split()])


KEY = "_piece_key"                              # a stored piece's own number
PIECE_FIELDS = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]


def tokenize(capacity: int, path: str | None, n_carry: int, with_ids: bool):
    """Rows (text, carried columns...) to one row per piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordIds(path), np.array([END_ID], "<u4").tobytes()
        step, key = 4 * capacity, TaskContext.get().partitionId() << 40
        for b in common.byte_slices(batches, limit=SLICE):
            row, piece, start, length, crc, own = [], [], [], [], [], []
            for i, text in enumerate(b.column(0).cast(pa.binary())):
                ids = words.text(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    own.append(part)
            take = pa.array(row, pa.int64())
            cols = [b.column(j + 1).take(take) for j in range(n_carry)]
            names = [b.schema.field(j + 1).name for j in range(n_carry)]
            cols += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names += ["piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols += [pa.array(own, pa.binary()), pa.array(range(key, key + len(row)), pa.int64())]
                names += ["ids", KEY]
                key += len(row)
            yield pa.RecordBatch.from_arrays(cols, names)
    return run


def pieces(docs: DataFrame, carry: list[str], capacity: int = CAPACITY, path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """``carry`` columns, piece, start, length, ids_crc32 (and ``ids`` as bytes,
    with a key that is a piece's own once the pieces are stored)."""
    carry = [c for c in carry if c in docs.columns]
    src = docs.select(F.col("text"), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)])
    schema = T.StructType([T.StructField(f"_c{i}", docs.schema[c].dataType) for i, c in enumerate(carry)]
                          + PIECE_FIELDS + [T.StructField("ids", T.BinaryType()), T.StructField(KEY, T.LongType())] * with_ids)
    out = src.mapInArrow(tokenize(capacity, path, len(carry), with_ids), schema)
    return out.withColumnsRenamed({f"_c{i}": c for i, c in enumerate(carry)})


class Counts:
    """Pieces left by length."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.lengths = sorted(k for k, n in counts.items() if n > 0)

    def largest(self, gap: int, used: dict[int, int]) -> int:
        """Largest length within ``gap`` that is left after ``used``; 0 if none."""
        i = bisect.bisect_right(self.lengths, gap) - 1
        while i >= 0 and self.left[self.lengths[i]] <= used.get(self.lengths[i], 0):
            i -= 1
        return self.lengths[i] if i >= 0 else 0

    def best_two(self, gap: int, used: dict[int, int]) -> tuple[int, int]:
        """The two lengths left after ``used`` with the largest sum within ``gap``."""
        free = np.array([k for k in self.lengths[:bisect.bisect_right(self.lengths, gap)]
                         if self.left[k] > used.get(k, 0)], dtype=np.int64)
        if not len(free):
            return 0, 0
        j = np.searchsorted(free, gap - free, "right") - 1
        n = np.array([self.left[int(k)] - used.get(int(k), 0) for k in free])
        own = np.arange(len(free))
        j = np.where((j >= own) & (own > 0) & (j == own) & (n < 2), j - 1, j)      # a second of its own kind
        ok = (j >= 0) & ((j != own) | (n >= 2))
        if not ok.any():
            return 0, 0
        sums = np.where(ok, free + free[np.maximum(j, 0)], 0)
        k = int(sums.argmax())
        return int(free[k]), int(free[j[k]])

    def take(self, used: dict[int, int], times: int) -> None:
        for k, n in used.items():
            self.left[k] -= n * times
            if not self.left[k]:
                self.lengths.pop(bisect.bisect_left(self.lengths, k))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Patterns (bins, {length: pieces per bin}) that pack ``counts`` pieces."""
    pool, out = Counts(counts), []
    while pool.lengths:
        used: dict[int, int] = {}
        gap = capacity
        while (k := pool.largest(gap, used)):
            used[k] = used.get(k, 0) + 1
            gap -= k
        while gap and (smallest := min(used)):
            a, b = pool.best_two(gap + smallest, used)
            if a + b <= smallest or not b:
                break
            used[smallest] -= 1
            if not used[smallest]:
                del used[smallest]
            gap += smallest - a - b
            for k in (a, b):
                used[k] = used.get(k, 0) + 1
        times = min(pool.left[k] // n for k, n in used.items())
        pool.take(used, times)
        out.append((times, used))
    return out


def plan_table(patterns: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """Columns, sorted by (length, first number): where the pieces with these
    numbers go.  ``per`` pieces of a bin are of this length, from ``offset`` on."""
    rows, base, seen = [], 0, {}
    for times, used in patterns:
        offset = 0
        for k in sorted(used, reverse=True):
            rows.append((k, seen.get(k, 0), base, used[k], offset))
            seen[k] = seen.get(k, 0) + times * used[k]
            offset += k * used[k]
        base += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "base", "per", "offset"), cols))


def place(table, at_length: int, at_number: int):
    """Adds sequence_id and offset; ``table`` is a broadcast plan table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        bounds = np.searchsorted(t["length"], np.arange(t["length"].max(initial=0) + 2))
        for b in batches:
            length = b.column(at_length).to_numpy(zero_copy_only=False)
            number = b.column(at_number).to_numpy(zero_copy_only=False)
            row = np.empty(len(length), dtype=np.int64)
            for k in np.unique(length):
                mine = length == k
                lo, hi = bounds[k], bounds[k + 1]
                row[mine] = lo + np.searchsorted(t["first"][lo:hi], number[mine], "right") - 1
            since = number - t["first"][row]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:at_number], pa.array(t["base"][row] + since // t["per"][row]),
                 pa.array(t["offset"][row] + since % t["per"][row] * length)],
                [*b.schema.names[:at_number], "sequence_id", "offset"])
    return run


def number(parts: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``parts`` with ``_number``, from 0 within each length, one task per
    block of about BLOCK_ROWS pieces."""
    blocks = parts.sparkSession.createDataFrame(          # one row per length
        [(k, -(-n // BLOCK_ROWS)) for k, n in counts.items()] or [(0, 1)], "length long, _blocks long")
    order = parts.columns
    tagged = (parts.join(F.broadcast(blocks), "length")
              .withColumn("_block", F.pmod(F.xxhash64(*order), F.col("_blocks"))).drop("_blocks"))
    sizes = tagged.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_block").orderBy(*order)
    return (tagged.join(base, ["length", "_block"])
            .withColumn("_number", F.col("_base") + F.row_number().over(inside) - F.lit(1))
            .select(*parts.columns, F.col("_number").cast("long").alias("_number")))


def pack(docs: DataFrame, carry: list[str] | None = None, capacity: int = CAPACITY,
         path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``carry`` columns, piece, start, length, ids_crc32,
    (ids,) sequence_id and offset."""
    spark = docs.sparkSession
    own = {"piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset", "text", KEY}
    carry = [c for c in (carry or ["doc_id"]) if c.lower() not in own]
    parts = common.materialize(pieces(docs, carry, capacity, path, with_ids), "pack-pieces")
    # one row per length: at most ``capacity``
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.sparkContext.broadcast(plan_table(plan(counts, capacity)))
    narrow = parts.drop("ids")                 # token ids move once, when every piece has its place
    schema = T.StructType([*narrow.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    placed = number(narrow, counts).mapInArrow(place(table, narrow.columns.index("length"), len(narrow.columns)), schema)
    if not with_ids:
        return placed
    return parts.join(placed.select(KEY, "sequence_id", "offset"), KEY).drop(KEY)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"), carry=["doc_id"])
